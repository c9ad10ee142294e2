"""Language-model scoring: a hierarchical Pitman-Yor model of word pairs.

Each word that precedes another has a restaurant; its dishes are the words that follow.  All these restaurants
share one parent, the restaurant of single words, whose customers are their tables, and whose own base is
uniform over the training words and one unknown.  Seatings are sampled by Gibbs (seating.py draws each dish's
tables from their exact conditional, whatever its customers); a round seats all dishes under the tables and parent
probabilities that the round before left, all restaurants at once, and its tables become the customers of the
word restaurant.  A text is scored with the predictive probability averaged over the rounds after BURN; each
round's discount and back-off come from the same seating, so every context's probabilities sum to 1.

The corpus is learnt over blocks of documents.  A block sends its distinct words and pairs, hashed and packed, to
the parts that own them; these add up the counts and answer in the same order, so an answer needs no keys.  Each
pair is then written down once, by the first block that has it; the rounds run over these rows alone and exchange
tables by word.  The last pass reads the texts again: random numbers are hashes of the dish and the round, so every
block draws the same tables for a pair as the block that wrote it down.  Nothing of the corpus' size is broadcast
or collected; the driver sees a few sums a part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Rolling, mix, stash, unstash, word_spans
from .packed import ROWS, batch, deal_sorted, home_column, pack, small, unbatch, undeal, unpack, unsmall
from .seating import seat

END = np.uint64(0x1D8AF066F21B9A35)  #: the hash that stands for the end of a text
PART_BYTES = 8 << 20  #: text bytes in a block
ROUNDS, BURN = 3, 1  #: from two rounds to three the held-out perplexity changes by 0.3 %
#: Strengths of the pair and the word restaurants; the discounts come from counts of counts.
STRENGTH_PAIR, STRENGTH_WORD = 1.0, 10.0
WORD, PAIR, STATS, OWN, TABLES = range(5)  #: kinds of rows; TABLES + r: those of round r


def held_out(doc_id: Column | str) -> Column:
    """Rows that nothing is learnt from: crc32(doc_id as text) mod 7 is 2 (never for a null doc_id)."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


class Block:
    """A block's tokens as places in its sorted distinct words and pairs.

    words, pairs: hashes; word_count, pair_count: places in training texts; word_of, pair_of, owner: of each token;
    left, right: of each pair, places in words.  END precedes a text's first word and is its last token."""

    def __init__(self, docs: pa.Table):
        texts = [t or b"" for t in docs["text"].cast(pa.large_binary()).to_pylist()]
        raw = b"\n".join([*texts, b""]).lower()
        start, stop = word_spans(np.frombuffer(raw, np.uint8))
        owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
        hashes, code = _word_hashes(raw, start, stop)
        self.words, rank = np.unique(np.append(hashes, END), return_inverse=True)
        n = self.docs = len(texts)
        word = np.full(len(code) + n, rank[-1])
        word[np.arange(len(code)) + owner] = rank[code]
        self.word_of = word
        self.owner = np.repeat(np.arange(n), np.bincount(owner, minlength=n) + 1)
        before = np.concatenate([rank[-1:], word[:-1]]) if len(word) else word
        with np.errstate(over="ignore"):
            hashed = mix(mix(self.words)[before] + self.words[word])
        self.pairs, self.pair_of = np.unique(hashed, return_inverse=True)
        self.left, self.right = np.zeros((2, len(self.pairs)), np.int64)
        self.left[self.pair_of], self.right[self.pair_of] = before, word
        known = np.array(docs["_train"].to_pylist(), bool)[self.owner]
        self.word_count = np.bincount(word[known], minlength=len(self.words))
        self.pair_count = np.bincount(self.pair_of[known], minlength=len(self.pairs))


def _word_hashes(raw: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of distinct words, and of each word the place of its hash."""
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edges = np.stack([start, stop], 1).ravel()  # words and, between them, white space
    both = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(raw)]).dictionary_encode()
    code = both.indices.to_numpy()[::2]
    offsets = np.frombuffer(both.dictionary.buffers()[1], np.int64, len(both.dictionary) + 1)
    hashes = Rolling(np.frombuffer(both.dictionary.buffers()[2], np.uint8, offsets[-1])).spans(offsets[:-1], offsets[1:])
    used = np.zeros(len(hashes), bool)
    used[code] = True
    return hashes[used], (np.cumsum(used) - 1)[code]


def _counts(parts: int):
    def run(docs: pa.Table) -> pa.Table:
        block, src = Block(docs), docs["_part"][0].as_py()
        rows = [*deal_sorted(WORD, block.words, [block.word_count], parts, src), *deal_sorted(PAIR, block.pairs, [block.pair_count], parts, src)]
        return pa.Table.from_batches([batch(rows)])

    return run


class Owned:
    """What blocks sent of one kind to the part that owns the keys: sorted by block, grouped by key."""

    def __init__(self, table: pa.Table, kind: int, columns: int):
        rows = sorted((r[2], r[3]) for r in unbatch(table) if r[1] == kind)
        self.src = [r[0] for r in rows]
        got = [undeal(r[1], columns) for r in rows]
        self.cut = np.cumsum([0, *(len(g[0]) for g in got)]).tolist()
        key, *self.columns = ([np.concatenate(c) for c in zip(*got, strict=True)] or [np.zeros(0, np.uint64)]) if got else [np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * columns]
        self.key, self.group = np.unique(key, return_inverse=True)
        first = np.zeros(len(self.key), np.int64)
        first[self.group[::-1]] = np.arange(len(key))[::-1]
        self.first = np.zeros(len(key), bool)
        self.first[first] = True

    def total(self, i: int) -> np.ndarray:
        return np.rint(np.bincount(self.group, weights=self.columns[i], minlength=len(self.key))).astype(np.int64)

    def answer(self, kind: int, own: int, *columns: np.ndarray) -> list:
        """A row for each block, its columns in the order in which the block sent its keys."""
        return [(src, kind, own, b"".join(small(c[a:b]) for c in columns)) for src, a, b in zip(self.src, self.cut[:-1], self.cut[1:], strict=True)]


def _add_counts(table: pa.Table) -> pa.Table:
    own, rows, stats = table["part"][0].as_py(), [], []
    for kind in (WORD, PAIR):
        got = Owned(table, kind, 1)
        total = got.total(0)
        rows += got.answer(kind, own, 2 * total[got.group] + got.first)
        stats += [total.sum(), (total > 0).sum()] if kind == WORD else [(total == 1).sum(), (total == 2).sum()]
    return pa.Table.from_batches([batch([*rows, (-1, STATS, 0, np.array(stats, np.int64).tobytes())])])


def _heard(rows: list, kind: int, columns: int, n: int) -> list[np.ndarray]:
    """The columns that the owners' answers hold, each as long as what the block had asked."""
    got = []
    for _, blob in sorted((r[2], r[3]) for r in rows if r[1] == kind):
        at, some = 0, []
        for _ in range(columns):
            column, at = unsmall(blob, at)
            some.append(column)
        got.append(some)
    out = [np.concatenate(c) for c in zip(*got, strict=True)] if got else [np.zeros(0, np.int64)] * columns
    if any(len(c) != n for c in out):
        raise ValueError(f"a block asked for {n} keys and was told of {len(out[0])}")
    return out


def _own_pairs(docs: pa.Table, told: pa.Table) -> pa.Table:
    """The pairs that the block is the first to have, with their counts over the corpus."""
    if not docs.num_rows:
        return pa.Table.from_batches([batch([])])
    block, rows = Block(docs), unbatch(told)
    value, = _heard(rows, PAIR, 1, len(block.pairs))
    own = np.flatnonzero((value & 1 == 1) & (value > 1))
    width = max(1, (len(block.words).bit_length() + 7) // 8)
    parts = [pack((block.words, 8)), pack((block.left[own], width), (block.right[own], width)), small(value[own] >> 1)]
    lengths = np.array([len(parts[0]), len(parts[1]), width], np.int64).tobytes()
    return pa.Table.from_batches([batch([(docs["_part"][0].as_py(), OWN, 0, lengths + b"".join(parts))])])


def _read_own(blob: bytes) -> tuple[np.ndarray, ...]:
    a, b, width = np.frombuffer(blob, np.int64, 3).tolist()
    words, = unpack(blob[24 : 24 + a], 8)
    left, right = (x.astype(np.int64) for x in unpack(blob[24 + a : 24 + a + b], width, width))
    with np.errstate(over="ignore"):
        pairs = mix(mix(words)[left] + words[right])
    return words, pairs, left, right, unsmall(blob, 24 + a + b)[0]


def word_chance(customers: np.ndarray, tables: np.ndarray, at: dict) -> np.ndarray:
    """Predictive probabilities of the word restaurant; at: its sums in that round."""
    base = 1 / (at["v"] + 1)
    return (np.maximum(customers - at["d1"] * tables, 0) + (STRENGTH_WORD + at["d1"] * at["t"]) * base) / (STRENGTH_WORD + at["c"])


def seatings(pairs: np.ndarray, customers: np.ndarray, left: np.ndarray, right: np.ndarray, words: list, at: list[dict]):
    """Tables of each pair, round by round from the first (one each): words has, for each round before, the tables of
    each word's restaurant, and its customers and tables in the word restaurant; at: that round's sums."""
    tables = (customers > 0).astype(np.int64)
    yield tables
    some = np.flatnonzero(customers > 1)
    pairs, customers, left, right = pairs[some], customers[some], left[some], right[some]
    for r, (rooms, eaters, own) in enumerate(words):
        parent = word_chance(eaters, own, at[r])
        tables = tables.copy()
        tables[some] = seat(pairs, customers, parent[right], rooms[left] - tables[some], at[r]["d2"], STRENGTH_PAIR, r)
        yield tables


def chances(customers, left, right, seated, words, context, at) -> np.ndarray:
    """Predictive probability of each pair in one round: seated, words and at are that round's; context: customers
    of each word's restaurant."""
    rooms, eaters, own = words
    rest = (STRENGTH_PAIR + at["d2"] * rooms) / (STRENGTH_PAIR + context)
    rest[context == 0] = 1
    return np.maximum(customers - at["d2"] * seated, 0) / (STRENGTH_PAIR + context[left]) + rest[left] * word_chance(eaters, own, at)[right]


def _seat_pairs(parts: int, at: list[dict]):
    """A round over the pairs written down: sums of their tables by preceding word and by word, to the words'
    owners, with each word's own tables of the round before."""

    def run(own: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        for src, _, _, blob in unbatch(own):
            words, pairs, left, right, count = _read_own(blob)
            heard = [_heard(unbatch(told), TABLES + r, 3, len(words)) for r in range(len(at))]
            for tables in seatings(pairs, count, left, right, heard, at):
                pass
            sums = [np.bincount(side, weights=tables, minlength=len(words)).astype(np.int64) for side in (left, right)]
            rows += deal_sorted(TABLES, words, [*sums, heard[-1][2] if heard else np.zeros(len(words), np.int64)], parts, src)
        return pa.Table.from_batches([batch(rows)])

    return run


def _seat_words(at: list[dict], v: int):
    def run(table: pa.Table) -> pa.Table:
        got, r = Owned(table, TABLES, 3), len(at)
        rooms, eaters = got.total(0), got.total(1)
        before = np.zeros(len(got.key), np.int64)
        before[got.group] = got.columns[2]
        tables = (eaters > 0).astype(np.int64)
        if at:
            tables = seat(got.key, eaters, np.full(len(eaters), 1 / (v + 1)), at[-1]["t"] - before, at[-1]["d1"], STRENGTH_WORD, 1000 + r)
        sums = np.array([eaters.sum(), tables.sum(), (eaters == 1).sum(), (eaters == 2).sum()], np.int64)
        rows = got.answer(TABLES + r, table["part"][0].as_py(), *(x[got.group] for x in (rooms, eaters, tables)))
        return pa.Table.from_batches([batch([*rows, (-1, STATS, 0, sums.tobytes())])])

    return run


def averaged(block: Block, rows: list, at: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of a block's words; its pairs' predictive probabilities averaged over the rounds after BURN."""
    words = _heard(rows, WORD, 1, len(block.words))[0] >> 1
    pairs = _heard(rows, PAIR, 1, len(block.pairs))[0] >> 1
    heard = [_heard(rows, TABLES + r, 3, len(block.words)) for r in range(len(at))]
    chance = np.zeros(len(block.pairs))
    for r, seated in enumerate(seatings(block.pairs, pairs, block.left, block.right, heard[:-1], at)):
        if r > BURN:
            chance += chances(pairs, block.left, block.right, seated, heard[r], words, at[r]) / (len(at) - 1 - BURN)
    return words, chance


def _score(schema: T.StructType, at: list[dict]):
    arrow = to_arrow_schema(schema)

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return arrow.empty_table()
        block = Block(docs)
        words, chance = averaged(block, unbatch(told), at)
        total, types = at[0]["n"], at[0]["v"]
        base = np.log10((words + 1) / (total + types + 1))
        n = block.docs
        made = {
            "n_tokens": np.bincount(block.owner, minlength=n),
            "n_known": np.bincount(block.owner, weights=words[block.word_of] > 0, minlength=n).astype(np.int64),
            "train_tokens": np.full(n, total),
            "base_score": np.bincount(block.owner, weights=base[block.word_of], minlength=n),
            "score": np.bincount(block.owner, weights=np.log10(chance)[block.pair_of], minlength=n),
        }
        return pa.table([docs["doc_id"], pc.invert(docs["_train"]), *[pa.array(made[k]) for k in arrow.names[2:]]], schema=arrow)

    return run


def _stats(told: DataFrame) -> list[int]:
    """The sum of a few numbers a part."""
    rows = [np.frombuffer(bytes(r["packed"]), np.int64) for r in told.filter(F.col("kind") == STATS).select("packed").collect()]
    return np.sum(rows, axis=0).tolist() if rows else [0, 0, 0, 0]


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def score_texts(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs (doc_id, text).

    Learns from the rows for which ``held`` is false.  Null and empty texts are one end token; repeated rows count
    each; a null doc_id is never held out; an empty table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    held = held_out("doc_id") if held is None else held
    total, = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (total or 0) // PART_BYTES) | 1
    number = F.coalesce(F.xxhash64("doc_id", F.substring("text", 1, 64)), F.lit(0))
    rows = docs.select("doc_id", "text", (~held).alias("_train"), home_column(number, parts).alias("_part"))
    counted = stash(rows.groupBy("_part").applyInArrow(_counts(parts), ROWS).groupBy("part").applyInArrow(_add_counts, ROWS))
    n, v, once, twice = _stats(counted)
    counts = counted.filter("part >= 0")
    own = stash(rows.groupBy("_part").cogroup(counts.groupBy("part")).applyInArrow(_own_pairs, ROWS))
    at: list[dict] = []
    told = own.limit(0)
    heard = []
    for r in range(ROUNDS + 1):
        sent = own.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_seat_pairs(parts, list(at)), ROWS)
        heard.append(stash(sent.groupBy("part").applyInArrow(_seat_words(list(at), v), ROWS)))
        c, t, single, double = _stats(heard[-1])
        at.append({"n": n, "v": v, "c": c, "t": t, "d2": _discount(once, twice), "d1": at[0]["d1"] if at else _discount(single, double)})
        answers = heard[-1].filter("part >= 0")
        told = told.unionByName(answers) if r else answers
    unstash(own)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("held_out", T.BooleanType())] + [T.StructField(k, T.LongType()) for k in ("n_tokens", "n_known", "train_tokens")] + [T.StructField(k, T.DoubleType()) for k in ("base_score", "score")])
    scored = stash(rows.groupBy("_part").cogroup(counts.unionByName(told).groupBy("part")).applyInArrow(_score(schema, at), schema))
    for done in (counted, *heard):
        unstash(done)
    return scored


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, n_tokens, perplexity) of scored texts."""
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))


def op3_lm(spark, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
