"""Suffix-array dedup: a depth-limited radix sort over the suffixes of all texts, distributed.

Suffixes are ordered only through WIDTH bytes, by most-significant-digit passes, and a suffix leaves as soon as
nobody shares its digits; the groups that are equal after the last pass are exactly the repeated windows.

* The first digit of a window is its smallest GRAM-byte substring by hash (the same for equal windows, wherever
  it lies), so only a few places a text, its anchors, are sorted in the first pass.  The bytes around an anchor
  that any of its windows can reach, its context, are sorted with it: where a smaller document has the same
  context, every window of the anchor is a repeat.
* Only anchors whose group holds several contexts go on to the last pass, with one document for each context;
  there whole windows are sorted.

Digits are compared by 64-bit hashes of their bytes: an anchor with its context, a window with its anchor's part.
Records travel as packed arrays, first folded inside a task (of equal records the smallest document's is kept,
the others are repeats already), so a passage in very many documents costs a task one record.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Rolling, mix, stash, text_blocks, trim, unstash
from .packed import ROWS, Row, batch, deal, gather, home, home_column, pack, unbatch

WIDTH, GRAM = 50, 24
HELD = 3_000_000  #: records that a task folds at once
PART_BYTES = 6 << 20  #: text bytes in a part
SLICE = BLOCK = 1 << 20  #: bytes hashed at once; an array of 8 bytes each takes 8 MB, some twenty live together


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of each run of ``width`` values, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[: len(x) - width + 1], out[width - have :]) if have < width else out


class Anchors:
    """Anchors of texts that lie in ``data`` one after the other, closed by one byte each.

    at: places; key: 64-bit hash of the gram; context: of all that its windows reach; owner: text number;
    least: for every place the key of the window that starts there, 0 where none does."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, width: int = WIDTH, gram: int = GRAM):
        self.width, self.reach = width, width - gram
        starts = np.concatenate([[0], ends[:-1]])
        close = ends - 1  # without the closing byte
        parts: list[tuple[np.ndarray, ...]] = []
        self.least = np.zeros(len(data), np.uint64)
        for low in range(0, len(data), SLICE):
            a, b = max(0, low - 2 * width), min(len(data), low + SLICE + 2 * width)
            rolling = Rolling(data[a:b])
            grams = rolling.windows(gram)
            if len(grams) <= self.reach:
                continue
            least = _slide(grams, self.reach + 1, np.minimum)
            place = np.arange(a, a + len(least))
            owner = np.searchsorted(ends, place, side="right")
            least[place + width > close[np.minimum(owner, len(ends) - 1)]] = 0  # windows never cross documents
            own = min(low + SLICE, a + len(least))
            if own > low:
                self.least[low:own] = least[low - a : own - a]
            padded = np.concatenate([np.zeros(self.reach, np.uint64), least, np.zeros(self.reach, np.uint64)])
            at = np.flatnonzero((_slide(padded, self.reach + 1, np.maximum) == grams) & (grams != 0)) + a
            at = at[(at >= low) & (at < low + SLICE)]
            owner = np.searchsorted(ends, at, side="right")
            left, right = np.maximum(starts[owner], at - self.reach), np.minimum(close[owner], at + width)
            context = mix(rolling.spans(left - a, right - a) + (at - left).astype(np.uint64))
            parts.append((at, grams[at - a], context, owner, left, right))
        none = np.zeros(0, np.int64)
        joined = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [none, none.astype(np.uint64), none.astype(np.uint64), none, none, none]
        self.at, self.key, self.context, self.owner, self.left, self.right = joined


def _pair(key: np.ndarray, context: np.ndarray) -> np.ndarray:
    """An anchor with its context in 64 bits."""
    return mix(key ^ mix(context))


#: Kinds of packed rows: first-pass records; anchors that are repeats; anchors whose windows are wanted;
#: last-pass windows; spans to remove.
FIRST, REPEAT, WANTED, WINDOW, SPAN = range(5)


def _firsts(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (a, b, id) and, in that order, whether a row has the smallest id of its (a, b)."""
    order = np.lexsort((ids, b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    group = np.cumsum(new) - 1
    return order, ids[order] == ids[order][np.flatnonzero(new)][group] if len(order) else new


def _first_pass(parts: int):
    def flush(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, context, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        order, least = _firsts(key, context, ids)
        key, context, ids = key[order], context[order], ids[order]
        other = np.flatnonzero(~least)
        rows = [*deal(REPEAT, home(ids[other], parts), (ids[other], 0), (_pair(key[other], context[other]), 8))]
        # One record for each (key, context): repeats inside one text need none.
        new = np.flatnonzero(least & np.concatenate([[True], (key[1:] != key[:-1]) | (context[1:] != context[:-1])]))
        part = (key[new] % np.uint64(parts)).astype(np.int64)
        rows += deal(FIRST, part, (key[new], 8), (context[new], 8), (ids[new], 0))
        return batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for some in batches:
            ids = some.column(0).to_numpy()
            for at, n, data, ends in text_blocks(some.column(1), BLOCK):
                found = Anchors(data, ends)
                held.append((found.key, found.context, ids[at : at + n][found.owner]))
                count += len(found.key)
                if count > HELD:
                    yield flush(held)
                    held, count = [], 0
        if held:
            yield flush(held)
        held.clear()
        trim()

    return run


def _first_sort(parts: int):
    def run(table: pa.Table) -> pa.Table:
        every = unbatch(table)
        rows = [r for r in every if r[1] != FIRST]
        key, context, ids = gather([r[3] for r in every if r[1] == FIRST], 8, 8, 0)
        order, least = _firsts(key, context, ids)
        key, context, ids = key[order], context[order], ids[order]
        again = ~least
        rows += deal(REPEAT, home(ids[again], parts), (ids[again], 0), (_pair(key[again], context[again]), 8))
        # Groups of several contexts: the smallest document of each context shows its windows.
        start = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        group = np.cumsum(start) - 1
        fresh = np.concatenate([[True], (context[1:] != context[:-1]) | start[1:]]) if len(key) else start
        several = (np.bincount(group, weights=fresh) > 1)[group] if len(key) else start
        wanted = several & fresh
        rows += deal(WANTED, home(ids[wanted], parts), (ids[wanted], 0), (key[wanted], 8))
        return pa.Table.from_batches([batch(rows)])

    return run


def _match(owner: np.ndarray, key: np.ndarray, ids: np.ndarray, told_ids: np.ndarray, told_key: np.ndarray) -> np.ndarray:
    """Rows (owner: a number into ids) whose (id, key) was told."""
    if not len(told_key) or not len(key):
        return np.zeros(len(key), bool)
    known = np.unique(ids)
    where = np.searchsorted(known, told_ids)
    where = np.minimum(where, len(known) - 1)
    good = known[where] == told_ids
    with np.errstate(over="ignore"):
        told = mix(told_key[good] + mix(where[good].astype(np.uint64)))
        mine = mix(key + mix(np.searchsorted(known, ids).astype(np.uint64))[owner])
    return np.isin(mine, told)


def _last_pass(parts: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        every = unbatch(told)
        repeat = gather([r[3] for r in every if r[1] == REPEAT], 0, 8)
        wanted = gather([r[3] for r in every if r[1] == WANTED], 0, 8)
        rows: list[Row] = []
        windows: list[tuple[np.ndarray, ...]] = []
        if docs.num_rows and (len(repeat[0]) or len(wanted[0])):
            all_ids = docs["doc_id"].to_numpy()
            for at, n, data, ends in text_blocks(docs["text"].combine_chunks(), BLOCK):
                ids = all_ids[at : at + n]
                found = Anchors(data, ends)
                start = np.concatenate([[0], ends[:-1]])
                hit = np.flatnonzero(_match(found.owner, _pair(found.key, found.context), ids, *repeat))
                low, high, owner = found.left[hit], found.right[hit], found.owner[hit]
                mark = _text_marks(data, ends)
                rows += deal(SPAN, home(ids[owner], parts), (ids[owner], 0), (mark[owner], 4), (low - start[owner], 5), (high - start[owner], 5))
                # Windows whose smallest gram is a wanted anchor; those inside one single context that goes are
                # shown by a smaller document, so they needn't be shown again.  A window over the junction of two
                # contexts may be in no smaller document.
                upto = np.zeros(len(data) + 1, np.int64)
                np.maximum.at(upto, low, high)
                upto = np.maximum.accumulate(upto)
                hit = np.flatnonzero(_match(found.owner, found.key, ids, *wanted))
                first = np.maximum(start[found.owner[hit]], found.at[hit] - (WIDTH - GRAM))
                size = found.at[hit] - first + 1
                total = np.cumsum(size)
                place = np.arange(total[-1] if len(total) else 0) + np.repeat(first - (total - size), size)
                anchor = np.repeat(hit, size)
                good = found.least[place] == found.key[anchor]
                place, anchor = place[good], anchor[good]
                good = upto[place] < place + WIDTH
                place, anchor = place[good], anchor[good]
                if len(place):
                    owner = found.owner[anchor]
                    windows.append((Rolling(data).spans(place, place + WIDTH), found.key[anchor], ids[owner], mark[owner], place - start[owner]))
        if windows:
            key, anchor, ids, mark, place = (np.concatenate(x) for x in zip(*windows, strict=True))
            least = np.zeros(len(key), bool)
            order, first = _firsts(key, np.zeros(len(key), np.uint64), ids)
            least[order] = first
            done = ~least
            rows += deal(SPAN, home(ids[done], parts), (ids[done], 0), (mark[done], 4), (place[done], 5), (place[done] + WIDTH, 5))
            # Runs of windows of one anchor and text: a head each, and the windows' keys one after the other.
            key, anchor, ids, mark, place = key[least], anchor[least], ids[least], mark[least], place[least]
            part = (anchor % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.concatenate([[0], np.flatnonzero(np.diff(part[order])) + 1, [len(order)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                own = order[a:b]
                new = np.ones(len(own), bool)
                new[1:] = (ids[own][1:] != ids[own][:-1]) | (mark[own][1:] != mark[own][:-1]) | (place[own][1:] != place[own][:-1] + 1)
                head = own[new]
                length = np.diff(np.concatenate([np.flatnonzero(new), [len(own)]]))
                if len(own):
                    heads = pack((ids[head], 0), (mark[head], 4), (place[head], 5), (length, 4))
                    rows.append((int(part[own[0]]), WINDOW, len(heads), heads + pack((key[own], 8))))
            del windows, key, anchor, ids, mark, place, order
        trim()
        return pa.Table.from_batches([batch(rows)])

    return run


def _text_marks(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """32 bits of each text's hash: rows of one doc_id and different texts aren't mixed up."""
    return Rolling(data).spans(np.concatenate([[0], ends[:-1]]), ends - 1) >> np.uint64(32)


def _last_sort(parts: int):
    def run(table: pa.Table) -> pa.Table:
        every = unbatch(table)
        rows = [r for r in every if r[1] == SPAN]
        shown = [r for r in every if r[1] == WINDOW]
        ids, mark, place, length = gather([r[3][: r[2]] for r in shown], 0, 4, 5, 4)
        key, = gather([r[3][r[2] :] for r in shown], 8)
        length = length.astype(np.int64)
        inside = np.arange(len(key)) - np.repeat(np.cumsum(length) - length, length)
        ids, mark, place = np.repeat(ids, length), np.repeat(mark, length), np.repeat(place, length) + inside.astype(np.uint64)
        order, least = _firsts(key, np.zeros(len(key), np.uint64), ids)
        again = order[~least]
        rows += deal(SPAN, home(ids[again], parts), (ids[again], 0), (mark[again], 4), (place[again], 5), (place[again] + np.uint64(WIDTH), 5))
        return pa.Table.from_batches([batch(rows)])

    return run


_COUNTS = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())]


def _apply(schema: T.StructType):
    """Take the spans out: counts, the digest of what stays, and what stays where the schema has ``kept``."""
    arrow = to_arrow_schema(schema)
    with_text = "kept" in schema.names

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return arrow.empty_table()
        ids, mark, low, high = gather(told["packed"].to_pylist(), 0, 4, 5, 5)
        all_ids = docs["doc_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, mark, low, high = ids[order], mark[order], low[order].astype(np.int64), high[order].astype(np.int64)
        out: list[tuple] = []
        for at, n, data, ends in text_blocks(docs["text"].combine_chunks(), BLOCK):
            start = np.concatenate([[0], ends[:-1]])
            marks = _text_marks(data, ends)
            own = all_ids[at : at + n]
            first, last = np.searchsorted(ids, own), np.searchsorted(ids, own, side="right")
            for i in range(n):
                text = data[start[i] : ends[i] - 1]
                size, removed, spans = len(text), 0, 0
                mine = np.arange(first[i], last[i])
                mine = mine[mark[mine] == marks[i]]
                if len(mine):
                    change = np.bincount(low[mine], minlength=size + 1) - np.bincount(high[mine], minlength=size + 1)
                    gone = np.cumsum(change[:-1]) > 0
                    removed = int(gone.sum())
                    spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                    text = text[~gone]
                kept = text.tobytes()
                row = (size, removed, spans, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept.decode("utf-8", "ignore")) if with_text else row)
        made = [pa.array(c, arrow.field(len(arrow) - len(out[0]) + i).type) for i, c in enumerate(zip(*out, strict=True))]
        return pa.Table.from_arrays([*[docs[c] for c in arrow.names[: -len(made)]], *made], schema=arrow)

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """docs' rows (doc_id, text and what else there is) without ``text``, with n_bytes, n_removed, n_spans,
    kept_sha256 and, if asked for, ``kept``: the text without its repeats, cut characters left out.

    A byte goes when a WIDTH-byte string over it also starts in a document of a smaller doc_id.  Null texts count
    as empty; texts shorter than WIDTH lose nothing; rows of one doc_id never remove from each other; rows
    without a doc_id lose nothing and remove nothing; a doc_id that is no whole number is an error.  Older columns of
    the new names are replaced.
    """
    spark = docs.sparkSession
    made = [*_COUNTS, *([T.StructField("kept", T.StringType())] if with_text else [])]
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise ValueError("doc_id must be a whole number")
    taken = {f.name.lower() for f in made} | {"_part"}
    docs = docs.select(*[F.col(c).cast("long").alias("doc_id") if c == "doc_id" else F.col(c) for c in docs.columns if c.lower() not in taken])
    others = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*others, *made])
    known = docs.filter("doc_id IS NOT NULL")
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PART_BYTES) | 1
    told = known.select("doc_id", "text").mapInArrow(_first_pass(parts), ROWS).groupBy("part").applyInArrow(_first_sort(parts), ROWS)
    told = first = stash(told)
    homed = known.select("doc_id", "text", home_column(F.col("doc_id"), parts).alias("_part"))
    told = homed.groupBy("_part").cogroup(told.groupBy("part")).applyInArrow(_last_pass(parts), ROWS)
    told = stash(told.groupBy("part").applyInArrow(_last_sort(parts), ROWS))
    unstash(first)
    homed = known.withColumn("_part", home_column(F.col("doc_id"), parts))
    found = homed.groupBy("_part").cogroup(told.groupBy("part")).applyInArrow(_apply(schema), schema)
    lost = docs.filter("doc_id IS NULL")
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    plain = [F.octet_length(raw).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256")]
    rest = lost.select(*[f.name for f in others], *plain, *([F.coalesce("text", F.lit("")).alias("kept")] if with_text else []))
    return found.unionByName(rest)


def op6_repeats(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
