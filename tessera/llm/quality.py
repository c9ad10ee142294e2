"""Quality classifier: a factorisation machine over hashed words, word shapes and structure statistics.

The score is the logistic of  b + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),  so a text
costs time linear in its features.  The model has a fixed size (DIMENSIONS by RANK), whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rolling, lower_bytes, text_blocks, trim, word_spans

WORDS = 1 << 15  #: places for hashed words
SHAPES = 1 << 12  #: places for hashed word shapes
STATS = 20
DIMENSIONS = WORDS + SHAPES + STATS
RANK = 6
#: The model is fitted on this many labelled rows at most, those of the smallest hash.
SAMPLE_ROWS = 8000

#: Bytes by class, for word shapes: letters to A or a, digits to 0, bytes from 0x80 on to a; others stay.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[128:] = ord("a")


def _per_text(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)[:n]


def features(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of the texts that lie in ``data`` one after the other, each closed by a line feed:
    (pointers, places, values).  An empty text has its statistics only."""
    n = len(ends)
    start, stop = word_spans(data)
    owner = np.searchsorted(ends, start, side="right")
    words = np.maximum(np.bincount(owner, minlength=n)[:n], 1)
    word = Rolling(lower_bytes(data)).spans(start, stop)
    shape_data = _CLASS[data]
    first = np.zeros(len(data) + 1, bool)
    first[start] = True
    keep = np.concatenate([[True], shape_data[1:] != shape_data[:-1]]) | first[: len(data)]
    place = np.concatenate([[0], np.cumsum(keep)])
    shape = Rolling(shape_data[keep]).spans(place[start], place[stop])

    place = np.concatenate([(word % np.uint64(WORDS)).astype(np.int64), (shape % np.uint64(SHAPES)).astype(np.int64) + WORDS])
    both = np.concatenate([owner, owner])
    cell, count = np.unique(both * DIMENSIONS + place, return_counts=True)
    row, column = cell // DIMENSIONS, cell % DIMENSIONS
    value = np.sqrt(count / words[row])

    text_of = np.repeat(np.arange(n), np.diff(np.concatenate([[0], ends])))
    size = np.maximum(np.diff(np.concatenate([[0], ends])) - 1, 0)
    total = np.maximum(size, 1)
    of = lambda mask: _per_text(mask.astype(np.float64), text_of, n)
    upper, digit, line = of((data >= 65) & (data <= 90)), of((data >= 48) & (data <= 57)), of(data == 10)
    letter = of(((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128))
    white = of(np.isin(data, [32, 9, 10, 11, 12, 13]))
    lengths = (stop - start).astype(np.float64)
    again = np.concatenate([[False], (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])])
    distinct = np.bincount(_distinct_owner(owner, word), minlength=n)[:n]
    top = np.zeros(n)
    np.maximum.at(top, row, np.where(column < WORDS, count, 0))
    no_letter = _lettered(data, start, stop) == 0
    stats = np.stack(
        [
            np.log1p(size) / 10, np.log1p(words) / 8, np.log1p(line) / 5, upper / total, digit / total, letter / total,
            white / total, (total - letter - digit - white) / total, distinct / words, top / words,
            _per_text(again, owner, n) / words, _per_text(lengths, owner, n) / words / 10,
            _per_text(no_letter, owner, n) / words, np.log1p(words / np.maximum(line, 1)) / 8,
            upper / np.maximum(letter, 1), of(data == 33) / words, of(data == 124) / words, of(np.isin(data, [35, 36, 37, 38, 42])) / words,
            (size == 0).astype(float), np.ones(n),
        ]
    )
    row = np.concatenate([row, np.repeat(np.arange(n), STATS)])
    column = np.concatenate([column, np.tile(np.arange(STATS) + WORDS + SHAPES, n)])
    value = np.concatenate([value, stats.T.ravel()])
    order = np.argsort(row, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]), column[order].astype(np.int32), value[order].astype(np.float32)


def _distinct_owner(owner: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The owner of each distinct (owner, word)."""
    order = np.lexsort((word, owner))
    o, w = owner[order], word[order]
    return o[np.concatenate([[True], (o[1:] != o[:-1]) | (w[1:] != w[:-1])])] if len(o) else o


def _lettered(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """1 for words with a letter or a byte from 0x80 on."""
    letter = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128)
    total = np.concatenate([[0], np.cumsum(letter)])
    return (total[stop] > total[start]).astype(np.int8)


class Machine:
    """A factorisation machine: bias, linear weights and RANK factors a feature."""

    def __init__(self, bias: float = 0.0, linear: np.ndarray | None = None, factor: np.ndarray | None = None):
        self.bias = bias
        self.linear = np.zeros(DIMENSIONS, np.float32) if linear is None else linear
        self.factor = np.zeros((DIMENSIONS, RANK), np.float32) if factor is None else factor

    def margin(self, pointer: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Margins of sparse rows, none of them empty."""
        cut = pointer[:-1]
        scaled = self.factor[place] * value[:, None]
        total = np.add.reduceat(scaled, cut, axis=0)
        squares = np.add.reduceat((scaled**2).sum(1), cut)
        return self.bias + np.add.reduceat(self.linear[place] * value, cut) + 0.5 * ((total**2).sum(1) - squares)

    def score(self, pointer: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(pointer, place, value).astype(np.float64), -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, rate: float = 0.1, batch: int = 64, decay: float = 2e-5, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss.  rows: (places, values) each; without rows every score is 0.5."""
    model = Machine()
    if not rows:
        return model
    rng = np.random.default_rng(seed)
    model.factor = rng.normal(0, 0.02, (DIMENSIONS, RANK)).astype(np.float32)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    model.bias = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_b = np.full(DIMENSIONS, 1e-3, np.float32), np.full((DIMENSIONS, RANK), 1e-3, np.float32), 1e-3
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            place = np.concatenate([rows[i][0] for i in pick])
            value = np.concatenate([rows[i][1] for i in pick])
            size = np.array([len(rows[i][0]) for i in pick])
            pointer = np.concatenate([[0], np.cumsum(size)])
            owner = np.repeat(np.arange(len(pick)), size)
            scaled = model.factor[place] * value[:, None]
            total = np.add.reduceat(scaled, pointer[:-1], axis=0)
            slope = (model.score(pointer, place, value) - labels[pick]) / len(pick)
            # Gradients by feature, then one adaptive step.
            used, back = np.unique(place, return_inverse=True)
            pull = (slope[owner] * value).astype(np.float32)
            g_w = np.bincount(back, weights=pull, minlength=len(used)).astype(np.float32) + decay * model.linear[used]
            each = pull[:, None] * (total[owner] - scaled)
            g_v = np.stack([np.bincount(back, weights=each[:, f], minlength=len(used)) for f in range(RANK)], axis=1).astype(np.float32) + decay * model.factor[used]
            g_b = float(slope.sum())
            seen_w[used] += g_w**2
            seen_v[used] += g_v**2
            seen_b += g_b**2
            model.linear[used] -= rate * g_w / np.sqrt(seen_w[used])
            model.factor[used] -= 0.5 * rate * g_v / np.sqrt(seen_v[used])
            model.bias -= rate * g_b / np.sqrt(seen_b)
    return model


def _remainder(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4


def _sparse(docs: DataFrame, key: str) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, data, ends in text_blocks(batch.column(1)):
                pointer, place, value = features(data, ends)
                offsets = pa.array(pointer.astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), pa.ListArray.from_arrays(offsets, pa.array(place)), pa.ListArray.from_arrays(offsets, pa.array(value))], [key, "place", "value"])

    return docs.select(key, "text").mapInArrow(run, f"{key} {kind}, place array<int>, value array<float>")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on the labelled rows whose crc32(doc_id as text) mod 4 isn't 2, at most ``sample_rows`` of them,
    taken by hash.  labels: doc_id, quality (null qualities and ids are left out, one label a doc_id)."""
    known = labels.filter((_remainder("doc_id") != 2) & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = {r["doc_id"]: r["quality"] for r in known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).collect()}
    if not chosen:
        return fit([], np.zeros(0))
    spark = docs.sparkSession
    ids = spark.createDataFrame([(k,) for k in chosen], labels.select("doc_id").schema)
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # sample_rows rows at most
    got = _gather(_sparse(texts, "doc_id"))
    keys = sorted(got, key=repr)
    return fit([got[k] for k in keys], np.array([chosen[k] for k in keys], np.float64))


def _gather(sparse: DataFrame) -> dict:
    """The sample's rows on the driver: at most sample_rows of them (one for each doc_id)."""
    found: dict = {}
    for batch in sparse.toArrow().to_batches():
        places, values = batch.column(1), batch.column(2)
        for i, key in enumerate(batch.column(0).to_pylist()):
            row = (places[i].values.to_numpy().copy(), values[i].values.to_numpy().copy())
            old = found.get(key)
            if old is None or (len(row[0]), row[0].tobytes()) < (len(old[0]), old[0].tobytes()):
                found[key] = row
    return found


def score_documents(docs: DataFrame, model: Machine, threshold: float = 0.7) -> DataFrame:
    """docs' rows with ``score`` and ``predicted``; texts are read whole, null ones as empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.linear, model.factor))  # fixed size
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("score", "predicted")])
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    at_text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*shared.value)
        for batch in batches:
            found = [machine.score(*features(data, ends)) for _, _, data, ends in text_blocks(batch.column(at_text), 1 << 20)]
            score = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=schema.names)
        trim()

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with score and predicted.  Null and empty texts are scored by their statistics; without usable
    labels every score is 0.5; repeated rows are scored each; further columns pass through unread,
    but for older columns named score or predicted, which are replaced."""
    return score_documents(docs, train(docs, labels, sample_rows), threshold)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_documents(docs, model)
    return scored.select("doc_id", F.coalesce(_remainder("doc_id") == 2, F.lit(False)).alias("held_out"), "score", "predicted")
