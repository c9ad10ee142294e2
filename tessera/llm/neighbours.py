"""Approximate nearest neighbours by learned partitions.

On a bounded sample: an exact neighbour graph, a balanced partitioning of it (few edges cut, parts of nearly
equal size), and a small network that learns a vector's part from itself and its neighbours.  Every row is
indexed in the part the network finds most probable; a query goes to its several most probable parts, where all
vectors are compared exactly.  The number of parts visited is the least that finds TARGET of the neighbours of
vectors of the sample that the router was not fitted on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash
from .vectors import answers, best_rows, finite, fold, matrix

#: Distinct vectors that the index is fitted on: SAMPLE_SHARE for each part, within these bounds.
SAMPLE_ROWS, SAMPLE_MOST, SAMPLE_SHARE = 4096, 65536, 16
PART_ROWS, LEAST_PARTS = 2048, 8  #: rows that a part should have; the fewest parts
HELD = 5  #: one of so many vectors of the sample chooses the number of visits and is not learnt from
TARGET = 0.95  #: of these vectors' neighbours that routing must reach
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 16384


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def neighbour_graph(x: np.ndarray, degree: int = 10) -> np.ndarray:
    """Row numbers of each row's nearest others by cosine."""
    n = len(x)
    degree = min(degree, n - 1)
    found = np.zeros((n, degree), np.int64)
    for at in range(0, n, 1024):
        near = x[at : at + 1024] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        found[at : at + 1024] = np.argpartition(-near, max(0, degree - 1), axis=1)[:, :degree] if degree else 0
    return found


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1, seed: int = 5) -> np.ndarray:
    """A part for each row: halved along main directions to begin with, then rows move to the part that most of
    their neighbours are in, the largest gains first and only while that part has room."""
    rng = np.random.default_rng(seed)
    part = np.zeros(len(x), np.int64)
    todo = [(np.arange(len(x)), 0, parts)]
    while todo:
        rows, first, share = todo.pop()
        if share == 1 or len(rows) < 2:
            part[rows] = first
            continue
        cut = x[rows] - x[rows].mean(0)
        way = rng.normal(size=x.shape[1])
        for _ in range(8):
            way = cut.T @ (cut @ way)
            way /= np.sqrt((way**2).sum()) + 1e-30
        order = rows[np.argsort(cut @ way, kind="stable")]
        half = share // 2
        at = len(rows) * half // share
        todo += [(order[:at], first, half), (order[at:], first + half, share - half)]
    room = int(slack * len(x) / parts) + 1
    both = np.concatenate([graph, np.zeros((len(x), 0), np.int64)], axis=1)
    for _ in range(rounds):
        votes = np.zeros((len(x), parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(len(x)), both.shape[1]), part[both].ravel()), 1)
        np.add.at(votes, (both.ravel(), np.repeat(part, both.shape[1])), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """One hidden layer; logits of the parts."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights = weights

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def learn(x: np.ndarray, aim: np.ndarray, hidden: int = 96, epochs: int = 25, batch: int = 256, rate: float = 4e-3, seed: int = 11) -> Router:
    """Adam on the cross entropy with ``aim``, each row's distribution over parts."""
    rng = np.random.default_rng(seed)
    width, parts = x.shape[1], aim.shape[1]
    weights = [rng.normal(0, np.sqrt(2 / width), (width, hidden)) * np.sqrt(width), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            h = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            z = h @ weights[2] + weights[3]
            z = np.exp(z - z.max(1, keepdims=True))
            d = (z / z.sum(1, keepdims=True) - aim[rows]) / len(rows)
            dh = (d @ weights[2].T) * (h > 0)
            slopes = [x[rows].T @ dh, dh.sum(0), h.T @ d, d.sum(0)]
            t += 1
            for i, g in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g**2
                weights[i] -= rate * (1 - epoch / epochs) * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    return Router(weights)


def fit_index(sample: np.ndarray, parts: int, k: int = 5) -> tuple[Router, int]:
    """The router and how many parts a query visits."""
    x = unit(sample)
    held = np.arange(len(x)) % HELD == HELD - 1
    known = x[~held]
    graph = neighbour_graph(known)
    part = balanced_parts(known, graph, parts)
    aim = np.zeros((len(known), parts))
    np.add.at(aim, (np.arange(len(known)), part), 2.0)
    np.add.at(aim, (np.repeat(np.arange(len(known)), graph.shape[1]), part[graph].ravel()), 1.0)
    router = learn(known, aim / aim.sum(1, keepdims=True))
    return router, needed_visits(router, x, np.flatnonzero(held), parts, k)


def needed_visits(router: Router, x: np.ndarray, asked: np.ndarray, parts: int, k: int) -> int:
    """The fewest most probable parts that hold TARGET of the k nearest rows of x to its rows ``asked``."""
    order = np.argsort(-router.logits(x), axis=1)
    home, place = order[:, 0], np.argsort(order[asked], axis=1)  # place: rank of each part in a row's order
    ranks = []
    for at in range(0, len(asked), 1024):
        some = asked[at : at + 1024]
        near = x[some] @ x.T
        near[np.arange(len(some)), some] = -np.inf
        width = min(k, len(x) - 1)
        best = np.argpartition(-near, max(0, width - 1), axis=1)[:, :width]
        ranks.append(place[at : at + 1024][np.arange(len(some))[:, None], home[best]].ravel())
    rank = np.concatenate(ranks) if ranks else np.zeros(0, int)
    return next((m + 1 for m in range(parts) if len(rank) and (rank <= m).mean() >= TARGET), parts)


def pair_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows, pair by pair, in double precision."""
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 5, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of other ids that routing finds, by cosine.

    queries, candidates: (vec_id, vector), finite vectors of one length other than zero.  Equal vectors are
    folded and indexed once, so copies load no part; parts of many rows are searched in bounded blocks, each of
    which returns a query's best k + 1.  Ties go to the smaller vec_id; with k or fewer candidates all are returned;
    empty tables give an empty result.  Fewer than 2 * SAMPLE_SHARE distinct vectors are one part.
    """
    folded = stash(fold(candidates, k + 1).withColumn("_v", F.monotonically_increasing_id()))
    asked = stash(fold(queries, 1).withColumn("_q", F.monotonically_increasing_id()))
    total = folded.count()
    parts = min(max(LEAST_PARTS, total // part_rows), SAMPLE_MOST // SAMPLE_SHARE, max(1, total // SAMPLE_SHARE))
    rows = max(SAMPLE_ROWS, SAMPLE_SHARE * parts)
    taken = folded.orderBy("_h1", "_h2").limit(rows).select("vector").toArrow()  # SAMPLE_MOST rows at most
    weights, visits = None, 1
    if parts > 1:
        router, visits = fit_index(matrix(taken["vector"], np.float64), parts, k)
        weights = router.weights
    shared = folded.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    def route(width: int):
        def run(batches):
            for batch in batches:
                x = matrix(batch.column(batch.schema.get_field_index("vector")), np.float64)
                if shared.value is None or not len(x):
                    best = np.zeros((len(x), 1), np.int64)
                else:
                    logits = Router(shared.value).logits(unit(x))
                    best = np.argsort(-logits, axis=1, kind="stable")[:, :width]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, best.size + 1, best.shape[1], dtype=np.int32)), pa.array(best.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "_parts"])

        return run

    kind = candidates.schema["vec_id"].dataType.simpleString()
    placed = folded.select("_v", F.element_at("ids", 1).alias("_least"), "_h1", "vector").mapInArrow(route(1), f"_v long, _least {kind}, _h1 long, vector array<double>, _parts array<int>")
    placed = stash(placed.select("_v", "_least", "_h1", "vector", F.element_at("_parts", 1).alias("_p")))
    sizes = placed.groupBy("_p").agg(F.ceil(F.count(F.lit(1)) / CANDIDATE_BLOCK).cast("int").alias("_n"))  # a row a part
    sent = asked.select("_q", "_h1", "vector").mapInArrow(route(visits), "_q long, _h1 long, vector array<double>, _parts array<int>")
    ways = max(1, -(-asked.count() * visits // (parts * QUERY_BLOCK)))
    left = (
        sent.select("_q", "vector", F.pmod("_h1", F.lit(ways)).cast("int").alias("_a"), F.explode("_parts").alias("_p"))
        .join(F.broadcast(sizes), "_p")  # a row a part
        .withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    )
    right = placed.join(F.broadcast(sizes), "_p").select("_v", "_least", "vector", "_p", F.pmod("_h1", F.col("_n")).cast("int").alias("_b")).withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))

    def cell(one: pa.Table, other: pa.Table) -> pa.Table:
        a, b, s = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        least = other["_least"].to_numpy()
        if one.num_rows and other.num_rows:
            x, y = matrix(one["vector"], np.float64), matrix(other["vector"], np.float64)
            near = unit(x) @ unit(y).T
            edge = -np.partition(-near, k, axis=1)[:, k : k + 1] if near.shape[1] > k + 1 else np.full((len(x), 1), -np.inf)
            for at in range(0, len(x), 64):  # ties may be many: a few queries at a time
                p, q = np.nonzero(near[at : at + 64] >= edge[at : at + 64] - 1e-12)
                p, q, t = best_rows(p + at, q, pair_cosine(x[p + at], y[q]), least, k + 1)
                a, b, s = np.concatenate([a, p]), np.concatenate([b, q]), np.concatenate([s, t])
        return pa.table({"_q": one["_q"].to_numpy()[a], "_v": other["_v"].to_numpy()[b], "_least": least[b], "score": s})

    pairs = left.select("_q", "vector", "_p", "_a", "_b").groupBy("_p", "_a", "_b").cogroup(right.groupBy("_p", "_a", "_b")).applyInArrow(cell, f"_q long, _v long, _least {kind}, score double")
    return answers(queries, asked, folded, pairs, k)


def op9_neighbours(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(finite("embedding") & F.col("vec_id").isNotNull())
    rows = stash(rows.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector")).filter(F.exists("vector", lambda x: x != 0)))
    return nearest(rows.filter("vec_id % 50 = 0"), rows, 5)
