"""Exact top-k by inner product: multi-resolution segment statistics, coarse to fine.

A vector is cut into segments; with means m and deviations (norms of what the means leave) r,
<q, x> <= sum over segments of (length * mq * mx + rq * rx).  The bound tightens as segments halve.  A block of
queries meets a block of candidates: candidates are visited in the order of the coarsest bound, and those whose
bound falls below a query's k-th best score so far are dropped, coarse to fine; survivors get exact scores.

The largest inner product is the smallest distance up to the query's and the candidate's norms, so the upper
bound on products here is the lower bound on distances of that method.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash
from .vectors import answers, best_rows, finite, fold, matrix

LEVELS = (1, 4, 16)
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 16384


def summary(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Scaled means and deviations by segment: their products add up to the bound.

    An uneven length is padded with zeros, which change no inner product."""
    n, width = x.shape
    length = -(-width // segments)
    padded = np.zeros((n, segments * length))
    padded[:, :width] = x
    cut = padded.reshape(n, segments, length)
    mean = cut.mean(2)
    rest = np.sqrt(np.maximum(((cut - mean[:, :, None]) ** 2).sum(2), 0))
    return mean * np.sqrt(length), rest


def block_top(query: np.ndarray, candidate: np.ndarray, ids: np.ndarray, k: int, step: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of each query's best ``k`` candidates, ties to the smaller of ``ids``.

    Whole numbers: where sums can pass 2**53, scores are made of Python's integers."""
    nq, nc = len(query), len(candidate)
    levels = [s for s in LEVELS if s <= query.shape[1]]
    q_sum = [np.hstack(summary(query, s)) for s in levels]
    c_sum = [np.hstack(summary(candidate, s)) for s in levels]
    largest = np.abs(query).sum(1).max(initial=0) * np.abs(candidate).max(initial=0)
    slack = 1e-6 * (1 + largest)
    wide = largest >= 2.0**53
    # Candidates of long vectors first: they set high thresholds early.
    order = np.argsort(-(candidate**2).sum(1), kind="stable")
    floor = np.full(nq, -np.inf)
    a, b, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object if wide else np.float64)
    for at in range(0, nc, step):
        some = order[at : at + step]
        # The coarsest bound over the whole block pair, then finer ones on what survives.
        alive_q, alive_c = np.nonzero(q_sum[0] @ c_sum[0][some].T + slack >= floor[:, None])
        for qs, cs in zip(q_sum[1:], c_sum[1:], strict=True):
            if len(alive_q) * 4 > nq * len(some):
                good = (qs @ cs[some].T)[alive_q, alive_c] + slack >= floor[alive_q]
            else:
                good = np.einsum("ij,ij->i", qs[alive_q], cs[some[alive_c]]) + slack >= floor[alive_q]
            alive_q, alive_c = alive_q[good], alive_c[good]
        if wide:
            score = np.array([sum(int(x) * int(y) for x, y in zip(query[i], candidate[some[j]], strict=True)) for i, j in zip(alive_q, alive_c, strict=True)], object)
        elif len(alive_q) * 4 > nq * len(some):
            score = (query @ candidate[some].T)[alive_q, alive_c]
        else:
            score = np.einsum("ij,ij->i", query[alive_q], candidate[some[alive_c]])
        good = wide | (score >= floor[alive_q]).astype(bool)
        a, b, s = np.concatenate([a, alive_q[good]]), np.concatenate([b, some[alive_c[good]]]), np.concatenate([s, score[good]])
        a, b, s = best_rows(a, b, s, ids, k)
        full = np.flatnonzero(np.bincount(a, minlength=nq) == k)
        last = np.cumsum(np.bincount(a, minlength=nq)) - 1
        floor[full] = s[last[full]].astype(np.float64) - (slack if wide else 0)
    return a, b, s


def top_products(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` candidates of other ids with the largest inner
    products of ``vector`` (array of double, whole numbers), ties to the smaller vec_id.

    queries, candidates: (vec_id, vector), all vectors of one length (a pair of other lengths is an error).
    Equal vectors are folded, so copies cost nothing.  Queries and candidates meet in a grid of bounded blocks;
    each cell returns a query's best k + 1 distinct vectors.  Repeated vec_ids are separate rows; fewer than k
    candidates give shorter lists, no queries none.  Scores beyond the range of long end at its limits.
    """
    folded = stash(fold(candidates, k + 1).withColumn("_v", F.monotonically_increasing_id()))
    asked = stash(fold(queries, 1).withColumn("_q", F.monotonically_increasing_id()))
    # A cell's block numbers: rows by hash, blocks by count.
    nc = max(1, -(-folded.count() // CANDIDATE_BLOCK))
    nq = max(1, -(-asked.count() // QUERY_BLOCK))
    left = asked.select("_q", "vector", F.pmod(F.col("_h1"), F.lit(nq)).cast("int").alias("_a")).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(nc - 1))))
    right = folded.select("_v", "vector", F.element_at("ids", 1).alias("_least"), F.pmod(F.col("_h1"), F.lit(nc)).cast("int").alias("_b")).withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))

    kind = candidates.schema["vec_id"].dataType.simpleString()

    def cell(one: pa.Table, other: pa.Table) -> pa.Table:
        a, b, s = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        least = other["_least"].to_numpy()
        if one.num_rows and other.num_rows:
            a, b, s = block_top(matrix(one["vector"], np.float64), matrix(other["vector"], np.float64), least, k + 1)
            if s.dtype == object:
                s = np.array([min(max(x, 1 - (1 << 63)), (1 << 63) - 1) for x in s], np.int64)
        return pa.table({"_q": one["_q"].to_numpy()[a], "_v": other["_v"].to_numpy()[b], "_least": least[b], "score": s.astype(np.int64)})

    pairs = left.groupBy("_a", "_b").cogroup(right.groupBy("_a", "_b")).applyInArrow(cell, f"_q long, _v long, _least {kind}, score long")
    return answers(queries, asked, folded, pairs, k)


def whole_vectors(rows: DataFrame, scale: float = 64.0) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of every component, as doubles; rows that can't take part are left out,
    and those whose components pass the range of double."""
    good = rows.filter(finite("embedding") & F.col("vec_id").isNotNull())

    def whole(x):
        y = F.lit(scale) * x.cast("double")
        return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)  # beyond, every double is whole

    return good.select("vec_id", F.transform("embedding", whole).alias("vector")).filter(finite("vector"))


def op4_topk(spark, sf_dir: str) -> DataFrame:
    rows = stash(whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return top_products(rows.filter("vec_id % 20 = 0"), rows, 20)
