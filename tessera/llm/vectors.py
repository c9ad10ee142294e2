"""Vectors for the searches: valid rows, equal vectors folded together, answers unfolded."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(embedding: str) -> Column:
    """Not null, not empty, and every component a finite number."""
    e = F.col(embedding)
    good = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(e.isNotNull() & (F.size(e) > 0) & good, F.lit(False))


def fold(rows: DataFrame, keep: int) -> DataFrame:
    """(vkey, vector, ids) for each distinct ``vector`` of rows (vec_id, vector): its ``keep`` smallest vec_ids.

    Where ties go to the smaller vec_id, k nearest of any row are among the k + 1 smallest ids of each distinct
    vector, so with keep = k + 1 nothing of an answer is lost, however many copies there are.  The ids are cut
    first in salted parts and then together, so no task holds a group of copies whole.
    """
    keyed = rows.select("vec_id", "vector", F.xxhash64("vector").alias("_h1"), F.hash("vector").alias("_h2"))
    salted = keyed.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    part = Window.partitionBy("_h1", "_h2", "_salt").orderBy("vec_id")
    whole = Window.partitionBy("_h1", "_h2").orderBy("vec_id")
    few = salted.withColumn("_r", F.row_number().over(part)).filter(F.col("_r") <= keep)
    few = few.withColumn("_r", F.row_number().over(whole)).filter(F.col("_r") <= keep)
    return few.groupBy("_h1", "_h2").agg(F.min_by("vector", "vec_id").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def matrix(column: pa.Array, dtype) -> np.ndarray:
    """A list column of equal lengths as a matrix; other lengths are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if len(set(np.diff(column.offsets.to_numpy()).tolist())) > 1:
        raise ValueError("vectors of several lengths")
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(n, -1) if n else np.zeros((0, 1), dtype)


def best_rows(a: np.ndarray, b: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of scored pairs (query a, candidate b) each query's ``k`` best, ties to the smaller ids[b]."""
    order = np.lexsort((ids[b], -score, a))
    a, b, score = a[order], b[order], score[order]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    first = np.flatnonzero(new)
    good = np.arange(len(a)) - first[np.cumsum(new) - 1] < k if len(a) else new
    return a[good], b[good], score[good]


def answers(queries: DataFrame, asked: DataFrame, folded: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) from scored pairs (_q, _v, _least, score) of distinct vectors; _least: the
    vector's smallest id.

    The k + 1 best distinct vectors of a query hold k rows of other ids; vectors that tie are ordered by their
    smallest id.  Every query row, copies too, takes its vector's list without itself.
    """
    order = Window.partitionBy("_q").orderBy(F.desc("score"), "_least")
    best = pairs.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1)
    named = best.join(folded.select("_v", "ids"), "_v")
    listed = named.select("_q", "score", F.explode("ids").alias("vec_id"))
    lists = listed.withColumn("_r", F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("score"), "vec_id"))).filter(F.col("_r") <= k + 1)
    whole = lists.groupBy("_q").agg(F.sort_array(F.collect_list(F.struct(F.negative("score").alias("s"), "vec_id"))).alias("_list"))
    rows = queries.select(F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("_h1"), F.hash("vector").alias("_h2"))
    found = rows.join(asked.select("_h1", "_h2", "_q"), ["_h1", "_h2"]).join(whole, "_q")
    others = F.slice(F.filter("_list", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    placed = found.select("query_id", F.posexplode(others).alias("_at", "_hit"))
    return placed.select("query_id", (F.col("_at") + 1).alias("rank"), F.col("_hit.vec_id").alias("vec_id"), F.negative("_hit.s").alias("score"))
