"""Narrative sequences: which element follows which, by document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def transitions(events: DataFrame, doc: str = "doc_id", element: str = "element", order: tuple[str, ...] = ("year", "ord")) -> DataFrame:
    """(source, target, weight, n_docs): consecutive unequal elements of a document, undated last."""
    by = Window.partitionBy(doc).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    steps = events.select(doc, F.col(element).alias("source"), F.lead(element).over(by).alias("target")).filter("target IS NOT NULL AND source <> target")
    return steps.groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"), F.count_distinct(doc).alias("n_docs"))
