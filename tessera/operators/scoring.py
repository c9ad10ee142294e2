"""Precision, recall, F1, matching and calibration against gold."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prf(counts: DataFrame, tp: str = "tp", fp: str = "fp", fn: str = "fn") -> DataFrame:
    """counts with precision, recall and f1 (0 where undefined)."""
    safe = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    precision, recall = safe(F.col(tp), F.col(tp) + F.col(fp)), safe(F.col(tp), F.col(tp) + F.col(fn))
    return counts.withColumns({"precision": precision, "recall": recall, "f1": safe(2 * precision * recall, precision + recall)})


def score_sets(predicted: DataFrame, gold: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn and the measures of distinct key sets, overall or ``by`` columns."""
    p, g = predicted.select(*keys).distinct().withColumn("_p", F.lit(1)), gold.select(*keys).distinct().withColumn("_g", F.lit(1))
    both = p.join(g, keys, "full")
    counts = both.groupBy(*(by or [])).agg(
        F.count_if(F.col("_p").isNotNull() & F.col("_g").isNotNull()).alias("tp"), F.count_if(F.col("_g").isNull()).alias("fp"), F.count_if(F.col("_p").isNull()).alias("fn")
    )
    return prf(counts)


def greedy_match(candidates: DataFrame) -> DataFrame:
    """(label, pred, gold): each prediction, in order, takes the first free gold it overlaps.

    candidates: label, pred, gold (orders as numbers).  Order decides, so one label is one group."""

    def match(part: pd.DataFrame) -> pd.DataFrame:
        taken, rows = set(), []
        done = set()
        for label, p, g in part.sort_values(["pred", "gold"])[["label", "pred", "gold"]].itertuples(index=False):
            if p not in done and g not in taken:
                done.add(p)
                taken.add(g)
                rows.append((label, p, g))
        return pd.DataFrame(rows, columns=["label", "pred", "gold"])

    kinds = dict(candidates.dtypes)
    return candidates.select("label", "pred", "gold").distinct().groupBy("label").applyInPandas(match, f"label {kinds['label']}, pred {kinds['pred']}, gold {kinds['gold']}")


#: The bins of confidence.
BINS = (0.0, 0.5, 0.6, 0.7, 0.8, 0.9, 1.01)


def confidence_bin(confidence: Column) -> Column:
    chain = F.lit(None).cast("int")
    for i, (low, high) in enumerate(zip(BINS[:-1], BINS[1:], strict=True)):
        chain = F.when((confidence >= low) & (confidence < high), i).otherwise(chain)
    return chain


def calibration(rows: DataFrame, confidence: str = "confidence", correct: str = "correct") -> DataFrame:
    """(bin, low, high, n, accuracy, gap): a row for every bin, empty ones too; gap: |middle - accuracy|."""
    spark = rows.sparkSession
    bins = spark.createDataFrame([(i, a, min(b, 1.0)) for i, (a, b) in enumerate(zip(BINS[:-1], BINS[1:], strict=True))], "bin int, low double, high double")
    found = rows.groupBy(confidence_bin(F.col(confidence)).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(correct).cast("double")).alias("accuracy"))
    made = bins.join(found, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return made.withColumn("gap", F.abs((F.col("low") + F.col("high")) / 2 - F.col("accuracy")))


def expected_calibration_error(table: DataFrame) -> DataFrame:
    return table.agg((F.sum(F.col("n") * F.coalesce("gap", F.lit(0.0))) / F.sum("n")).alias("ece"))
