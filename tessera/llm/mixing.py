"""Mixing sources to target weights: Efraimidis-Spirakis sampling, in DataFrame functions alone.

Every document gets an exponential key, -ln(u) / quality, from a reproducible u; the smaller keys go first.
A source whose target holds k times its words is taken whole k times (complete epochs); what is left of the
target is filled in the order of the keys, and the document at the edge gives only the words still wanted.

No source is ever sorted in one task: the keys fall into ``buckets`` order-keeping buckets, whose sums are
prefix-summed per source, and rows are ordered only inside the one bucket that a source's budget ends in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stash, unit_hash

WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def text_quality(text: Column | str) -> Column:
    """A document's weight in the draw, 0.1 to 1: the share of its characters that aren't signs of noise."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    plain = F.length(F.translate(text, "!|%$&*#<>{}[]=\\/~^_0123456789", ""))
    return F.greatest(F.lit(0.1), plain / F.greatest(F.length(text), F.lit(1)))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, repeats: float = 2.0) -> DataFrame:
    """(source, source_size) -> with ``target``: shares by weight of ``share`` times all words, none above
    ``repeats`` times its source, what that cuts off being shared again by weight until none is above.

    That ends where target = min(repeats * size, level * weight) and the targets sum up to what is shared;
    the sources at their limit are those of the lowest limit per weight, so one ordered pass finds the level.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = (
        sizes.withColumn("_w", F.element_at(cycle, (rank % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.lit(float(repeats)) * F.col("source_size"))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
    )
    upto = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    level = (
        ranked.withColumn("_caps", F.sum("_cap").over(upto) - F.col("_cap"))
        .withColumn("_rest", F.sum("_w").over(every) - F.sum("_w").over(upto) + F.col("_w"))
        .withColumn("_level", (F.lit(float(share)) * F.sum("source_size").over(every) - F.col("_caps")) / F.col("_rest"))
        .withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(every)["_level"])
    )
    return level.select(
        "source",
        "source_size",
        F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap"))).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    quality: Column | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    repeats: float = 2.0,
    seed: int = 17,
    buckets: int = 4096,
    extra: str | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and epochs for every row of ``docs`` (doc_id, text, source).

    ``extra``: one more column to keep.  ``quality``: a positive column that scales the keys; text_quality by default (null counts as 0.1).
    Null sources form one source, the last; null and empty texts have size 0 and nothing taken; repeated rows
    count each; an empty table gives an empty result.  Other columns are ignored.  The same rows and seed
    always give the same result: rows that tie in every column are alike.
    """
    more = [extra] if extra else []
    quality = F.greatest(F.coalesce(quality if quality is not None else text_quality("text"), F.lit(0.1)), F.lit(1e-6))
    keyed = docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("_t"), quality.alias("_q"), *more)
    key = -F.log(unit_hash("doc_id", "source", "_t", seed=seed)) / F.col("_q")
    # 1 - exp(-key) keeps the order of the keys and lies in (0, 1).
    keyed = stash(keyed.select("doc_id", "source", "size", "_t", key.alias("_key"), *[F.col(m).alias("_more") for m in more]).withColumn("_bucket", F.floor((1 - F.exp(-F.col("_key"))) * buckets).cast("int")))

    sums = stash(keyed.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum")))
    goal = targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, share, repeats)
    goal = goal.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = goal.withColumn("_budget", F.round(F.col("target")).cast("long") - F.col("_epochs") * F.col("source_size"))

    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    steps = (
        sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .join(goal.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .select("_s", F.col("_bucket").alias("_b"), "source_size", "target", "_epochs", "_budget", "_before", "_sum")
    )
    # A bucket is wholly in, wholly out, or the edge.
    state = F.when(F.col("_before") + F.col("_sum") <= F.col("_budget"), 1).when(F.col("_before") >= F.col("_budget"), 0).otherwise(2)
    rows = keyed.join(steps.withColumn("_state", state), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    out = ["doc_id", "source", "size", "source_size", "target", "_epochs", "taken", *["_more" for _ in more]]
    sure = rows.filter("_state < 2").withColumn("taken", F.col("size") * (F.col("_epochs") + F.col("_state"))).select(*out)
    inside = Window.partitionBy("source").orderBy("_key", "doc_id", "_t", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.filter("_state = 2").withColumn("_left", F.col("_budget") - F.col("_before") - F.coalesce(F.sum("size").over(inside), F.lit(0)))
    edge = edge.withColumn("taken", F.col("size") * F.col("_epochs") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("_left")))).select(*out)
    both = sure.unionByName(edge).withColumnRenamed("_epochs", "epochs")
    return both.withColumnRenamed("_more", extra) if extra else both


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mix_sources(docs)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "epochs")
