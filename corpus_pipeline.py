"""A training corpus from raw documents: five stages, each one operator of tessera.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, pieces, quality, repeats, simhash
from tessera.storage import shared_dir


#: The columns that stages work on; further ones pass through untouched.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def apart(stage):
    """The stage with the further columns of docs set aside under names that no operator makes."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: f"_aside_{i}" for i, c in enumerate(docs.columns) if c not in OWN}
        made = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
        return made.withColumnsRenamed({new: old for old, new in aside.items()})

    return run


@apart
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score below 0.7) go."""
    scored = quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.filter("predicted = 1").select(*docs.columns)


@apart
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) one document stays: SimHash groups
    them, an exact check follows, and what fingerprints leave apart is found exactly."""
    return simhash.drop_near_copies(docs)


@apart
def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that a document of smaller doc_id has are cut out; documents of which
    nothing but white space is left go.  n_chars follows the text."""
    cut = repeats.remove_repeats(docs, with_text=True)
    names = [F.col("kept").alias("text") if c == "text" else F.length("kept").cast("long").alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns]
    return cut.filter("n_removed = 0 OR kept RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'").select(*names)


@apart
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: a document comes once for each time it is taken whole; one that
    is taken in part, at most one a source, comes whole if half its words or more are wanted."""
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "source", "text"))
    mixed = mixing.mix_sources(keyed, extra="_key")
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    counts = mixed.groupBy("_key").agg(F.sum(times).alias("_times"), F.count(F.lit(1)).alias("_rows"))
    # Rows that repeat in every column share their copies out; the remainder goes to one of them each.
    rows = keyed.join(counts, "_key").withColumn("_each", F.round(F.col("_times") / F.col("_rows")).cast("int"))
    return rows.filter("_each > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_each")))).select(*docs.columns)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as pieces: doc_id, source, lang, the ids, their number and whether they decode to the text."""
    return pieces.encode_documents(docs).select("doc_id", "lang", "source", "n_pieces", "ids", "round_trip")


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("repeats", repeats_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

#: No stage can be stated in SQL: they learn, hash with XXH64, sort suffixes and run automata.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
