"""Readers of annotated corpora, and books cut into chapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.extract import bio_spans

#: Tokens that no blank follows; what no blank precedes.
NO_SPACE_AFTER = ("(", "[", "{", "$", "``")
NO_SPACE_BEFORE = r"^[.,;:!?)\]}'\"%]"


def read_iob2(spark: SparkSession, path: str) -> DataFrame:
    """(sent_id, i, token, tag) of files of token and tag a line: the first and the last column, blank lines between
    sentences, comments left out.  A sentence is numbered by its file and its first line.

    Each file is read whole, as its lines' order decides."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("_f"), F.split(F.replace("value", F.lit("\r"), F.lit("")), "\n").alias("_l"))
    lines = files.select("_f", F.posexplode("_l").alias("_p", "_t")).filter(~F.col("_t").startswith("#"))
    order = Window.partitionBy("_f").orderBy("_p")
    placed = lines.withColumn("_s", F.sum(F.when(F.trim("_t") == "", 1).otherwise(0)).over(order)).filter(F.trim("_t") != "")
    cells = F.when(F.contains("_t", F.lit("\t")), F.split("_t", "\t")).otherwise(F.split(F.trim("_t"), r"\s+"))
    rows = placed.withColumn("_c", cells).filter(F.size("_c") >= 2)
    within = Window.partitionBy("_f", "_s").orderBy("_p")
    sent = F.concat(F.regexp_replace("_f", r"^.*/", ""), F.lit(":"), F.format_string("%09d", F.first("_p").over(within)))
    return rows.select(sent.alias("sent_id"), (F.row_number().over(within) - 1).alias("i"), F.element_at("_c", 1).alias("token"), F.element_at("_c", -1).alias("tag"))


def pseudo_documents(tokens: DataFrame, types: dict[str, str], per_document: int = 25) -> tuple[DataFrame, DataFrame]:
    """(documents, entities) of tagged sentences (sent_id, ord, i, token, tag): ``per_document`` sentences, by ord, make a
    document (doc_id, text); its entities (doc_id, name, type), of the types mapped, are distinct but for case."""
    doc = F.floor(F.col("ord") / per_document).alias("doc_id")
    words = tokens.groupBy(doc, "ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "token"))), lambda t: t["token"]), " ").alias("_s"))
    documents = words.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "_s"))), lambda s: s["_s"]), "\n").alias("text"))
    names = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    spans = bio_spans(tokens.select(F.col("ord").alias("sent_id"), "i", "token", "tag")).withColumn("type", F.try_element_at(names, F.col("label"))).filter("type IS NOT NULL")
    placed = spans.select(F.floor(F.col("sent_id") / per_document).alias("doc_id"), F.col("sent_id").alias("_o"), F.col("text").alias("name"), "type")
    entities = placed.groupBy("doc_id", F.lower("name").alias("_k"), "type").agg(F.min_by("name", F.struct("_o", "name")).alias("name"))
    return documents, entities.select("doc_id", "name", "type")


def keep_types(entities: DataFrame, relations: DataFrame, types: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Gold entities (doc_id, name, type) of some types, and the relations (doc_id, source, target) among them."""
    kept = entities.filter(F.col("type").isin(*types))
    names = kept.select("doc_id", "name").distinct()
    side = lambda c: names.withColumnRenamed("name", c)
    return kept, relations.join(side("source"), ["doc_id", "source"], "left_semi").join(side("target"), ["doc_id", "target"], "left_semi").select(*relations.columns)


def detokenized(tokens: Column) -> Column:
    """An array of tokens as text: a blank between two, but before closing marks and after opening ones."""
    start = F.struct(F.lit("").alias("text"), F.lit("").alias("last"), F.lit(True).alias("first"))
    glue = lambda acc, t: F.when(acc["first"] | t.rlike(NO_SPACE_BEFORE) | acc["last"].isin(*NO_SPACE_AFTER), "").otherwise(" ")
    step = lambda acc, t: F.struct(F.concat(acc["text"], glue(acc, t), t).alias("text"), t.alias("last"), F.lit(False).alias("first"))
    return F.aggregate(tokens, start, step, lambda acc: acc["text"])


def speaker_name(slot: Column, dialogue: Column, names: tuple[tuple[str, ...], ...]) -> Column:
    """The name of a dialogue's speaker: each slot has its own list, from which the dialogue's number chooses."""
    lists = F.array(*[F.array(*[F.lit(n) for n in part]) for part in names])
    chosen = F.element_at(lists, (slot % len(names) + 1).cast("int"))
    return F.element_at(chosen, (dialogue % F.size(chosen) + 1).cast("int"))


def chapters(docs: DataFrame, heading: str = r"(?m)^(?:CHAPTER|Chapter)\s+[\dIVXLCivxlc]+\b.*$", least: int = 3, body: int = 500) -> DataFrame:
    """(doc_id, chapter, title, text) of books with at least ``least`` headings; chapters of at most ``body`` characters
    go, their numbers stay."""
    found = docs.select("doc_id", F.regexp_extract_all("text", F.lit(heading), F.lit(0)).alias("_h"), F.split("text", heading).alias("_b")).filter(F.size("_h") >= least)
    rows = found.select("doc_id", F.posexplode(F.arrays_zip("_h", F.slice("_b", 2, F.size("_h")).alias("_t"))).alias("chapter", "_z"))
    made = rows.select("doc_id", "chapter", F.trim("_z._h").alias("title"), F.regexp_replace("_z._t", r"^\s+|\s+$", "").alias("text"))
    return made.filter(F.length("text") > body)
