"""Replies of extraction models as mentions, relations and dated events.

A reply is repaired once on Arrow batches and brought to one shape; all rules after that are Column expressions."""

from __future__ import annotations

import json
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import name_key, verbatim
from ..storage import stash
from .documents import repair_json
from .extract import dates

#: The lists of a reply, each with the other name it goes by.
LISTS = {"entities": "entities", "relationships": "relations", "timeline": "events"}
_SHAPE = (
    "entities array<struct<name string, type string, confidence string>>, timeline array<struct<date string, description string, entities array<string>, confidence string>>, "
    "relationships array<struct<source string, target string, type string, evidence string, confidence string, directed string, extra map<string,string>>>"
)
_KNOWN = ("source", "target", "type", "evidence", "confidence", "directed")
UNSURE = 0.6  #: confidence where a reply gives none
LEAST_ALIKE = 0.9  #: similarity of an author's name and a spelling of it


def _text(value: object) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _one(found: dict) -> dict:
    """A document's lists, of objects alone; relations keep their further scalar fields apart."""
    lists = {name: found.get(name) or found.get(other) or [] for name, other in LISTS.items()}
    made = {name: [x for x in rows if isinstance(x, dict)] if isinstance(rows, list) else [] for name, rows in lists.items()}
    for row in made["relationships"]:
        row["extra"] = {k: _text(v) for k, v in row.items() if k not in _KNOWN and v not in (None, "", [], {})}
    for row in made["timeline"]:
        who = row.get("entities")
        row["entities"] = [_text(x).strip() for x in who if x is not None] if isinstance(who, list) else []
    return made


def by_document(data: object) -> dict[str, dict]:
    """A reply's extractions by document: an object by ids, a list of records with ids, or one document's own ("")."""
    if isinstance(data, list):
        rows = [(r.get("doc_id") or r.get("id"), r) for r in data if isinstance(r, dict)]
        return {str(i if key is None else key): r for i, (key, r) in enumerate(rows)}
    if not isinstance(data, dict):
        return {}
    if any(k in data for pair in LISTS.items() for k in pair):
        return {"": data}
    return {str(k): v for k, v in data.items() if isinstance(v, dict)}


def extractions(replies: DataFrame) -> DataFrame:
    """(doc_id string, data struct) of replies (doc_id string, reply): a reply on several documents names them; one that
    names none is on its own doc_id.  Replies that can't be repaired give nothing."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for doc, reply in zip(part["doc_id"], part["reply"], strict=True):
                fixed = repair_json(reply)
                found = by_document(json.loads(fixed)) if fixed else {}
                rows += [(key or doc, json.dumps(_one(one), ensure_ascii=False)) for key, one in found.items()]
            yield pd.DataFrame(rows, columns=["doc_id", "data"])

    made = replies.select(F.col("doc_id").cast("string"), "reply").mapInPandas(read, "doc_id string, data string")
    return made.select("doc_id", F.from_json("data", _SHAPE).alias("data"))


def _sure(text: Column) -> Column:
    number = text.try_cast("double")
    return F.when(number != 0, number).otherwise(F.lit(UNSURE))


def reply_mentions(found: DataFrame, labels: tuple[str, ...], known: DataFrame | None = None) -> DataFrame:
    """(doc_id, text, label, start, end, confidence): entities of the allowed labels at no certain place (0, 0), the first
    of each name (case aside) of a document, but for those that ``known`` mentions (doc_id, text) have already."""
    each = found.select("doc_id", F.posexplode("data.entities").alias("_i", "e")).select("doc_id", "_i", F.trim("e.name").alias("text"), F.upper(F.trim("e.type")).alias("label"), _sure(F.col("e.confidence")).alias("confidence"))
    good = each.filter((F.col("text") != "") & F.col("label").isin(*labels)).withColumn("_k", F.lower("text"))
    if known is not None:
        good = good.join(known.select(F.col("doc_id").cast("string"), F.lower(F.trim("text")).alias("_k")).distinct(), ["doc_id", "_k"], "left_anti")
    first = Window.partitionBy("doc_id", "_k").orderBy("_i")
    kept = good.withColumn("_r", F.row_number().over(first)).filter("_r = 1")
    return kept.select("doc_id", "text", "label", F.lit(0).alias("start"), F.lit(0).alias("end"), "confidence")


def reply_relations(found: DataFrame, docs: DataFrame | None = None, qualifiers: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ord, source, target, rel_type, evidence, confidence, directed, evidence_unverified, qual_<q> ...): relations
    with two different ends; without a type they are related_to.

    evidence_unverified: the text of docs (doc_id, text) does not hold the evidence; false without docs or evidence."""
    each = found.select("doc_id", F.posexplode("data.relationships").alias("ord", "r"))
    clean = lambda c: F.trim(F.coalesce(F.col(f"r.{c}"), F.lit("")))
    made = each.select(
        "doc_id", "ord", clean("source").alias("source"), clean("target").alias("target"), F.coalesce(F.nullif(clean("type"), F.lit("")), F.lit("related_to")).alias("rel_type"), clean("evidence").alias("evidence"),
        _sure(F.col("r.confidence")).alias("confidence"), (F.lower(clean("directed")) == "true").alias("directed"), *[F.coalesce(F.try_element_at("r.extra", F.lit(q)), F.lit("")).alias(f"qual_{q}") for q in qualifiers],
    )
    good = made.filter((F.col("source") != "") & (F.col("target") != "") & (F.lower("source") != F.lower("target")))
    unseen = F.lit(False)
    if docs is not None:
        good = good.join(docs.select(F.col("doc_id").cast("string"), F.col("text").alias("_t")), "doc_id", "left")
        unseen = (F.col("evidence") != "") & (F.coalesce("_t", F.lit("")) != "") & ~verbatim(F.col("evidence"), F.coalesce("_t", F.lit("")))
    return good.withColumn("evidence_unverified", unseen).select("doc_id", "ord", "source", "target", "rel_type", "evidence", "confidence", "directed", "evidence_unverified", *[f"qual_{q}" for q in qualifiers])


def reply_timeline(found: DataFrame, pivot: int | None = None) -> DataFrame:
    """(doc_id, date_text, iso_date, year, description, entities, confidence): events whose date has a year.  A date of
    several forms counts by the earliest of them."""
    # Read twice below, and behind it are the replies' repairs.
    each = stash(found.select("doc_id", F.posexplode("data.timeline").alias("_i", "t")).filter("trim(t.date) <> ''").withColumn("_e", F.concat_ws("|", "doc_id", "_i")))
    read = dates(each.select(F.col("_e").alias("doc_id"), F.trim("t.date").alias("text")), pivot).filter("year IS NOT NULL")
    one = read.groupBy(F.col("doc_id").alias("_e")).agg(F.min(F.struct("iso_date", "year")).alias("d"))
    named = F.filter(F.coalesce("t.entities", F.array().cast("array<string>")), lambda x: x != "")
    return each.join(one, "_e").select("doc_id", F.trim("t.date").alias("date_text"), "d.iso_date", "d.year", F.trim(F.coalesce("t.description", F.lit(""))).alias("description"), named.alias("entities"), _sure(F.col("t.confidence")).alias("confidence"))


def complete(reply: Column) -> Column:
    """Whether a reply holds an object or list that parses as it stands, from its first to its last bracket."""
    span = F.regexp_extract(F.coalesce(reply, F.lit("")), r"(?s)([{\[].*[}\]])", 1)
    return (span != "") & F.try_parse_json(span).isNotNull()


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def flag_narrators(mentions: DataFrame, authors: DataFrame) -> DataFrame:
    """mentions (doc_id, text, label) with is_author: persons named as their document's author (authors: doc_id, author);
    where none is, the most alike one, from a similarity of ``LEAST_ALIKE`` on (the smaller name at a tie)."""
    who = authors.select("doc_id", name_key(F.col("author")).alias("_a")).filter("_a <> ''").groupBy("doc_id").agg(F.min("_a").alias("_a"))
    persons = mentions.filter("label = 'PERSON'").select("doc_id", name_key(F.col("text")).alias("_k")).distinct().join(who, "doc_id")
    scored = persons.withColumn("_s", _ratio(F.col("_k"), F.col("_a"))).filter(F.col("_s") >= LEAST_ALIKE)
    best = scored.groupBy("doc_id").agg(F.min_by("_k", F.struct(-F.col("_s"), "_k")).alias("_b"))
    found = mentions.join(best, "doc_id", "left")
    return found.withColumn("is_author", F.coalesce((F.col("label") == "PERSON") & (name_key(F.col("text")) == F.col("_b")), F.lit(False))).drop("_b")
