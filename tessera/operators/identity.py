"""Identities beyond names: narrators, authors' surnames, metadata and reconciled spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import name_key, stable_id

#: Relations that say two names are one person.
IDENTITY = (
    "is", "am", "are", "was", "self_reference", "self-reference", "selfreference", "aka", "also_known_as", "named",
    "identified_as", "real_name", "same_as", "identity", "alias_of",
)


def narrator_folds(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(entity_id, into): narrator placeholders into the one named person an identity relation gives them.

    edges hold names; exactly one end is a narrator and the other a person that isn't."""
    who = entities.select("entity_id", name_key(F.col("canonical_name")).alias("k"), "label", (F.coalesce("is_author", F.lit(False)) | name_key(F.col("canonical_name")).startswith("narrator")).alias("n"))
    who = who.groupBy("k").agg(F.min_by(F.struct("entity_id", "label", "n"), "entity_id").alias("e"))
    same = edges.filter(F.lower(F.trim("rel_type")).isin(*IDENTITY)).select(name_key(F.col("source")).alias("a"), name_key(F.col("target")).alias("b"))
    both = same.union(same.select("b", "a")).distinct()
    left, right = who.select(F.col("k").alias("a"), F.col("e").alias("x")), who.select(F.col("k").alias("b"), F.col("e").alias("y"))
    found = both.join(left, "a").join(right, "b").filter("x.n AND NOT y.n AND y.label = 'PERSON'")
    return found.groupBy(F.col("x.entity_id").alias("entity_id")).agg(F.min("y.entity_id").alias("into"))


def drop_identity_edges(edges: DataFrame) -> DataFrame:
    return edges.filter(~F.lower(F.trim("rel_type")).isin(*IDENTITY))


def surname_folds(entities: DataFrame, least: int = 4) -> DataFrame:
    """(entity_id, into): a bare surname into the one author that has it, if no other person does."""
    persons = entities.filter("label = 'PERSON'").select("entity_id", F.split("key", " ").alias("t"), F.coalesce("is_author", F.lit(False)).alias("author"))
    named = persons.withColumn("surname", F.element_at("t", -1))
    full = named.filter(F.size("t") > 1).groupBy("surname").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("author").alias("a"), F.min(F.when(F.col("author"), F.col("entity_id"))).alias("into")
    )
    bare = named.filter((F.size("t") == 1) & ~F.col("author") & (F.length("surname") >= least)).select("entity_id", "surname")
    return bare.join(full.filter("n = 1 AND a = 1"), "surname").select("entity_id", "into")


def author_folds(entities: DataFrame) -> DataFrame:
    """(entity_id, into, pin): persons named like exactly one author, who keeps the name, diacritics aside;
    placeholders stay."""
    plain = F.translate(F.col("key"), "áàâäãåéèêëíìîïóòôöõúùûüçñ", "aaaaaaeeeeiiiiooooouuuucn")
    persons = entities.filter("label = 'PERSON'").select("entity_id", plain.alias("p"), F.coalesce("is_author", F.lit(False)).alias("author")).filter("p NOT IN ('unknown', 'anonymous', 'narrator', 'author', '')")
    authors = persons.filter("author").groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("entity_id").alias("into")).filter("n = 1")
    return persons.filter("NOT author").join(authors, "p").select("entity_id", "into", F.lit(True).alias("pin"))


def merge_metadata(entities: DataFrame, rows: DataFrame, links: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(entities, edges): a sheet's rows (key, and a column for each of ``links``: column -> relation) as verified
    edges from the author of that key; targets that aren't known yet become entities."""
    authors = entities.filter("is_author").select(F.col("entity_id").alias("source"), "letter_id")
    long = rows.select("letter_id", F.explode(F.create_map(*[x for c, r in links.items() for x in (F.lit(r), F.col(c))])).alias("rel_type", "name")).filter("trim(name) <> ''")
    known = entities.groupBy("key").agg(F.min("entity_id").alias("target"))
    found = long.withColumn("key", name_key(F.col("name"))).join(authors, "letter_id").join(known, "key", "left")
    made = found.withColumn("target", F.coalesce("target", stable_id(F.col("key"), F.lit("META"), prefix="meta_")))
    edges = made.select("source", "target", "rel_type", F.lit("metadata").alias("edge_source"), F.lit(1.0).alias("confidence"))
    fresh = made.join(entities.select(F.col("entity_id").alias("target")), "target", "left_anti").select(F.col("target").alias("entity_id"), F.col("name").alias("canonical_name"), "key").dropDuplicates(["entity_id"])
    return entities.unionByName(fresh, allowMissingColumns=True), edges


def reconcile_spans(extracted: DataFrame, recognised: DataFrame, add: bool = False) -> DataFrame:
    """extracted mentions (doc_id, text, label) with the label that the recogniser gives the same name in the same
    document; ``add``: what only the recogniser saw joins as ner_only."""
    known = recognised.groupBy("doc_id", name_key(F.col("text")).alias("_k")).agg(F.min("label").alias("_l"), F.min("text").alias("_t"))
    named = extracted.withColumn("_k", name_key(F.col("text")))
    out = named.join(known, ["doc_id", "_k"], "left").withColumn("label", F.coalesce("_l", "label")).withColumn("ner_only", F.lit(False))
    if add:
        only = known.join(named.select("doc_id", "_k"), ["doc_id", "_k"], "left_anti").select("doc_id", F.col("_t").alias("text"), F.col("_l").alias("label"), F.lit(True).alias("ner_only"))
        out = out.unionByName(only, allowMissingColumns=True)
    return out.drop("_k", "_l", "_t")


def attach_letters(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """rows with letter_id and author from a manifest (doc_id, letter_id, author)."""
    return rows.join(manifest.select("doc_id", "letter_id", "author"), "doc_id", "left")


def unit_edges(units: DataFrame, parents: dict[str, str], entities: DataFrame, existing: DataFrame) -> DataFrame:
    """(source, target, rel_type): units part of the organisation whose pattern their name matches, where that
    organisation is an entity and the pair isn't linked yet.  parents: pattern -> organisation; first match wins."""
    chain = F.lit(None).cast("string")
    for pattern, parent in reversed(parents.items()):
        chain = F.when(F.col("canonical_name").rlike(pattern), F.lit(parent)).otherwise(chain)
    named = units.select(F.col("entity_id").alias("source"), name_key(chain).alias("k")).filter("k IS NOT NULL")
    index = entities.groupBy(F.col("key").alias("k")).agg(F.min("entity_id").alias("target"))
    made = named.join(index, "k").filter("source <> target").select("source", "target")
    return made.join(existing.select("source", "target"), ["source", "target"], "left_anti").withColumn("rel_type", F.lit("part_of"))
