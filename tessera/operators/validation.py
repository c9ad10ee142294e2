"""Checks of a finished run: counts, names that should be one, known names found, authors found, claims that can't be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.domain import INTERWAR, DomainPack, anachronism, rank_key
from ..functions.text import name_key


def _share(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / F.greatest(F.lit(1), whole), 1)


def run_counts(entities: DataFrame, edges: DataFrame, timeline: DataFrame) -> DataFrame:
    """(measure, value): sizes, isolated nodes, authors, memberships, and shares with an alias or evidence."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("entity_id")).distinct().withColumn("_e", F.lit(1))
    n = F.count(F.lit(1))
    nodes = entities.join(ends, "entity_id", "left").agg(
        n.alias("entities"), F.count_if(F.col("_e").isNull()).alias("isolated_nodes"), F.count_if(F.coalesce("is_author", F.lit(False))).alias("author_nodes"),
        _share(F.count_if(F.size("aliases") > 0), n).alias("pct_entities_with_alias"),
    )
    ties = edges.agg(n.alias("edges"), F.count_if(F.col("rel_type") == "member_of").alias("member_of_edges"), _share(F.count_if(F.trim(F.coalesce("evidence", F.lit(""))) != ""), n).alias("pct_edges_with_evidence"))
    events = timeline.agg(n.alias("timeline"))
    rows = [part.select(F.explode(F.create_map(*[x for c in part.columns for x in (F.lit(c), F.col(c).cast("double"))])).alias("measure", "value")) for part in (nodes, ties, events)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def alias_misses(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """(alias, canonical): known aliases (alias, canonical) that stand beside their canonical name as another node."""
    present = entities.groupBy(name_key(F.col("canonical_name")).alias("k")).agg(F.max("entity_id").alias("id"))
    side = lambda name: present.select(F.col("k").alias(f"_{name}"), F.col("id").alias(f"_{name}_id"))
    keyed = aliases.withColumns({"_a": name_key(F.col("alias")), "_c": name_key(F.col("canonical"))}).filter("_a <> _c")
    return keyed.join(side("a"), "_a").join(side("c"), "_c").filter("_a_id <> _c_id").select("alias", "canonical")


def known_coverage(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """(known, found, coverage_pct): how many canonical names of the table some entity has as a name or alias."""
    present = entities.select(F.explode(F.transform(F.array_union(F.array("canonical_name"), "aliases"), name_key)).alias("k")).distinct().withColumn("_p", F.lit(1))
    known = aliases.select(name_key(F.col("canonical")).alias("k")).distinct().join(present, "k", "left")
    n, hit = F.count(F.lit(1)), F.count("_p")
    return known.agg(n.alias("known"), hit.alias("found"), _share(hit, n).alias("coverage_pct"))


def author_coverage(entities: DataFrame, documents: DataFrame) -> DataFrame:
    """(author, found, flagged): each author of the documents, whether a person has that name or alias, and whether that
    person is marked as an author."""
    persons = entities.filter("label = 'PERSON'").select(F.explode(F.transform(F.array_union(F.array("canonical_name"), "aliases"), name_key)).alias("author"), "entity_id", F.coalesce("is_author", F.lit(False)).alias("a"))
    first = persons.groupBy("author").agg(F.min_by("a", "entity_id").alias("_a"))
    asked = documents.select(name_key(F.col("author")).alias("author")).filter("author <> ''").distinct()
    return asked.join(first, "author", "left").select("author", F.col("_a").isNotNull().alias("found"), F.coalesce("_a", F.lit(False)).alias("flagged"))


def organisation_in(text: Column, pack: DomainPack = INTERWAR) -> Column:
    """The first organisation of the pack, in its order, that the text names; null for none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(*[F.when(F.contains(low, F.lit(org.lower())), F.lit(org)) for org in pack.existence]) if pack.existence else F.lit(None).cast("string")


def timeline_findings(events: DataFrame, pack: DomainPack = INTERWAR) -> DataFrame:
    """(item, kind, message) of dated events (doc_id, date_text, year, description) that can't be."""
    org = organisation_in(F.col("description"), pack)
    told = events.filter("year IS NOT NULL").withColumn("_o", org).withColumn("message", anachronism(F.col("year"), F.col("_o"), pack)).filter("message <> ''")
    return told.select(F.concat_ws(":", "doc_id", "date_text").alias("item"), F.when(F.col("_o").isNull(), "implausible_date").otherwise("anachronism").alias("kind"), "message")


def rank_findings(entities: DataFrame, edges: DataFrame, pack: DomainPack = INTERWAR, orgs: tuple[str, ...] = ("SA", "SS")) -> DataFrame:
    """(item, kind, message): persons (entity_id, canonical_name, label, rank) of a rank of one of ``orgs`` without an
    edge to an entity that names it."""
    table = pack.rank_table(entities.sparkSession).select(F.col("form").alias("_f"), "org").filter(F.col("org").isin(*orgs))
    holders = entities.filter("label = 'PERSON' AND rank <> ''").withColumn("_f", rank_key(F.col("rank"))).join(F.broadcast(table), "_f")  # the pack's ladders
    ends = edges.select(F.col("source").alias("entity_id"), F.col("target").alias("_t")).union(edges.select(F.col("target"), F.col("source"))).distinct()
    named = entities.select(F.col("entity_id").alias("_t"), F.col("canonical_name").alias("_n"))
    linked = holders.select("entity_id", "org").join(ends, "entity_id").join(named, "_t").filter(F.contains("_n", "org")).select("entity_id").distinct()
    message = F.concat(F.col("canonical_name"), F.lit(" holds rank '"), F.col("rank"), F.lit("' of "), F.col("org"), F.lit(" without a tie to it"))
    return holders.join(linked, "entity_id", "left_anti").select(F.col("entity_id").alias("item"), F.lit("rank_mismatch").alias("kind"), message.alias("message"))
