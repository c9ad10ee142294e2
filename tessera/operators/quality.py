"""Filters, tags and consistency checks of entities and relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules, text
from .network import nearest_rank


def rule_filter(entities: DataFrame, min_mentions: int = 1, min_confidence: float = 0.0, stopwords: tuple[str, ...] = ()) -> DataFrame:
    """Entities (canonical_name, label, mention_count, confidence, is_author) that the rules keep; authors always."""
    key = text.name_key(F.col("canonical_name"))
    bad = text.bad_name(F.col("canonical_name")) | ((F.col("label") == "PERSON") & text.junk_person(F.col("canonical_name")))
    if stopwords:
        bad = bad | key.isin(*stopwords) | text.strip_determiner(key).isin(*stopwords)
    good = (F.col("mention_count") >= min_mentions) & (F.col("confidence") >= min_confidence) & ~bad
    return entities.filter(F.coalesce("is_author", F.lit(False)) | good)


def pos_gate(entities: DataFrame, keep_mentions: int = 20) -> DataFrame:
    """Entities with suspect_common_noun, by the share of proper-noun tokens (propn_ratio; null passes).

    Persons of ratio 0 seen at least twice go unless seen ``keep_mentions`` times; names of ratio below one half
    are tagged, but for organisations with a telling ending and authors."""
    ratio, persons = F.col("propn_ratio"), F.col("label") == "PERSON"
    author = F.coalesce("is_author", F.lit(False))
    zero = persons & (ratio == 0) & (F.col("mention_count") >= 2) & ~author
    named = F.col("label").isin("PERSON", "ORG", "INSTITUTION", "LOCATION")
    suspect = F.coalesce(named & (ratio < 0.5) & ~author & ~text.org_marker(F.col("canonical_name")), F.lit(False))
    kept = entities.filter(~F.coalesce(zero & (F.col("mention_count") < keep_mentions), F.lit(False)))
    return kept.withColumn("suspect_common_noun", suspect)


def edge_floor(edges: DataFrame, entities: DataFrame, min_weight: int = 1) -> DataFrame:
    """Edges seen ``min_weight`` times as (source, target, rel_type) whose ends are both kept entities."""
    counted = edges.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("source", "target", "rel_type"))).filter(F.col("_n") >= min_weight).drop("_n")
    ids = entities.select("entity_id").distinct()
    return counted.join(ids.withColumnRenamed("entity_id", "source"), "source", "left_semi").join(ids.withColumnRenamed("entity_id", "target"), "target", "left_semi")


def suspect_membership(rel: Column, target_label: Column) -> Column:
    """Membership in what is no organisation."""
    return rel.isin("member_of", "joined", "served_in") & ~F.coalesce(target_label, F.lit("")).isin("ORG", "INSTITUTION")


def check_signatures(edges: DataFrame, drop: bool = False) -> DataFrame:
    """edges (rel_type, source_label, target_label) with type_violation, or without the violations."""
    marked = edges.withColumn("type_violation", rules.type_violation(F.col("rel_type"), F.col("source_label"), F.col("target_label")))
    return marked.filter(~F.col("type_violation")) if drop else marked


def functional_conflicts(edges: DataFrame, drop: bool = False, relations: tuple[str, ...] | None = rules.FUNCTIONAL) -> DataFrame:
    """edges (source, target, rel_type, confidence) with functional_conflict: a functional relation of one subject
    with several targets; ``drop`` keeps the target with most edges, then confidence, then the smallest."""
    some = edges.filter(F.col("rel_type").isin(*relations)) if relations else edges
    each = some.groupBy("source", "rel_type", "target").agg(F.count(F.lit(1)).alias("n"), F.max("confidence").alias("c"))
    best = each.groupBy("source", "rel_type").agg(F.count(F.lit(1)).alias("_targets"), F.min_by("target", F.struct(-F.col("n"), -F.col("c"), "target")).alias("_best")).filter("_targets > 1")
    marked = edges.join(best, ["source", "rel_type"], "left").withColumn("functional_conflict", F.col("_targets").isNotNull())
    if drop:
        marked = marked.filter(~F.col("functional_conflict") | (F.col("target") == F.col("_best")))
    return marked.drop("_targets", "_best")


def drop_isolated(entities: DataFrame, edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("source", "target")).alias("entity_id")).distinct()
    return entities.join(ends, "entity_id", "left_semi")


def tag_entities(entities: DataFrame) -> DataFrame:
    """entities (entity_id, mention_count, n_docs, degree) with entity_scope and relevance_tier from nearest-rank
    percentiles of the three signals; the thresholds are one row each."""
    out = entities
    for column in ("mention_count", "n_docs", "degree"):
        cut = nearest_rank(entities, column).select(F.col("p50").alias(f"_{column}50"), F.col("p85").alias(f"_{column}85"))
        out = out.crossJoin(F.broadcast(cut))  # one row
    high = lambda c: (F.col(c) >= F.col(f"_{c}85")) & (F.col(f"_{c}85") > 0)
    points = lambda c: F.when(F.col(c) >= F.col(f"_{c}85"), 1.0).when(F.col(c) >= F.col(f"_{c}50"), 0.5).otherwise(0.0)
    score = points("mention_count") + points("degree") + points("n_docs")
    tagged = out.withColumn("entity_scope", F.when(high("degree") | high("n_docs"), "macro").otherwise("specific"))
    tagged = tagged.withColumn("relevance_tier", F.when(score >= 2, "core").when(score >= 1, "secondary").otherwise("peripheral"))
    return tagged.select(*entities.columns, "entity_scope", "relevance_tier")


def reference_figures(entities: DataFrame, known: tuple[str, ...] = (), share: float = 0.95, least: int = 5) -> DataFrame:
    """entities with reference_figure: known names, or persons in at least as many documents as the one at index
    floor(share * (n - 1)) of all persons, ``least`` at the smallest."""
    persons = entities.filter("label = 'PERSON'")
    counts = persons.groupBy(F.col("n_docs").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_u", F.sum("c").over(upto)).withColumn("_n", F.sum("c").over(Window.partitionBy()))
    cut = ranked.agg(F.greatest(F.lit(least), F.min(F.when(F.col("_u") > F.floor(F.lit(share) * (F.col("_n") - 1)), F.col("v")))).alias("_cut"))
    listed = text.name_key(F.col("canonical_name")).isin(*known) if known else F.lit(False)
    found = (F.col("label") == "PERSON") & ((F.col("n_docs") >= F.col("_cut")) | listed)
    return entities.crossJoin(F.broadcast(cut)).withColumn("reference_figure", found).drop("_cut")  # one row


def ungrounded(evidence: Column, source_name: Column, target_name: Column) -> Column:
    """The evidence names neither end, wholly or by a token of three letters or more."""
    low = F.lower(F.coalesce(evidence, F.lit("")))
    tokens = lambda n: F.filter(F.split(F.lower(n), r"\s+"), lambda t: (F.length(t) >= 3) & ~t.isin(*text.STOP_NAMES))
    named = lambda n: F.contains(low, F.lower(n)) | F.exists(tokens(n), lambda t: F.contains(low, t))
    return ~F.coalesce(named(source_name), F.lit(False)) & ~F.coalesce(named(target_name), F.lit(False))


def verify(edges: DataFrame, verdicts: DataFrame, drop: bool = False) -> DataFrame:
    """edges with ``verification`` from cached verdicts (key, verdict yes/no), by the hash of both names, relation
    and the first 300 characters of evidence; only extracted edges are verified."""
    key = F.sha1(F.concat_ws("||", "source_name", "target_name", "rel_type", F.substring("evidence", 1, 300)))
    extracted = F.exists(F.split("edge_source", ";"), lambda s: s.isin("llm_extracted", "langextract_extracted"))
    found = edges.withColumn("_key", F.when(extracted, key)).join(verdicts.select(F.col("key").alias("_key"), "verdict"), "_key", "left")
    found = found.withColumn("verification", F.when(F.col("verdict") == "no", "unsupported").when(F.col("verdict") == "yes", "supported")).drop("_key", "verdict")
    return found.filter("verification IS NULL OR verification <> 'unsupported'") if drop else found


def expansion_lock(edges: DataFrame, known_relations: DataFrame, strict: bool = False) -> DataFrame:
    """edges outside a prior network's relation vocabulary tagged (outside_schema), or dropped; co-occurrence and an
    empty vocabulary lock nothing."""
    known = known_relations.select(F.lower("rel_type").alias("_r")).filter("_r <> 'co_occurs_with'").distinct()
    total = known.agg((F.count(F.lit(1)) > 0).alias("_locked"))
    marked = edges.withColumn("_k", F.lower("rel_type")).join(known, F.col("_k") == F.col("_r"), "left").crossJoin(F.broadcast(total))  # one row
    marked = marked.withColumn("outside_schema", F.col("_locked") & F.col("_r").isNull()).drop("_k", "_r", "_locked")
    return marked.filter(~F.col("outside_schema")) if strict else marked


def protected_drops(entities: DataFrame, drops: DataFrame, fraction: float = 0.5) -> DataFrame:
    """entities without those a reviewer dropped (batch, entity_id): a batch that drops over ``fraction`` of its
    entities is ignored, and salient entities stay."""
    salient = F.coalesce("is_author", F.lit(False)) | (F.col("mention_count") >= 5) | (F.col("n_docs") >= 3) | (F.col("degree") >= 3)
    asked = drops.groupBy("batch").agg(F.count_distinct("entity_id").alias("_d"))
    sizes = entities.groupBy("batch").agg(F.count(F.lit(1)).alias("_b"))
    fair = asked.join(sizes, "batch").filter(F.col("_d") <= fraction * F.col("_b")).select("batch")
    gone = drops.join(fair, "batch").select("entity_id").distinct().withColumn("_gone", F.lit(True))
    return entities.join(gone, "entity_id", "left").filter(F.col("_gone").isNull() | salient).drop("_gone")
