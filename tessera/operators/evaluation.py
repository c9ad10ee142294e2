"""Scores against gold with linked entities: entities with and without types, relations typed, by family and untyped.

Tables: predicted and gold entities (name, type, aliases array); relations (source, target, rel_type) by names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import name_key
from .scoring import greedy_match, prf

VIEWS = ("typed", "family", "untyped")


def surfaces(entities: DataFrame) -> DataFrame:
    """(node, type, ord, surface) of entities (name, type, aliases, ord): one node for each name key and type, with
    the keys of all its surfaces; ord: the first row's."""
    keyed = entities.select(name_key(F.col("name")).alias("node"), "type", "ord", F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("_s")).filter("node <> ''")
    each = keyed.select("node", "type", "ord", F.explode(F.array_distinct(F.transform("_s", name_key))).alias("surface")).filter("surface <> ''")
    first = keyed.groupBy("node", "type").agg(F.min("ord").alias("ord"))
    return each.select("node", "type", "surface").distinct().join(first, ["node", "type"]).select("node", "type", "ord", "surface")


def entity_scores(predicted: DataFrame, gold: DataFrame, typed: bool = True) -> DataFrame:
    """One row a type (``*`` for all): tp, fp, fn and the measures.  Each prediction, in order, takes the first free
    gold that shares a surface (and the type, if ``typed``), so splits of one entity count once.

    The row of all is the sum of the types' when types count; else one matching over everything."""
    p, g = surfaces(predicted), surfaces(gold)
    label = F.col("type") if typed else F.lit("*")
    left = p.select(label.alias("label"), F.col("ord").alias("pred"), "surface")
    right = g.select(label.alias("label"), F.col("ord").alias("gold"), "surface")
    hits = greedy_match(left.join(right, ["label", "surface"]).select("label", "pred", "gold")).groupBy("label").agg(F.count(F.lit(1)).alias("tp"))
    count = lambda df, name: df.select("label", name).distinct().groupBy("label").agg(F.count(F.lit(1)).alias(f"_{name}"))
    both = count(left, "pred").join(count(right, "gold"), "label", "full").join(hits, "label", "left").fillna(0, ["_pred", "_gold", "tp"])
    made = both.select(F.col("label").alias("type"), "tp", (F.col("_pred") - F.col("tp")).alias("fp"), (F.col("_gold") - F.col("tp")).alias("fn"))
    if typed:
        total = made.agg(F.lit("*").alias("type"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")])
        made = made.unionByName(total)
    return prf(made)


def _linked(names: DataFrame, column: str, predicted: DataFrame | None, gold: DataFrame) -> DataFrame:
    """names with ``<column>_id``: the gold node of the name, else one reached through another surface of the
    predicted node that owns the name, else the name itself (null for gold relations, which need a node)."""
    first = gold.groupBy("surface").agg(F.min("ord").alias("_g"))
    direct = first.select(F.col("surface").alias("_k"), F.col("_g"))
    out = names.withColumn("_k", name_key(F.col(column))).join(direct, "_k", "left")
    own = F.concat(F.lit("g"), F.col("_g"))
    if predicted is None:
        return out.withColumn(f"{column}_id", F.when(F.col("_g").isNotNull(), own)).drop("_k", "_g")
    owner = predicted.withColumn("_p", F.row_number().over(Window.partitionBy("surface").orderBy("ord"))).filter("_p = 1").select(F.col("surface").alias("_k"), F.col("node").alias("_n"), F.col("type").alias("_t"))
    reached = predicted.join(first, "surface").groupBy(F.col("node").alias("_n"), F.col("type").alias("_t")).agg(F.min("_g").alias("_via"))
    via = owner.join(reached, ["_n", "_t"]).select("_k", "_via")
    shown = F.when(F.col("_g").isNotNull(), own).when(F.col("_via").isNotNull(), F.concat(F.lit("g"), F.col("_via"))).otherwise(F.concat(F.lit("p::"), F.col("_k")))
    return out.join(via, "_k", "left").withColumn(f"{column}_id", shown).drop("_k", "_g", "_via")


def _slot(view: str, rel: Column) -> Column:
    if view == "untyped":
        return F.lit("")
    if view == "typed":
        return rel
    family = F.when(rel == "", "").otherwise(rules.tie_class(rel, F.lit(""), F.lit("")))
    return F.when(family == "other", rel).otherwise(family)  # unknown relations don't match one another


def relation_keys(relations: DataFrame, predicted: DataFrame | None, gold: DataFrame, view: str, directed: bool = True) -> DataFrame:
    """Distinct (a, b, slot) of relations between linked nodes; symmetric relations have their ends in order."""
    ends = _linked(_linked(relations, "source", predicted, gold), "target", predicted, gold).filter("source_id <> target_id")
    rel = F.lower(F.coalesce("rel_type", F.lit("")))
    keep = (rel != "") & ~rules.is_symmetric(rel) if directed else F.lit(False)
    left, right = F.col("source_id"), F.col("target_id")
    return ends.select(F.when(keep, left).otherwise(F.least(left, right)).alias("a"), F.when(keep, right).otherwise(F.greatest(left, right)).alias("b"), _slot(view, rel).alias("slot")).distinct()


def relation_scores(pred_entities: DataFrame, pred_relations: DataFrame, gold_entities: DataFrame, gold_relations: DataFrame, directed: bool = True) -> DataFrame:
    """(view, slot, tp, fp, fn, precision, recall, f1): each view's relations and, where types count, each label;
    ``*`` is all of a view."""
    p, g = surfaces(pred_entities), surfaces(gold_entities)
    parts = []
    for view in VIEWS:
        said = relation_keys(pred_relations, p, g, view, directed).withColumn("_p", F.lit(1))
        true = relation_keys(gold_relations, None, g, view, directed).withColumn("_g", F.lit(1))
        parts.append(said.join(true, ["a", "b", "slot"], "full").withColumn("view", F.lit(view)))
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    shown = both.withColumn("slot", F.explode(F.when(F.col("view") == "untyped", F.array(F.lit("*"))).otherwise(F.array(F.lit("*"), F.col("slot")))))
    counts = shown.groupBy("view", "slot").agg(
        F.count_if(F.col("_p").isNotNull() & F.col("_g").isNotNull()).alias("tp"), F.count_if(F.col("_g").isNull()).alias("fp"), F.count_if(F.col("_p").isNull()).alias("fn")
    )
    return prf(counts)
