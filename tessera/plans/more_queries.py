"""Queries of identity, domain, document and export operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import domain, ontology
from ..operators import documents, identity, quality
from ..sources import sinks
from .graph_queries import REL, relations, table
from .registry import query


@query("""WITH p AS (SELECT conv_id, turn, role, lead(role, -1) OVER (PARTITION BY conv_id ORDER BY turn) AS x FROM conversations), q AS (SELECT a.conv_id AS doc_id, a.role AS source, b.role AS target FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1)
SELECT DISTINCT source, target, 'replied_to' AS rel_type, doc_id FROM q WHERE source <> target""")
def social_replies(spark, sf_dir):
    posts = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("post_id"), F.concat_ws("-", "conv_id", (F.col("turn") - 1).cast("string")).alias("parent_id"), F.col("role").alias("author"), F.col("conv_id").alias("doc_id"),
        F.lit(None).cast("string").alias("community"), F.lit(None).cast("string").alias("forwarded_from"), F.array().cast("array<string>").alias("mentions"),
    )
    return documents.social_edges(documents.with_parents(posts)).select("source", "target", "rel_type", "doc_id")


@query("""SELECT o_orderkey, CASE WHEN y < 1919 THEN 'imperial_ww1' WHEN y <= 1932 THEN 'weimar' ELSE 'nazi_rule' END AS period, CASE WHEN y NOT BETWEEN 1900 AND 1946 THEN 'outside the period' WHEN y < 1920 THEN 'before it existed' WHEN y > 1945 THEN 'after it ended' ELSE '' END AS reason
FROM (SELECT o_orderkey, CAST(1890 + o_orderkey % 70 AS INTEGER) AS y FROM orders)""")
def anachronisms(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (1890 + F.col("o_orderkey") % 70).cast("int").alias("y"))
    return orders.select("o_orderkey", domain.temporal_period(F.col("y")).alias("period"), domain.anachronism(F.col("y"), F.lit("NSDAP")).alias("reason"))


@query(f"""WITH {REL}, w AS (SELECT source, target, count(*) AS weight, round(max(confidence), 6) AS confidence, min(year) AS year, string_agg(DISTINCT rel_type, ';' ORDER BY rel_type) AS rel_type FROM rel GROUP BY 1, 2)
SELECT source, target, CAST(weight AS BIGINT) AS weight, confidence, year, rel_type FROM w""")
def collapsed_edges(spark, sf_dir):
    edges = relations(spark, sf_dir).withColumns({"weight": F.lit(1), "tie_class": F.lit("other")})
    return sinks.collapse(edges).select("source", "target", "weight", F.round("confidence", 6).alias("confidence"), "year", "rel_type")


@query(f"WITH {REL} SELECT rel_type, count(*) AS n, min(evidence) FILTER (evidence <> '') AS example FROM rel GROUP BY 1")
def codebook_relations(spark, sf_dir):
    edges = relations(spark, sf_dir).withColumn("tie_class", F.lit("other"))
    return sinks.codebook(edges.select(F.col("source").alias("id"), F.col("source_label").alias("label")), edges)["relations"]


@query(f"WITH {REL} SELECT source, part, count(*) AS n FROM (SELECT source, unnest(string_split(edge_source, ';')) AS part FROM rel) GROUP BY ALL")
def source_counts(spark, sf_dir):
    return relations(spark, sf_dir).select("source", F.explode(F.split("edge_source", ";")).alias("part")).groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"))


@query()
def relation_alignment(spark, sf_dir):
    return ontology.align(relations(spark, sf_dir)).groupBy("rel_type", "aligned").agg(F.count(F.lit(1)).alias("n"))


_FORMS = ", ".join(f"('{form}', '{org}', '{forms[0]}', {level})" for org, ladder in domain.RANKS.items() for level, forms in enumerate(ladder, 1) for form in forms)


@query(rf"""WITH r(form, org, canonical, level) AS (VALUES {_FORMS}), k AS (SELECT regexp_replace(replace(replace(replace(replace(lower(trim(form)), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), '[\s\-_.]+', '', 'g') AS form, org, canonical, level FROM r)
SELECT form, string_agg(DISTINCT org, '/' ORDER BY org) AS org, arg_min(canonical, org) AS canonical, CAST(arg_min(level, org) AS INTEGER) AS level, count(DISTINCT org) > 1 AS ambiguous FROM k GROUP BY form""")
def rank_table(spark, sf_dir):
    return domain.INTERWAR.rank_table(spark)


@query()
def packed_batches(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select((F.col("doc_id") % 4).alias("shard"), "doc_id", "n_chars")
    return documents.pack_batches(docs, 20000, 12)


@query("""WITH m AS (SELECT c_custkey AS entity_id, 'ORG' AS label, c_custkey % 9 AS mention_count, c_custkey % 5 AS n_docs, c_custkey % 4 AS degree, c_custkey % 7 AS batch FROM customer), d AS (SELECT batch, entity_id FROM m WHERE entity_id % 3 = 0 OR batch = 2),
f AS (SELECT d.batch FROM d GROUP BY 1 HAVING count(*) <= 0.5 * (SELECT count(*) FROM m WHERE m.batch = d.batch)), g AS (SELECT DISTINCT entity_id FROM d JOIN f USING (batch)) SELECT entity_id FROM m WHERE entity_id NOT IN (SELECT entity_id FROM g) OR mention_count >= 5 OR n_docs >= 3 OR degree >= 3""")
def protected_drops(spark, sf_dir):
    key = F.col("c_custkey")
    made = table(spark, sf_dir, "customer").select(key.alias("entity_id"), (key % 9).alias("mention_count"), (key % 5).alias("n_docs"), (key % 4).alias("degree"), (key % 7).alias("batch"), F.lit(False).alias("is_author"))
    return quality.protected_drops(made, made.filter("entity_id % 3 = 0 OR batch = 2").select("batch", "entity_id")).select("entity_id")


@query("SELECT c_custkey AS doc_id, s_suppkey AS letter_id, s_name AS author FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def letters(spark, sf_dir):
    manifest = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc_id"), F.col("s_suppkey").alias("letter_id"), F.col("s_name").alias("author"))
    return identity.attach_letters(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id")), manifest)
