"""Network queries over the order and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..operators import extract, narrative, network, quality, scoring
from ..operators.components import connected_components
from ..sources.files import best_records
from ..storage import stash
from .registry import query

RELATIONS = (
    "met_with", "member_of", "led", "opposed", "born_in", "funded", "supported", "co_occurs_with", "secretly_funded",
    "fought_against", "married_to", "publicly_endorsed", "studied_at", "caused", "posted_in", "blorp", "rivalled",
    "owned_by", "promoted_to", "attended_event",
)
LABELS = ("PERSON", "ORG", "LOCATION", "EVENT", "RANK", "INSTITUTION", "CUSTOM")
SOURCES = ("llm_extracted", "metadata", "rule_cooccurrence", "canonical_inferred;rule_cooccurrence", "pipeline_inferred", "", "metadata;llm_extracted")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations made of order lines: supplier to part, with labels, sources and years from the keys."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.concat(F.lit("s"), "l_suppkey").alias("source"),
        F.concat(F.lit("p"), "l_partkey").alias("target"),
        pick(RELATIONS, F.col("l_partkey") + F.col("l_linenumber")).alias("rel_type"),
        pick(LABELS, F.col("l_suppkey")).alias("source_label"),
        pick(LABELS, F.col("l_partkey")).alias("target_label"),
        pick(SOURCES, F.col("l_orderkey") + F.col("l_linenumber")).alias("edge_source"),
        F.col("l_orderkey").alias("doc_id"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000 + F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01"))).alias("ord"),
        F.when(F.col("l_quantity") > 10, F.year("l_shipdate")).alias("year"),
        (0.5 + F.col("l_discount")).alias("confidence"),
        F.when(F.col("l_tax") > 0.02, F.concat(F.lit("line "), "l_linenumber")).otherwise("").alias("evidence"),
    )


def _list(values: tuple[str, ...], number: str) -> str:
    return "list_element([" + ", ".join(f"'{v}'" for v in values) + f"], CAST(({number}) % {len(values)} + 1 AS INTEGER))"


REL = f"""rel AS (SELECT 's' || l_suppkey AS source, 'p' || l_partkey AS target,
  {_list(RELATIONS, "l_partkey + l_linenumber")} AS rel_type, {_list(LABELS, "l_suppkey")} AS source_label,
  {_list(LABELS, "l_partkey")} AS target_label, {_list(SOURCES, "l_orderkey + l_linenumber")} AS edge_source,
  l_orderkey AS doc_id, (l_orderkey * 10 + l_linenumber) * 100000 + date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS ord,
  CASE WHEN l_quantity > 10 THEN year(l_shipdate) END AS year, 0.5 + l_discount AS confidence,
  CASE WHEN l_tax > 0.02 THEN 'line ' || l_linenumber ELSE '' END AS evidence FROM lineitem)"""


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _like(key: str, parts) -> str:
    return "(" + " OR ".join(f"contains({key}, '{p}')" for p in parts) + ")"


def _listed(key: str, groups: dict[str, tuple[str, ...]]) -> str:
    return "CASE " + " ".join(f"WHEN {key} IN {_in(v)} THEN '{n}'" for n, v in groups.items()) + " END"


_LABELLED = "CASE target_label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.LABEL_CLASS.items()) + " END"
TIE = f"""CASE WHEN target_label IN ('ORG', 'INSTITUTION') AND {_like("rel_type", rules.OPPOSITION)} THEN 'stance'
  WHEN {_listed("rel_type", rules.TIE_CLASS)} = 'interaction' AND NOT (source_label = 'PERSON' AND target_label = 'PERSON') THEN coalesce({_LABELLED}, 'affiliation')
  WHEN {_listed("rel_type", rules.TIE_CLASS)} IS NOT NULL AND source_label = 'PERSON' AND target_label = 'PERSON' AND rel_type IN {_in(rules.PERSON_TO_PERSON)} THEN 'interaction'
  WHEN {_listed("rel_type", rules.TIE_CLASS)} IS NOT NULL THEN {_listed("rel_type", rules.TIE_CLASS)}
  WHEN {_LABELLED} IS NOT NULL THEN {_LABELLED}
  WHEN source_label = 'PERSON' AND target_label = 'PERSON' THEN 'interaction' ELSE 'other' END"""
POLARITY = f"""CASE WHEN rel_type IN {_in(rules.POSITIVE)} THEN 'positive' WHEN rel_type IN {_in(rules.NEGATIVE)} OR {_like("rel_type", rules.NEGATIVE_PARTS)} THEN 'negative'
  WHEN {_like("rel_type", rules.POSITIVE_PARTS)} THEN 'positive' ELSE 'neutral' END"""
CONNECTION = f"""CASE WHEN {_listed("rel_type", rules.CONNECTION)} IS NOT NULL THEN {_listed("rel_type", rules.CONNECTION)}
  WHEN {_like("rel_type", rules.IDEOLOGICAL_PARTS)} THEN 'ideological' WHEN {_like("rel_type", rules.PHYSICAL_PARTS)} THEN 'physical'
  WHEN {_like("rel_type", rules.ORGANIZATIONAL_PARTS)} THEN 'organizational' WHEN target_label IN ('LOCATION', 'RANK') THEN 'biographical'
  WHEN target_label IN ('ORG', 'INSTITUTION') THEN 'organizational' ELSE 'unspecified' END"""
SYMMETRIC = f"(rel_type IN {_in(rules.SYMMETRIC)} OR {_like('rel_type', rules.SYMMETRIC_PARTS)})"


def _violation() -> str:
    out = []
    for name, sides in rules.SIGNATURES.items():
        left, right = (rules.allowed_labels(s) for s in sides)
        bad = [f"{c} IN {_in([x for x in rules.CORE_LABELS if x not in good])}" for c, good in (("source_label", left), ("target_label", right))]
        out.append(f"WHEN rel_type = '{name}' THEN {bad[0]} OR {bad[1]}")
    return "CASE " + " ".join(out) + " ELSE false END"


# Co-occurrence, projection, proximity

COOC = """seen AS (SELECT DISTINCT l_orderkey AS d, l_partkey AS e FROM lineitem), sized AS (SELECT d, e, count(*) OVER (PARTITION BY d) AS k FROM seen),
pairs AS (SELECT x.e AS a, y.e AS b, count(*) AS shared_docs, sum(1.0 / (x.k - 1)) AS strength FROM sized x JOIN sized y ON x.d = y.d AND x.e < y.e GROUP BY 1, 2 HAVING count(*) >= {least})"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_partkey").alias("entity_id"))


@query("WITH " + COOC.format(least=2) + " SELECT a, b, shared_docs, round(strength, 6) AS strength, round(least(1.0, 0.3 + 0.1 * shared_docs), 6) AS confidence FROM pairs")
def cooccurrence_edges(spark, sf_dir):
    return network.cooccurrence(_orders(spark, sf_dir)).select("a", "b", "shared_docs", F.round("strength", 6).alias("strength"), F.round("confidence", 6).alias("confidence"))


_DISPARITY = """, ends AS (SELECT a AS n, strength AS w FROM pairs UNION ALL SELECT b, strength FROM pairs), nodes AS (SELECT n, sum(w) AS s, count(*) AS k FROM ends GROUP BY n),
scored AS (SELECT a, b, shared_docs, strength, round(least(CASE WHEN x.k <= 1 THEN 0.0 ELSE pow(greatest(0.0, 1 - strength / x.s), x.k - 1) END, CASE WHEN y.k <= 1 THEN 0.0 ELSE pow(greatest(0.0, 1 - strength / y.s), y.k - 1) END), 5) AS disparity_alpha
FROM pairs JOIN nodes x ON x.n = a JOIN nodes y ON y.n = b)"""


@query("WITH " + COOC.format(least=2) + _DISPARITY + " SELECT a, b, shared_docs, round(strength, 6) AS strength, disparity_alpha FROM scored WHERE disparity_alpha < 0.3")
def backbone_edges(spark, sf_dir):
    kept = network.disparity(network.cooccurrence(_orders(spark, sf_dir)), 0.3)
    return kept.select("a", "b", "shared_docs", F.round("strength", 6).alias("strength"), "disparity_alpha")


@query("WITH " + COOC.format(least=1) + _DISPARITY + " SELECT count(*) AS n, sum(CASE WHEN disparity_alpha < 0.3 THEN 1 ELSE 0 END) AS strong, round(sum(disparity_alpha), 1) AS total FROM scored")
def backbone_summary(spark, sf_dir):
    scored = network.disparity(network.cooccurrence(_orders(spark, sf_dir), min_shared=1))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("disparity_alpha") < 0.3, 1).otherwise(0)).alias("strong"), F.round(F.sum("disparity_alpha"), 1).alias("total"))


@query("""WITH seen AS (SELECT DISTINCT l_partkey AS d, l_suppkey AS e FROM lineitem), sized AS (SELECT d, e, count(*) OVER (PARTITION BY d) AS k FROM seen)
SELECT x.e AS a, y.e AS b, count(*) AS shared_groups, round(sum(1.0 / (x.k - 1)), 6) AS strength, round(least(1.0, 0.4 + 0.1 * count(*)), 6) AS confidence FROM sized x JOIN sized y ON x.d = y.d AND x.e < y.e GROUP BY 1, 2 HAVING count(*) >= 3""")
def supplier_projection(spark, sf_dir):
    members = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    made = network.project(members, "l_partkey", "l_suppkey", 3)
    return made.select("a", "b", "shared_groups", F.round("strength", 6).alias("strength"), F.round("confidence", 6).alias("confidence"))


@query(f"""WITH {REL}, ties AS (SELECT *, {TIE} AS tie_class FROM rel), m AS (SELECT DISTINCT CASE WHEN target_label IN ('ORG', 'INSTITUTION', 'EVENT') AND source_label = 'PERSON' THEN target ELSE source END AS g,
CASE WHEN target_label IN ('ORG', 'INSTITUTION', 'EVENT') AND source_label = 'PERSON' THEN source ELSE target END AS m FROM ties WHERE tie_class IN ('affiliation', 'participation') AND rel_type NOT IN {_in(rules.NON_PROJECTING)}
AND ((target_label IN ('ORG', 'INSTITUTION', 'EVENT') AND source_label = 'PERSON') OR (source_label IN ('ORG', 'INSTITUTION', 'EVENT') AND target_label = 'PERSON'))),
k AS (SELECT g, m, count(*) OVER (PARTITION BY g) AS k FROM m) SELECT x.m AS a, y.m AS b, count(*) AS shared_groups, round(sum(1.0 / (x.k - 1)), 6) AS strength FROM k x JOIN k y ON x.g = y.g AND x.m < y.m GROUP BY 1, 2 HAVING count(*) >= 2""")
def affiliation_edges(spark, sf_dir):
    edges = relations(spark, sf_dir).withColumn("tie_class", rules.tie_class(F.col("rel_type"), F.col("source_label"), F.col("target_label")))
    return network.affiliation_projection(edges, min_shared=2).select("a", "b", "shared_groups", F.round("strength", 6).alias("strength"))


@query("""WITH e AS (SELECT user_id AS d, event_type AS x, epoch_us(ts) // 1000000 AS p FROM events) SELECT least(l.x, r.x) AS a, greatest(l.x, r.x) AS b, count(DISTINCT l.d) AS n_docs, count(*) AS n_pairs, min(r.p - l.p) AS min_gap,
round(least(0.6, 0.3 + 0.05 * count(*)), 6) AS confidence FROM e l JOIN e r ON l.d = r.d AND l.x <> r.x AND r.p - l.p BETWEEN 0 AND 3600 AND (r.p > l.p OR l.x < r.x) GROUP BY 1, 2""")
def proximity_edges(spark, sf_dir):
    spots = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("entity_id"), F.unix_timestamp("ts").alias("pos"))
    return network.proximity(spots, 3600).withColumn("confidence", F.round("confidence", 6))


@query("""WITH s AS (SELECT DISTINCT conv_id, role FROM conversations), k AS (SELECT conv_id, role, count(*) OVER (PARTITION BY conv_id) AS k FROM s)
SELECT x.role AS a, y.role AS b, round(sum(1.0 / (x.k - 1)), 6) AS scene_weight, count(*) AS scene_count FROM k x JOIN k y ON x.conv_id = y.conv_id AND x.role < y.role WHERE x.k BETWEEN 2 AND 25 GROUP BY 1, 2""")
def scene_edges(spark, sf_dir):
    return network.scene_copresence(table(spark, sf_dir, "conversations"), "conv_id", "role").withColumn("scene_weight", F.round("scene_weight", 6))


@query("""WITH s AS (SELECT conv_id, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS t FROM conversations) SELECT role AS source, t AS target, count(*) AS n FROM s WHERE t IS NOT NULL AND t <> role GROUP BY 1, 2""")
def reply_edges(spark, sf_dir):
    return extract.reply_edges(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role")


# Classification of relations


@query(f"WITH {REL} SELECT rel_type, source_label, target_label, {TIE} AS tie_class, {POLARITY} AS polarity, {CONNECTION} AS connection, {SYMMETRIC} AS symmetric, {_violation()} AS violation, count(*) AS n FROM rel GROUP BY ALL")
def relation_classes(spark, sf_dir):
    rel, left, right = F.col("rel_type"), F.col("source_label"), F.col("target_label")
    distinct = relations(spark, sf_dir).groupBy("rel_type", "source_label", "target_label").agg(F.count(F.lit(1)).alias("n"))
    return distinct.select("rel_type", "source_label", "target_label", rules.tie_class(rel, left, right).alias("tie_class"), rules.polarity(rel).alias("polarity"), rules.connection_type(rel, right).alias("connection"), rules.is_symmetric(rel).alias("symmetric"), rules.type_violation(rel, left, right).alias("violation"), "n")


@query(f"WITH {REL} SELECT edge_source, list_has_any(string_split(edge_source, ';'), {list(rules.ASSERTED)}) AS conservative, list_has_any(string_split(edge_source, ';'), {list(rules.ASSERTED + rules.INFERRED)}) AS moderate, edge_source = 'metadata' AS only_metadata, count(*) AS n FROM rel GROUP BY ALL")
def evidence_tiers(spark, sf_dir):
    source = F.col("edge_source")
    some = relations(spark, sf_dir).groupBy("edge_source").agg(F.count(F.lit(1)).alias("n"))
    return some.select("edge_source", rules.tier_allows(source, "conservative").alias("conservative"), rules.tier_allows(source, "moderate").alias("moderate"), rules.excludes_all(source, ["metadata"]).alias("only_metadata"), "n")


@query(f"WITH {REL} SELECT source, target, rel_type, ord FROM rel WHERE NOT ({_violation()})")
def signature_filter(spark, sf_dir):
    return quality.check_signatures(relations(spark, sf_dir), drop=True).select("source", "target", "rel_type", "ord")


@query(f"WITH {REL} SELECT target_label, rel_type IN ('member_of', 'joined', 'served_in') AND target_label NOT IN ('ORG', 'INSTITUTION') AS suspect, count(*) AS n FROM rel GROUP BY ALL")
def membership_suspicion(spark, sf_dir):
    marked = relations(spark, sf_dir).withColumn("suspect", quality.suspect_membership(F.col("rel_type"), F.col("target_label")))
    return marked.groupBy("target_label", "suspect").agg(F.count(F.lit(1)).alias("n"))


# Edges and nodes

_DIRECTED = f"CASE WHEN {SYMMETRIC} THEN least(source, target) ELSE source END AS s, CASE WHEN {SYMMETRIC} THEN greatest(source, target) ELSE target END AS t"


def _directed(edges: DataFrame) -> DataFrame:
    return edges.withColumns({"directed": ~rules.is_symmetric(F.col("rel_type")), "origin": F.lit("extracted")})


@query(f"""WITH {REL}, e AS (SELECT *, {_DIRECTED} FROM rel) SELECT s AS source, t AS target, rel_type, count(*) AS n_mentions, count(DISTINCT doc_id) AS weight, string_agg(DISTINCT edge_source, ';' ORDER BY edge_source) AS edge_source,
round(max(confidence), 3) AS confidence, arg_min(evidence, ord) FILTER (evidence <> '') AS evidence, arg_min(year, ord) FILTER (year IS NOT NULL) AS year FROM e GROUP BY 1, 2, 3""")
def aggregated_edges(spark, sf_dir):
    return network.aggregate_edges(_directed(relations(spark, sf_dir))).drop("origin")


@query(f"""WITH {REL}, e AS (SELECT source, target, year, {TIE} AS c FROM rel), n AS (SELECT source AS id, c, year FROM e UNION ALL SELECT target, c, year FROM e)
SELECT id, {", ".join(f"count(*) FILTER (c = '{c}') AS deg_{c}" for c in rules.CLASSES)}, min(year) AS first_year, max(year) AS last_year FROM n GROUP BY id""")
def node_degrees(spark, sf_dir):
    edges = relations(spark, sf_dir).withColumn("tie_class", rules.tie_class(F.col("rel_type"), F.col("source_label"), F.col("target_label")))
    return network.degrees(edges)


@query(f"WITH {REL}, c AS (SELECT *, count(*) OVER (PARTITION BY source, target, rel_type) AS n FROM rel) SELECT source, target, rel_type, ord FROM c WHERE n >= 2 AND source IN (SELECT 's' || s_suppkey FROM supplier WHERE s_acctbal > 0) AND target LIKE 'p%'")
def edge_floor(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.concat(F.lit("s"), "s_suppkey").alias("entity_id"))
    parts = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("entity_id"))
    return quality.edge_floor(relations(spark, sf_dir), suppliers.unionByName(parts), 2).select("source", "target", "rel_type", "ord")


_SUPPLIERS = """links AS (SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem), pairs AS (SELECT x.l_suppkey AS source, y.l_suppkey AS target, CASE WHEN x.l_returnflag = 'R' THEN 'opposed' ELSE 'supported' END AS rel_type
FROM links x JOIN links y ON x.l_partkey = y.l_partkey AND x.l_suppkey < y.l_suppkey AND x.l_returnflag = y.l_returnflag JOIN supplier a ON a.s_suppkey = x.l_suppkey JOIN supplier b ON b.s_suppkey = y.l_suppkey AND a.s_nationkey = b.s_nationkey)"""


def supplier_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of one nation that share a part and flag: opposed for returned parts, else supported."""
    links = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct().join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    left = links.withColumnRenamed("l_suppkey", "source")
    right = links.withColumnRenamed("l_suppkey", "target")
    both = left.join(right, ["l_partkey", "l_returnflag", "s_nationkey"]).filter("source < target")
    made = both.select("source", "target", F.when(F.col("l_returnflag") == "R", "opposed").otherwise("supported").alias("rel_type"))
    return made.withColumn("polarity", rules.polarity(F.col("rel_type")))


@query(f"""WITH {_SUPPLIERS}, net AS (SELECT source AS a, target AS b, sign(sum(CASE WHEN rel_type = 'opposed' THEN -1 ELSE 1 END)) AS s FROM pairs GROUP BY 1, 2), n AS (SELECT * FROM net WHERE s <> 0),
t AS (SELECT x.s * y.s * z.s AS p FROM n x JOIN n y ON x.b = y.a JOIN n z ON z.a = x.a AND z.b = y.b) SELECT count(*) FILTER (p > 0) AS balanced, count(*) FILTER (p < 0) AS unbalanced, round(100.0 * count(*) FILTER (p > 0) / nullif(count(*), 0), 1) AS balance_pct FROM t""")
def signed_balance(spark, sf_dir):
    return network.signed_balance(supplier_signs(spark, sf_dir))


@query(f"WITH {_SUPPLIERS} SELECT source AS a, target AS b, 'supported' AS positive, 'opposed' AS negative FROM pairs GROUP BY 1, 2 HAVING count(DISTINCT rel_type) = 2")
def polarity_conflicts(spark, sf_dir):
    return network.polarity_conflicts(supplier_signs(spark, sf_dir))


@query("""WITH e AS (SELECT user_id AS source, CAST(ts AS DATE) AS day, event_type AS target, value FROM events), g AS (SELECT source, day, count(DISTINCT target) AS k FROM e GROUP BY 1, 2)
SELECT source || '@' || day AS source, count(*) AS n, bool_or(k > 1) AS conflict FROM e JOIN g USING (source, day) GROUP BY 1""")
def functional_conflicts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.concat("user_id", F.lit("@"), F.to_date("ts").cast("string")).alias("source"), F.col("event_type").alias("target"), F.lit("born_in").alias("rel_type"), F.col("value").alias("confidence"))
    marked = quality.functional_conflicts(events)
    return marked.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.bool_or("functional_conflict").alias("conflict"))


@query(f"""WITH {REL} SELECT round(100.0 * count(*) FILTER (list_has_any(string_split(edge_source, ';'), {list(rules.ASSERTED)})) / count(*), 1) AS asserted_pct, round(100.0 * count(*) FILTER (edge_source <> '') / count(*), 1) AS provenance_pct,
round(100.0 * count(year) / count(*), 1) AS dated_pct, count(*) FILTER ({_violation()}) AS violations FROM rel""")
def quality_pillars(spark, sf_dir):
    return network.quality_pillars(quality.check_signatures(relations(spark, sf_dir)), rules.ASSERTED)


@query("""WITH m AS (SELECT o_custkey AS id, count(*) AS mention_count, count(DISTINCT o_orderpriority) AS n_docs, count(DISTINCT CAST(o_orderdate AS DATE)) AS degree FROM orders GROUP BY 1),
a AS (SELECT mention_count AS v, row_number() OVER (ORDER BY mention_count) - 1 AS i, count(*) OVER () AS n FROM m), b AS (SELECT degree AS v, row_number() OVER (ORDER BY degree) - 1 AS i, count(*) OVER () AS n FROM m), c AS (SELECT n_docs AS v, row_number() OVER (ORDER BY n_docs) - 1 AS i, count(*) OVER () AS n FROM m),
p AS (SELECT (SELECT v FROM a WHERE i = round_even(0.5 * (n - 1), 0)) AS m50, (SELECT v FROM a WHERE i = round_even(0.85 * (n - 1), 0)) AS m85, (SELECT v FROM b WHERE i = round_even(0.5 * (n - 1), 0)) AS g50, (SELECT v FROM b WHERE i = round_even(0.85 * (n - 1), 0)) AS g85, (SELECT v FROM c WHERE i = round_even(0.5 * (n - 1), 0)) AS d50, (SELECT v FROM c WHERE i = round_even(0.85 * (n - 1), 0)) AS d85),
s AS (SELECT m.*, p.*, CASE WHEN mention_count >= m85 THEN 1.0 WHEN mention_count >= m50 THEN 0.5 ELSE 0 END + CASE WHEN degree >= g85 THEN 1.0 WHEN degree >= g50 THEN 0.5 ELSE 0 END + CASE WHEN n_docs >= d85 THEN 1.0 WHEN n_docs >= d50 THEN 0.5 ELSE 0 END AS score FROM m, p)
SELECT id AS entity_id, mention_count, n_docs, degree, CASE WHEN (degree >= g85 AND g85 > 0) OR (n_docs >= d85 AND d85 > 0) THEN 'macro' ELSE 'specific' END AS entity_scope, CASE WHEN score >= 2 THEN 'core' WHEN score >= 1 THEN 'secondary' ELSE 'peripheral' END AS relevance_tier FROM s""")
def relevance_tiers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    made = orders.groupBy(F.col("o_custkey").alias("entity_id")).agg(F.count(F.lit(1)).alias("mention_count"), F.count_distinct("o_orderpriority").alias("n_docs"), F.count_distinct(F.to_date("o_orderdate")).alias("degree"))
    return quality.tag_entities(made)


@query("""WITH m AS (SELECT o_custkey AS id, count(*) AS n_docs FROM orders GROUP BY 1), r AS (SELECT n_docs, row_number() OVER (ORDER BY n_docs) - 1 AS i, count(*) OVER () AS n FROM m), c AS (SELECT greatest(5, (SELECT n_docs FROM r WHERE i = floor(0.95 * (n - 1)))) AS cut)
SELECT id AS entity_id, n_docs, n_docs >= cut AS reference_figure FROM m, c""")
def reference_figures(spark, sf_dir):
    made = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity_id")).agg(F.count(F.lit(1)).alias("n_docs"))
    made = made.withColumns({"label": F.lit("PERSON"), "canonical_name": F.col("entity_id").cast("string")})
    return quality.reference_figures(made).select("entity_id", "n_docs", "reference_figure")


# Graph measures

_BACKBONE = "WITH RECURSIVE " + COOC.format(least=2) + _DISPARITY + ", g AS (SELECT a, b, strength AS weight FROM scored WHERE disparity_alpha < 0.3)"


def _graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = network.disparity(network.cooccurrence(_orders(spark, sf_dir)), 0.3)
    return kept.select("a", "b", F.col("strength").alias("weight"))


@query(_BACKBONE + """, e AS (SELECT a AS x, b AS y FROM g UNION SELECT b, a FROM g), w(n, r) AS (SELECT x, x FROM e UNION SELECT e.y, w.r FROM w JOIN e ON e.x = w.n) SELECT n AS node, min(r) AS root FROM w GROUP BY n""")
def components(spark, sf_dir):
    return connected_components(stash(_graph(spark, sf_dir)))


@query(_BACKBONE + """, e AS (SELECT a AS x, b AS y FROM g UNION SELECT b, a FROM g), w(n, r) AS (SELECT x, x FROM e UNION SELECT e.y, w.r FROM w JOIN e ON e.x = w.n), k AS (SELECT n, min(r) AS root FROM w GROUP BY n),
nn AS (SELECT count(*) AS nodes FROM part), t AS (SELECT count(*) AS tied, count(DISTINCT root) AS roots FROM k), m AS (SELECT max(c) AS most FROM (SELECT count(*) AS c FROM k GROUP BY root)), x AS (SELECT count(*) AS edges FROM g)
SELECT nodes, edges, roots + nodes - tied AS components, nodes - tied AS isolates, round(100.0 * most / nodes, 1) AS largest_pct, round(2.0 * edges / (nodes * (nodes - 1)), 6) AS density FROM nn, t, m, x""")
def graph_quality(spark, sf_dir):
    return network.graph_quality(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("id")), _graph(spark, sf_dir))


@query(_BACKBONE + """, b AS (SELECT a AS i, b AS j, weight FROM g UNION ALL SELECT b, a, weight FROM g), t AS (SELECT i, sum(weight) AS s, max(weight) AS m FROM b GROUP BY i), p AS (SELECT b.i, b.j, b.weight / t.s AS p, b.weight / t.m AS m FROM b JOIN t ON t.i = b.i),
v AS (SELECT x.i, y.j, sum(x.p * y.p) AS s FROM p x JOIN p y ON y.i = x.j WHERE x.i <> y.j GROUP BY 1, 2), c AS (SELECT p.i, sum(pow(p.p + coalesce(v.s, 0), 2)) AS c, count(*) AS n FROM p LEFT JOIN v ON v.i = p.i AND v.j = p.j GROUP BY 1),
r AS (SELECT x.i, sum(x.p * y.m) AS r FROM p x JOIN p y ON y.j = x.j JOIN p z ON z.i = x.i AND z.j = y.i GROUP BY 1) SELECT c.i AS id, round(c, 6) AS "constraint", round(n - coalesce(r.r, 0), 6) AS effective_size FROM c LEFT JOIN r ON r.i = c.i""")
def burt_measures(spark, sf_dir):
    return network.constraint(_graph(spark, sf_dir)).select("id", F.round("constraint", 6).alias("constraint"), F.round("effective_size", 6).alias("effective_size"))


@query()
def cut_points(spark, sf_dir):
    return network.cut_points(_graph(spark, sf_dir))


@query(f"WITH {REL} SELECT least(source, target) AS a, greatest(source, target) AS b, CAST(count(*) AS BIGINT) AS weight FROM rel WHERE {TIE} IN ('interaction', 'affiliation') GROUP BY 1, 2")
def simple_graph(spark, sf_dir):
    edges = relations(spark, sf_dir).withColumns({"tie_class": rules.tie_class(F.col("rel_type"), F.col("source_label"), F.col("target_label")), "weight": F.lit(1)})
    return network.simple_graph(edges, classes=("interaction", "affiliation"))


# Sequences, best records, scores


@query("""WITH s AS (SELECT user_id, event_type AS source, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS target FROM events) SELECT source, target, count(*) AS weight, count(DISTINCT user_id) AS n_docs FROM s WHERE target IS NOT NULL AND source <> target GROUP BY 1, 2""")
def narrative_transitions(spark, sf_dir):
    return narrative.transitions(table(spark, sf_dir, "events"), "user_id", "event_type", ("ts", "event_id"))


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id DESC) AS r FROM events) SELECT user_id, event_id, event_type, value FROM s WHERE r = 1""")
def best_records_by_user(spark, sf_dir):
    return best_records(table(spark, sf_dir, "events"), "user_id", "value", "event_id").select("user_id", "event_id", "event_type", "value")


@query("""SELECT p.event_id, CASE WHEN count(DISTINCT s.event_id) > 0 AND count(DISTINCT s.v) = 1 THEN min(s.v) END AS antecedent FROM (SELECT *, epoch_us(ts) // 1000000 AS t FROM events WHERE event_type = 'purchase') p LEFT JOIN (SELECT event_id, user_id, epoch_us(ts) // 1000000 AS t, CAST(floor(value) AS BIGINT) AS v FROM events WHERE event_type = 'signup') s
ON s.user_id = p.user_id AND s.t BETWEEN p.t - 86400 AND p.t - 1 GROUP BY 1""")
def nearest_antecedent(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumns({"t": F.unix_timestamp("ts"), "v": F.floor("value")})
    return extract.nearest_before(events, "user_id", "t", "event_type", "purchase", "signup", 86400, "v").select("event_id", "antecedent")


@query("""WITH e AS (SELECT event_id, user_id, epoch_us(ts) // 1000000 AS s, epoch_us(ts) // 1000000 + 1800 AS e FROM events), r AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM e),
g AS (SELECT *, sum(CASE WHEN m IS NULL OR s >= m THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM r) SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(s) AS first_second, max(e) AS last_second FROM g GROUP BY 1, 2""")
def span_islands(spark, sf_dir):
    spans = table(spark, sf_dir, "events").select("user_id", F.unix_timestamp("ts").alias("start"), (F.unix_timestamp("ts") + 1800).alias("end"))
    return extract.span_groups(spans, "user_id").groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("first_second"), F.max("end").alias("last_second"))


_PREDICTED = "p AS (SELECT d.doc_id, CASE WHEN d.n_chars > 600 THEN 1 ELSE 0 END AS quality, d.lang FROM documents d JOIN labels l USING (doc_id)), g AS (SELECT doc_id, quality, lang FROM labels JOIN documents USING (doc_id))"


def _predicted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    both = docs.join(labels, "doc_id")
    return both.select("doc_id", F.when(F.col("n_chars") > 600, 1).otherwise(0).alias("quality"), "lang"), both.select("doc_id", "quality", "lang")


@query(f"""WITH {_PREDICTED}, x AS (SELECT coalesce(p.lang, g.lang) AS lang, p.doc_id IS NOT NULL AS hp, g.doc_id IS NOT NULL AS hg FROM p FULL JOIN g ON p.doc_id = g.doc_id AND p.quality = g.quality AND p.lang = g.lang), c AS (SELECT lang, count(*) FILTER (hp AND hg) AS tp, count(*) FILTER (NOT hg) AS fp, count(*) FILTER (NOT hp) AS fn FROM x GROUP BY lang)
SELECT lang, tp, fp, fn, round(tp / (tp + fp), 9) AS "precision", round(tp / (tp + fn), 9) AS recall, round(2.0 * tp / (2 * tp + fp + fn), 9) AS f1 FROM c""")
def precision_recall(spark, sf_dir):
    scored = scoring.score_sets(*_predicted(spark, sf_dir), ["doc_id", "quality", "lang"], ["lang"])
    return scored.select("lang", "tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("""WITH r AS (SELECT least(1.0, n_chars / 5000.0) AS c, quality FROM documents JOIN labels USING (doc_id)), b(bin, low, high) AS (VALUES (0, 0.0, 0.5), (1, 0.5, 0.6), (2, 0.6, 0.7), (3, 0.7, 0.8), (4, 0.8, 0.9), (5, 0.9, 1.01))
SELECT bin, CAST(low AS DOUBLE) AS low, CAST(least(high, 1.0) AS DOUBLE) AS high, count(quality) AS n, round(avg(quality), 9) AS accuracy, round(abs((low + least(high, 1.0)) / 2 - avg(quality)), 9) AS gap FROM b LEFT JOIN r ON c >= low AND c < high GROUP BY bin, low, high""")
def calibration_bins(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(F.least(F.lit(1.0), F.col("n_chars") / 5000.0).alias("confidence"), F.col("quality").alias("correct"))
    made = scoring.calibration(rows)
    return made.select("bin", "low", "high", "n", F.round("accuracy", 9).alias("accuracy"), F.round("gap", 9).alias("gap"))


@query("""SELECT label, rank, vec_id, round(score, 6) AS score FROM (SELECT label, vec_id, score, row_number() OVER (PARTITION BY label ORDER BY round(score, 6) DESC, vec_id) AS rank FROM (SELECT e.label, e.vec_id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS score FROM embeddings e JOIN (SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label) c USING (label))) WHERE rank <= 5""")
def label_neighbours(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    heads = rows.groupBy("label").agg(F.min_by("v", "vec_id").alias("h"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = rows.join(heads, "label").withColumn("score", F.round(dot("v", "h") / F.sqrt(dot("v", "v") * dot("h", "h")), 6))
    by = Window.partitionBy("label").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(by)).filter("rank <= 5").select("label", "rank", "vec_id", "score")


# Relational basics


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


@query("""SELECT r_name, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def revenue_rollup(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
