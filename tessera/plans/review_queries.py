"""Queries of the output tables, reviews, checks, crawl rules and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import domain, names, rules
from ..functions.text import name_key
from ..functions.urls import host_key
from ..operators import evaluation, exports, extract, inference, network, quality, relations, replies, review, validation
from ..sources import crawl
from .graph_queries import CONNECTION, LABELS, POLARITY, REL, SYMMETRIC, TIE, _in, _list, _listed, pick, table
from .graph_queries import relations as made_relations
from .registry import query

_ENTITIES = f"""ent AS (SELECT 's' || s_suppkey AS entity_id, s_name AS canonical_name, {_list(LABELS, "s_suppkey")} AS label, s_suppkey % 7 AS mention_count FROM supplier
UNION ALL SELECT 'p' || p_partkey, p_name, {_list(LABELS, "p_partkey")}, p_partkey % 7 FROM part)"""


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and parts as entities, with the ids of the relations' ends."""
    one = lambda name, key, shown, letter: table(spark, sf_dir, name).select(
        F.concat(F.lit(letter), key).alias("entity_id"), F.col(shown).alias("canonical_name"), pick(LABELS, F.col(key)).alias("label"), (F.col(key) % 7).alias("mention_count"),
        F.array().cast("array<string>").alias("aliases"), F.array(F.col(key).cast("string")).alias("doc_ids"), F.lit(0.5).alias("confidence"), F.lit(False).alias("is_author"),
    )
    both = one("supplier", "s_suppkey", "s_name", "s").unionByName(one("part", "p_partkey", "p_name", "p"))
    return both.withColumn("key", name_key(F.col("canonical_name")))


@query(f"WITH {REL}, {_ENTITIES}, ends AS (SELECT source AS e FROM rel UNION ALL SELECT target FROM rel) SELECT entity_id, count(e) AS degree FROM ent LEFT JOIN ends ON e = entity_id GROUP BY 1")
def degree_tags(spark, sf_dir):
    return exports.degree_tags(_entities(spark, sf_dir), made_relations(spark, sf_dir)).select("entity_id", "degree")


_DEGREES = ", ".join(f"count(*) FILTER (tie = '{c}') AS deg_{c}" for c in rules.CLASSES)


@query(f"""WITH {REL}, {_ENTITIES}, r AS (SELECT *, {TIE} AS tie FROM rel), ends AS (SELECT source AS e, tie, year FROM r UNION ALL SELECT target, tie, year FROM r)
SELECT entity_id AS "Id", canonical_name AS "Label", label AS type, mention_count, 1 AS doc_count, '' AS aliases, CAST(min(year) AS INTEGER) AS first_year, CAST(max(year) AS INTEGER) AS last_year, {_DEGREES}, 0.5 AS confidence
FROM ent LEFT JOIN ends ON e = entity_id GROUP BY entity_id, canonical_name, label, mention_count""")
def node_table(spark, sf_dir):
    tied = made_relations(spark, sf_dir).withColumn("tie_class", rules.tie_class(F.col("rel_type"), F.col("source_label"), F.col("target_label")))
    return exports.node_table(_entities(spark, sf_dir), tied)


@query(f"""WITH {REL}, {_ENTITIES}, e AS (SELECT source, target, rel_type, count(*) AS n, count(DISTINCT doc_id) AS w, round(max(confidence), 3) AS c, string_agg(DISTINCT edge_source, ';' ORDER BY edge_source) AS src, arg_min(evidence, ord) FILTER (evidence <> '') AS ev,
arg_min(year, ord) FILTER (year IS NOT NULL) AS y, min(source_label) AS source_label, min(target_label) AS target_label FROM (SELECT CASE WHEN {SYMMETRIC} THEN least(source, target) ELSE source END AS source, CASE WHEN {SYMMETRIC} THEN greatest(source, target) ELSE target END AS target,
rel_type, doc_id, ord, confidence, evidence, year, edge_source, CASE WHEN {SYMMETRIC} THEN target_label ELSE source_label END AS source_label, CASE WHEN {SYMMETRIC} THEN source_label ELSE target_label END AS target_label FROM rel) GROUP BY 1, 2, 3)
SELECT 'edge_' || substr(sha1(source || '||' || target || '||' || rel_type), 1, 12) AS "Id", rel_type, CASE WHEN {SYMMETRIC} THEN 'Undirected' ELSE 'Directed' END AS "Type", {TIE} AS tie_class, {CONNECTION} AS connection_type, {POLARITY} AS polarity, w AS "Weight", n AS n_mentions,
CAST(y AS INTEGER) AS year, src AS edge_source, c AS confidence, a.canonical_name AS source_name, b.canonical_name AS target_name, coalesce(ev, '') AS evidence FROM e JOIN ent a ON a.entity_id = source JOIN ent b ON b.entity_id = target""")
def edge_table(spark, sf_dir):
    edges = made_relations(spark, sf_dir).withColumns({"directed": ~rules.is_symmetric(F.col("rel_type")), "origin": F.lit("extracted")})
    packed = network.aggregate_edges(edges).withColumn("directed", ~rules.is_symmetric(F.col("rel_type")))
    shown = exports.edge_table(packed, _entities(spark, sf_dir))
    return shown.select("Id", "rel_type", "Type", "tie_class", "connection_type", "polarity", "Weight", "n_mentions", "year", "edge_source", "confidence", "source_name", "target_name", "evidence")


@query(f"WITH {REL}, pairs AS (SELECT DISTINCT source, target, rel_type, NOT {SYMMETRIC} AS directed FROM (SELECT 'n' || l_suppkey % 40 AS source, 'n' || l_partkey % 40 AS target, rel_type FROM (SELECT CAST(substr(source, 2) AS INTEGER) AS l_suppkey, CAST(substr(target, 2) AS INTEGER) AS l_partkey, rel_type FROM rel)))"
       " SELECT p.*, p.directed AND p.source <> p.target AND EXISTS (SELECT 1 FROM pairs q WHERE q.source = p.target AND q.target = p.source AND q.rel_type = p.rel_type AND q.directed) AS reciprocal FROM pairs p")  # fmt: skip
def reciprocal_edges(spark, sf_dir):
    number = lambda c: F.concat(F.lit("n"), F.substring(c, 2, 20).cast("int") % 40)
    pairs = made_relations(spark, sf_dir).select(number("source").alias("source"), number("target").alias("target"), "rel_type", (~rules.is_symmetric(F.col("rel_type"))).alias("directed")).distinct()
    return exports.reciprocal(pairs).select("source", "target", "rel_type", "directed", "reciprocal")


@query("""SELECT o_orderkey AS doc_id, o_custkey AS letter_id, 'order ' || o_orderkey AS date_text, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso_date, CAST(year(o_orderdate) AS INTEGER) AS year,
repeat('x', CAST(o_orderkey % 600 AS INTEGER))[1:500] AS description, 'a; b' AS entities, round(0.1234 + o_orderkey % 5, 3) AS confidence FROM orders""")
def timeline_table(spark, sf_dir):
    key = F.col("o_orderkey")
    events = table(spark, sf_dir, "orders").select(
        key.alias("doc_id"), F.col("o_custkey").alias("letter_id"), F.concat(F.lit("order "), key).alias("date_text"), F.when(key % 3 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("iso_date"),
        F.year("o_orderdate").alias("year"), F.repeat(F.lit("x"), (key % 600).cast("int")).alias("description"), F.array(F.lit("a"), F.lit("b")).alias("entities"), (0.1234 + key % 5).alias("confidence"),
    )
    return exports.timeline_table(events)


_VIOLATIONS = " ".join(f"WHEN rel_type = '{n}' THEN " + " OR ".join(f"{c} IN {_in([x for x in rules.CORE_LABELS if x not in rules.allowed_labels(s)])}" for c, s in zip(("source_label", "target_label"), sides, strict=True)) for n, sides in rules.SIGNATURES.items())


@query(f"WITH {REL} SELECT rel_type, count(*) AS n FROM rel WHERE CASE {_VIOLATIONS} ELSE false END GROUP BY 1")
def violations_by_relation(spark, sf_dir):
    return exports.violations_by_relation(quality.check_signatures(made_relations(spark, sf_dir)))


@query("SELECT CAST(c_custkey AS VARCHAR) AS entity_id, c_custkey * 37 % 101 AS mention_count FROM customer WHERE c_custkey * 37 % 101 >= 2 AND c_custkey % 3 <> 0 ORDER BY 2 DESC, 1 LIMIT 400")
def linking_candidates(spark, sf_dir):
    key = F.col("c_custkey")
    made = table(spark, sf_dir, "customer").select(key.cast("string").alias("entity_id"), F.when(key % 3 == 0, "EVENT").otherwise("ORG").alias("label"), (key * 37 % 101).alias("mention_count"))
    return exports.linking_candidates(made).select("entity_id", "mention_count")


@query("""WITH e AS (SELECT c_custkey, 'L' || c_custkey % 3 AS label, c_custkey * 37 % 101 AS m FROM customer WHERE c_custkey % 5 <> 0), p AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY m DESC, CAST(c_custkey AS VARCHAR)) AS place FROM e)
SELECT label, CAST(c_custkey AS VARCHAR) AS entity_id, CAST(place AS INTEGER) AS place FROM p WHERE place <= 300""")
def proposal_names(spark, sf_dir):
    key = F.col("c_custkey")
    name = F.when(key % 5 == 0, "12.3.1921").otherwise("Some name")
    made = table(spark, sf_dir, "customer").select(key.cast("string").alias("entity_id"), F.concat(F.lit("L"), key % 3).alias("label"), (key * 37 % 101).alias("mention_count"), name.alias("canonical_name"))
    return exports.proposal_names(made).select("label", "entity_id", "place")


@query(f"""WITH {REL}, {_ENTITIES}, ends AS (SELECT source AS e FROM rel UNION SELECT target FROM rel)
SELECT 'entities' AS measure, CAST(count(*) AS DOUBLE) AS value FROM ent UNION ALL SELECT 'isolated_nodes', count(*) FROM ent WHERE entity_id NOT IN (SELECT e FROM ends) UNION ALL SELECT 'author_nodes', 0 UNION ALL SELECT 'pct_entities_with_alias', 0
UNION ALL SELECT 'edges', count(*) FROM rel UNION ALL SELECT 'member_of_edges', count(*) FROM rel WHERE rel_type = 'member_of' UNION ALL SELECT 'pct_edges_with_evidence', round(100.0 * count(*) FILTER (evidence <> '') / count(*), 1) FROM rel UNION ALL SELECT 'timeline', count(*) FROM orders""")
def run_counts(spark, sf_dir):
    return validation.run_counts(_entities(spark, sf_dir), made_relations(spark, sf_dir), table(spark, sf_dir, "orders"))


@query("""WITH e AS (SELECT lower(p_name) AS k, max('p' || p_partkey) AS id FROM part GROUP BY 1), a AS (SELECT p_name AS alias, lag(p_name) OVER (ORDER BY p_partkey) AS canonical FROM part)
SELECT alias, canonical FROM a JOIN e x ON x.k = lower(alias) JOIN e y ON y.k = lower(canonical) WHERE lower(alias) <> lower(canonical) AND x.id <> y.id""")
def alias_misses(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    after = parts.select((F.col("p_partkey") + 1).alias("p_partkey"), F.col("p_name").alias("canonical"))
    aliases = parts.join(after, "p_partkey").select(F.col("p_name").alias("alias"), "canonical")
    return validation.alias_misses(_entities(spark, sf_dir).filter("entity_id LIKE 'p%'"), aliases)


@query("SELECT count(DISTINCT lower(c_name)) AS known, count(DISTINCT CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) END) AS found, round(100.0 * count(DISTINCT CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) END) / count(DISTINCT lower(c_name)), 1) AS coverage_pct FROM customer")
def known_coverage(spark, sf_dir):
    people = table(spark, sf_dir, "customer")
    entities = people.filter("c_custkey % 2 = 0").select(F.lit("x").alias("canonical_name"), F.array("c_name").alias("aliases"))
    return validation.known_coverage(entities, people.select(F.col("c_mktsegment").alias("alias"), F.col("c_name").alias("canonical")))


@query("SELECT lower(replace(c_name, '#', '')) AS author, c_custkey % 2 = 0 AS found, c_custkey % 4 = 0 AS flagged FROM customer")
def author_coverage(spark, sf_dir):
    people, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    entities = people.filter("c_custkey % 2 = 0").select(key.alias("entity_id"), F.lit("PERSON").alias("label"), F.col("c_name").alias("canonical_name"), F.array().cast("array<string>").alias("aliases"), (key % 4 == 0).alias("is_author"))
    return validation.author_coverage(entities, people.select(F.col("c_name").alias("author")))


_TOLD = ("the DAP met", "a Reichswehr barracks", "nothing known", "he joined the NSDAP and the SPD", "Gestapo men")
_FOUND = ("DAP", "Reichswehr", None, "NSDAP", "Gestapo")


def _quoted(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


_WHO = "CASE o_orderkey % 5 " + " ".join(f"WHEN {i} THEN {_quoted(v)}" for i, v in enumerate(_FOUND)) + " END"


@query(f"""WITH w(org, a, b) AS (VALUES {", ".join(f"('{o}', {a}, {b})" for o, (a, b) in domain.EXISTENCE.items())}), e AS (SELECT o_orderkey, CAST(1890 + o_orderkey % 70 AS INTEGER) AS y, {_WHO} AS who FROM orders),
r AS (SELECT o_orderkey, who, CASE WHEN y NOT BETWEEN 1900 AND 1946 THEN 'outside the period' WHEN y < a THEN 'before it existed' WHEN y > b THEN 'after it ended' ELSE '' END AS message FROM e LEFT JOIN w ON org = who)
SELECT o_orderkey || ':d' AS item, CASE WHEN who IS NULL THEN 'implausible_date' ELSE 'anachronism' END AS kind, message FROM r WHERE message <> ''""")
def timeline_findings(spark, sf_dir):
    key = F.col("o_orderkey")
    events = table(spark, sf_dir, "orders").select(key.alias("doc_id"), F.lit("d").alias("date_text"), (1890 + key % 70).cast("int").alias("year"), pick(_TOLD, key).alias("description"))
    return validation.timeline_findings(events)


_RANKS = ("SS-Mann", "Uffz.", "Sturmmann", "SA-Sturmmann", "")


@query("""WITH h AS (SELECT c_custkey AS k, c_custkey % 5 AS r FROM customer WHERE c_custkey % 5 IN (0, 3)) SELECT 'c' || k AS item, 'rank_mismatch' AS kind FROM h
WHERE NOT (k % 2 = 0 AND r = 0)""")
def rank_findings(spark, sf_dir):
    key = F.col("c_custkey")
    people = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), key).alias("entity_id"), F.concat(F.lit("person "), key).alias("canonical_name"), F.lit("PERSON").alias("label"), pick(_RANKS, key).alias("rank"))
    unit = spark.createDataFrame([("o1", "SS (Schutzstaffel)", "ORG", "")], "entity_id string, canonical_name string, label string, rank string")
    edges = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.concat(F.lit("c"), key).alias("source"), F.lit("o1").alias("target"))
    return validation.rank_findings(people.unionByName(unit), edges).select("item", "kind")


@query("""WITH s AS (SELECT o_orderkey, o_orderdate AS d, year(o_orderdate) % 100 AS yy FROM orders), y AS (SELECT *, CASE WHEN 1900 + yy <= 1990 THEN 1900 + yy ELSE 1800 + yy END AS year FROM s)
SELECT o_orderkey AS doc_id, strftime(d, '%-m/%-d/%y') AS date_text, coalesce(strftime(TRY_CAST(year || strftime(d, '-%m-%d') AS DATE), '%Y-%m-%d'), CAST(year AS VARCHAR)) AS iso_date, CAST(year AS INTEGER) AS year FROM y""")
def short_dates(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("on "), F.date_format("o_orderdate", "M/d/yy"), F.lit(" it came")).alias("text"))
    return extract.dates(docs, pivot=1990)


_ROBOTS = "User-agent: other\nDisallow: /\n\nUser-agent: *\nAllow: /en/1\nDisallow: /en/\nCrawl-delay: 2\n"


@query(r"SELECT url FROM pages WHERE NOT (regexp_matches(url, '^[a-z]+://[^/]+/en/') AND NOT regexp_matches(url, '^[a-z]+://[^/]+/en/1'))")
def permitted_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("url")
    robots = pages.select(host_key(F.col("url")).alias("host"), F.lit(_ROBOTS).alias("text")).distinct()
    return crawl.permitted(pages, crawl.robot_rules(robots, "reader/1.0"))


#: Pages of a sitemap file, and files of an index file, about.
_FILE = 1000


@query("SELECT DISTINCT url FROM pages WHERE NOT regexp_matches(lower(url), '\\.(pdf|jpg|jpeg|png|gif|zip)$')")
def sitemap_pages(spark, sf_dir):
    """Files of about a thousand pages of one host, index files of about a thousand of these, and a root that lists the index
    files: no row grows with a host or the table."""
    pages = table(spark, sf_dir, "pages").select("url", "page_id", F.coalesce(host_key(F.col("url")), F.lit("")).alias("h"))
    share = lambda n: F.ceil(F.col(n) / _FILE)
    parts = pages.groupBy("h").agg(F.count(F.lit(1)).alias("_n"))
    total = parts.agg(F.sum(share("_n")).alias("_m"))  # one row
    file = F.concat(F.lit("https://"), "h", F.lit("/pages"), F.pmod(F.xxhash64("page_id", "url"), share("_n")), F.lit(".xml"))
    placed = pages.join(parts, "h").select(file.alias("file"), "url")
    wrap = lambda tag, items: F.concat(F.lit(f"<{tag}>"), F.array_join(F.collect_list(items), ""), F.lit(f"</{tag}>")).alias("text")
    loc = F.concat(F.lit("<url><loc> "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </loc></url>"))
    leaves = placed.groupBy(F.col("file").alias("url")).agg(wrap("urlset", loc))
    listed = lambda files, by: files.groupBy(by.alias("_i")).agg(wrap("sitemapindex", F.concat(F.lit("<loc>"), "url", F.lit("</loc>")))).select(F.col("_i").alias("url"), "text")
    names = placed.select(F.col("file").alias("url")).distinct().crossJoin(total)
    index = listed(names, F.concat(F.lit("index"), F.pmod(F.xxhash64("url"), share("_m"))))
    root = listed(index.select("url"), F.lit("root"))
    return crawl.sitemap_urls(leaves.unionByName(index).unionByName(root), spark.createDataFrame([("root",)], "url string"))


_PHRASES = (("MIT License", "LICENSE"), ("apache license", "LICENSE"), ("General Public License", "LICENSE"))


@query(r"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+(?:[''’.-][\p{L}\p{N}]+)*') AS w FROM documents), s AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM t),
h AS (SELECT doc_id, i, lower(array_to_string(w[i + 1 : i + 2], ' ')) AS two, lower(array_to_string(w[i + 1 : i + 3], ' ')) AS three FROM s)
SELECT doc_id, CAST(i AS INTEGER) AS first, CASE WHEN three = 'general public license' THEN 3 ELSE 2 END AS n_words FROM h WHERE two IN ('mit license', 'apache license') OR three = 'general public license'""")
def gazetteer_hits(spark, sf_dir):
    phrases = spark.createDataFrame(list(_PHRASES), "phrase string, label string")
    return relations.gazetteer(table(spark, sf_dir, "documents"), phrases, 3).select("doc_id", "first", "n_words")


_SUBTYPES = ("Maker", "unknown", "ORG", "poet", "  dealer ")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS entity_id, CASE WHEN c_custkey % 2 = 0 THEN CASE c_custkey % 5 WHEN 0 THEN 'maker' WHEN 4 THEN 'dealer' END END AS subtype, CASE WHEN c_custkey % 3 = 0 THEN 'own' WHEN c_custkey % 2 = 0 THEN 'told' END AS city FROM customer""")
def enriched(spark, sf_dir):
    key, people = F.col("c_custkey"), table(spark, sf_dir, "customer")
    some = lambda v: F.create_map(F.lit("city"), F.lit(v))
    entities = people.select(key.cast("string").alias("entity_id"), name_key(F.col("c_name")).alias("key"), F.lit("ORG").alias("label"), F.lit(None).cast("string").alias("subtype"), F.when(key % 3 == 0, some("own")).alias("attributes"))
    records = people.filter("c_custkey % 2 = 0").select(F.col("c_name").alias("name"), pick(_SUBTYPES, key).alias("subtype"), some("told").alias("attributes"))
    vocabulary = spark.createDataFrame([("ORG", "Maker"), ("ORG", "dealer"), ("PERSON", "poet")], "label string, subtype string")
    return review.enrich(entities, records, vocabulary).select("entity_id", "subtype", F.try_element_at("attributes", F.lit("city")).alias("city"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS entity_id, CASE WHEN s_suppkey % 4 > 1 AND s_suppkey % 3 <> 0 THEN 'Q' || s_suppkey END AS wikidata_qid FROM supplier")
def linked_entities(spark, sf_dir):
    key, firms = F.col("s_suppkey"), table(spark, sf_dir, "supplier")
    entities = firms.select(key.cast("string").alias("entity_id"), F.col("s_name").alias("canonical_name"), F.lit("ORG").alias("label"), (key % 4).alias("mention_count"))
    about = F.when(key % 3 == 0, "city in the north").otherwise("maker of parts")
    lookups = firms.select(F.upper("s_name").alias("name"), F.concat(F.lit("Q"), key).alias("qid"), F.lit("u").alias("url"), F.col("s_name").alias("title"), about.alias("description"))
    return review.link(entities, lookups, most=100000).select("entity_id", "wikidata_qid")


_FAMILY = f"coalesce({_listed('rel_type', rules.TIE_CLASS)}, rel_type)"


@query(f"""WITH {REL}, n AS (SELECT rel_type, edge_source, 's' || CAST(substr(source, 2) AS INTEGER) % 20 AS source, 's' || CAST(substr(target, 2) AS INTEGER) % 20 AS target FROM rel),
k AS (SELECT CASE WHEN {SYMMETRIC} THEN least(source, target) ELSE source END AS a, CASE WHEN {SYMMETRIC} THEN greatest(source, target) ELSE target END AS b, least(source, target) AS lo, greatest(source, target) AS hi, rel_type, {_FAMILY} AS family, edge_source = 'metadata' AS pred, edge_source <> '' AS gold FROM n WHERE source <> target),
v AS (SELECT 'typed' AS view, a, b, rel_type AS slot, pred, gold FROM k UNION ALL SELECT 'family', a, b, family, pred, gold FROM k UNION ALL SELECT 'untyped', a, b, '', pred, gold FROM k),
c AS (SELECT view, a, b, slot, bool_or(pred) AS p, bool_or(gold) AS g FROM v GROUP BY ALL HAVING p OR g), s AS (SELECT view, slot, p, g FROM c WHERE view <> 'untyped' UNION ALL SELECT view, '*', p, g FROM c)
SELECT view, slot, count(*) FILTER (p AND g) AS tp, count(*) FILTER (p AND NOT g) AS fp, count(*) FILTER (g AND NOT p) AS fn FROM s GROUP BY 1, 2""")
def relation_scores(spark, sf_dir):
    names = lambda c: F.concat(F.lit("s"), F.substring(c, 2, 20).cast("int") % 20)
    edges = made_relations(spark, sf_dir).select(names("source").alias("source"), names("target").alias("target"), "rel_type", "edge_source")
    nodes = spark.range(20).select(F.concat(F.lit("s"), "id").alias("name"), F.lit("ORG").alias("type"), F.array().cast("array<string>").alias("aliases"), F.col("id").alias("ord"))
    return evaluation.relation_scores(nodes, edges.filter("edge_source = 'metadata'"), nodes, edges.filter("edge_source <> ''")).select("view", "slot", "tp", "fp", "fn")


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's reply on each order: two relations, the second with an end missing at every third."""
    key, other = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(F.lit("Rome"))
    shown = F.format_string(
        '```json\n{"entities": [{"name": "Anna %d", "type": "person", "confidence": 0.9}, {"name": "anna %d", "type": "ORG"}, {"name": "X", "type": "thing"}], "relations": [{"source": "Anna %d", "target": "Bob", "type": "met_with", "evidence": "e", "year": %d,}, '
        '{"source": "Anna", "target": "%s", "confidence": 0}], "events": [{"date": "%s", "description": "d", "entities": ["Anna", ""]}, {"date": "6 years old"}]}\n```',
        key, key, key, key % 50, other, F.date_format("o_orderdate", "yyyy-MM-dd"),
    )
    return replies.extractions(table(spark, sf_dir, "orders").select(key.cast("string").alias("doc_id"), shown.alias("reply")))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'Anna ' || o_orderkey AS text, 'PERSON' AS label, 0.9 AS confidence FROM orders")
def reply_mentions(spark, sf_dir):
    return replies.reply_mentions(_replies(spark, sf_dir), ("PERSON", "ORG")).select("doc_id", "text", "label", "confidence")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'Anna ' || o_orderkey AS source, 'Bob' AS target, 'met_with' AS rel_type, 0.6 AS confidence, CAST(o_orderkey % 50 AS VARCHAR) AS qual_year FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'Anna', 'Rome', 'related_to', 0.6, '' FROM orders WHERE o_orderkey % 3 <> 0""")
def reply_relations(spark, sf_dir):
    return replies.reply_relations(_replies(spark, sf_dir), qualifiers=("year",)).select("doc_id", "source", "target", "rel_type", "confidence", "qual_year")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, strftime(o_orderdate, '%Y-%m-%d') AS iso_date, CAST(year(o_orderdate) AS INTEGER) AS year, 'd' AS description, 'Anna' AS entities FROM orders")
def reply_timeline(spark, sf_dir):
    return replies.reply_timeline(_replies(spark, sf_dir)).select("doc_id", "iso_date", "year", "description", F.array_join("entities", ";").alias("entities"))


_FILES = ("August Spanku239694.rtf", "unknown12.rtf", "NN.txt", "Berg.v2.txt", "77.rtf")
_AUTHORS = ("August Spanku", None, None, "Berg.v", None)
_NUMBERS = ("239694", "12", None, "2", "77")
_CHOSEN = lambda values: "CASE o_orderkey % 5 " + " ".join(f"WHEN {i} THEN {_quoted(v)}" for i, v in enumerate(values)) + " END"


@query(f"SELECT o_orderkey, {_CHOSEN(_AUTHORS)} AS author, {_CHOSEN(_NUMBERS)} AS number FROM orders")
def file_authors(spark, sf_dir):
    file = pick(_FILES, F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", names.file_author(file).alias("author"), names.file_number(file).alias("number"))


_SENTENCES = ("geboren am 5.5.1898 dort", "Ich wohnte lange hier", "mein Vater wurde hier geboren", "nichts", "I was born and lived here")


@query("""WITH m AS (SELECT DISTINCT 'c' || o_custkey AS source, 'n' || o_orderkey % 25 AS target, CASE WHEN o_orderkey % 5 = 1 THEN 'resided_in' ELSE 'born_in' END AS rel_type FROM orders WHERE o_orderkey % 5 IN (0, 1, 4)),
e AS (SELECT 'c' || c_custkey AS source, 'n5' AS target, CASE WHEN c_custkey % 2 = 0 THEN 'resided_in' ELSE 'located_in' END AS rel_type FROM customer WHERE c_custkey % 3 = 0)
SELECT * FROM m UNION SELECT * FROM e WHERE (source, target) NOT IN (SELECT (source, target) FROM m)""")
def biographical_edges(spark, sf_dir):
    key, order = F.col("c_custkey"), F.col("o_orderkey")
    none = F.array().cast("array<string>")
    people = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), key).alias("entity_id"), F.concat(F.lit("person "), key).alias("canonical_name"), none.alias("aliases"), F.lit("PERSON").alias("label"), F.lit(1).alias("mention_count"), F.lit(True).alias("is_author"), F.array(key).alias("doc_ids"))
    places = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("entity_id"), F.concat(F.lit("place "), "n_nationkey").alias("canonical_name"), none.alias("aliases"), F.lit("LOCATION").alias("label"), F.lit(1).alias("mention_count"), F.lit(False).alias("is_author"), F.array().cast("array<bigint>").alias("doc_ids"))
    told = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("long").alias("doc_id"), F.concat(F.lit("Place "), order % 25).alias("text"), F.lit("LOCATION").alias("label"), pick(_SENTENCES, order).alias("sentence"), order.alias("ord"))
    rel, proof = F.when(key % 2 == 0, "lived_in").otherwise("located_in"), F.when(key % 2 == 0, "I lived there").otherwise("geb. Krotzki")
    edges = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.concat(F.lit("c"), key).alias("source"), F.lit("n5").alias("target"), rel.alias("rel_type"), key.alias("doc_id"), proof.alias("evidence"), F.lit(0.6).alias("confidence"), F.lit("llm_extracted").alias("edge_source"), key.alias("ord"))
    made = inference.biographical_edges(people.unionByName(places), edges, told)
    return made.select("source", "target", "rel_type").distinct()
