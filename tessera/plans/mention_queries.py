"""Queries of the mention operators, over phrases and spans made of the tables' keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mentions, resolve
from ..operators.mentions import FIRST_PERSON, FUNCTION_WORDS, NARRATION, NO_PERSON, THIRD_PERSON
from .graph_queries import _in, _list, pick, table
from .registry import query

PHRASES = ("in Anna Berg", "Bofur and", "Anna Berg and Max Vogt", "Berg and Company", "The Shire", "und im Rome", "Max & Ida", "for", "by the Lake with")
_WORDS = "|".join(FUNCTION_WORDS)


@query(rf"""WITH m AS (SELECT o_orderkey AS doc_id, {_list(PHRASES, "o_orderkey")} AS text, CASE WHEN o_orderkey % 4 = 0 THEN 'LOCATION' ELSE 'PERSON' END AS label, o_custkey % 100 AS s FROM orders),
l AS (SELECT *, regexp_replace(text, '^(?:(?:{_WORDS})\s+)+', '', 'i') AS led FROM m), k AS (SELECT *, regexp_replace(led, '(?:\s+(?:{_WORDS}))+$', '', 'i') AS kept FROM l), p AS (SELECT *, string_split_regex(kept, '\s+(?:and|und|&)\s+') AS parts FROM k),
q AS (SELECT *, label = 'PERSON' AND len(parts) = 2 AND len(list_filter(parts, lambda x: regexp_matches(x, '^[A-Z]\S*(\s+[A-Z]\S*)?(\s+[A-Z]\S*)?$') AND lower(string_split(x, ' ')[-1]) NOT IN {_in(NO_PERSON)})) = 2 AS pair FROM p),
u AS (SELECT *, unnest(CASE WHEN pair THEN parts ELSE [kept] END) AS part FROM q), v AS (SELECT doc_id, label, part AS text, CASE WHEN part = kept THEN s + length(text) - length(led) ELSE s + instr(text, part) - 1 END AS start FROM u)
SELECT doc_id, label, text, CAST(start AS BIGINT) AS start, CAST(start + length(text) AS BIGINT) AS "end" FROM v""")
def repaired_spans(spark, sf_dir):
    made = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"), pick(PHRASES, F.col("o_orderkey")).alias("text"),
        F.when(F.col("o_orderkey") % 4 == 0, "LOCATION").otherwise("PERSON").alias("label"), (F.col("o_custkey") % 100).alias("start"),
    )
    return mentions.repair_spans(made.withColumn("end", F.col("start") + F.length("text")))


@query("""WITH e AS (SELECT user_id AS doc_id, event_id AS ord, 'L' || event_id % 2 AS label, epoch_us(ts) // 1000000 AS s, epoch_us(ts) // 1000000 + 14400 + event_id % 600 AS t, 0.5 + 0.05 * (event_id % 7) AS c, event_id % 3 <> 1 AS gl, event_id % 3 <> 0 AS sp FROM events),
a AS (SELECT *, CASE WHEN label = lag(label) OVER (PARTITION BY doc_id ORDER BY s, t, ord) THEN 0 ELSE 1 END AS o FROM e), b AS (SELECT *, sum(o) OVER (PARTITION BY doc_id ORDER BY s, t, ord ROWS UNBOUNDED PRECEDING) AS run FROM a),
r AS (SELECT *, max(t) OVER (PARTITION BY doc_id, run ORDER BY s, t, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b), g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s, t, ord ROWS UNBOUNDED PRECEDING) AS g FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, g ORDER BY round(c, 3) DESC, t - s DESC, gl DESC, s, t, ord) AS place, bool_or(gl) OVER (PARTITION BY doc_id, g) AS any_gl, bool_or(sp) OVER (PARTITION BY doc_id, g) AS any_sp, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g)
SELECT doc_id, 'e' || ord AS text, label, s AS start, t AS "end", round(CASE WHEN any_gl AND any_sp THEN least(1.0, c + 0.15) ELSE c END, 6) AS confidence, CASE WHEN any_gl AND any_sp THEN 'gliner;spacy' WHEN any_gl THEN 'gliner' ELSE 'spacy' END AS sources, n AS n_merged FROM k WHERE place = 1""")
def merged_mentions(spark, sf_dir):
    key = F.col("event_id")
    sources = F.when(key % 3 == 0, F.array(F.lit("gliner"))).when(key % 3 == 1, F.array(F.lit("spacy"))).otherwise(F.array(F.lit("gliner"), F.lit("spacy")))
    spans = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc_id"), F.concat(F.lit("e"), key).alias("text"), F.concat(F.lit("L"), key % 2).alias("label"), F.unix_timestamp("ts").alias("start"),
        (F.unix_timestamp("ts") + 14400 + key % 600).alias("end"), (0.5 + 0.05 * (key % 7)).alias("confidence"), sources.alias("sources"), key.alias("ord"),
    )
    return mentions.merge_mentions(spans).withColumns({"confidence": F.round("confidence", 6), "sources": F.array_join("sources", ";")})


@query(rf"""WITH w AS (SELECT doc_id, len(list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}_]+'), lambda x: x IN {_in(NARRATION)})) AS n FROM documents) SELECT doc_id, least(40, n) AS n_mentions FROM w WHERE n > 0""")
def narrator_spans(spark, sf_dir):
    chunks = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("chunk_id"), "text", F.lit(0).alias("start_char"), F.lit("The narrator").alias("narrator"))
    return mentions.narrator_mentions(chunks).groupBy(F.col("chunk_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_mentions"))


SUBJECTS, OBJECTS = ("ich", "Anna", "he", "We", "Bob"), ("Anna", " me", "Rome", "It", "bob", "uns")


@query(f"""WITH e AS (SELECT o_orderkey, {_list(SUBJECTS, "o_orderkey")} AS s, {_list(OBJECTS, "o_custkey")} AS t FROM orders), k AS (SELECT * FROM e WHERE lower(trim(s)) NOT IN {_in(THIRD_PERSON)} AND lower(trim(t)) NOT IN {_in(THIRD_PERSON)}),
n AS (SELECT o_orderkey, CASE WHEN lower(trim(s)) IN {_in(FIRST_PERSON)} THEN 'Anna' ELSE s END AS source, CASE WHEN lower(trim(t)) IN {_in(FIRST_PERSON)} THEN 'Anna' ELSE t END AS target FROM k) SELECT * FROM n WHERE lower(trim(source)) <> lower(trim(target))""")
def named_endpoints(spark, sf_dir):
    edges = table(spark, sf_dir, "orders").select("o_orderkey", pick(SUBJECTS, F.col("o_orderkey")).alias("source"), pick(OBJECTS, F.col("o_custkey")).alias("target"))
    return mentions.name_endpoints(edges, F.lit("Anna"))


ORGS = ("the Knight Foundations", "Knight Foundation", "Open Society Foundations", "Trade Unions", "the Lilly Endowment", "Union Companies")
_S = resolve._PLURAL_S.removeprefix("(?i)")
_IES = resolve._PLURAL_IES.removeprefix("(?i)")


@query(rf"""WITH e AS (SELECT {_list(ORGS, "c_custkey")} || ' ' || c_custkey % 35 AS name, c_custkey % 9 + 1 AS mention_count FROM customer), b AS (SELECT *, regexp_replace(name, '^the\s+', '', 'i') AS bare FROM e),
s AS (SELECT *, regexp_replace(regexp_replace(bare, '{_S}', '\1', 'gi'), '{_IES}', '\1y', 'gi') AS single FROM b), m AS (SELECT *, CASE WHEN single <> bare AND lower(single) IN (SELECT lower(bare) FROM s) THEN single ELSE bare END AS shown FROM s)
SELECT shown AS canonical_name, CAST(sum(mention_count) AS BIGINT) AS mention_count, count(DISTINCT name) FILTER (name <> shown) AS n_aliases FROM m GROUP BY 1""")
def org_surfaces(spark, sf_dir):
    key = F.col("c_custkey")
    name = F.concat_ws(" ", pick(ORGS, key), key % 35)
    made = table(spark, sf_dir, "customer").select(
        key.cast("string").alias("entity_id"), name.alias("canonical_name"), F.lit("ORG").alias("label"), (key % 9 + 1).alias("mention_count"), F.array().cast("array<string>").alias("aliases"),
        F.array(key.cast("string")).alias("doc_ids"), F.lit(0.9).alias("confidence"), F.lit(False).alias("is_author"), F.lower(name).alias("key"),
    )
    return resolve.clean_org_surfaces(made).select("canonical_name", "mention_count", F.size("aliases").cast("long").alias("n_aliases"))


@query("""WITH w AS (SELECT doc_id, text, unnest(CASE WHEN length(text) <= 2000 THEN [0] ELSE range(0, length(text), 1800) END) AS start FROM documents)
SELECT doc_id, CAST(start AS INTEGER) AS start, md5(substr(text, CAST(start AS BIGINT) + 1, 2000)) AS digest FROM w""")
def text_windows(spark, sf_dir):
    return mentions.text_windows(table(spark, sf_dir, "documents")).select("doc_id", "start", F.md5("text").alias("digest"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def uncovered_documents(spark, sf_dir):
    return mentions.uncovered(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
