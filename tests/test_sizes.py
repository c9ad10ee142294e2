"""Queries on odd inputs and on the shapes that large tables have."""

import time

import pytest
from tessera.operators import extract, network, relations
from tessera.plans import registry
from tessera.sources import crawl
from tessera.storage import parts_for


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_sentence_counts_by_the_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    texts = ["One. Two! 3? Four", 'He came. "Go." (Then he left.) [1] End', "", None, "\u0001A.\u0001", " . B", "a.\x0bB. C", "It was. (A. B. C", "x. Y", "same. Id"]
    folder = write(spark, tmp_path, "documents", [(min(i, 8), t) for i, t in enumerate(texts)], "doc_id long, text string")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    made = registry.QUERIES["sentence_counts"](spark, folder)
    assert sorted((tuple(r) for r in made.collect()), key=str) == sorted(con.execute(registry.ORACLES["sentence_counts"]).fetchall(), key=str)


def test_sitemaps_of_one_large_file(spark):
    began = time.time()
    text = "<urlset>" + "".join(f"<url><ns:LOC >\n https://a.org/{i}?x=1&amp;y=2 </ns:loc></url>" for i in range(60000)) + "<loc>https://a.org/open</urlset>"
    files = spark.createDataFrame([("leaf", text), ("root", "<sitemapindex><loc> leaf\n</loc><loc></loc></loc></sitemapindex>")], "url string, text string")
    found = crawl.sitemap_urls(files, spark.createDataFrame([("root",)], "url string"))
    assert (found.count(), found.filter("url = 'https://a.org/7?x=1&y=2'").count()) == (60000, 1)
    assert time.time() - began < 60  # it takes seconds; matching all in one text takes minutes


def test_pairs_are_dealt_by_their_number(spark, monkeypatch):
    """Members that fit one small partition make their pairs in many, and the pairs stay the same."""
    members = spark.range(4 * 300).selectExpr("id % 4 AS g", "id div 4 AS m").coalesce(1)
    parts, stash_in = [], network.stash_in
    monkeypatch.setattr(network, "parts_for", lambda spark, rows: parts_for(spark, rows, 5000))
    monkeypatch.setattr(network, "stash_in", lambda df, n: parts.append(n) or stash_in(df, n))
    made = network.project(members, "g", "m", 3)
    assert parts[-1] == -(-4 * 300 * 299 // 2 // 5000) == 36
    assert made.filter("shared_groups = 4 AND strength = 4 / 299D").count() == 300 * 299 // 2
    joined = network._pairs(members.selectExpr("*", "300L AS _k", "1D AS _w"), "g", "m", "_w")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def test_gazetteer_keys_are_runs_that_begin_a_phrase(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "The New York Times of New York, new  york"), (2, None), (3, ""), (4, "york NEW york")], "doc_id long, text string")
    phrases = spark.createDataFrame([("New York", "LOCATION"), ("new york times", "ORG"), ("York Times", "EVENT"), (None, "ORG")], "phrase string, label string")
    few = relations.gazetteer(docs, phrases)
    assert " IN (new,york" in few._jdf.queryExecution().optimizedPlan().toString().replace("york,new", "new,york").replace(", ", ",").replace("IN(", "IN (")
    monkeypatch.setattr(relations, "_HEADS", 0)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, relations.gazetteer(docs, phrases).collect()))
    assert few.count() == 4


def test_chunks_are_made_from_slices_of_a_batch(monkeypatch):
    """A batch of many texts gives several frames, none of many times the slice."""
    import pandas as pd

    class Caught(Exception):
        pass

    class Docs:
        dtypes = [("doc_id", "bigint")]

        def select(self, *_):
            return self

        def mapInPandas(self, cut, _):
            raise Caught(cut)

    with pytest.raises(Caught) as caught:
        extract.chunks(Docs())
    texts = ["A b. " * 400] * 3000 + [None, ""]
    frames = list(caught.value.args[0](iter([pd.DataFrame({"doc_id": range(3002), "text": texts})])))
    assert len(frames) > 1 and max(f["text"].str.len().sum() for f in frames) < 3 << 20
    assert [d for f in frames for d in f["doc_id"]] == list(range(3002))
