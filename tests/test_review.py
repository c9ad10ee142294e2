"""Reviews, scores, corpora, crawl rules and rules of relations on small literals."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import names, text
from tessera.operators import evaluation, exports, extract, inference, relations, replies, resolve, review
from tessera.sources import corpora, crawl

ENTITY = "entity_id string, canonical_name string, label string, aliases array<string>, mention_count int, doc_ids array<string>, confidence double, is_author boolean, key string"


def entities(spark, *rows):
    """(id, name, mentions, author, aliases) of persons, or of another label where one is given."""
    made = [(r[0], r[1], r[5] if len(r) > 5 else "PERSON", list(r[4]), r[2], ["d" + r[0]], 0.9, r[3], r[1].lower()) for r in rows]
    return spark.createDataFrame(made, ENTITY)


def test_dates_claim_by_specificity(spark):
    docs = spark.createDataFrame([(1, "May 1921-03-04 and 03/04/21"), (2, "25/03/1921, 31/31/1921 or 1889"), (3, None), (4, "")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["date_text"], r["iso_date"], r["year"]) for r in extract.dates(docs, pivot=1946).collect())
    assert got == [
        (1, "03/04/21", "1921-03-04", 1921), (1, "1921-03-04", "1921-03-04", 1921), (1, "May 1921", "1921-05-01", 1921),
        (2, "1889", "1889-01-01", 1889), (2, "25/03/1921", "1921-03-25", 1921), (2, "31/31/1921", "1921", 1921),
    ]
    assert [r["year"] for r in extract.dates(docs.filter("doc_id = 1")).orderBy("date_text").collect()] == [None, 1921, 1921]


def test_plausible_alias(spark):
    cases = [("NSV", "NSDAP", False), ("N.S.V.", "NSV", True), ("Knight Foundation", "The Knight Fund", True), ("SPD", "Partei SPD", True), ("Bofur and Bombur", "Bofur", False), ("Thror", "Thorin", False), ("Schoenherr", "Schonherr", True)]
    frame = spark.createDataFrame(cases, "name string, alias string, want boolean")
    assert all(r["plausible"] == r["want"] for r in review.plausible_alias(frame).collect())


def test_guarded_merges(spark):
    names = entities(spark, ("1", "Knight Foundation", 9, False, [], "ORG"), ("2", "Knight Fund", 5, False, [], "ORG"), ("3", "Knight Trust", 4, True, [], "ORG"), ("4", "Ford Motors", 3, False, [], "ORG"), ("5", "1921", 2, False, [], "ORG"))
    given = spark.createDataFrame([("ORG", 0, "knight foundation", ["Knight Fund", "Knight Trust", "Ford Motors", "1921"]), ("ORG", 1, "Knight Fund", ["Knight Foundation"]), ("ORG", 2, "Ford Motors", ["Knight Fund"] * 17)], "label string, ord int, canonical string, aliases array<string>")
    assert [tuple(r) for r in review.guarded_merges(names, given).collect()] == [("2", "1")]


def test_merges_are_bounded_and_chains_end(spark):
    names = entities(spark, *[(f"{i:02}", f"Guild {chr(97 + i)}", 50 - i, False, [], "ORG") for i in range(12)])
    given = spark.createDataFrame([("ORG", 0, "Guild b", ["Guild c"]), ("ORG", 1, "Guild a", [f"Guild {chr(98 + i)}" for i in range(11)])], "label string, ord int, canonical string, aliases array<string>")
    got = {r["entity_id"]: r["into"] for r in review.guarded_merges(names, given).collect()}
    assert got["02"] == "00" and got["01"] == "00" and set(got.values()) == {"00"} and len(got) == 9


def test_enforced_names(spark):
    names = entities(spark, ("1", "Anna Berg Pate", 1, False, ["Anna Berg"]), ("2", "Anna Berg", 90, False, []), ("3", "S. P.D.", 7, False, [], "ORG"), ("4", "A. Berg", 3, True, []), ("5", "Max", 2, False, ["Anna Berg", "SPD"]))
    table = spark.createDataFrame([("Anna Berg", "Anna Berg"), ("S.P.D.", "SPD"), ("SPD", "SPD"), ("A. Berg", "Anna Berg")], "alias string, canonical string")
    made, folds = review.enforce_names(names, table)
    assert {(r["entity_id"], r["canonical_name"], r["mention_count"]) for r in made.collect()} == {("2", "Anna Berg", 91), ("3", "SPD", 7), ("4", "A. Berg", 3), ("5", "Max", 2)}
    assert {(r["entity_id"], r["into"]) for r in folds.collect()} == {("1", "2"), ("2", "2")}


def test_folds_choose_names(spark):
    names = entities(spark, ("1", "Theodore Abel", 9, False, []), ("2", "Theodore Fred Abel", 1, False, []), ("3", "Adolf Kurz", 90, False, []), ("4", "Adolf Kurz Pate", 1, False, []), ("5", "Paul Schönherr", 4, True, []), ("6", "Paul Schonherr", 8, False, []))
    shown = {r["canonical_name"] for r in resolve.resolve(names).collect()}
    assert shown == {"Theodore Fred Abel", "Adolf Kurz", "Paul Schönherr"}


def test_entity_scores_count_splits(spark):
    schema = "name string, type string, aliases array<string>, ord long"
    said = spark.createDataFrame([("Anna Berg", "PERSON", ["Anna"], 0), ("Berg", "PERSON", [], 1), ("Rome", "ORG", [], 2)], schema)
    true = spark.createDataFrame([("Anna Berg", "PERSON", ["Berg"], 0), ("Rome", "LOCATION", None, 1)], schema)
    typed = {r["type"]: (r["tp"], r["fp"], r["fn"]) for r in evaluation.entity_scores(said, true).collect()}
    assert typed == {"PERSON": (1, 1, 0), "ORG": (0, 1, 0), "LOCATION": (0, 0, 1), "*": (1, 2, 1)}
    free = [(r["tp"], r["fp"], r["fn"]) for r in evaluation.entity_scores(said, true, typed=False).collect()]
    assert free == [(2, 1, 0)]


def test_relation_scores_link_by_aliases(spark):
    schema = "name string, type string, aliases array<string>, ord long"
    said = spark.createDataFrame([("Annie", "PERSON", ["Anna Berg"], 0), ("Rome", "LOCATION", [], 1)], schema)
    true = spark.createDataFrame([("Anna Berg", "PERSON", [], 0), ("Rome", "LOCATION", [], 1)], schema)
    edges = "source string, target string, rel_type string"
    found = spark.createDataFrame([("Annie", "Rome", "Located_In"), ("Annie", "Anna Berg", "met_with"), ("Rome", "Nobody", "owns")], edges)
    gold = spark.createDataFrame([("Anna Berg", "Rome", "born_in")], edges)
    got = {r["view"]: (r["tp"], r["fp"], r["fn"]) for r in evaluation.relation_scores(said, found, true, gold).filter("slot = '*'").collect()}
    assert got == {"typed": (0, 2, 1), "family": (1, 1, 0), "untyped": (1, 1, 0)}


def test_verb_relations(spark):
    sentences = spark.createDataFrame([(1, 0, "Anna founded Acme near Rome."), (1, 1, "Later Anna founded Acme again."), (2, 0, "Anna met Anna and Bob.")], "doc_id long, sent_index int, sentence string")
    spans = [(1, 0, 0, 4, "Anna"), (1, 0, 13, 17, "Acme"), (1, 0, 23, 27, "Rome"), (1, 1, 6, 10, "Anna"), (1, 1, 19, 23, "Acme"), (2, 0, 0, 4, "Anna"), (2, 0, 9, 13, "Anna"), (2, 0, 18, 21, "Bob")]
    mentions = spark.createDataFrame(spans, "doc_id long, sent_index int, start int, end int, text string")
    got = [(r["doc_id"], r["source"], r["target"], r["rel_type"], r["directed"], r["sent_index"]) for r in relations.verb_relations(mentions, sentences).collect()]
    assert got == [(1, "Anna", "Acme", "founded", True, 0)]


def test_gazetteer_takes_the_longest(spark):
    docs = spark.createDataFrame([(1, "The New York Times of New York, new  york"), (2, None), (3, "")], "doc_id long, text string")
    phrases = spark.createDataFrame([("New York", "LOCATION"), ("new york times", "ORG"), ("York Times", "EVENT"), ("Times of", "EVENT")], "phrase string, label string")
    got = sorted((r["first"], r["label"], r["n_words"]) for r in relations.gazetteer(docs, phrases).collect())
    assert got == [(1, "ORG", 3), (5, "LOCATION", 2), (7, "LOCATION", 2)]


def test_iob2(spark, tmp_path):
    (tmp_path / "a.iob2").write_text("# text\nAnna\tx\tB-PER\nBerg\tx\tI-PER\n\n\nRome B-LOC\nlone\n, O\n")
    tokens = corpora.read_iob2(spark, str(tmp_path / "a.iob2"))
    got = [(r["sent_id"], r["i"], r["token"], r["tag"]) for r in tokens.orderBy("sent_id", "i").collect()]
    assert got == [("a.iob2:000000001", 0, "Anna", "B-PER"), ("a.iob2:000000001", 1, "Berg", "I-PER"), ("a.iob2:000000005", 0, "Rome", "B-LOC"), ("a.iob2:000000005", 1, ",", "O")]
    numbered = tokens.withColumn("ord", F.when(F.col("sent_id").endswith("5"), 1).otherwise(0))
    docs, names = corpora.pseudo_documents(numbered, {"PER": "PERSON"}, 2)
    assert [tuple(r) for r in docs.collect()] == [(0, "Anna Berg\nRome ,")] and [tuple(r) for r in names.collect()] == [(0, "Anna Berg", "PERSON")]


def test_gold_of_some_types(spark):
    gold = spark.createDataFrame([(1, "A", "PERSON"), (1, "B", "DATE"), (1, "C", "ORG")], "doc_id int, name string, type string")
    told = spark.createDataFrame([(1, "A", "C"), (1, "A", "B"), (2, "A", "C")], "doc_id int, source string, target string")
    kept, among = corpora.keep_types(gold, told, ("PERSON", "ORG"))
    assert kept.count() == 2 and [tuple(r) for r in among.collect()] == [(1, "A", "C")]


def test_detokenized_and_speakers(spark):
    frame = spark.createDataFrame([(["He", "(", "Bob", ")", "left", ",", "then", "``", "no", "''", "."], 4)], "t array<string>, n int")
    row = frame.select(corpora.detokenized(F.col("t")).alias("a"), corpora.speaker_name(F.col("n") % 3, F.col("n"), (("Ann", "Ida"), ("Max", "Tom", "Jon"))).alias("b")).first()
    assert (row["a"], row["b"]) == ("He (Bob) left, then ``no''.", "Tom")


def test_chapters(spark):
    book = "".join(f"Chapter {n}\n{'word ' * (200 if n != 2 else 3)}\n" for n in (1, 2, 3))
    docs = spark.createDataFrame([(1, "front\n" + book), (2, "Chapter 1\n" + "word " * 300), (3, None)], "doc_id int, text string")
    assert [(r["doc_id"], r["chapter"], r["title"]) for r in corpora.chapters(docs).orderBy("chapter").collect()] == [(1, 0, "Chapter 1"), (1, 2, "Chapter 3")]


def test_robots(spark):
    text = "User-agent: reader\nUser-agent: other\nAllow: /a/open\nDisallow: /a # closed\nCrawl-delay: 1.5\n\nUser-agent: *\nDisallow: /\n"
    robots = spark.createDataFrame([("x.org", text), ("y.org", "Disallow\nUser-agent: *\nDisallow:\n"), ("z.org", None)], "host string, text string")
    urls = spark.createDataFrame([(u,) for u in ("http://x.org/a/open/1", "http://x.org/a/b", "http://x.org/c", "http://y.org/a", "http://z.org", "http://none.org/")], "url string")
    seen = lambda agent: {r["url"] for r in crawl.permitted(urls, crawl.robot_rules(robots, agent)).collect()}
    assert seen("Reader/2.0") == {"http://x.org/a/open/1", "http://x.org/c", "http://y.org/a", "http://z.org", "http://none.org/"}
    assert seen("bot") == {"http://y.org/a", "http://z.org", "http://none.org/"}
    assert [tuple(r) for r in crawl.crawl_delays(crawl.robot_rules(robots, "reader")).collect()] == [("x.org", 1.5)]


def test_sitemap_levels(spark):
    index = lambda *u: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in u) + "</sitemapindex>"
    leaf = lambda *u: "<urlset>" + "".join(f"<url><loc>\n{x}\n</loc></url>" for x in u) + "</urlset>"
    files = [("r", index("r", "s1", "l1")), ("s1", index("s2")), ("s2", index("s3")), ("s3", leaf("http://x/too-deep")), ("l1", leaf("http://x/1?a=1&amp;b=2", "http://x/pic.png", "ftp://x/no")), ("bad", None)]
    got = crawl.sitemap_urls(spark.createDataFrame(files, "url string, text string"), spark.createDataFrame([("r",), ("bad",)], "url string"))
    assert [r["url"] for r in got.collect()] == ["http://x/1?a=1&b=2"]
    assert crawl.fingerprint(["b", "a"], depth=2) == crawl.fingerprint(["a", "b"], depth=2) != crawl.fingerprint(["a"], depth=2)


def test_write_run(spark, tmp_path):
    nodes = entities(spark, ("1", "Anna", 2, False, ["A."]), ("2", "Bob", 1, False, [])).withColumn("tag_scope", F.lit("macro"))
    edges = spark.createDataFrame([("1", "2", "met_with", "interaction", 1921)], "source string, target string, rel_type string, tie_class string, year int")
    full = edges.select("*", F.lit(1).alias("weight"), F.lit(1).alias("n_mentions"), F.lit("extracted").alias("origin"), F.lit("").alias("edge_source"), F.lit(0.5).alias("confidence"), F.lit("e").alias("evidence"), F.lit(False).alias("directed"))
    shown = exports.edge_table(full, nodes, ("amount",))
    docs = spark.createDataFrame([(1, "x")], "doc_id int, author string")
    events = spark.createDataFrame([("d", "", "1921", "1921", 1921, "text", ["Anna"], 0.7)], "doc_id string, letter_id string, date_text string, iso_date string, year int, description string, entities array<string>, confidence double")
    paths = exports.write_run(str(tmp_path), exports.node_table(nodes, edges), shown, exports.timeline_table(events), docs, settings="{}")
    assert len(paths) == 21 and spark.read.parquet(f"{tmp_path}/nodes_interaction.parquet").count() == 2 and spark.read.parquet(f"{tmp_path}/edges_affiliation.parquet").count() == 0
    row = spark.read.option("header", True).csv(f"{tmp_path}/edges.csv").first()
    assert (row["Type"], row["tie_class"], row["source_name"], row["qual_amount"], row["period"]) == ("Undirected", "interaction", "Anna", None, None)
    assert exports.run_summary(nodes.withColumn("relevance_tier", F.lit("core")), edges, events).first().asDict() == {"entities": 2, "core": 2, "edges": 1, "timeline": 1}
    with pytest.raises(ValueError):
        exports.write_run(str(tmp_path), nodes, edges, events, docs, formats=("xlsx",))


def test_reply_shapes(spark):
    whole = '{"d1": {"entities": [{"name": "Anna", "type": "PERSON"}, "stray"]}, "d2": {"relations": [{"source": "A", "target": "a"}, {"source": "A", "target": "B", "evidence": "not said", "directed": true}]}}'
    given = [("x", whole), ("y", 'Sure: [{"id": "d3", "events": [{"date": "6 years old"}, {"date": "May 1921", "entities": [" Anna ", null, 7]}]}]'), ("z", "nothing here"), ("w", None), ("v", '{"entities": null, "timeline": "bad"}')]
    found = replies.extractions(spark.createDataFrame(given, "doc_id string, reply string"))
    assert sorted(r["doc_id"] for r in found.collect()) == ["d1", "d2", "d3", "v"]
    assert [(r["doc_id"], r["text"], r["confidence"]) for r in replies.reply_mentions(found, ("PERSON",)).collect()] == [("d1", "Anna", 0.6)]
    assert replies.reply_mentions(found, ("PERSON",), spark.createDataFrame([("d1", " anna ")], "doc_id string, text string")).count() == 0
    docs = spark.createDataFrame([("d2", "quite another text of the document")], "doc_id string, text string")
    told = replies.reply_relations(found, docs, ("amount",)).collect()
    assert [(r["doc_id"], r["source"], r["target"], r["rel_type"], r["directed"], r["evidence_unverified"], r["qual_amount"]) for r in told] == [("d2", "A", "B", "related_to", True, True, "")]
    assert [(r["doc_id"], r["date_text"], r["iso_date"], r["year"], r["entities"]) for r in replies.reply_timeline(found).collect()] == [("d3", "May 1921", "1921-05-01", 1921, ["Anna", "7"])]


def test_complete_replies(spark):
    frame = spark.createDataFrame([('ok: {"a": [1]} done', True), ('{"a": [1}', False), ("", False), (None, False)], "v string, want boolean")
    assert all(r["got"] == r["want"] for r in frame.withColumn("got", replies.complete(F.col("v"))).collect())


def test_flagged_narrators(spark):
    mentions = spark.createDataFrame([(1, "Villwak", "PERSON"), (1, "Berg", "PERSON"), (1, "Vilwak", "ORG"), (2, "Anna Berg", "PERSON"), (2, "Ana Berg", "PERSON"), (3, "Max", "PERSON")], "doc_id int, text string, label string")
    authors = spark.createDataFrame([(1, "Vilwak"), (2, "Ana Berg"), (3, None)], "doc_id int, author string")
    flagged = {(r["doc_id"], r["text"]) for r in replies.flag_narrators(mentions, authors).filter("is_author").collect()}
    assert flagged == {(1, "Villwak"), (2, "Ana Berg")}


def test_names_of_files_and_firms(spark):
    frame = spark.createDataFrame([("The Acme Works, Inc.", "a b/c?.txt"), ("Acme Works & Sons", "???"), (None, None)], "v string, f string")
    got = [tuple(r) for r in frame.select(names.firm_key(F.col("v")), names.safe_name(F.col("f"), F.lit("none"))).collect()]
    assert got == [("acme works", "a_b_c_.txt"), ("acme works & sons", "none"), ("", "none")]
    assert frame.limit(1).select(text.strip_boilerplate(F.lit("a [x  b"), ["[", r"\[x"])).first()[0] == "a b"


def test_biographical_edges(spark):
    names = entities(spark, ("a", "Anna Berg", 5, True, []), ("r", "Rome", 5, False, ["Roma"], "LOCATION"), ("b", "Bern", 2, False, [], "LOCATION"), ("k", "Kiel", 2, False, [], "LOCATION"))
    told = spark.createDataFrame([
        ("da", "Roma", "LOCATION", "Ich bin 1898 in Roma geboren.", 0), ("da", "Rome", "LOCATION", "Ich wohnte in Rome.", 1), ("da", "Bern", "LOCATION", "Mein Vater wurde in Bern geboren.", 2),
        ("da", "Kiel", "LOCATION", "Nothing of Kiel.", 3), ("dx", "Rome", "LOCATION", "born in Rome", 4), ("da", "Rome", "ORG", "born in Rome", 5), ("da", "Rome", "LOCATION", None, 6),
    ], "doc_id string, text string, label string, sentence string, ord int")
    edges = spark.createDataFrame([("a", "r", "located_in", "da", "", 0.6, "llm", 0), ("a", "r", "located_in", "da", "again", 0.6, "llm", 1), ("a", "b", "lived_in", "da", "She lived in Bern", 0.6, "llm", 2), ("a", "k", "located_in", "da", "Marie, geb. Krotzki", 0.6, "llm", 3)], "source string, target string, rel_type string, doc_id string, evidence string, confidence double, edge_source string, ord int")
    got = {(r["target"], r["rel_type"], r["ord"], r["biographical_cue"], r["type_upgraded_from"]) for r in inference.biographical_edges(names, edges, told).collect()}
    assert got == {("r", "born_in", 0, "geboren", "located_in"), ("r", "located_in", 1, None, None), ("r", "resided_in", None, "wohnte", None), ("b", "resided_in", 2, "lived", "lived_in"), ("k", "located_in", 3, None, None)}
    assert inference.biographical_edges(names, edges.limit(0), told.limit(0)).count() == 0
