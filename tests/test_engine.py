"""Operators on small literals with their expected results."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import domain, ontology, rules, text, urls
from tessera.operators import documents, extract, inference, mentions, narrative, network, quality, resolve, scoring
from tessera.operators.components import connected_components


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def table(spark, data, schema):
    return spark.createDataFrame(data, schema)


def values(spark, expression, inputs):
    """A Column expression over one string column, for each input in order."""
    frame = spark.createDataFrame(list(enumerate(inputs)), "i int, v string")
    return [r["o"] for r in frame.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]


def test_names(spark):
    assert values(spark, text.name_key, ["Stallup√∂nen", "  Robert\nChen! ", "W. W. Norton & Co-op", "Müller"]) == ["stallupönen", "robert chen", "w. w. norton & co-op", "müller"]
    assert values(spark, text.junk_person, ["lch", "Anna Berg", "anna berg"]) == [True, False, True]
    assert values(spark, text.acronym, ["American Enterprise Institute", "the Club"]) == ["AEI", "C"]
    assert values(spark, text.handles, ["hi @carol and u/bob!"]) == [["carol", "bob"]]


def test_reference_tail(spark):
    body = "\n".join(f"line {i} of the body" for i in range(20))
    early = "Notes\n" + body
    assert values(spark, text.cut_reference_tail, [body + "\nReferences\nA. B.", early, "a\nb\nReferences\nc"]) == [body, early, "a\nb\nReferences\nc"]


def test_normalize_text(spark):
    assert values(spark, text.normalize_text, ["a  \r\nb\r\n\n\n\n\n\nc d​ "]) == ["a\nb\n\n\nc d"]


def test_verbatim(spark):
    frame = table(spark, [("He met ... the chairman there", "Then he MET, and so on; the chairman there."), ("made up entirely", "something else")], "e string, t string")
    assert [r[0] for r in frame.select(text.verbatim(F.col("e"), F.col("t"))).collect()] == [True, False]


def test_urls(spark):
    given = ["HTTP://Ex.COM:80/p#frag", "http://ex.com/p/", "http://ex.com/", "http://ex.com//a//b", "http://ex.com/p?q=1&utm_source=x&ref=y", "not a url"]
    want = ["http://ex.com/p", "http://ex.com/p", "http://ex.com/", "http://ex.com/a/b", "http://ex.com/p?q=1", "not a url"]
    assert values(spark, urls.canonical_url, given) == want
    assert values(spark, urls.directory, ["http://x/docs/intro", "http://x/docs", "http://x/"]) == ["/docs/", "/docs/", "/"]
    assert values(spark, urls.host_key, ["http://www.Ex.com/a"]) == ["ex.com"]


def test_connection_types(spark):
    frame = table(spark, [("met_with", ""), ("fought_against", ""), ("influenced_by", ""), ("opposed", ""), ("member_of", ""), ("born_in", ""), ("co_occurs_with", ""), ("secretly_funded", ""), ("publicly_endorsed", ""), ("blorp", "LOCATION"), ("blorp", "")], "r string, l string")
    got = [r[0] for r in frame.select(rules.connection_type(F.col("r"), F.col("l"))).collect()]
    assert got == ["physical", "physical", "ideological", "ideological", "organizational", "biographical", "cooccurrence", "physical", "ideological", "biographical", "unspecified"]


def test_tie_classes(spark):
    given = [("led", "PERSON", "PERSON"), ("recruited", "PERSON", "ORG"), ("opposes", "PERSON", "ORG"), ("caused", "", ""), ("blorp", "PERSON", "PERSON"), ("blorp", "", "")]
    frame = table(spark, given, "r string, s string, t string")
    assert [r[0] for r in frame.select(rules.tie_class(F.col("r"), F.col("s"), F.col("t"))).collect()] == ["interaction", "affiliation", "stance", "causal", "interaction", "other"]


def test_signatures(spark):
    frame = table(spark, [("led", "PERSON", "ORG"), ("led", "PERSON", "LOCATION"), ("born_in", "PERSON", "ROLE"), ("supported", "PERSON", "ORG"), ("located_in", "PERSON", "ORG"), ("promoted_to", "PERSON", "RANK")], "rel_type string, source_label string, target_label string")
    marked = quality.check_signatures(frame)
    assert [r.type_violation for r in marked.collect()] == [False, True, False, False, True, False]
    assert quality.check_signatures(frame, drop=True).count() == 4


def test_ontology():
    align = ontology.Aligner()
    given = ["provided_funding_to", "president_of", "works_for", "trustee_of", "former_employee_of", "controlled_by_initially", "funded_by", "zzzzqqq"]
    assert [align(x) for x in given] == ["funded", "led", "employed_by", "member_of", "employed_by", "owned_by", "funded_by", None]


def test_domain(spark):
    assert values(spark, domain.demonym_place, ["Americans", "Prussian", "Mars"]) == ["United States", "Prussia", None]
    ranks = {r.form: r for r in domain.INTERWAR.rank_table(spark).collect()}
    assert [ranks[k].canonical for k in ("stabschef", "general", "uffz")] == ["Oberster SA-Führer", "General der Infanterie", "Unteroffizier"]
    assert ranks["sasturmmann"].level == 2 and ranks["sturmmann"].org == "SA/SS" and ranks["leutnant"].level == 14
    frame = table(spark, [(1919, "NSDAP"), (1930, "NSDAP"), (1850, None), (1936, "Reichswehr"), (None, "SPD")], "y int, o string")
    assert [r[0] for r in frame.select(domain.anachronism(F.col("y"), F.col("o"))).collect()] == ["before it existed", "", "outside the period", "after it ended", ""]


def test_cooccurrence(spark):
    docs = [("small", "X"), ("small", "Y"), *[("big", e) for e in ["P", "Q", *[f"f{i}" for i in range(8)]]]]
    made = {(r.a, r.b): r.strength for r in network.cooccurrence(table(spark, docs, "doc_id string, entity_id string"), min_shared=1).collect()}
    assert made["X", "Y"] == 1.0 and abs(made["P", "Q"] - 1 / 9) < 1e-12


def test_projection(spark):
    edges = [("a", "pac", "member_of"), ("b", "pac", "member_of"), ("b", "ev", "participated_in"), ("c", "ev", "participated_in"), ("d", "pac", "funded")]
    labels = {"pac": "ORG", "ev": "EVENT"}
    frame = table(spark, [(s, t, r, "PERSON", labels[t]) for s, t, r in edges], "source string, target string, rel_type string, source_label string, target_label string")
    frame = frame.withColumn("tie_class", rules.tie_class(F.col("rel_type"), F.col("source_label"), F.col("target_label")))
    assert rows(network.affiliation_projection(frame), "a", "b", "strength") == [("a", "b", 1.0), ("b", "c", 1.0)]
    assert network.affiliation_projection(frame, min_shared=2).count() == 0


def test_disparity(spark):
    pairs = [("A", "B", 10.0), ("B", "C", 10.0), ("A", "C", 10.0), ("A", "D", 1.0), ("B", "D", 1.0), ("C", "D", 1.0)]
    frame = table(spark, pairs, "a string, b string, strength double")
    assert rows(network.disparity(frame, 0.3), "a", "b") == [("A", "B"), ("A", "C"), ("B", "C")]
    assert network.disparity(frame).filter("disparity_alpha IS NOT NULL").count() == 6


def test_proximity(spark):
    frame = table(spark, [("d", "Alice", 0), ("d", "Bob", 100), ("d", "Carol", 1000), ("d", "Dan", None)], "doc_id string, entity_id string, pos int")
    assert rows(network.proximity(frame, 600), "a", "b", "n_pairs", "min_gap") == [("Alice", "Bob", 1, 100)]
    assert network.proximity(frame, 0).count() == 0


def test_scenes(spark):
    scenes = [(1, "Gandalf"), (1, "Bilbo"), (1, "Thorin"), (2, "Bilbo"), (2, "Thorin"), (3, "Gandalf")]
    made = {(r.a, r.b): r.scene_weight for r in network.scene_copresence(table(spark, scenes, "scene_id int, speaker string")).collect()}
    assert made["Bilbo", "Thorin"] == 1.5 and len(made) == 3


def test_balance_and_conflicts(spark):
    signs = [("a", "b", "+"), ("b", "c", "+"), ("a", "c", "+"), ("x", "y", "+"), ("y", "z", "+"), ("x", "z", "-"), ("q", "r", "+"), ("r", "q", "-")]
    frame = table(spark, [(s, t, "allied_with" if g == "+" else "fought_against", "positive" if g == "+" else "negative") for s, t, g in signs], "source string, target string, rel_type string, polarity string")
    assert rows(network.signed_balance(frame), "balanced", "unbalanced", "balance_pct") == [(1, 1, 50.0)]
    assert rows(network.polarity_conflicts(frame), "a", "b", "positive", "negative") == [("q", "r", "allied_with", "fought_against")]


def test_components_and_cuts(spark):
    edges = table(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (10, 11)], "a long, b long")
    assert rows(connected_components(edges), "node", "root") == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (10, 10), (11, 10)]
    found = network.cut_points(edges).collect()
    assert sorted((r.a, r.b) for r in found if r.kind == "bridge") == [(3, 4), (4, 5), (10, 11)]
    assert sorted(r.a for r in found if r.kind == "node") == [3, 4]
    chain = table(spark, [(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.root for r in connected_components(chain).collect()} == {0}


def test_constraint(spark):
    """A star's centre and leaves, by hand."""
    made = {r.id: r for r in network.constraint(table(spark, [(0, 1, 1.0), (0, 2, 1.0), (0, 3, 1.0)], "a long, b long, weight double")).collect()}
    assert abs(made[0].constraint - 1 / 3) < 1e-9 and made[0].effective_size == 3 and made[1].constraint == 1


def test_functional_conflicts(spark):
    edges = [("p1", "born_in", "Berlin", 0.9), ("p1", "born_in", "Hamburg", 0.6), ("p1", "resided_in", "X", 0.5), ("p1", "resided_in", "Y", 0.5), ("p2", "born_in", "Bonn", 0.9)]
    frame = table(spark, edges, "source string, rel_type string, target string, confidence double")
    assert quality.functional_conflicts(frame).filter("functional_conflict").count() == 2
    assert ("p1", "Berlin") in rows(quality.functional_conflicts(frame, drop=True), "source", "target") and quality.functional_conflicts(frame, drop=True).count() == 4


def test_tiers(spark):
    given = ["llm_extracted", "metadata", "canonical_inferred", "rule_cooccurrence;llm_extracted", "pipeline_inferred", "", "new_source"]
    assert values(spark, lambda c: rules.tier_allows(c, "conservative"), given) == [True, True, False, True, False, False, False]
    assert values(spark, lambda c: rules.tier_allows(c, "full"), given) == [True] * 7
    assert values(spark, lambda c: rules.excludes_all(c, ["metadata"]), ["metadata", "metadata;llm_extracted", ""]) == [True, False, False]


def test_narrative(spark):
    events = [(d, y, i, e) for d in ("d1", "d2") for i, (y, e) in enumerate([(1916, "war"), (1919, "factory"), (1919, "wage"), (1921, "party")])]
    frame = table(spark, events, "doc_id string, year int, ord int, t string").withColumn("element", rules.narrative_element(F.col("t")))
    assert rows(narrative.transitions(frame), "source", "target", "weight", "n_docs") == [("war_combat", "work_economic", 2, 2), ("work_economic", "politics_party", 2, 2)]


def entities(spark, *names):
    data = [(f"e{i}", n, label, m, [], ["d"], 0.9, False) for i, (n, label, m) in enumerate(names)]
    frame = table(spark, data, "entity_id string, canonical_name string, label string, mention_count int, aliases array<string>, doc_ids array<string>, confidence double, is_author boolean")
    return frame.withColumn("key", text.name_key(F.col("canonical_name")))


@pytest.mark.parametrize(
    "names, want",
    [
        ([("Theodore Fred Abel", "PERSON", 3), ("Theodore Abel", "PERSON", 7)], 1),
        ([("American Enterprise Institute", "ORG", 9), ("AEI", "ORG", 2)], 1),
        ([("DVP", "ORG", 5), ("DNVP", "ORG", 5)], 2),
        ([("the Berger Action Fund", "ORG", 5), ("Berger Action Fund", "PERSON", 2)], 1),
    ],
)
def test_resolution(spark, names, want):
    assert resolve.resolve(entities(spark, *names)).count() == want


def test_mentions_to_entities(spark):
    data = [("Robert\nChen", "PERSON", "d1", 0.5, "s1", False, 1), ("Robert Chen", "PERSON", "d2", 0.9, "s2", False, 2), ("robert chen", "PERSON", "d2", 0.7, "", True, 3)]
    made = resolve.mentions_to_entities(table(spark, data, "text string, label string, doc_id string, confidence double, sentence string, is_author boolean, ord int")).collect()
    assert len(made) == 1 and (made[0].canonical_name, made[0].mention_count, made[0].aliases, made[0].is_author, made[0].evidence) == ("Robert Chen", 3, ["robert chen"], True, "s1")


def test_chunks_and_dates(spark):
    long = "This is a sentence. " * 40
    parts = extract.chunks(table(spark, [("d", long)], "doc_id string, text string"), 200, 40)
    assert parts.filter("end_char - start_char > 240").count() == 0 and extract.reassemble(parts).first()["text"] == long.rstrip() or extract.reassemble(parts).first()["text"] == long
    docs = table(spark, [(1, "Am 4. März 1921 und im Herbst 1923, on March 4, 1921 or 2021-03-04; in 1889.")], "doc_id int, text string")
    assert rows(extract.dates(docs), "iso_date", "date_text") == [("1889-01-01", "1889"), ("1921-03-04", "4. März 1921"), ("1921-03-04", "March 4, 1921"), ("1923-09-01", "Herbst 1923"), ("2021-03-04", "2021-03-04")]


def test_author(spark):
    assert values(spark, extract.author, ["My name is Johann Alff. I was born", "The war began.", "Memoir of Anna Berg\nfirst"]) == ["Johann Alff", "", "Anna Berg"]


def test_bio(spark):
    tags = [(1, 0, "Ann", "B-PER"), (1, 1, "Lee", "I-PER"), (1, 2, "in", "O"), (1, 3, "Rome", "B-LOC"), (1, 4, "x", "O"), (1, 5, "orphan", "I-ORG")]
    assert rows(extract.bio_spans(table(spark, tags, "sent_id int, i int, token string, tag string")), "label", "text") == [("LOC", "Rome"), ("PER", "Ann Lee")]


def test_dense_chunks(spark):
    data = [("c1", "Alice", 1), ("c1", "Bob", 20), ("c2", "Alice", 1), ("c3", "Alice", 1), ("c3", "Carol", 400)]
    assert rows(extract.dense_chunks(table(spark, data, "chunk_id string, entity string, word_pos int")), "chunk_id", "dense") == [("c1", True), ("c2", False), ("c3", False)]


def test_scores(spark):
    gold, predicted = table(spark, [("a",), ("b",), ("c",)], "k string"), table(spark, [("a",), ("b",), ("x",), ("y",)], "k string")
    made = scoring.score_sets(predicted, gold, ["k"]).first()
    assert (made.tp, made.fp, made.fn) == (2, 2, 1) and made.precision == 0.5 and abs(made.f1 - 4 / 7) < 1e-12
    pairs = table(spark, [("P", 0, 0), ("P", 1, 0), ("P", 1, 1)], "label string, pred int, gold int")
    assert rows(scoring.greedy_match(pairs), "pred", "gold") == [(0, 0), (1, 1)]


def test_expansion_and_verify(spark):
    edges = table(spark, [("lived_in",), ("met_with",)], "rel_type string")
    known = table(spark, [("lived_in",), ("co_occurs_with",)], "rel_type string")
    assert rows(quality.expansion_lock(edges, known), "rel_type", "outside_schema") == [("lived_in", False), ("met_with", True)]
    assert quality.expansion_lock(edges, known.limit(0)).filter("outside_schema").count() == 0


def test_percentiles(spark):
    frame = spark.range(1, 12).withColumnRenamed("id", "v")
    assert tuple(network.nearest_rank(frame, "v").first()) == (6, 9)


def test_script_lines():
    kinds = {
        "INT. HOUSE - DAY": (0, ""), "EXT/": (0, ""), "INT": (2, ""), "  cut to:": (0, ""), "GANDALF": (1, "Gandalf"), "  O'NEIL (V.O.)": (1, "O'Neil"),
        "BILBO (softly) now": (2, ""), "THE END": (2, ""), "Bilbo": (2, ""), "A B C D E": (2, ""), "ONE -- TWO": (2, ""), "": (2, ""), " " * 21 + "THORIN": (2, ""),
    }
    assert {k: documents.line_kind(k) for k in kinds} == kinds


def test_deep_replies(spark):
    data = {"id": "0", "text": "x"}
    for i in range(1, 200):
        data = {"id": str(i), "text": "x", "replies": [data]}
    made = documents.comment_tree(table(spark, [(json.dumps(data),)], "data string"))
    assert made.count() == 200 and made.agg(F.max("level")).first()[0] == 199


def test_repair_spans(spark):
    given = [("in Fili", "PERSON", 10, 17), ("Bofur and", "PERSON", 0, 9), ("Bofur and Bombur", "PERSON", 5, 21), ("Thorin and Company", "PERSON", 0, 18), ("The Shire", "LOCATION", 0, 9), ("in", "ORG", 0, 2), ("and in Rome", "LOCATION", 3, 14)]
    made = mentions.repair_spans(table(spark, given, "text string, label string, start int, end int"))
    assert rows(made, "text", "start", "end") == [("Bofur", 0, 5), ("Bofur", 5, 10), ("Bombur", 15, 21), ("Fili", 13, 17), ("Rome", 10, 14), ("The Shire", 0, 9), ("Thorin and Company", 0, 18), ("in", 0, 2)]


def test_merge_mentions(spark):
    given = [(1, "Ann", "P", 0, 3, 0.8, ["spacy"], 0), (1, "Ann Lee", "P", 0, 7, 0.8, ["gliner"], 1), (1, "Lee", "O", 4, 7, 0.9, ["spacy"], 2), (1, "Lee Rd", "P", 4, 10, 0.5, ["spacy"], 3), (1, "X", "P", 10, 11, 0.99, ["spacy"], 4), (2, "Y", "P", 0, 1, 0.95, ["gliner", "spacy"], 0)]
    made = mentions.merge_mentions(table(spark, given, "doc_id int, text string, label string, start int, end int, confidence double, sources array<string>, ord int"))
    assert rows(made.withColumn("confidence", F.round("confidence", 6)), "doc_id", "text", "confidence", "n_merged") == [(1, "Ann Lee", 0.95, 2), (1, "Lee", 0.9, 1), (1, "Lee Rd", 0.5, 1), (1, "X", 0.99, 1), (2, "Y", 1.0, 1)]


def test_narrator_mentions(spark):
    text_ = "Ich ging. Then I and my brother; mine not, même not. We"
    made = mentions.narrator_mentions(table(spark, [("c", text_, 100, "Anna Berg"), ("d", "I am", 0, ""), ("e", None, 0, "X"), ("f", "", 0, "X")], "chunk_id string, text string, start_char int, narrator string"))
    assert rows(made, "start", "surface") == [(100, "Ich"), (115, "I"), (121, "my"), (100 + text_.index("mine"), "mine"), (100 + text_.index("We"), "We")]
    long = mentions.narrator_mentions(table(spark, [("c", "I " * 90, 0, "A")], "chunk_id string, text string, start_char int, narrator string"))
    assert rows(long, "start") == [(2 * i,) for i in range(40)]


def test_pronouns(spark):
    spans = [("c", 1, 0, 0, 3, "Ann"), ("c", 1, 1, 10, 13, "She"), ("c", 1, 2, 20, 24, "Anna"), ("c", 2, 0, 30, 32, "he")]
    named = [("c", "Anna Berg", "PERSON", 20, 29, 5), ("c", "Ann", "PERSON", 0, 3, 9)]
    made = mentions.cluster_mentions(table(spark, spans, "chunk_id string, cluster int, i int, start int, end int, surface string"), table(spark, named, "chunk_id string, text string, label string, start int, end int, ord int"))
    assert rows(made, "text", "start", "resolved_from") == [("Ann", 10, "she")]
    edges = table(spark, [("I", "Rome"), ("he", "Rome"), ("Bob", " Me "), ("Anna", "ich"), ("Bob", "bob ")], "source string, target string")
    assert rows(mentions.name_endpoints(edges, F.lit("Anna")), "source", "target") == [("Anna", "Rome"), ("Bob", "Anna")]


def test_small_mention_rules(spark):
    frame = table(spark, [("PERSON", "city in Hesse"), ("PERSON", "German politician"), ("ORG", "writer"), ("LOCATION", None), ("EVENT", "city")], "l string, d string")
    assert [r[0] for r in frame.select(mentions.type_rejected(F.col("l"), F.col("d"))).collect()] == [True, False, True, False, False]
    said = table(spark, [(1, "Ann", "P"), (1, "Ann Lee", "P"), (1, "Lee", "O"), (2, "B", "O"), (2, "B", "P"), (2, "Bob", "P")], "cluster int, surface string, label string")
    assert rows(mentions.representative_surface(said), "cluster", "name", "label") == [(1, "Ann Lee", "P"), (2, "B", "P")]
    found, old = [("A", "B", "met"), ("a", "b", "MET"), ("A", "Z", "met"), ("B", "A", "led")], [("b", "a", "led")]
    schema = "source string, target string, rel_type string"
    assert mentions.recalled_edges(table(spark, found, schema), table(spark, [("A",), ("B",)], "name string"), table(spark, old, schema)).count() == 1


def test_org_surfaces(spark):
    made = resolve.clean_org_surfaces(entities(spark, ("the Knight Foundations", "ORG", 2), ("Knight Foundation", "ORG", 5), ("Open Society Foundations", "ORG", 3), ("the Ann", "PERSON", 1)))
    assert rows(made, "canonical_name", "mention_count") == [("Knight Foundation", 7), ("Open Society Foundations", 3), ("the Ann", 1)]
    assert [r.aliases for r in made.filter("mention_count = 7").collect()] == [["the Knight Foundations"]]


def test_memberships(spark):
    data = [("p1", "Anna Berg", "PERSON", [], ["d1"], True), ("p2", "Max Vogt", "PERSON", ["Max, SA-Mann"], ["d1", "d2"], False), ("p3", "Ida", "PERSON", [], ["d3"], False), ("o1", "NSDAP", "ORG", [], [], False), ("o2", "Storm", "ORG", ["SA (Sturmabteilung)"], [], False), ("o3", "SS (Schutzstaffel)", "ORG", [], [], False)]
    frame = table(spark, data, "entity_id string, canonical_name string, label string, aliases array<string>, doc_ids array<string>, is_author boolean")
    told = table(spark, [("p2", "p3", "met_with", "both went in die SS and to class", 1), ("p3", "o1", "joined", "Parteigenosse seit 1930", 2), ("p1", "p2", "met_with", "", 3)], "source string, target string, rel_type string, evidence string, ord int")
    made = inference.memberships(frame, told)
    assert rows(made, "source", "target", "evidence_tier", "evidence") == [("p1", "o1", 0, "assumed of the corpus"), ("p2", "o2", 1, "sa-mann"), ("p2", "o3", 2, "in die ss"), ("p3", "o3", 2, "in die ss")]
    assert inference.memberships(frame, told, scope="off").filter("evidence_tier = 0").count() == 0
    assert inference.memberships(frame, told, scope="all").filter("evidence_tier = 0").count() == 2
    with pytest.raises(ValueError):
        inference.memberships(frame, told, scope="some")


def test_hot_group_pairs(spark):
    members = table(spark, [("g", i) for i in range(60)] + [("h", 1), ("h", 2)], "g string, m int").withColumns({"_k": F.lit(60), "_w": F.lit(1.0)})
    made = network._pairs(members, "g", "m", "_w", 7)
    assert made.count() == 60 * 59 // 2 + 1 and made.distinct().count() == made.count()


def test_constraint_by_networks_formula(spark):
    """Every node of a weighted graph with triangles against the definition itself."""
    given = {(0, 1): 2.0, (0, 2): 1.0, (1, 2): 3.0, (2, 3): 1.0, (1, 3): 0.5, (3, 4): 4.0, (0, 4): 1.5}
    w = lambda i, j: given.get((min(i, j), max(i, j)), 0.0)
    near = {i: [j for j in range(5) if w(i, j)] for i in range(5)}
    p = {(i, j): w(i, j) / sum(w(i, k) for k in near[i]) for i in range(5) for j in near[i]}
    made = {r.id: r for r in network.constraint(table(spark, [(a, b, x) for (a, b), x in given.items()], "a long, b long, weight double")).collect()}
    for i in range(5):
        want = sum((p[i, j] + sum(p[i, q] * p.get((q, j), 0) for q in near[i] if q != j)) ** 2 for j in near[i])
        size = sum(1 - sum(p[i, q] * w(j, q) / max(w(j, k) for k in near[j]) for q in near[i] if q != j) for j in near[i])
        assert abs(made[i].constraint - want) < 1e-9 and abs(made[i].effective_size - size) < 1e-9
