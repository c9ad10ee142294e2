"""Memberships that texts about a person imply."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.membership import CONFIDENCE, INTERWAR, Evidence
from ..functions.text import name_key
from ..storage import stash

MEMBERSHIPS = ("member_of", "joined", "served_in")


def _first_signal(text: Column, org: Evidence) -> Column:
    """The strongest signal for ``org`` in a text: struct of tier, its place in the list, and what was found."""
    tries = []
    for place, (tier, kind, signal) in enumerate(org.signals()):
        if kind == "text":
            hit, shown = F.contains(text, F.lit(signal)), F.lit(signal)
        else:
            pattern = r"(?U)(?i)" + (signal if kind == "pattern" else rf"\b{re.escape(signal)}\b")
            hit, shown = text.rlike(pattern), F.trim(F.regexp_extract(text, pattern, 0)) if kind == "pattern" else F.lit(signal)
        tries.append(F.when(hit, F.struct(F.lit(tier).alias("tier"), F.lit(place).alias("place"), shown.alias("signal"))))
    return F.coalesce(*tries)


def person_texts(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """(entity_id, piece, at): lower-case names of each PERSON, evidence of its edges and names of their other ends."""
    people = entities.filter("label = 'PERSON'")
    own = people.select("entity_id", F.explode(F.array_union(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("piece"), F.lit(-1).cast("long").alias("at"))
    told = edges.filter("evidence <> ''").select("evidence", F.col("ord").cast("long").alias("at"), F.inline(F.array(F.struct(F.col("source").alias("entity_id"), F.col("target").alias("_o")), F.struct(F.col("target").alias("entity_id"), F.col("source").alias("_o")))))
    told = told.join(people.select("entity_id"), "entity_id", "left_semi").join(entities.select(F.col("entity_id").alias("_o"), "canonical_name"), "_o", "left")
    near = told.select("entity_id", F.explode(F.array("evidence", "canonical_name")).alias("piece"), "at").filter("piece IS NOT NULL")
    return own.unionByName(near).withColumn("piece", F.concat(F.lower("piece"), F.lit(" ")))


def memberships(entities: DataFrame, edges: DataFrame, evidence: tuple[Evidence, ...] = INTERWAR, scope: str = "authors_only") -> DataFrame:
    """(source, target, rel_type, doc_id, evidence, confidence, edge_source, evidence_tier, inferred_org): memberships
    that are not among ``edges`` yet.

    entities: entity_id, canonical_name, label, aliases, doc_ids, is_author; edges: source, target, rel_type, evidence,
    ord.  Of several signals the lowest tier wins, then the first listed, then the earliest text; every text is judged
    by itself, so a person of very many texts is a partial minimum, not one long string.  Organisations that are no
    entity are passed over.  ``scope`` says of whom an assumed membership holds: authors_only, all or off.
    """
    if scope not in ("authors_only", "all", "off"):
        raise ValueError(f"scope is authors_only, all or off, not {scope}")
    found = F.array(*[F.struct(F.lit(o.name).alias("org"), _first_signal(F.col("piece"), o).alias("s")) for o in evidence])
    hits = person_texts(entities, edges).select("entity_id", "at", F.inline(found)).filter("s IS NOT NULL")
    best = hits.groupBy("entity_id", "org").agg(F.min(F.struct("s.tier", "s.place", "at", "s.signal")).alias("b")).select("entity_id", "org", "b.tier", "b.signal")
    assumed = [o.name for o in evidence if o.assumed]
    if assumed and scope != "off":
        who = entities.filter("label = 'PERSON'" + (" AND coalesce(is_author, false)" if scope == "authors_only" else ""))
        held = who.select("entity_id", F.explode(F.array(*[F.lit(n) for n in assumed])).alias("org"), F.lit(0).alias("tier"), F.lit("assumed of the corpus").alias("signal"))
        best = best.unionByName(held).groupBy("entity_id", "org").agg(F.min(F.struct("tier", "signal")).alias("b")).select("entity_id", "org", "b.tier", "b.signal")
    groups = entities.filter("label IN ('ORG', 'INSTITUTION')")
    names = groups.select("entity_id", F.lower("canonical_name").alias("n"), F.lit(0).alias("k")).unionByName(groups.select("entity_id", F.explode(F.transform("aliases", F.lower)).alias("n"), F.lit(1).alias("k")))
    index = names.join(F.broadcast(entities.sparkSession.createDataFrame([(o.name, o.name.lower()) for o in evidence], "org string, n string")), "n")
    index = index.groupBy("org").agg(F.min_by("entity_id", F.struct("k", "entity_id")).alias("target"))  # a row an organisation of the list
    made = best.join(index, "org").filter("entity_id <> target").withColumnRenamed("entity_id", "source")
    made = made.join(edges.filter(F.col("rel_type").isin(*MEMBERSHIPS)).select("source", "target"), ["source", "target"], "left_anti")
    docs = entities.select(F.col("entity_id").alias("source"), F.array_join("doc_ids", ";").alias("doc_id"))
    sure = F.element_at(F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv]), F.col("tier"))
    origin = F.when(F.col("tier") == 0, "pipeline_inferred").otherwise("canonical_inferred")
    return made.join(docs, "source").select("source", "target", F.lit("member_of").alias("rel_type"), "doc_id", F.col("signal").alias("evidence"), sure.alias("confidence"), origin.alias("edge_source"), F.col("tier").alias("evidence_tier"), F.col("org").alias("inferred_org"))


# Words that tell of a birth (the short form only in a mention's sentence, as elsewhere it marks a maiden
# name), of a residence, and of relatives, whose birthplace is not the narrator's.
BIRTH = ("geboren", "gebürtig", "gebuertig", "born")
SHORT_BIRTH = ("geb.",)
RESIDENCE = (
    "wohnhaft", "wohnte", "wohnt", "ansässig", "ansaessig", "niedergelassen", "lebte", "lebt", "resided", "reside", "residing",
    "lived", "domiciled",
)
RELATIVES = (
    "vater", "mutter", "eltern", "großvater", "grossvater", "großmutter", "grossmutter", "bruder", "schwester", "onkel", "tante",
    "sohn", "tochter", "gattin", "ehefrau", "gemahlin", "father", "mother", "parents", "grandfather", "grandmother", "brother",
    "sister", "uncle", "aunt", "son", "daughter", "wife",
)
IN_LAW = "schwieger"
BIOGRAPHICAL = ("born_in", "resided_in")
GENERIC_PLACE = ("located_in", "lived_in")


def _cue(text: Column, words: tuple[str, ...]) -> Column:
    """The first of the words in a text, in lower case; null for none."""
    pattern = r"(?U)(?i)\b(" + "|".join(re.escape(w) + (r"\b" if w[-1].isalpha() else "") for w in words) + ")"
    return F.lower(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")))


def biographical_edges(entities: DataFrame, edges: DataFrame, mentions: DataFrame) -> DataFrame:
    """edges with the narrators' birthplaces and residences, and the columns biographical_cue and type_upgraded_from.

    A place (mentions: doc_id, text, label, sentence, ord) whose sentence tells of a birth or residence, but of no relative,
    ties the document's author to it.  An edge that only says where that author is becomes this tie (the first such edge,
    by the first cue); else the tie is new.  Then edges from authors to places whose evidence tells of a birth or residence
    become ties too.  A tie that is there already is not made again.

    entities: entity_id, canonical_name, aliases, label, mention_count, is_author, doc_ids; edges: source, target, rel_type,
    doc_id, evidence, confidence, edge_source and a unique ord."""
    authors = entities.filter("is_author").select(F.explode("doc_ids").alias("doc_id"), "entity_id").groupBy("doc_id").agg(F.min("entity_id").alias("source"))
    places = entities.filter("label = 'LOCATION'")
    named = places.select("entity_id", "mention_count", F.explode(F.array_union(F.array("canonical_name"), "aliases")).alias("_n"))
    index = named.groupBy(name_key(F.col("_n")).alias("_k")).agg(F.max_by("entity_id", F.struct("mention_count", "entity_id")).alias("target"))

    said = F.coalesce("sentence", F.lit(""))
    birth, home = _cue(said, (*BIRTH, *SHORT_BIRTH)), _cue(said, RESIDENCE)
    relative = _cue(said, RELATIVES).isNotNull() | said.rlike(rf"(?U)(?i)\b{IN_LAW}\w*\b")
    told = mentions.filter("label = 'LOCATION'").withColumns({"cue": F.coalesce(birth, home), "rel": F.when(birth.isNotNull(), "born_in").otherwise("resided_in")}).filter(F.col("cue").isNotNull() & ~relative)
    ties = told.withColumn("_k", name_key(F.col("text"))).join(authors, "doc_id").join(index, "_k").filter("source <> target")
    first = ties.groupBy("source", "target", "rel").agg(F.min_by(F.struct("ord", "cue", "doc_id", F.substring(F.trim("sentence"), 1, 200).alias("evidence")), F.struct("ord", "cue")).alias("m"))
    there = edges.filter(F.col("rel_type").isin(*BIOGRAPHICAL)).select("source", "target", F.col("rel_type").alias("rel")).distinct()
    wanted = stash(first.join(there, ["source", "target", "rel"], "left_anti"))

    generic = edges.filter(F.col("rel_type").isin(*GENERIC_PLACE))
    heads = generic.groupBy("source", "target").agg(F.min("ord").alias("ord"))
    lead = wanted.groupBy("source", "target").agg(F.min_by(F.struct("rel", F.col("m.cue").alias("cue")), F.struct("m.ord", "rel")).alias("w"))
    by_mention = heads.join(lead, ["source", "target"]).select("ord", "source", "target", "w.rel", "w.cue")

    proof = F.coalesce("evidence", F.lit(""))
    strict, lives = _cue(proof, BIRTH), _cue(proof, RESIDENCE)
    own = generic.join(authors.select("source").distinct(), "source", "left_semi").join(places.select(F.col("entity_id").alias("target")), "target", "left_semi").filter("source <> target")
    shown = own.withColumns({"cue": F.coalesce(strict, lives), "rel": F.when(strict.isNotNull(), "born_in").otherwise("resided_in")}).filter("cue IS NOT NULL")
    taken = there.unionByName(wanted.select("source", "target", "rel"))
    rest = shown.join(by_mention.select("ord"), "ord", "left_anti").join(taken, ["source", "target", "rel"], "left_anti")
    by_proof = rest.groupBy("source", "target", "rel").agg(F.min_by(F.struct("ord", "cue"), "ord").alias("p")).select("p.ord", "source", "target", "rel", "p.cue")

    changes = by_mention.unionByName(by_proof).select("ord", F.col("rel").alias("_rel"), F.col("cue").alias("biographical_cue"))
    kept = edges.join(changes, "ord", "left").withColumns({"type_upgraded_from": F.when(F.col("_rel").isNotNull(), F.col("rel_type")), "rel_type": F.coalesce("_rel", "rel_type")}).drop("_rel")
    made = wanted.join(by_mention.select("source", "target", "rel"), ["source", "target", "rel"], "left_anti").select(
        "source", "target", F.col("rel").alias("rel_type"), "m.doc_id", "m.evidence", F.lit(0.78).alias("confidence"), F.lit("rule_extracted").alias("edge_source"), F.col("m.cue").alias("biographical_cue"),
    )
    return kept.unionByName(made, allowMissingColumns=True)
