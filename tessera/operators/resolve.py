"""From mentions to entities and their resolution, layer by layer; the order of the layers matters.

Only the greedy fuzzy layer runs Python, block by block; everything else is joins and aggregates."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import acronym, clean_surface, name_key, org_marker, stable_id
from ..storage import stash
from .identity import author_folds

#: Least similarity of names by label.
THRESHOLDS = {"PERSON": 0.85, "ORG": 0.72, "LOCATION": 0.82, "EVENT": 0.92}
OTHER_THRESHOLD = 0.85
#: Words that don't tell organisations apart.
STOP_TOKENS = ("the", "of", "and", "for", "in", "der", "die", "das", "und", "für", "von", "des", "a", "an")


def mentions_to_entities(mentions: DataFrame) -> DataFrame:
    """Mentions (text, label, doc_id, confidence, sentence, is_author, ord) as entities by (name key, label).

    canonical_name: the most frequent clean surface, then the longest, then the first seen; the others are aliases.
    Two levels of grouping with partial aggregation: a very frequent name is counted by surface first."""
    keyed = mentions.withColumns({"surface": clean_surface(F.col("text")), "key": name_key(F.col("text"))}).filter("key <> ''")
    surfaces = keyed.groupBy("key", "label", "surface").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))
    names = surfaces.groupBy("key", "label").agg(
        F.max_by("surface", F.struct("n", F.length("surface"), -F.col("first"))).alias("canonical_name"), F.array_sort(F.collect_set("surface")).alias("_all")
    )
    facts = keyed.groupBy("key", "label").agg(
        F.count(F.lit(1)).alias("mention_count"),
        F.array_sort(F.collect_set("doc_id")).alias("doc_ids"),
        F.max("confidence").alias("confidence"),
        F.bool_or(F.coalesce("is_author", F.lit(False))).alias("is_author"),
        F.substring(F.min_by("sentence", F.when(F.col("sentence") != "", F.col("ord"))), 1, 300).alias("evidence"),
    )
    made = facts.join(names, ["key", "label"])
    return made.select(
        stable_id(F.col("key"), F.col("label"), prefix="ent_").alias("entity_id"),
        "canonical_name", "label", F.array_except("_all", F.array("canonical_name")).alias("aliases"), "mention_count", "doc_ids",
        "confidence", "is_author", "evidence", "key",
    )


def consolidate_edges(edges: DataFrame) -> DataFrame:
    """One row for each (doc_id, names, relation, evidence), case and blanks aside: the first by ord."""
    fold = lambda c: F.lower(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"\s+", " "))
    by = Window.partitionBy("doc_id", name_key(F.col("source")), name_key(F.col("target")), F.lower("rel_type"), fold(F.col("evidence"))).orderBy("ord")
    return edges.withColumn("_r", F.row_number().over(by)).filter("_r = 1").drop("_r")


def rename_by_alias(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """canonical_name through an alias table (alias, canonical), by the name's key, by the key without a genitive s
    (keys of over four characters), then by the key without spaces; authors keep their names."""
    table = aliases.select(name_key(F.col("alias")).alias("_k"), "canonical").groupBy("_k").agg(F.min("canonical").alias("_c"))
    squashed = table.select(F.replace("_k", F.lit(" "), F.lit("")).alias("_k"), "_c").groupBy("_k").agg(F.min("_c").alias("_c"))
    key = F.col("key")
    tries = (
        ("_c1", key, table),
        ("_c2", F.when((F.length(key) > 4) & key.endswith("s"), F.regexp_replace(key, "s$", "")), table),
        ("_c3", F.replace(key, F.lit(" "), F.lit("")), squashed),
    )
    out = entities
    for name, probe, source in tries:
        out = out.withColumn("_p", probe).join(source.select(F.col("_k").alias("_p"), F.col("_c").alias(name)), "_p", "left").drop("_p")
    found = F.when(F.coalesce("is_author", F.lit(False)), F.col("canonical_name")).otherwise(F.coalesce("_c1", "_c2", "_c3", "canonical_name"))
    return out.withColumn("canonical_name", found).withColumn("key", name_key(F.col("canonical_name"))).drop("_c1", "_c2", "_c3")


def block_key(name: Column, label: Column) -> Column:
    """Persons: first letter of the last token; others: first letter of the first telling token."""
    tokens = F.split(name_key(name), " ")
    telling = F.filter(tokens, lambda t: ~t.isin(*STOP_TOKENS))
    first = F.coalesce(F.try_element_at(telling, F.lit(1)), F.element_at(tokens, 1))
    return F.substring(F.when(label == "PERSON", F.element_at(tokens, -1)).otherwise(first), 1, 1)


def ratio(a: str, b: str, least: float) -> float:
    match = SequenceMatcher(None, a, b)
    return match.ratio() if match.real_quick_ratio() >= least and match.quick_ratio() >= least else 0.0


def _years(name: str) -> set[str]:
    return {t for t in name.split() if t.isdigit() and len(t) == 4}


def blocked(a: str, b: str, label: str) -> bool:
    """Pairs that never fold however alike: events of different years, places within others' names, families
    (one surname, given names that differ), organisations that differ in a telling token."""
    x, y = a.split(), b.split()
    if label == "EVENT" and _years(a) != _years(b):
        return True
    if label == "LOCATION" and a != b and (a in b or b in a):
        return True
    if label == "PERSON" and len(x) > 1 and len(y) > 1 and x[-1] == y[-1]:
        return ratio(" ".join(x[:-1]), " ".join(y[:-1]), 0.8) < 0.8
    if label in ("ORG", "LOCATION", "INSTITUTION"):
        only_x, only_y = [t for t in x if t not in y and t not in STOP_TOKENS], [t for t in y if t not in x and t not in STOP_TOKENS]
        return bool(only_x and only_y) and any(all(ratio(t, u, 0.8) < 0.8 for u in only_y) for t in only_x)
    return False


def greedy_fuzzy(entities: DataFrame) -> DataFrame:
    """(entity_id, into): each entity and the one it folds into (itself, if none).

    Within a block of one label, by falling mentions, an entity joins the first survivor whose name is alike
    enough.  A block's names have to fit in a task; cheap bounds come before each full comparison."""

    def fold(part: pd.DataFrame) -> pd.DataFrame:
        label = part["label"].iloc[0]
        least = THRESHOLDS.get(label, OTHER_THRESHOLD)
        rows = part.sort_values(["mention_count", "key"], ascending=[False, True], kind="stable")
        kept: list[tuple[str, str, bool]] = []
        into = []
        for own, key, author, short in zip(rows["entity_id"], rows["key"], rows["is_author"], rows["short"], strict=True):
            # Two acronyms are never spellings of one another.
            target = None if author else next((i for i, k, s in kept if not (s and short and k != key) and ratio(key, k, least) >= least and not blocked(key, k, label)), None)
            if target is None:
                target = own
                if not author:
                    kept.append((own, key, short))
            into.append(target)
        return pd.DataFrame({"entity_id": rows["entity_id"], "into": into})

    keyed = entities.select("entity_id", "key", "label", "mention_count", F.coalesce("is_author", F.lit(False)).alias("is_author"), F.col("canonical_name").rlike(r"^\p{Lu}{2,6}$").alias("short"), block_key(F.col("canonical_name"), F.col("label")).alias("block"))
    return keyed.groupBy("label", "block").applyInPandas(fold, "entity_id string, into string")


def cross_type(entities: DataFrame) -> DataFrame:
    """(entity_id, into): one name under several labels: the key without "the" and a closing parenthesis; most
    mentions win, then the look of an organisation, then the label's rank; groups with authors stay."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim("canonical_name")), r"^the\s+", ""), r"\s*\([^)]*\)$", ""))
    rank = F.array_position(F.array(*[F.lit(x) for x in ("PERSON", "LOCATION", "EVENT", "INSTITUTION", "ORG")]), F.col("label"))
    keyed = entities.withColumn("_b", name_key(bare))
    order = F.struct(-F.col("mention_count"), F.when(org_marker(F.col("canonical_name")) & F.col("label").isin("ORG", "INSTITUTION"), 0).otherwise(1), F.when(rank == 0, 9).otherwise(rank), "entity_id")
    best = keyed.groupBy("_b").agg(F.min_by("entity_id", order).alias("into"), F.bool_or(F.coalesce("is_author", F.lit(False))).alias("_a"))
    return keyed.join(best, "_b").select("entity_id", F.when(F.col("_a"), F.col("entity_id")).otherwise(F.col("into")).alias("into"))


def acronym_folds(entities: DataFrame) -> DataFrame:
    """(entity_id, into, pin): an organisation named by the initials of exactly one other, which keeps its name."""
    orgs = entities.filter("label IN ('ORG', 'INSTITUTION')")
    long = orgs.withColumn("_i", acronym(F.col("canonical_name"))).filter(F.length("_i") >= 2)
    one = long.groupBy("_i").agg(F.count(F.lit(1)).alias("_n"), F.min("entity_id").alias("into")).filter("_n = 1")
    short = orgs.filter(F.col("canonical_name").rlike(r"^[A-ZÄÖÜ]{2,}$")).select("entity_id", F.col("canonical_name").alias("_i"))
    return short.join(one, "_i").filter("entity_id <> into").select("entity_id", "into", F.lit(True).alias("pin"))


def partial_person_folds(entities: DataFrame) -> DataFrame:
    """(entity_id, into, pin): a single-token person that is the first or last token of exactly one longer one, which
    keeps its name."""
    persons = entities.filter("label = 'PERSON' AND NOT coalesce(is_author, false)").withColumn("_t", F.split("key", " "))
    long = persons.filter(F.size("_t") > 1).select(F.explode(F.array_distinct(F.array(F.element_at("_t", 1), F.element_at("_t", -1)))).alias("key"), F.col("entity_id").alias("into"))
    one = long.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.min("into").alias("into")).filter("_n = 1")
    return persons.filter(F.size("_t") == 1).join(one, "key").select("entity_id", "into", F.lit(True).alias("pin"))


def subset_person_folds(entities: DataFrame) -> DataFrame:
    """(entity_id, into, pin): a person whose tokens, two or more, occur in order in exactly one longer person.

    The longer name is pinned if both have the same outer tokens (middle names); else the better attested one wins."""
    persons = entities.filter("label = 'PERSON'").select("entity_id", F.split("key", " ").alias("t"))
    short = persons.filter(F.size("t") >= 2).select(F.col("entity_id").alias("s"), F.col("t").alias("st"), F.element_at("t", 1).alias("k1"), F.element_at("t", -1).alias("k2"))
    # Both outer tokens occur in the longer name: an equi-join on the pair.
    long = persons.filter(F.size("t") >= 3).select(F.col("entity_id").alias("l"), F.col("t").alias("lt"), F.posexplode("t").alias("i", "k1")).select("l", "lt", "i", "k1", F.explode(F.slice("lt", F.col("i") + 2, F.size("lt"))).alias("k2")).distinct()
    step = lambda at, tok: F.when(at < 0, at).otherwise(_next_place(F.col("lt"), tok, at))
    inside = F.aggregate("st", F.lit(0), step) > 0
    same = (F.element_at("lt", 1) == F.element_at("st", 1)) & (F.element_at("lt", -1) == F.element_at("st", -1))
    found = short.join(long, ["k1", "k2"]).filter((F.size("lt") > F.size("st")) & inside).select("s", "l", same.alias("same")).distinct()
    one = found.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("l").alias("into"), F.bool_and("same").alias("pin")).filter("n = 1")
    return one.select(F.col("s").alias("entity_id"), "into", "pin")


def _next_place(tokens: Column, token: Column, after: Column) -> Column:
    at = F.array_position(F.slice(tokens, after + 1, F.size(tokens)), token).cast("int")
    return F.when(at > 0, after + at).otherwise(F.lit(-1))


def qid_folds(entities: DataFrame) -> DataFrame:
    """(entity_id, into): entities of one external id; most mentions win; authors stay."""
    known = entities.filter("wikidata_qid IS NOT NULL AND NOT coalesce(is_author, false)")
    best = known.groupBy("wikidata_qid").agg(F.min_by("entity_id", F.struct(-F.col("mention_count"), "entity_id")).alias("into"))
    return known.join(best, "wikidata_qid").select("entity_id", "into")


def merge(entities: DataFrame, folds: DataFrame) -> DataFrame:
    """Entities after folds (entity_id, into and perhaps ``pin``): mentions add up, documents and aliases unite, the name
    of most mentions stays, or that of ``into`` where a fold pins it."""
    pins = folds if "pin" in folds.columns else folds.withColumn("pin", F.lit(False))
    placed = entities.join(pins, "entity_id", "left").withColumn("into", F.coalesce("into", "entity_id"))
    own = F.when(F.col("entity_id") == F.col("into"), F.lit(0))
    order = F.struct(F.when(F.col("canonical_name").startswith("Narrator ["), 1).otherwise(0), -F.col("mention_count"), F.coalesce(own, F.lit(1)), "entity_id")
    made = placed.groupBy("into").agg(
        F.min_by("canonical_name", order).alias("_top"),
        F.min_by("canonical_name", own).alias("_own"),
        F.bool_or(F.coalesce("pin", F.lit(False))).alias("_pin"),
        F.min_by("label", own).alias("label"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_union("aliases", F.array("canonical_name")))))).alias("_names"),
        F.sum("mention_count").alias("mention_count"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("doc_ids")))).alias("doc_ids"),
        F.max("confidence").alias("confidence"),
        F.bool_or(F.coalesce("is_author", F.lit(False))).alias("is_author"),
    )
    made = made.withColumn("canonical_name", F.when(F.col("_pin"), F.coalesce("_own", "_top")).otherwise(F.col("_top")))
    made = made.withColumn("aliases", F.array_except("_names", F.array("canonical_name")))
    named = made.select(F.col("into").alias("entity_id"), "canonical_name", "label", "aliases", "mention_count", "doc_ids", "confidence", "is_author")
    return named.withColumn("key", name_key(F.col("canonical_name")))


def remap_edges(edges: DataFrame, folds: DataFrame) -> DataFrame:
    """Edges with folded ends; self loops go."""
    side = lambda c: folds.select(F.col("entity_id").alias(c), F.col("into").alias(f"_{c}"))
    out = edges.join(side("source"), "source", "left").join(side("target"), "target", "left")
    return out.withColumn("source", F.coalesce("_source", "source")).withColumn("target", F.coalesce("_target", "target")).drop("_source", "_target").filter("source <> target")


def resolve_endpoints(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges between names as edges between ids, through canonical and alias keys; a key of several entities goes
    to the one of most mentions; unresolved edges and self loops go."""
    names = entities.select("entity_id", "mention_count", F.explode(F.array_union(F.array("canonical_name"), "aliases")).alias("n"))
    index = names.groupBy(name_key(F.col("n")).alias("k")).agg(F.max_by("entity_id", F.struct("mention_count", "entity_id")).alias("id"))
    left, right = index.select(F.col("k").alias("_s"), F.col("id").alias("_sid")), index.select(F.col("k").alias("_t"), F.col("id").alias("_tid"))
    out = edges.withColumns({"_s": name_key(F.col("source")), "_t": name_key(F.col("target"))}).join(left, "_s").join(right, "_t")
    return out.withColumns({"source": F.col("_sid"), "target": F.col("_tid")}).drop("_s", "_t", "_sid", "_tid").filter("source <> target")


# Words of organisations' names whose plural may stand for the singular, in -s and in -ies.
_PLURAL_S = r"(?i)\b(foundation|institute|institution|endowment|fund|trust|association|college|corporation|council|committee|union|party|center|centre|department|bank|federation|alliance|league|brotherhood|group|school|club|board|office)s\b"
_PLURAL_IES = r"(?i)\b(universit|compan|societ|agenc|ministr|facult|academ)ies\b"


def clean_org_surfaces(entities: DataFrame) -> DataFrame:
    """Organisations' names without a leading "the", and in the singular where the singular is an entity too; the
    name before becomes an alias, and what now has one key and label is one entity."""
    org = F.col("label").isin("ORG", "INSTITUTION")
    bare = F.coalesce(F.nullif(F.trim(F.regexp_replace("canonical_name", r"(?i)^the\s+", "")), F.lit("")), F.col("canonical_name"))
    single = F.regexp_replace(F.regexp_replace("_bare", _PLURAL_S, "$1"), _PLURAL_IES, "$1y")
    named = entities.withColumn("_bare", bare).withColumn("_single", single)
    there = named.filter(org).select(name_key(F.col("_bare")).alias("_k")).distinct().withColumn("_there", F.lit(True))
    asked = F.when(org & (F.col("_single") != F.col("_bare")), name_key(F.col("_single")))
    named = named.withColumn("_k", asked).join(there, "_k", "left")
    named = named.withColumn("_name", F.when(F.col("_there"), F.col("_single")).when(org, F.col("_bare")).otherwise(F.col("canonical_name")))
    aliases = F.when(F.col("_name") != F.col("canonical_name"), F.array_union("aliases", F.array("canonical_name"))).otherwise(F.col("aliases"))
    clean = named.withColumns({"aliases": aliases, "canonical_name": F.col("_name"), "key": name_key(F.col("_name"))}).select(*entities.columns)
    heads = clean.groupBy("key", "label").agg(F.min_by("entity_id", F.struct(-F.col("mention_count"), "entity_id")).alias("into"))
    return merge(clean, clean.filter(org).join(heads, ["key", "label"]).select("entity_id", "into"))


def resolve(entities: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """All layers in order: aliases, fuzzy, cross type, subset persons, acronyms, partial persons, authors,
    organisations' surfaces.  A layer reads the entities more than once, so each is written before the next."""
    entities = stash(entities if aliases is None else rename_by_alias(entities, aliases))
    for layer in (greedy_fuzzy, cross_type, subset_person_folds, acronym_folds, partial_person_folds, author_folds):
        entities = stash(merge(entities, layer(entities)))
    return clean_org_surfaces(entities)
