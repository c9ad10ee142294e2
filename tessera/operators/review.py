"""What reviewers, lookups and a curated naming table propose for entities, each behind its guards.

Proposals are tables: the model or service that fills them is outside the engine."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions.text import name_key, numeric_alias
from .exports import linking_candidates, proposal_names
from .mentions import FUNCTION_WORDS, type_rejected
from .resolve import STOP_TOKENS, merge

MOST_ALIASES = 8  #: merges that one name may take in
MOST_GROUP = 16  #: a proposal of more aliases than this is made up
LEAST_ALIKE = 0.75  #: similarity of names that share no word
#: Subtypes that say nothing.
EMPTY_SUBTYPES = ("string", "none", "unknown", "n/a", "na", "other", "")
_ACRONYM = r"^(?:\p{Lu}\.?){2,6}$"


def _short(name: Column) -> Column:
    """The letters of a name that is an acronym, else null."""
    bare = F.replace(F.trim(name), F.lit(" "), F.lit(""))
    return F.when(bare.rlike(_ACRONYM), F.replace(bare, F.lit("."), F.lit("")))


def _words(name: Column) -> Column:
    return F.filter(F.split(name_key(name), " "), lambda t: (t != "") & ~t.isin(*STOP_TOKENS))


@F.pandas_udf(BooleanType())
def _alike(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([x is not None and y is not None and SequenceMatcher(None, x, y).ratio() >= LEAST_ALIKE for x, y in zip(a, b, strict=True)], dtype="bool")


def plausible_alias(pairs: DataFrame, name: str = "name", alias: str = "alias") -> DataFrame:
    """pairs with ``plausible``: they share a telling word, or one is an acronym found among the other's words, or they
    are much alike; two acronyms have to be the same, and a name with an outer function word is no name."""
    a, b = F.col(name), F.col(alias)
    outer = lambda c: F.lower(c).rlike(r"^(?:" + "|".join(FUNCTION_WORDS) + r")\s|\s(?:" + "|".join(FUNCTION_WORDS) + r")(?:\s|$)")
    x, y = _short(a), _short(b)
    shared = F.arrays_overlap(_words(a), _words(b)) | F.coalesce(F.array_contains(_words(b), F.lower(x)), F.lit(False)) | F.coalesce(F.array_contains(_words(a), F.lower(y)), F.lit(False))
    made = pairs.withColumns({"_no": outer(a) | outer(b), "_two": x.isNotNull() & y.isNotNull(), "_same": x == y, "_sh": F.coalesce(shared, F.lit(False)), "_al": _alike(name_key(a), name_key(b))})
    return made.withColumn("plausible", F.when(F.col("_no"), False).when(F.col("_two"), F.col("_same")).otherwise(F.col("_sh") | F.col("_al"))).drop("_no", "_two", "_same", "_sh", "_al")


def guarded_merges(entities: DataFrame, proposals: DataFrame, most_names: int = 300) -> DataFrame:
    """(entity_id, into) from proposals (label, ord, canonical, aliases array) that pass the guards: groups that aren't
    oversized, names among those asked about, no numbers, no authors absorbed, plausible pairs only.

    In order within a label, a name takes in at most ``MOST_ALIASES`` others; who was taken in takes in nobody.  A label
    has at most ``most_names`` names, so its pairs fit in a task whatever the corpus."""
    asked = proposal_names(entities, most_names).join(entities.select("entity_id", F.coalesce("is_author", F.lit(False)).alias("_author")), "entity_id").withColumn("_k", name_key(F.col("canonical_name")))
    named = asked.groupBy("label", "_k").agg(F.max_by(F.struct("entity_id", "canonical_name", "_author"), "place").alias("e"))
    given = proposals.filter(F.size("aliases") <= MOST_GROUP).select("label", "ord", name_key(F.col("canonical")).alias("_k"), F.posexplode("aliases").alias("i", "said"))
    left = given.join(named, ["label", "_k"]).select("label", "ord", "i", "said", F.col("e").alias("x")).withColumn("_k", name_key(F.col("said")))
    both = left.filter(~numeric_alias(F.col("said"))).join(named, ["label", "_k"]).filter("x.entity_id <> e.entity_id AND NOT e._author")
    pairs = both.select("label", "ord", "i", F.col("x.entity_id").alias("into"), F.col("x.canonical_name").alias("name"), F.col("e.entity_id").alias("entity_id"), F.col("e.canonical_name").alias("alias"))
    good = plausible_alias(pairs).filter("plausible").groupBy("label", "into", "entity_id").agg(F.min(F.struct("ord", "i")).alias("at")).select("label", "into", "entity_id", "at.ord", "at.i")

    def take(part: pd.DataFrame) -> pd.DataFrame:
        gone, size, out = set(), {}, []
        for into, own in part.sort_values(["ord", "i", "into", "entity_id"])[["into", "entity_id"]].itertuples(index=False):
            if into not in gone and own not in gone and size.get(into, 0) < MOST_ALIASES:
                gone.add(own)
                size[into] = size.get(into, 0) + 1
                out.append((own, into))
        # One taken in later carries along what it has taken in before.
        last = dict(out)
        for own, into in out:
            while into in last:
                into = last[into]
            last[own] = into
        return pd.DataFrame(list(last.items()), columns=["entity_id", "into"])

    return good.groupBy("label").applyInPandas(take, "entity_id string, into string")


def enforce_names(entities: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities, folds): a curated table (alias, canonical) has the last word on names; what then shares a key and
    label folds into the one of most mentions.

    A name is looked up by its key, then without spaces, then both without a genitive s (keys of over four characters);
    if it is unknown, its aliases are, and count if they agree.  Authors keep their names and fold with nobody."""
    table = names.select(name_key(F.col("alias")).alias("_k"), "canonical").filter("_k <> ''").groupBy("_k").agg(F.min("canonical").alias("_c"))
    tight = table.groupBy(F.replace("_k", F.lit(" "), F.lit("")).alias("_k")).agg(F.min("_c").alias("_c"))
    both = table.select(F.concat(F.lit("="), "_k").alias("_k"), "_c").union(tight.select(F.concat(F.lit("~"), "_k").alias("_k"), "_c"))
    surfaces = entities.filter("NOT coalesce(is_author, false)").select("entity_id", F.posexplode(F.concat(F.array("canonical_name"), "aliases")).alias("_i", "_n")).withColumn("_key", name_key(F.col("_n")))
    bare = F.when((F.length("_key") > 4) & F.col("_key").endswith("s"), F.regexp_replace("_key", "s$", ""))
    tight_of = lambda c: F.concat(F.lit("~"), F.replace(c, F.lit(" "), F.lit("")))
    probes = F.array(F.concat(F.lit("="), "_key"), tight_of(F.col("_key")), F.concat(F.lit("="), bare), tight_of(bare))
    hits = surfaces.select("entity_id", "_i", F.posexplode(probes).alias("_p", "_k")).join(both, "_k").groupBy("entity_id", "_i").agg(F.min_by("_c", "_p").alias("_c"))
    found = hits.groupBy("entity_id").agg(F.min(F.when(F.col("_i") == 0, F.col("_c"))).alias("_own"), F.collect_set(F.when(F.col("_i") > 0, F.col("_c"))).alias("_set"))
    target = found.select("entity_id", F.coalesce("_own", F.when(F.size("_set") == 1, F.element_at("_set", 1))).alias("_to")).filter("_to IS NOT NULL")
    joined = entities.join(target, "entity_id", "left").withColumn("_name", F.coalesce("_to", "canonical_name"))
    aliases = F.array_sort(F.array_except(F.array_union("aliases", F.array("canonical_name")), F.array("_name")))
    named = joined.withColumns({"aliases": aliases, "canonical_name": F.col("_name"), "key": name_key(F.col("_name"))}).select(*entities.columns)
    free = named.filter("NOT coalesce(is_author, false)")
    heads = free.groupBy("key", "label").agg(F.min_by("entity_id", F.struct(-F.col("mention_count"), "entity_id")).alias("into"), F.count(F.lit(1)).alias("_n"))
    folds = free.join(heads.filter("_n > 1"), ["key", "label"]).select("entity_id", "into")
    return merge(named, folds), folds


def enrich(entities: DataFrame, records: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """entities (with ``subtype`` and ``attributes`` map) after records (name, subtype, attributes map): a subtype counts
    if it is telling, no echo of the label, and in the label's vocabulary (label, subtype) where that has any; attributes
    only fill gaps."""
    said = records.select(name_key(F.col("name")).alias("key"), F.lower(F.trim("subtype")).alias("_st"), F.map_filter("attributes", lambda _, v: v.isNotNull() & ~v.isin("", "string")).alias("_at"))
    one = said.groupBy("key").agg(F.max_by(F.struct("_st", "_at"), F.coalesce("_st", F.lit(""))).alias("_r"))
    out = entities.join(one, "key", "left")
    st = F.col("_r._st")
    good = st.isNotNull() & ~st.isin(*EMPTY_SUBTYPES) & (st != F.lower("label"))
    if vocabulary is not None:
        allowed = vocabulary.groupBy("label").agg(F.collect_set(F.lower("subtype")).alias("_allowed"))
        out = out.join(allowed, "label", "left")
        good = good & (F.col("_allowed").isNull() | F.array_contains("_allowed", st))
    empty = F.create_map().cast("map<string,string>")
    have = F.coalesce("attributes", empty)
    gaps = F.map_filter(F.coalesce("_r._at", empty), lambda k, _: ~F.map_contains_key(have, k))
    made = out.withColumns({"subtype": F.when(F.coalesce(good, F.lit(False)), st).otherwise(F.col("subtype")), "attributes": F.map_concat(have, gaps)})
    return made.select(*entities.columns)


def link(entities: DataFrame, lookups: DataFrame, labels: tuple[str, ...] = ("PERSON", "ORG", "LOCATION"), least: int = 2, most: int = 400) -> DataFrame:
    """entities with wikidata_qid, _url and _label from a lookup table (name, qid, url, title, description), for the
    entities worth a lookup; a description of another type is no hit."""
    asked = linking_candidates(entities, labels, least, most).select("entity_id", F.lower("canonical_name").alias("_n"))
    cached = lookups.groupBy(F.lower("name").alias("_n")).agg(F.min(F.struct("qid", "url", "title", "description")).alias("_h"))
    out = entities.join(asked.join(cached, "_n").select("entity_id", "_h"), "entity_id", "left")
    hit = F.col("_h.qid").isNotNull() & ~type_rejected(F.col("label"), F.col("_h.description"))
    return out.withColumns({f"wikidata_{c}": F.when(hit, F.col(f"_h.{f}")) for c, f in (("qid", "qid"), ("url", "url"), ("label", "title"))}).drop("_h")
