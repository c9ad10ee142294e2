"""Mentions of several recognisers as one list: spans repaired, overlaps merged, pronouns named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words that no name begins or ends with (articles and particles can be part of one), what joins two
# names, and what makes the second part of such a pair no name.
FUNCTION_WORDS = ("in", "on", "at", "to", "by", "with", "for", "from", "as", "and", "or", "und", "oder", "im", "am", "beim", "bei", "mit", "zu", "zur", "zum")
CONJUNCTION = r"\s+(?:and|und|&)\s+"
NO_PERSON = ("company", "co", "co.", "sons", "söhne", "others", "family")
# Pronouns of relations' ends.
FIRST_PERSON = ("ich", "mich", "mir", "mein", "meine", "meinen", "meinem", "meiner", "wir", "uns", "unser", "unsere", "i", "me", "my", "myself", "we", "us", "our")
THIRD_PERSON = ("er", "sie", "ihn", "ihm", "ihr", "ihre", "es", "sein", "seine", "man", "he", "him", "his", "she", "her", "they", "them", "their", "it")
# Pronouns at which a narrator speaks, in English and German.
NARRATION = (
    "i", "me", "my", "mine", "myself", "we", "us", "our", "ours",
    "ich", "mich", "mir", "mein", "meine", "meinen", "meinem", "meiner", "meines", "wir", "uns", "unser", "unsere", "unserem", "unseren", "unserer",
)
# Words of descriptions that speak against a macro type.
PLACE_WORDS = ("city", "town", "village", "country", "municipality", "capital", "river", "mountain", "region", "province", "district", "commune")
ORG_WORDS = ("party", "organization", "company", "band", "club", "association")
PERSON_WORDS = ("politician", "writer", "painter", "actor", "general", "officer", "philosopher", "composer", "poet", "physician", "soldier", "born", "–19", "–18", "human")
REJECTED = {"PERSON": (*PLACE_WORDS, "film", "album", "song", "genus", "species"), "ORG": (*PLACE_WORDS, *PERSON_WORDS), "LOCATION": (*ORG_WORDS, *PERSON_WORDS)}
AGREEMENT = 0.15


def _name_like(part: Column) -> Column:
    tokens = F.split(part, r"\s+")
    capital = F.forall(tokens, lambda t: F.substring(t, 1, 1).rlike(r"^\p{Lu}"))
    return (F.size(tokens) <= 3) & capital & ~F.lower(F.element_at(tokens, -1)).isin(*NO_PERSON)


def repair_spans(mentions: DataFrame) -> DataFrame:
    """mentions (text, label, start, end, ...) without function words at their ends; a PERSON of two names joined
    by a conjunction becomes two.  Offsets follow; a lone function word stays; other columns are kept."""
    words = "|".join(FUNCTION_WORDS)
    led = F.regexp_replace("text", rf"^(?i)(?:(?:{words})\s+)+(?=\S)", "")
    cut = mentions.withColumns({"_led": led, "_kept": F.regexp_replace(led, rf"(?i)(?<=\S)(?:\s+(?:{words}))+$", "")})
    cut = cut.withColumns({"_parts": F.split("_kept", CONJUNCTION), "_at": F.col("start") + F.length("text") - F.length("_led")})
    pair = (F.col("label") == "PERSON") & (F.size("_parts") == 2) & F.forall("_parts", _name_like)
    split = cut.withColumn("_part", F.explode(F.when(pair, F.col("_parts")).otherwise(F.array("_kept")))).filter("_part <> ''")
    begin = F.when(F.col("_part") == F.col("_kept"), F.col("_at")).otherwise(F.col("start") + F.expr("instr(text, _part)") - 1)
    split = split.withColumn("start", begin.cast(dict(mentions.dtypes)["start"]))
    made = split.withColumns({"end": (F.col("start") + F.length("_part")).cast(dict(mentions.dtypes)["end"]), "text": F.col("_part")})
    return made.select(*mentions.columns)


def merge_mentions(mentions: DataFrame, by: str = "doc_id") -> DataFrame:
    """One mention for each run of overlapping mentions of one label, in order of (start, end, ord).

    mentions: ``by``, text, label, start, end, confidence, sources (array), ord.  The most confident stands for the
    run, then the widest, then one of "gliner", then the first; sources unite, and "gliner" and "spacy" together add
    0.15 to its confidence (1 at most).  Another label between two mentions ends a run.
    """
    order = Window.partitionBy(by).orderBy("start", "end", "ord")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    other = F.when(F.col("label") == F.lag("label").over(order), 0).otherwise(1)
    runs = mentions.withColumn("_other", other).withColumn("_run", F.sum("_other").over(upto))
    within = Window.partitionBy(by, "_run").orderBy("start", "end", "ord").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end").over(within)
    groups = runs.withColumn("_new", F.when(reach.isNull() | (F.col("start") >= reach), 1).otherwise(0)).withColumn("_group", F.sum("_new").over(upto))
    flag = F.array_contains("sources", "gliner").cast("int")
    rank = F.struct(F.round("confidence", 3), F.col("end") - F.col("start"), flag, -F.col("start"), -F.col("end"), -F.col("ord"))
    best = groups.groupBy(by, "_group").agg(
        F.max_by(F.struct("text", "label", "start", "end", "confidence"), rank).alias("_m"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources"),
        F.count(F.lit(1)).alias("n_merged"),
    )
    both = F.array_contains("sources", "gliner") & F.array_contains("sources", "spacy")
    shown = F.when(both, F.least(F.lit(1.0), F.col("_m.confidence") + AGREEMENT)).otherwise(F.col("_m.confidence"))
    return best.select(by, "_m.text", "_m.label", "_m.start", "_m.end", shown.alias("confidence"), "sources", "n_merged")


def narrator_mentions(chunks: DataFrame, words: tuple[str, ...] = NARRATION, most: int = 40) -> DataFrame:
    """(chunk_id, text, label, start, end, confidence, surface): the narrator at the first ``most`` first-person
    pronouns of each chunk (chunk_id, text, start_char, narrator); chunks without a narrator give none."""
    pattern = r"(?U)(?i)\b(?:" + "|".join(sorted(words, key=len, reverse=True)) + r")\b"
    found = chunks.filter("narrator <> ''").withColumns({"_hit": F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), "_gap": F.split("text", pattern, most + 1)})
    # The i-th pronoun starts after i + 1 stretches of other text and i pronouns.
    lengths = F.slice(F.transform(F.arrays_zip("_gap", "_hit"), lambda z: F.struct(F.length(z["_gap"]).alias("g"), F.length(z["_hit"]).alias("h"), z["_hit"].alias("s"))), 1, most)
    seen = found.select("chunk_id", "narrator", "start_char", F.posexplode(lengths).alias("_i", "_z")).filter("_z.s IS NOT NULL")
    before = Window.partitionBy("chunk_id").orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("start_char") + F.sum(F.col("_z.g") + F.col("_z.h")).over(before) - F.col("_z.h")
    placed = seen.withColumn("start", start)
    return placed.select("chunk_id", F.col("narrator").alias("text"), F.lit("PERSON").alias("label"), "start", (F.col("start") + F.col("_z.h")).alias("end"), F.lit(0.5).alias("confidence"), F.col("_z.s").alias("surface"))


def cluster_mentions(spans: DataFrame, mentions: DataFrame, by: str = "chunk_id") -> DataFrame:
    """(by, text, label, start, end, confidence, resolved_from): pronouns of coreference clusters under the name
    that the cluster overlaps first.

    spans: by, cluster, i, start, end, surface; mentions: by, text, label, start, end, ord.  Chunks are short, so an
    overlap is sought within a chunk.  Clusters without a named mention give nothing."""
    named = mentions.select(by, F.col("start").alias("_s"), F.col("end").alias("_e"), "text", "label", "ord")
    touching = spans.join(named, by).filter((F.col("_s") < F.col("end")) & (F.col("start") < F.col("_e")))
    identity = touching.groupBy(by, "cluster").agg(F.min_by(F.struct("text", "label"), F.struct("i", "ord")).alias("_who"))
    said = F.lower(F.trim("surface"))
    pronouns = spans.filter(said.isin(*NARRATION, *THIRD_PERSON, "hers") & ~said.isin("es", "man", "it"))
    return pronouns.join(identity, [by, "cluster"]).select(by, "_who.text", "_who.label", "start", "end", F.lit(0.45).alias("confidence"), said.alias("resolved_from"))


def name_endpoints(relations: DataFrame, author: Column) -> DataFrame:
    """relations (source, target, ...) whose first-person ends are the author; a third-person end can't be named, so
    its relation goes, as do self loops (case and outer spaces apart)."""
    key = lambda c: F.lower(F.trim(c))
    kept = relations.filter(~key(F.col("source")).isin(*THIRD_PERSON) & ~key(F.col("target")).isin(*THIRD_PERSON))
    named = kept.withColumns({c: F.when(key(F.col(c)).isin(*FIRST_PERSON), author).otherwise(F.col(c)) for c in ("source", "target")})
    return named.filter(key(F.col("source")) != key(F.col("target")))


def type_rejected(label: Column, description: Column) -> Column:
    """Whether a description's words belong to another macro type than ``label``."""
    text, out = F.lower(F.coalesce(description, F.lit(""))), F.lit(False)
    for name, words in REJECTED.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(text, F.lit(w))
        out = F.when(label == name, hit).otherwise(out)
    return out


def representative_surface(surfaces: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, name, label): the most frequent surface, the longer at a tie; the most frequent label."""
    named = surfaces.groupBy(cluster, "surface").agg(F.count(F.lit(1)).alias("n")).groupBy(cluster).agg(F.max_by("surface", F.struct("n", F.length("surface"), "surface")).alias("name"))
    typed = surfaces.groupBy(cluster, "label").agg(F.count(F.lit(1)).alias("n")).groupBy(cluster).agg(F.max_by("label", F.struct("n", "label")).alias("label"))
    return named.join(typed, cluster)


def recalled_edges(found: DataFrame, names: DataFrame, existing: DataFrame) -> DataFrame:
    """found (source, target, rel_type) of a second pass whose ends are both known (names: name) and that the first
    pass (existing: source, target, rel_type) lacks; each once."""
    known = names.select(F.lower("name").alias("_k")).distinct()
    lower = lambda df: df.withColumns({"_s": F.lower("source"), "_t": F.lower("target"), "_r": F.lower("rel_type")})
    ends = lower(found).dropDuplicates(["_s", "_t", "_r"]).filter("_s <> _t")
    for end in ("_s", "_t"):
        ends = ends.join(known.withColumnRenamed("_k", end), end, "left_semi")
    return ends.join(lower(existing).select("_s", "_t", "_r"), ["_s", "_t", "_r"], "left_anti").select(*found.columns)


def text_windows(docs: DataFrame, width: int = 2000, overlap: int = 200) -> DataFrame:
    """(doc_id, start, text): windows of ``width`` characters that share ``overlap`` with the next; a text that fits is
    one window (empty for null)."""
    whole = F.coalesce("text", F.lit(""))
    starts = F.when(F.length(whole) <= width, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.length(whole) - 1, F.lit(max(1, width - overlap))))
    placed = docs.select("doc_id", whole.alias("_t"), F.explode(starts).alias("start"))
    return placed.select("doc_id", "start", F.substring("_t", F.col("start") + 1, F.lit(width)).alias("text"))


def uncovered(docs: DataFrame, replies: DataFrame) -> DataFrame:
    """(doc_id) of documents that no reply covers."""
    return docs.select("doc_id").join(replies.select("doc_id"), "doc_id", "left_anti")
