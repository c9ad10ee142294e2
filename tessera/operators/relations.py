"""Relations by rule: known phrases in texts, and a verb between two mentions of a sentence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Verbs, the relation each stands for, and whether it has a direction.
VERBS = {
    "work": ("works_for", True), "employ": ("employs", True), "lead": ("leads", True), "head": ("leads", True), "found": ("founded", True),
    "establish": ("founded", True), "join": ("member_of", True), "belong": ("member_of", True), "own": ("owns", True), "acquire": ("acquired", True),
    "buy": ("acquired", True), "meet": ("met_with", False), "marry": ("married_to", False), "visit": ("visited", True), "attend": ("attended", True),
    "represent": ("represents", True), "support": ("supports", True), "fund": ("funded", True), "finance": ("funded", True), "appoint": ("appointed", True),
    "report": ("reports_to", True), "live": ("located_in", True), "locate": ("located_in", True),
}
_IRREGULAR = {"led": "lead", "leading": "lead", "bought": "buy", "met": "meet", "married": "marry", "marries": "marry"}
CONFIDENCE = 0.55
#: First words of phrases that a plan holds itself; more than these are left to the join.
_HEADS = 2000


def verb_forms() -> dict[str, str]:
    """Every form of the verbs and its base: endings by rule, irregular ones listed."""
    out = dict(_IRREGULAR)
    for verb in VERBS:
        stem = verb.removesuffix("e")
        past = stem + "ed"
        out |= {form: verb for form in (verb, verb + "s", past, stem + "ing")}
    return out


def verb_relations(mentions: DataFrame, sentences: DataFrame) -> DataFrame:
    """(doc_id, sent_index, source, target, rel_type, directed, evidence, confidence): two neighbouring mentions of a
    sentence with a known verb between them; each (source, relation, target) of a document once, its first sentence.

    mentions: doc_id, sent_index, start, end (in the sentence), text; sentences: doc_id, sent_index, sentence.  This is
    the rule that stands in where no parser is given: the first verb counts, the left mention is its subject."""
    forms = verb_forms()
    order = Window.partitionBy("doc_id", "sent_index").orderBy("start", "end")
    pairs = mentions.select("doc_id", "sent_index", F.col("text").alias("source"), F.col("start").alias("_s"), F.col("end").alias("_e"), F.lead("text").over(order).alias("target"), F.lead("start").over(order).alias("_n"))
    near = pairs.filter(F.col("_n") >= F.col("_e")).join(sentences, ["doc_id", "sent_index"])
    between = F.lower(F.substring("sentence", F.col("_e") + 1, F.col("_n") - F.col("_e")))
    form = F.regexp_extract(between, r"\b(" + "|".join(sorted(forms, key=len, reverse=True)) + r")\b", 1)
    table = F.create_map(*[x for f, verb in forms.items() for x in (F.lit(f), F.struct(F.lit(VERBS[verb][0]).alias("r"), F.lit(VERBS[verb][1]).alias("d")))])
    told = near.withColumn("_v", F.try_element_at(table, form)).filter(F.col("_v").isNotNull() & (F.lower(F.trim("source")) != F.lower(F.trim("target"))))
    made = told.select("doc_id", "sent_index", "_s", F.trim("source").alias("source"), F.trim("target").alias("target"), F.col("_v.r").alias("rel_type"), F.col("_v.d").alias("directed"), F.trim("sentence").alias("evidence"), F.lit(CONFIDENCE).alias("confidence"))
    first = Window.partitionBy("doc_id", F.lower("source"), "rel_type", F.lower("target")).orderBy("sent_index", "_s")
    return made.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r", "_s")


def gazetteer(docs: DataFrame, phrases: DataFrame, most_words: int = 6) -> DataFrame:
    """(doc_id, label, first, n_words, surface): phrases (phrase, label) of up to ``most_words`` words in documents (doc_id,
    text), case aside: by word position, the longest at a place, none that overlaps one before it.

    Every run of words is one key of an equi-join, so the list of phrases may be large; but only runs whose first word
    begins a phrase are keys at all, when the first words are few enough to go along with the plan."""
    known = phrases.select(F.lower(F.regexp_replace(F.trim("phrase"), r"\s+", " ")).alias("_k"), "label").groupBy("_k").agg(F.min("label").alias("label"))
    heads = [r[0] for r in known.select(F.split("_k", " ")[0]).distinct().limit(_HEADS + 1).collect()]
    words = docs.select("doc_id", F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+(?:['’.-][\p{L}\p{N}]+)*"), F.lit(0)).alias("_w"))
    # The words beside those that follow, by shifted arrays: a row holds a few words and never the whole text.
    shifted = F.arrays_zip(*[F.slice("_w", k + 1, F.size("_w")).alias(f"w{k}") for k in range(most_words)])
    placed = F.transform(shifted, lambda r, i: F.struct(i.alias("first"), r.alias("_r")))
    if len(heads) <= _HEADS:  # else every run is a key
        placed = F.filter(placed, lambda p: F.lower(p["_r"]["w0"]).isin(*heads))
    spots = words.filter(F.size("_w") > 0).select("doc_id", F.explode(placed).alias("_p")).select("doc_id", "_p.first", "_p._r")
    run = lambda n: F.struct(F.lit(n).alias("n"), F.when(F.col(f"_r.w{n - 1}").isNotNull(), F.concat_ws(" ", *[F.col(f"_r.w{k}") for k in range(n)])).alias("s"))
    runs = spots.select("doc_id", "first", F.explode(F.array(*[run(n) for n in range(1, most_words + 1)])).alias("_x")).filter("_x.s IS NOT NULL")
    hits = runs.select("doc_id", "first", F.col("_x.n").alias("n_words"), F.col("_x.s").alias("surface"), F.lower("_x.s").alias("_k")).join(known, "_k")
    longest = hits.groupBy("doc_id", "first").agg(F.max(F.struct("n_words", "label", "surface")).alias("h"))
    # In order of place, a hit counts if it starts where the last one that counted has ended.
    row = F.struct("first", "h.n_words", "h.label", "h.surface")
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("at"))
    step = lambda acc, x: F.when(x["first"] >= acc["end"], F.struct((x["first"] + x["n_words"]).alias("end"), F.array_append(acc["at"], x["first"]).alias("at"))).otherwise(acc)
    grouped = longest.groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("_h"))
    kept = grouped.select("doc_id", "_h", F.aggregate("_h", start, step, lambda acc: acc["at"]).alias("_at"))
    return kept.select("doc_id", F.explode(F.filter("_h", lambda x: F.array_contains(F.col("_at"), x["first"]))).alias("x")).select("doc_id", "x.label", "x.first", "x.n_words", "x.surface")
