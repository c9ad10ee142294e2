"""The tables that a run gives out: nodes, edges, timeline, transitions, ranked reports, and the counts of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import clean_surface, numeric_alias, stable_id
from ..sources import sinks
from .network import degrees

#: Edge flags that a run may set; a table without one shows false.
FLAGS = ("reciprocal", "suspect_membership", "evidence_unverified", "type_violation", "evidence_ungrounded", "functional_conflict")
#: Edge measures that only some layers set.
MEASURES = ("cooccur_strength", "disparity_alpha", "affiliation_strength", "shared_groups")
#: Tie classes of the subnetworks that an export writes besides the whole.
VIEWS = {
    "interaction": ("interaction",),
    "affiliation": ("affiliation", "participation"),
    "biography": ("biographical", "stance"),
}


def _column(df: DataFrame, name: str, otherwise: Column) -> Column:
    return F.coalesce(F.col(name), otherwise) if name in df.columns else otherwise


def union_layers(layers: list[DataFrame]) -> DataFrame:
    """Edge layers of differing columns as one table; what a layer lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)


def degree_tags(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """entities with ``degree``: edges whose two ends are both entities, counted at either end; 0 without any."""
    ids = entities.select("entity_id").distinct()
    side = lambda c: ids.withColumnRenamed("entity_id", c)
    valid = edges.select("source", "target").join(side("source"), "source", "left_semi").join(side("target"), "target", "left_semi")
    ends = valid.select(F.explode(F.array("source", "target")).alias("entity_id"))
    counted = ends.groupBy("entity_id").agg(F.count(F.lit(1)).alias("_d"))
    return entities.drop("degree").join(counted, "entity_id", "left").withColumn("degree", F.coalesce("_d", F.lit(0))).drop("_d")


def node_table(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """The node table: one row an entity, its degree by tie class, its first and last year, and any ``tag_`` or
    ``attr_`` columns it has.  edges: source, target, tie_class, year."""
    extra = [c for c in entities.columns if c.startswith(("tag_", "attr_"))]
    shown = F.array_join(F.transform("aliases", clean_surface), "; ")
    base = entities.select(
        F.col("entity_id").alias("Id"), clean_surface(F.col("canonical_name")).alias("Label"), F.col("label").alias("type"), "mention_count",
        F.size("doc_ids").alias("doc_count"), shown.alias("aliases"), F.col("confidence"), *extra,
    )
    measured = degrees(edges).withColumnRenamed("id", "Id")
    counts = [f"deg_{c}" for c in rules.CLASSES]
    out = base.join(measured, "Id", "left").fillna(0, counts)
    return out.select("Id", "Label", "type", "mention_count", "doc_count", "aliases", "first_year", "last_year", *counts, "confidence", *extra)


def edge_table(edges: DataFrame, entities: DataFrame, qualifiers: tuple[str, ...] = ()) -> DataFrame:
    """The edge table of aggregated edges (source, target, rel_type, directed, weight, n_mentions, n_sources, year,
    origin, edge_source, confidence, evidence, period, letter_id): classes by both ends' labels, names, the flags and
    measures there are, and a column ``qual_<q>`` for each qualifier, empty where an edge has none."""
    who = entities.select("entity_id", F.col("label").alias("_l"), clean_surface(F.col("canonical_name")).alias("_n"))
    side = lambda c: who.select(F.col("entity_id").alias(c), F.col("_l").alias(f"_{c}_l"), F.col("_n").alias(f"_{c}_n"))
    both = edges.join(side("source"), "source", "left").join(side("target"), "target", "left")
    rel = F.col("rel_type")
    label = lambda c: F.coalesce(F.col(f"_{c}_l"), F.lit(""))
    empty, nothing = F.lit(""), F.lit(None).cast("double")
    return both.select(
        stable_id(F.col("source"), F.col("target"), rel, prefix="edge_").alias("Id"), F.col("source").alias("Source"), F.col("target").alias("Target"),
        F.when(_column(both, "directed", F.lit(True)), "Directed").otherwise("Undirected").alias("Type"), rel.alias("Label"), "rel_type",
        rules.tie_class(rel, label("source"), label("target")).alias("tie_class"), rules.connection_type(rel, label("target")).alias("connection_type"),
        rules.polarity(rel).alias("polarity"), F.col("weight").alias("Weight"), "n_mentions", _column(both, "n_sources", F.col("weight")).alias("n_sources"),
        *[_column(both, m, nothing).alias(m) for m in MEASURES], *[_column(both, f, F.lit(False)).alias(f) for f in FLAGS],
        _column(both, "verification", empty).alias("verification"), _column(both, "period", empty).alias("period"), "year", "origin", "edge_source",
        F.round("confidence", 3).alias("confidence"), F.coalesce("_source_n", F.col("source")).alias("source_name"), F.coalesce("_target_n", F.col("target")).alias("target_name"),
        _column(both, "letter_id", empty).alias("letter_id"), F.substring(F.coalesce("evidence", empty), 1, 500).alias("evidence"),
        *[_column(both, f"qual_{q}", empty).alias(f"qual_{q}") for q in qualifiers],
    )


def reciprocal(edges: DataFrame) -> DataFrame:
    """edges with ``reciprocal``: directed, and the same relation also goes the other way."""
    back = edges.filter("directed AND source <> target").select(F.col("target").alias("source"), F.col("source").alias("target"), "rel_type", F.lit(True).alias("_back")).distinct()
    found = edges.join(back, ["source", "target", "rel_type"], "left")
    return found.withColumn("reciprocal", F.col("directed") & F.coalesce("_back", F.lit(False))).drop("_back")


def timeline_table(events: DataFrame) -> DataFrame:
    """The timeline in order: by date, those without one last, then by document.

    events: doc_id, letter_id, date_text, iso_date, year, description, entities (array), confidence."""
    made = events.select(
        "doc_id", "letter_id", "date_text", F.coalesce("iso_date", F.lit("")).alias("iso_date"), "year", F.substring("description", 1, 500).alias("description"),
        F.array_join("entities", "; ").alias("entities"), F.round("confidence", 3).alias("confidence"),
    )
    return made.orderBy(F.coalesce(F.nullif(F.col("iso_date"), F.lit("")), F.lit("9999")), "doc_id", "date_text")


def ranked(df: DataFrame, by: str, *ties: str) -> DataFrame:
    """Rows by falling ``by``, ties in order: transitions by weight, violations by number."""
    return df.orderBy(F.col(by).desc(), *ties)


def violations_by_relation(edges: DataFrame) -> DataFrame:
    """(rel_type, n) of edges with type_violation, most first."""
    return ranked(edges.filter("type_violation").groupBy("rel_type").agg(F.count(F.lit(1)).alias("n")), "n", "rel_type")


def linking_candidates(entities: DataFrame, labels: tuple[str, ...] = ("PERSON", "ORG", "LOCATION"), least: int = 2, most: int = 400) -> DataFrame:
    """The ``most`` entities of most mentions that are worth an outside lookup; ties by id."""
    return ranked(entities.filter(F.col("label").isin(*labels) & (F.col("mention_count") >= least)), "mention_count", "entity_id").limit(most)


def proposal_names(entities: DataFrame, most: int = 300) -> DataFrame:
    """(label, entity_id, canonical_name, place): the ``most`` names of each label to propose merges among, by falling
    mentions; numbers and dates aren't asked about, labels of one name neither."""
    named = entities.filter(~numeric_alias(F.col("canonical_name")))
    by = Window.partitionBy("label")
    placed = named.withColumns({"place": F.row_number().over(by.orderBy(F.col("mention_count").desc(), "entity_id")), "_n": F.count(F.lit(1)).over(by)})
    return placed.filter((F.col("place") <= most) & (F.col("_n") > 1)).select("label", "entity_id", "canonical_name", "place")


def samples(df: DataFrame, by: str, *order: str, most: int = 50) -> DataFrame:
    """The first ``most`` rows of each ``by``, as reports show them."""
    return df.withColumn("_p", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("_p") <= most).drop("_p")


def run_summary(entities: DataFrame, edges: DataFrame, timeline: DataFrame) -> DataFrame:
    """(entities, edges, timeline, core): the counts that close a run, from one pass over each table."""
    people = entities.agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.col("relevance_tier") == "core").alias("core"))
    return people.crossJoin(edges.agg(F.count(F.lit(1)).alias("edges"))).crossJoin(timeline.agg(F.count(F.lit(1)).alias("timeline")))  # one row each


def write_run(folder: str, nodes: DataFrame, edges: DataFrame, timeline: DataFrame, documents: DataFrame, formats: tuple[str, ...] = ("csv", "parquet"), settings: str | None = None) -> list[str]:
    """Every table in every format, the subnetworks of ``VIEWS`` and the run's settings (a JSON text); the paths
    written."""
    wrong = set(formats) - set(sinks.FORMATS)
    if wrong:
        raise ValueError(f"unknown formats: {', '.join(sorted(wrong))}")
    tables = {"nodes": nodes, "edges": edges, "timeline": timeline, "documents": documents}
    for name, classes in VIEWS.items():
        some = edges.filter(F.col("tie_class").isin(*classes))
        ends = some.select(F.explode(F.array("Source", "Target")).alias("Id")).distinct()
        tables |= {f"edges_{name}": some, f"nodes_{name}": nodes.join(ends, "Id", "left_semi")}
    written = []
    for name, made in tables.items():
        for format in formats:
            written.append(f"{folder}/{name}.{format}")
            sinks.write_table(made, written[-1], format)
    if settings is not None:
        written.append(f"{folder}/settings")
        nodes.sparkSession.createDataFrame([(settings,)], "value string").coalesce(1).write.mode("overwrite").text(written[-1])
    return written
