"""Writers: tables, tie-class views, GEXF, codebook and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("csv", "parquet", "json")


def write_table(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite") -> None:
    """Arrays and maps become text where the format has none."""
    if format not in FORMATS:
        raise ValueError(f"format has to be one of {', '.join(FORMATS)}")
    if format == "csv":
        plain = [F.array_join(F.col(n).cast("array<string>"), "; ").alias(n) if t.startswith("array") else F.to_json(n).alias(n) if t.startswith(("map", "struct")) else F.col(n) for n, t in df.dtypes]
        df.select(*plain).write.mode(mode).option("header", True).csv(path)
    else:
        getattr(df.write.mode(mode), format)(path)


def write_snapshot(docs: DataFrame, path: str, existing: int = 0) -> bool:
    """JSON lines; refuses to replace a snapshot of over 20 documents that is twice as large as the new one."""
    if existing > max(20, 2 * docs.count()):
        return False
    docs.write.mode("overwrite").json(path)
    return True


def view(nodes: DataFrame, edges: DataFrame, classes: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The subnetwork of some tie classes: its edges and the nodes they touch."""
    some = edges.filter(F.col("tie_class").isin(*classes))
    ends = some.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    return nodes.join(ends, "id", "left_semi"), some


def collapse(edges: DataFrame) -> DataFrame:
    """One edge a pair for formats without parallel edges: weights add up, relations and sources unite."""
    union = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split(c, ";"))))), ";")
    return edges.groupBy("source", "target").agg(
        F.sum("weight").alias("weight"), union("rel_type").alias("rel_type"), union("tie_class").alias("tie_class"), F.max("confidence").alias("confidence"), F.min("year").alias("year")
    )


def gexf_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(section, ord, line): the node and edge elements of a GEXF file, made on the executors."""
    attribute = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.replace(F.replace(F.col(c).cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;")), F.lit('"'))
    node = nodes.select(F.lit(0).alias("section"), F.col("id").cast("string").alias("ord"), F.concat(F.lit("<node id="), attribute("id"), F.lit(" label="), attribute("label"), F.lit("/>")).alias("line"))
    key = F.concat_ws("|", "source", "target")
    edge = collapse(edges).select(
        F.lit(1).alias("section"), key.alias("ord"),
        F.concat(F.lit("<edge source="), attribute("source"), F.lit(" target="), attribute("target"), F.lit(" label="), attribute("rel_type"), F.lit(' weight="'), F.col("weight").cast("string"), F.lit('"/>')).alias("line"),
    )
    return node.unionByName(edge)


def write_gexf(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """A GEXF file on the driver, streamed a partition at a time."""
    lines = gexf_lines(nodes, edges).orderBy("section", "ord").select("section", "line")
    with open(path, "w", encoding="utf-8") as out:
        out.write('<?xml version="1.0" encoding="UTF-8"?>\n<gexf version="1.3"><graph defaultedgetype="directed">\n<nodes>\n')
        section = 0
        for row in lines.toLocalIterator():
            if row["section"] != section:
                out.write("</nodes>\n<edges>\n")
                section = row["section"]
            out.write(row["line"] + "\n")
        out.write("</nodes>\n<edges>\n</edges>\n</graph></gexf>\n" if section == 0 else "</edges>\n</graph></gexf>\n")


def codebook(nodes: DataFrame, edges: DataFrame) -> dict[str, DataFrame]:
    """Summary tables: type counts, tie-class counts, relations with an example, sources."""
    return {
        "types": nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n")),
        "tie_classes": edges.groupBy("tie_class").agg(F.count(F.lit(1)).alias("n")),
        "relations": edges.groupBy("rel_type").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("evidence") != "", F.col("evidence"))).alias("example")),
        "sources": edges.select(F.explode(F.split("edge_source", ";")).alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("n")),
    }


