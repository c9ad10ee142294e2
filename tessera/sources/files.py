"""Readers: files of several formats, snapshots, sheets, prior networks, gold, checkpoints; and gathering them."""

from __future__ import annotations

import html
import io
import re
import warnings
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from importlib.util import find_spec
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import cut_reference_tail, normalize_text, stable_id

DOCUMENT = "doc_id string, source_path string, text string, meta string"
BINARY = (".png", ".jpg", ".jpeg", ".gif", ".zip", ".exe", ".mp3", ".mp4", ".gz")


class _Text(HTMLParser):
    """Visible text; the parts that never are content are left out."""

    SKIPPED = {"script", "style", "noscript", "header", "footer", "nav", "form"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.SKIPPED

    def handle_endtag(self, tag):
        self.depth -= tag in self.SKIPPED and self.depth > 0

    def handle_data(self, data):
        if not self.depth and data.strip():
            self.parts.append(data.strip())


def html_to_text(raw: str) -> str:
    parser = _Text()
    parser.feed(raw)
    parser.close()
    return "\n".join(parser.parts)


def docx_to_text(raw: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        tree = ElementTree.fromstring(z.read("word/document.xml"))
    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    return "\n".join("".join(t.text or "" for t in p.iter(f"{space}t")) for p in tree.iter(f"{space}p"))


def rtf_to_text(raw: str) -> str:
    text = re.sub(r"\{\\(?:fonttbl|colortbl|stylesheet|info|\*)[^{}]*(?:\{[^{}]*\}[^{}]*)*\}", "", raw)
    text = re.sub(r"\\'([0-9a-fA-F]{2})", lambda m: bytes([int(m[1], 16)]).decode("cp1252", "replace"), text)
    text = re.sub(r"\\u(-?\d+)\??", lambda m: chr(int(m[1]) % 65536), text)
    text = re.sub(r"\\(?:par|line)\b ?", "\n", text)
    text = re.sub(r"\\tab\b ?", "\t", text)
    text = re.sub(r"\\[a-zA-Z]+-?\d* ?", "", text)
    return re.sub(r"[{}]", "", text).strip()


def epub_to_text(raw: bytes) -> str:
    skipped = re.compile(r"(nav|toc|cover|copyright|title)", re.I)
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = sorted(n for n in z.namelist() if n.lower().endswith((".xhtml", ".html", ".htm")) and not skipped.search(n.rpartition("/")[2]))
        return "\n\n".join(html_to_text(z.read(n).decode("utf-8", "replace")) for n in names)


def decode(raw: bytes) -> str:
    """UTF-8, by mark UTF-16, else Windows-1252."""
    if raw[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return raw.decode("utf-16", "replace")
    try:
        return raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return raw.decode("cp1252", "replace")


def extract(raw: bytes, suffix: str) -> str | None:
    """The text of one file by its suffix; what can't be read gives null and is left out."""
    try:
        if suffix in (".html", ".htm", ".xhtml"):
            return html_to_text(decode(raw))
        if suffix == ".docx":
            return docx_to_text(raw)
        if suffix == ".rtf":
            return rtf_to_text(decode(raw))
        if suffix == ".epub":
            return epub_to_text(raw)
        if suffix == ".pdf":
            import fitz  # optional

            with fitz.open(stream=raw, filetype="pdf") as pdf:
                return "\n".join(page.get_text() for page in pdf)
        return html.unescape(decode(raw)) if suffix == ".xml" else decode(raw)
    except (ImportError, KeyError, ValueError, zipfile.BadZipFile, ElementTree.ParseError):
        return None


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Documents of all files under ``path``; unreadable and empty ones are left out, PDFs with a warning where no
    library for them is installed."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    suffix = F.lower(F.regexp_extract("path", r"(\.[A-Za-z0-9]+)$", 1))
    raw = raw.select("path", suffix.alias("suffix"), "content").filter(~F.col("suffix").isin(*BINARY))
    if find_spec("fitz") is None:
        warnings.warn("PDF files are left out: fitz is not installed", stacklevel=2)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame({"path": part["path"], "suffix": part["suffix"], "text": [extract(c, s) for c, s in zip(part["content"], part["suffix"], strict=True)]})

    read = raw.mapInPandas(run, "path string, suffix string, text string").filter("trim(text) <> ''")
    text = normalize_text(cut_reference_tail(F.col("text")))
    meta = F.to_json(F.struct(F.regexp_extract("path", "([^/]+)$", 1).alias("filename"), "suffix", F.length("text").alias("n_chars")))
    return read.select(stable_id(F.col("path"), prefix="doc_"), F.col("path"), text, meta).toDF("doc_id", "source_path", "text", "meta")


def literal(spark: SparkSession, text: str, name: str = "text") -> DataFrame:
    """A string as a document."""
    row = spark.createDataFrame([(name, text)], "source_path string, text string")
    return row.select(stable_id(F.col("source_path"), F.substring("text", 1, 200), prefix="txt_").alias("doc_id"), "source_path", "text", F.lit("{}").alias("meta"))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Documents from JSON lines; lines that aren't JSON are left out."""
    return spark.read.schema(DOCUMENT).option("mode", "DROPMALFORMED").json(path)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(value) of a list file: blank lines and # comments left out."""
    return spark.read.text(path).select(F.trim("value").alias("value")).filter("value <> '' AND NOT startswith(value, '#')")


def gather(sources: list[DataFrame], limit: int | None = None) -> DataFrame:
    """All sources, the first of each doc_id: the earlier source, then the smaller path."""
    ranked = [s.withColumn("_s", F.lit(i)) for i, s in enumerate(sources)]
    both = ranked[0]
    for more in ranked[1:]:
        both = both.unionByName(more, allowMissingColumns=True)
    first = Window.partitionBy("doc_id").orderBy("_s", "source_path")
    found = both.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")
    return (found.orderBy("_s", "doc_id").limit(limit) if limit else found).drop("_s")


def best_records(records: DataFrame, key: str = "doc_id", score: str = "score", order: str = "ord") -> DataFrame:
    """The best record of each key: lowest failure score, the last among equals."""
    by = Window.partitionBy(key).orderBy(F.col(score).asc(), F.col(order).desc())
    return records.withColumn("_r", F.row_number().over(by)).filter("_r = 1").drop("_r")


def failure_score(n_chunks: Column, failed: Column) -> Column:
    """0: whole, 1: partly failed, 2: nothing worked or nothing was counted."""
    return F.when(n_chunks.isNull() | (failed >= n_chunks), 2).when(failed > 0, 1).otherwise(0)


def read_network_schema(spark: SparkSession, entities: str, edges: str) -> tuple[DataFrame, DataFrame]:
    """(relations, kinds) of a prior network: JSON entities and a CSV of edges; co-occurrence doesn't count."""
    relations = spark.read.option("header", True).csv(edges).select(F.lower("rel_type").alias("rel_type")).distinct().filter("rel_type <> 'co_occurs_with'")
    return relations, spark.read.option("multiLine", True).json(entities).select(F.upper("label").alias("kind")).distinct()


def read_gold(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entities, relations) of gold documents; types upper, relations lower case."""
    docs = spark.read.option("multiLine", True).json(path)
    docs = docs.select(F.explode("documents").alias("d")).select("d.*") if "documents" in docs.columns else docs
    entity = docs.select("doc_id", F.explode("entities").alias("e")).select("doc_id", "e.name", F.upper("e.type").alias("type"), "e.aliases")
    relation = docs.select("doc_id", F.explode("relations").alias("r")).select("doc_id", "r.source", "r.target", F.lower("r.type").alias("type"))
    return entity, relation


def curated_edges(records: DataFrame, names: DataFrame | None = None, categories: tuple[int, ...] = (), min_amount: float = 0.0, induced: bool = False) -> DataFrame:
    """Curated relations (entity1, entity2, category_id, amount) of given names, categories and amounts: either end
    among the names (one hop), or both."""
    out = records.filter(F.col("category_id").isin(*categories)) if categories else records
    out = out.filter(F.coalesce("amount", F.lit(0.0)) >= min_amount) if min_amount else out
    if names is None:
        return out
    keys = names.select(F.lower(F.trim("name")).alias("k")).distinct()
    one = lambda c: out.join(keys, F.lower(F.trim(c)) == F.col("k"), "left_semi")
    if induced:
        return one("entity1").join(keys, F.lower(F.trim("entity2")) == F.col("k"), "left_semi")
    return one("entity1").union(one("entity2")).distinct()
