"""Sharding by histogram sort, in DataFrame functions alone.

Rows are ordered by the hash of their text, then by a hash of their id, so equal texts stand together.
Each round counts exact bytes between candidate boundaries over all partitions and then refines only the
intervals in which a shard's ideal end falls, until every splitter is within tolerance.  The rows are
exchanged once, for their numbering.  What the driver sees is bounded by shards and probes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

BITS = 64
STEP = 10
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _prefix(column: str, bits: int) -> Column:
    """The first ``bits`` bits; the arithmetic shift keeps the order of signed numbers."""
    return F.lit(0).cast("long") if bits == 0 else F.shiftright(F.col(column), BITS - bits)


def _nearest(goal: float, at: float, cell: dict, slack: float, last: bool) -> int | None:
    """0 or 1: the cell's lower or upper edge serves as the boundary; None: look further inside."""
    low, high = goal - at, at + cell["b"] - goal
    return int(high < low) if last or cell["n"] == 1 or min(low, high) <= slack else None


def _round(rows: DataFrame, keys: list[Column]) -> dict[tuple, dict]:
    """Exact bytes and rows of each probed interval; its number is bounded by open intervals * 2**STEP."""
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    found = rows.groupBy(*named).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"), F.min("_group").alias("lo"), F.max("_group").alias("hi")).collect()
    return {tuple(r[: len(keys)]): {"b": r["b"], "n": r["n"], "lo": r["lo"], "hi": r["hi"]} for r in sorted(found, key=lambda r: r[: len(keys)])}


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """The first (text hash, id hash) of every shard but the first.  rows: _group, _id, size.

    A group of equal texts is cut only where keeping it whole would put a boundary off by more than
    ``tolerance`` times a shard's share; then the boundary is refined on the id hash inside that group.
    """
    total = rows.agg(F.sum("size").alias("s")).first()["s"] or 0
    if not total:
        return []
    goals = {s: total * s / shards for s in range(1, shards)}
    slack = tolerance * total / shards
    found: dict[int, tuple[int, int]] = {}
    single: dict[int, tuple[float, list[int]]] = {}  # by group: bytes before it, goals inside it
    open_: dict[int, tuple[float, list[int]]] = {0: (0.0, list(goals))}
    bits = 0
    while open_:
        old, bits = bits, min(BITS, bits + STEP)
        part = rows.filter(_prefix("_group", old).isin(list(open_))) if old else rows
        following: dict[int, tuple[float, list[int]]] = {}
        left = {parent: [at, list(wanted)] for parent, (at, wanted) in open_.items()}
        for (parent, p), cell in _round(part, [_prefix("_group", old), _prefix("_group", bits)]).items():
            at, wanted = left[parent]
            for s in [s for s in wanted if goals[s] < at + cell["b"]]:
                wanted.remove(s)
                edge = _nearest(goals[s], at, cell, slack, False)
                if edge is not None:
                    found[s] = ((p + edge) << (BITS - bits), LOWEST)
                elif cell["lo"] == cell["hi"]:
                    single.setdefault(cell["lo"], (at, []))[1].append(s)
                else:
                    following.setdefault(p, (at, []))[1].append(s)
            left[parent][0] = at + cell["b"]
        open_ = following
    bits, inner = 0, {(g, 0): x for g, x in single.items()}
    while inner:
        old, bits = bits, min(BITS, bits + STEP)
        part = rows.filter(F.col("_group").isin([g for g, _ in inner]))
        if old:
            part = part.filter(_prefix("_id", old).isin([p for _, p in inner]))
        left = {k: [at, list(wanted)] for k, (at, wanted) in inner.items()}
        following = {}
        for (group, parent, p), cell in _round(part, [F.col("_group"), _prefix("_id", old), _prefix("_id", bits)]).items():
            if (group, parent) not in left:
                continue
            at, wanted = left[group, parent]
            for s in [s for s in wanted if goals[s] < at + cell["b"]]:
                wanted.remove(s)
                edge = _nearest(goals[s], at, cell, slack, bits == BITS)
                if edge is None:
                    following.setdefault((group, p), (at, []))[1].append(s)
                else:
                    found[s] = (group, (p + edge) << (BITS - bits))
            left[group, parent][0] = at + cell["b"]
        inner = following
    return [found[s] for s in sorted(found)]


def _shard(bounds: list[tuple[int, int]]) -> Column:
    """The number of splitters at or below a row; a splitter beyond 63 bits lies above every row."""
    number = F.lit(0)
    for group, key in bounds:
        if group <= HIGHEST:
            at = F.col("_group") > group
            if key <= HIGHEST:
                at = at | ((F.col("_group") == group) & (F.col("_id") >= key))
            number = number + at.cast("int")
    return number


def shard_rows(docs: DataFrame, shards: int = 40, tolerance: float = 0.01, overhead: int = 16, cells: int = 1024) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs`` (doc_id, text); law: equal bytes.

    size: the text's UTF-8 bytes plus ``overhead`` (null: the overhead; its CRC is that of no bytes, 0).
    slot numbers a shard's rows from 0 without gaps: rows are counted per shard and cell of the id hash, the
    counts are summed up (at most shards * cells of them), and only within a cell are rows numbered.
    Repeated rows and ties each get a slot of their own; an empty table gives an empty result.
    """
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = stash(
        docs.select(
            "doc_id",
            (F.octet_length(raw).cast("long") + overhead).alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.xxhash64(raw).alias("_group"),
            F.xxhash64(F.col("doc_id"), F.lit(3)).alias("_id"),
        )
    )
    placed = rows.withColumn("shard", _shard(splitters(rows, shards, tolerance))).withColumn("_cell", F.pmod(F.col("_id"), F.lit(cells)).cast("int"))
    counts = placed.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    within = Window.partitionBy("shard", "_cell").orderBy("_group", "_id", "doc_id")
    numbered = placed.withColumn("_row", F.row_number().over(within) - 1)
    joined = numbered.join(F.broadcast(offsets), ["shard", "_cell"])  # shards * cells rows at most
    return joined.select("doc_id", "size", "text_crc32", "shard", (F.col("_from") + F.col("_row")).alias("slot"))


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    rows = shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
