"""SimHash near-dedup: fingerprints embedded as segment popcounts, joined on a grid, verified exactly.

A 64-bit fingerprint becomes 32 coordinates, the number of set bits in each 2-bit segment.  The Manhattan
distance of two such vectors never exceeds the Hamming distance of the fingerprints, so fingerprints at most
k bits apart have vectors at most k apart, and these differ in k coordinates at most.  With the coordinates
dealt into k + 3 blocks, some 3 blocks agree: the grid has a cell for each choice of 3 blocks and each value
of their coordinates, and every pair within k meets in one of the cells.  Inside a cell pairs first pass the
Manhattan bound, then the exact distance.

Only distinct fingerprints are joined; a cell emits at most one link a fingerprint (a spanning forest of its
links), never all pairs.  Components are found by alternating large-star and small-star steps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import Rolling, lower_bytes, mix, stash, text_blocks, trim, unstash, word_spans, words_of

_EVEN = 0x5555555555555555


def fingerprint(text: str | None, width: int = 3, seed: int = 42, bits: int = 64) -> int:
    """The unsigned fingerprint of one whole text (see op10): no words give 0; a bit is set when it is set in
    over half of the shingles' XXH64.  ``bits`` = 128 adds a second half from seed + 1."""
    words = words_of(text)
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        line = b" ".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        start = (end - size)[: len(words) - width + 1].tolist()
        shingles = [line[a:b] for a, b in zip(start, end[width - 1 :].tolist(), strict=True)]
    result = 0
    for half in range(bits // 64):
        hashed = np.fromiter((xxhash.xxh64_intdigest(s, seed + half) for s in shingles), np.uint64, len(shingles))
        count = np.zeros(64, np.int64)
        for at in range(0, len(hashed), 16384):
            piece = hashed[at : at + 16384]
            count += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
        result |= int(np.packbits(2 * count > len(hashed), bitorder="little").view("<u8")[0]) << (64 * half)
    return result


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): the signed 64-bit view of each text's fingerprint; null texts count as empty."""
    schema = "fp long"
    kind = docs.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.dataType.simpleString()}, {schema}")


def _popcounts(fp: Column) -> Column:
    """The 32 popcounts, each written in unary in its segment (0: 00, 1: 01, 2: 11)."""
    even = F.lit(_EVEN)
    low, high = fp.bitwiseAND(even), F.shiftrightunsigned(fp, 1).bitwiseAND(even)
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _unary(x: np.ndarray) -> np.ndarray:
    """Segments with their bits sorted: the Hamming distance of these is the Manhattan distance of popcounts."""
    even = np.uint64(_EVEN)
    high = (x >> np.uint64(1)) & even
    return ((x & even) | high) | ((x & high) << np.uint64(1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Every node and the smallest node it is linked to, from links between indices below n."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all() and (root[a] == root[b]).all():
            break
    child = np.flatnonzero(root != np.arange(n))
    return child, root[child]


def cell_links(cell: np.ndarray, fp: np.ndarray, distance: int, wide: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among fingerprints of equal cell, both sorted by cell.  A cell of over ``wide``
    fingerprints is not compared pairwise: for a distance of 2 at most, fingerprints are linked when the balls
    of one flipped bit around them meet, which is the same relation."""
    cut = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
    size = np.diff(cut)
    left, right = [], []
    small = np.repeat((size <= wide) | (distance > 2), size)
    bound = int(size[(size <= wide) | (distance > 2)].max(initial=1))
    unary = _unary(fp)
    for gap in range(1, bound):
        near = np.flatnonzero((cell[gap:] == cell[:-gap]) & small[gap:])
        if not len(near):
            break
        near = near[np.bitwise_count(unary[near] ^ unary[near + gap]) <= distance]
        near = near[np.bitwise_count(fp[near] ^ fp[near + gap]) <= distance]
        left.append(near)
        right.append(near + gap)
    for k in np.flatnonzero((size > wide) & (distance <= 2)):
        span = np.arange(cut[k], cut[k + 1])
        own = fp[span]
        flips = [np.uint64(1 << i) for i in range(64)] if distance == 2 else []
        keys = np.concatenate([own, *(own ^ f for f in flips)])
        who = np.tile(span, len(flips) + 1)
        if distance == 1:
            keys, who = np.concatenate([own & ~np.uint64(1 << i) for i in range(64)]), np.tile(span, 64)
            keys = keys ^ np.repeat(np.arange(64, dtype=np.uint64) * np.uint64(_EVEN), len(span))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        a, b = who[order][1:][same], who[order][:-1][same]
        good = np.bitwise_count(fp[a] ^ fp[b]) <= distance
        left.append(a[good])
        right.append(b[good])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _forest(np.concatenate(left), np.concatenate(right), len(fp))


def links(distinct: DataFrame, distance: int = 2, spare: int = 3) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` whose components are those of all pairs at most
    ``distance`` apart.  ``spare``: the blocks of coordinates that must agree in a cell."""
    blocks = distance + spare
    masks = [sum(3 << (2 * i) for i in range(32) if i % blocks == g) for g in range(blocks)]
    popped = distinct.select("fp", _popcounts(F.col("fp")).alias("_p"))
    cells = F.array(*[F.xxhash64(F.lit(n), F.col("_p").bitwiseAND(F.lit(_signed(sum(masks[g] for g in c))))) for n, c in enumerate(combinations(range(blocks), spare))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def found(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            child, parent = cell_links(cell, fp, distance)
            return pa.RecordBatch.from_arrays([pa.array(fp[child].view(np.int64)), pa.array(fp[parent].view(np.int64))], ["a", "b"])

        for batch in batches:
            cell, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            waiting.append((cell, fp))
            if not len(cell) or cell[-1] == waiting[0][0][:1]:  # still the one cell
                continue
            cell, fp = (np.concatenate(c) for c in zip(*waiting, strict=True))
            whole = int(np.searchsorted(cell, cell[-1]))
            yield found(cell[:whole], fp[:whole])
            waiting = [(cell[whole:], fp[whole:])]
        if waiting:
            yield found(*(np.concatenate(c) for c in zip(*waiting, strict=True)))

    spread = popped.select(F.explode(cells).alias("_cell"), "fp").repartition("_cell").sortWithinPartitions("_cell", "fp")
    return spread.mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text).

    Documents whose fingerprints differ in at most ``distance`` bits are linked; component_id is the smallest
    doc_id that links reach.  Null and empty texts have fingerprint 0 and are linked like any other; repeated
    rows keep their rows; an empty table gives an empty result; further columns are ignored.  Rows with a null
    doc_id are grouped like others (component_id null only where a whole group has no id).
    """
    marked = stash(fingerprints(docs, width))
    least = stash(marked.groupBy("fp").agg(F.min("doc_id").alias("_least")))
    rooted = connected_components(links(least.select("fp"), distance))
    named = least.join(rooted.withColumnRenamed("node", "fp"), "fp", "left").withColumn("_root", F.coalesce("root", "fp"))
    ids = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    lookup = named.join(ids, "_root").select("fp", "component_id")
    return marked.join(lookup, "fp").select("doc_id", "fp", "component_id")


def shingle_sets(data: np.ndarray, ends: np.ndarray, width: int) -> list[np.ndarray]:
    """Hashes of each text's distinct ``width``-word shingles (of all its words, if fewer), sorted."""
    start, stop = word_spans(data)
    cut = np.searchsorted(start, np.concatenate([[0], ends]))
    word = Rolling(lower_bytes(data)).spans(start, stop)
    with np.errstate(over="ignore"):
        line = np.zeros(len(word), np.uint64)
        for i in range(width):
            upto = max(len(word) - i, 0)
            line[:upto] = mix(line[:upto] + word[i:])
    sets = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b - a >= width:
            sets.append(np.unique(line[a : b - width + 1]))
        else:
            sets.append(mix(np.array([zlib.crc32(word[a:b].tobytes()) + (b - a << 32)], np.uint64)) if b > a else np.zeros(0, np.uint64))
    return sets


#: Texts (one of so many, by hash) whose shingles are counted for the order by rarity; a shingle is common from
#: that many of them; the most common ones that tasks get to know.  They bear on speed only.
RARITY_SHARE, COMMON, COMMON_MOST = 16, 4, 250_000


BITS = ("bits0", "bits1", "bits2", "bits3")
#: Partners that a text is compared with in a round, and rounds, before all pairs; they bear on speed only.
GUESSES, ROUNDS = 4, 1


def prefixes(sets: list[np.ndarray], similarity: float, common: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of each set, and the set's number: sets of at least this Jaccard similarity share one.

    A set of n shares ceil(similarity * n) shingles or more with any such set, so two sets that share none of
    their first n - ceil(similarity * n) + 1 in one common order cannot be that similar.  The order is (weight in
    the sorted ``common``, 0 elsewhere; hash); any order is right, rare first is fast."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), size)
    rank = np.zeros(len(flat), np.int64)
    if len(common) and len(flat):
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        rank = np.where(common[at] == flat, weight[at], 0)
    order = np.lexsort((flat, rank, owner))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    some = order[place < prefix_length(size, similarity)[owner]]
    return flat[some], owner[some]


def prefix_length(size: np.ndarray, similarity: float) -> np.ndarray:
    return size - np.ceil(similarity * size - 1e-6).astype(np.int64) + 1


def parity_bits(own: np.ndarray) -> np.ndarray:
    """256 bits of a set, as four numbers: bit i is set if the set has an odd number of hashes that end in i.  Two sets
    differ in at least as many members as these bits differ."""
    odd = np.bincount((own & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _set_key(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63)


def _shared_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, size, node), sorted, without repeats and without cells of one node; with each the first and
    the previous node of its cell."""
    names = ["cell", "size", "node", "head", "head_size", "prev", "prev_size"]
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3

    def found(cell: np.ndarray, size: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]) | (node[1:] != node[:-1])
        cell, size, node = cell[new], size[new], node[new]
        cut = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        count = np.diff(np.concatenate([cut, [len(cell)]]))
        head = np.repeat(cut, count)
        keep = np.flatnonzero(np.repeat(count, count) > 1)
        head, prev = head[keep], np.maximum(keep - 1, head[keep])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (cell[keep], size[keep], node[keep], node[head], size[head], node[prev], size[prev])], names)

    waiting: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        some = [batch.column(i).to_numpy() for i in range(3)]
        waiting.append(some)
        if some[0][0] == some[0][-1] == waiting[0][0][0]:  # still the one cell
            continue
        held = [np.concatenate(c) for c in zip(*waiting, strict=True)]
        whole = int(np.searchsorted(held[0], held[0][-1]))
        yield found(*(c[:whole] for c in held))
        waiting = [[c[whole:] for c in held]]
    if waiting:
        yield found(*(np.concatenate(c) for c in zip(*waiting, strict=True)))


def fingerprint_pairs(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b), a < b: each node of ``rows`` (row_key, node) with the head of every component that simhash_groups puts
    one of its texts (``keyed``: row_key, text) in; the head is the component's row of the smallest row_key."""
    found = simhash_groups(keyed.select(F.col("row_key").alias("doc_id"), "text"))
    nodes = rows.select("row_key", "node").distinct()
    heads = nodes.select(F.col("row_key").alias("component_id"), F.col("node").alias("head"))
    placed = found.select(F.col("doc_id").alias("row_key"), "component_id").join(nodes, "row_key").select("node", "component_id").distinct()
    met = placed.join(heads, "component_id").filter("node <> head")
    return met.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


def near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(row_key, group, stays) for each distinct (doc_id, text) of docs: groups of near copies.

    Texts are linked if the Jaccard similarity of their sets of ``width``-word shingles is at least ``similarity``;
    the groups are the components of all such links.  simhash_groups goes first: each text is compared with the
    head of the component of its fingerprint.  Fingerprints of similar texts may lie further apart than it links, so
    the rest is found exactly: candidates share a cell, one of the rarest shingles that the similarity forces them to
    share (see prefixes).  Each text is compared with the first and the previous one of its cells, then with random
    members of their largest groups; at last, in every cell, all pairs that these links have not joined yet
    and whose lengths and shared cells allow the similarity.  Each is computed exactly.  Of a group the row of the
    smallest doc_id stays (null last).  Null texts count as empty and as copies of one another.
    row_key: xxhash64(doc_id, text).
    """
    spark = docs.sparkSession
    keyed = docs.select("doc_id", row_key().alias("row_key"), F.coalesce("text", F.lit("")).alias("text"))

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, data, ends in text_blocks(batch.column(2), 1 << 20):
                own = shingle_sets(data, ends, width)
                node = np.array([_set_key(s) for s in own], np.int64)
                bits = np.array([parity_bits(s) for s in own], np.int64).reshape(-1, 4).T.copy()
                shown = [s if k % RARITY_SHARE == 0 else s[:0] for s, k in zip(own, node.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, n) for i in range(2)), pa.array(node), _lists(shown), *(pa.array(c) for c in bits)], ["doc_id", "row_key", "node", "sample", *BITS])
        trim()

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = stash(keyed.mapInArrow(marks, f"doc_id {kind}, row_key long, node long, sample array<long>, " + ", ".join(f"{b} long" for b in BITS)))
    sampled = rows.filter(F.size("sample") > 0).groupBy("node").agg(F.first("sample").alias("sample"))
    counted = sampled.select(F.explode("sample").alias("shingle")).groupBy("shingle").count().filter(F.col("count") >= COMMON)
    top = counted.orderBy(F.desc("count"), "shingle").limit(COMMON_MOST).toPandas()
    common, weight = top["shingle"].to_numpy(np.int64).view(np.uint64), top["count"].to_numpy(np.int64)
    order = np.argsort(common)
    known = spark.sparkContext.broadcast((common[order], weight[order]))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # texts of one set need their cells once a task
        for batch in batches:
            for _, _, data, ends in text_blocks(batch.column(0), 1 << 20):
                sets, nodes = [], []
                for own in shingle_sets(data, ends, width):
                    node = _set_key(own)
                    if node not in seen:
                        seen.add(node)
                        sets.append(own)
                        nodes.append(node)
                cell, owner = prefixes(sets, similarity, *known.value)
                size = np.fromiter(map(len, sets), np.int64, len(sets))
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(size[owner].astype(np.int64)), pa.array(np.array(nodes, np.int64)[owner])], ["cell", "size", "node"])

    cells = keyed.select("text").mapInArrow(spread, "cell long, size long, node long").repartition("cell").sortWithinPartitions("cell", "size", "node")
    cells = stash(cells.mapInArrow(_shared_cells, "cell long, size long, node long, head long, head_size long, prev long, prev_size long"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, data, ends in text_blocks(batch.column(1), 1 << 20):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), _lists(shingle_sets(data, ends, width))], ["node", "shingles"])

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are similar."""
        wanted = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")
        from_row = rows.join(wanted, "node").groupBy("node").agg(F.min("row_key").alias("row_key"))
        shown = keyed.select("row_key", "text").join(from_row, "row_key").select("node", "text").mapInArrow(sets, "node long, shingles array<long>")
        shown = stash(shown.dropDuplicates(["node"]))
        joined = pairs.join(shown.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(shown.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        both = F.size(F.array_intersect("x", "y"))
        made = stash(joined.filter(both >= F.lit(similarity) * (F.size("x") + F.size("y") - both)).select("a", "b"))
        unstash(shown)
        return made

    # A spanning guess, so that the copies of one text are not compared all with all.
    guess = cells.select(F.col("head").alias("a"), F.col("node").alias("b"), F.col("head_size").alias("low"), F.col("size").alias("high"))
    guess = guess.union(cells.select("prev", "node", "prev_size", "size")).filter("a <> b").filter(F.col("low") >= F.lit(similarity) * F.col("high") - 1e-6)
    guess = guess.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.first("high").alias("high")).filter("n * 20 >= high")
    # The few partners that share most cells: what they leave apart, the pass over all pairs below joins.
    closest = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("n"), "a"))
    guess = guess.withColumn("place", closest).filter(F.col("place") <= GUESSES).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    guess = stash(fingerprint_pairs(keyed, rows).union(guess).distinct())
    first = linked(guess)
    roots = stash(connected_components(first))

    # Rounds of one partner a cell: members of other components meet a random one of the cell's largest, so a group of
    # texts that are near each other grows together before all pairs that are still apart are looked at.
    tried = guess
    for turn in range(ROUNDS):
        rooted = cells.select("cell", "size", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        pick = F.max_by(F.struct("node", "size"), F.xxhash64(F.lit(turn), "node"))
        sides = rooted.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("count"), pick.alias("pick"))
        major = sides.groupBy("cell").agg(F.max_by(F.struct("root", "pick"), F.struct("count", "root")).alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        met = rooted.join(major, "cell").filter("root <> top.root").select("node", "size", F.col("top.pick.node").alias("other"), F.col("top.pick.size").alias("far"))
        met = met.filter(F.least("size", "far") >= F.lit(similarity) * F.greatest("size", "far") - 1e-6).groupBy("node", "other").count()
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("count"), "other"))
        met = met.withColumn("place", place).filter(F.col("place") <= GUESSES).select(F.greatest("node", "other").alias("b"), F.least("node", "other").alias("a"))
        new = stash(met.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
        found = linked(new)
        if not found.limit(1).count():
            break
        tried, first = tried.union(new), first.union(found)
        roots = stash(connected_components(first))
    guess = tried

    # All pairs of a cell that are not joined yet: those within the cell's most frequent group need no row.
    rooted = cells.select("cell", "size", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    major = rooted.groupBy("cell", "root").count().groupBy("cell").agg(F.max_by("root", F.struct("count", "root")).alias("major"), F.count(F.lit(1)).alias("n"))
    bits = rows.dropDuplicates(["node"]).select("node", *BITS)
    rooted = rooted.join(major.filter("n > 1").select("cell", "major"), "cell").withColumn("major", F.col("root") == F.col("major"))
    rooted = stash(rooted.join(bits, "node"))
    x = rooted.filter("NOT major").select("cell", F.col("node").alias("x"), F.col("root").alias("rx"), F.col("size").alias("nx"), *[F.col(b).alias(f"x{b}") for b in BITS])
    y = rooted.select("cell", F.col("node").alias("y"), F.col("root").alias("ry"), F.col("size").alias("ny"), "major", *BITS)
    # Sets this similar differ in (1 - s) / (1 + s) of their sizes' sum at most, and so do their parity bits.
    apart = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"x{b}"))) for b in BITS), F.lit(0))
    low, high = F.least("nx", "ny"), F.greatest("nx", "ny")
    met = x.join(y, "cell").filter("rx <> ry AND (major OR x < y)").filter((low >= F.lit(similarity) * high - 1e-6) & (apart <= F.lit((1 - similarity) / (1 + similarity)) * (low + high) + 1e-6))
    met = met.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.first(low).alias("low"), F.first(high).alias("high"))
    # What two sets share is at most their common cells and one set's shingles outside its cells: the set whose
    # last cell comes first has all its shared cells in the other's.  The longer one has more outside.
    needed = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("low") + F.col("high")) - 1e-6)
    outside = F.ceil(F.lit(similarity) * F.col("high") - 1e-6) - 1
    rest = stash(met.filter(F.col("n") + outside >= needed).select("a", "b").join(guess, ["a", "b"], "left_anti"))
    roots = stash(connected_components(first.union(linked(rest))))
    grouped = stash(rows.join(roots, "node", "left").select("doc_id", "row_key", F.coalesce("root", "node").alias("group")))
    least = grouped.groupBy("group").agg(F.min_by("row_key", _order()).alias("_stays"))
    for done in (rows, cells, rooted, guess, first, rest):
        unstash(done)
    return grouped.join(least, "group").select("row_key", "group", (F.col("row_key") == F.col("_stays")).alias("stays")).distinct()


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    offsets = pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)))


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """docs without the near copies: one row of each group stays (see near_copies), all columns as they are.

    Of rows that repeat both doc_id and text one stays as well.
    """
    names = docs.columns
    decided = stash(near_copies(docs, **options))
    rows = docs.select(*names, row_key().alias("_row_key"))
    kept = rows.join(decided.filter("stays").select(F.col("row_key").alias("_row_key")), "_row_key", "left_semi")
    return kept.dropDuplicates(["_row_key"]).select(*names)


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
