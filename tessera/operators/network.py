"""Networks from affiliations, co-occurrence and proximity, and their measures; all joins are equi-joins."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import CLASSES, NON_PROJECTING
from ..storage import parts_for, stash, stash_in
from .components import connected_components


def _pairs(members: DataFrame, group: str, member: str, weight: str, block: int = 1000) -> DataFrame:
    """(group, a, b, weight) for a < b within each group; members: also _k, at least the group's size.

    A group of more than ``block`` members is dealt to blocks that meet pairwise, so no task holds a hot group."""
    blocks = F.ceil(F.col("_k") / block)
    mine = F.pmod(F.xxhash64(member), blocks)
    every = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    left = members.select(group, F.col(member).alias("a"), weight, mine.alias("_i"), every.alias("_j"))
    right = members.select(group, F.col(member).alias("b"), mine.alias("_j"), every.alias("_i"))
    # A broadcast would leave the pairs to as many tasks as there are files.
    return left.join(right.hint("merge"), [group, "_i", "_j"]).filter("a < b").drop("_i", "_j")


def cooccurrence(mentions: DataFrame, doc: str = "doc_id", entity: str = "entity_id", min_shared: int = 2) -> DataFrame:
    """(a, b, shared_docs, strength, confidence): entities that share at least ``min_shared`` documents.

    A document of k entities adds 1 / (k - 1) to each of its pairs (k counts all of them).  Only entities in
    ``min_shared`` documents can be in a pair, so the others go before the self-join, which they would square.
    Each step has as many partitions as its rows need, the self-join as its pairs need: what it reads is far smaller.
    """
    spark = mentions.sparkSession
    named = mentions.select(doc, entity).filter(F.col(doc).isNotNull() & F.col(entity).isNotNull())
    parts = parts_for(spark, named.count())
    seen = stash_in(named.distinct(), parts)
    sized = seen.join(seen.groupBy(doc).agg(F.count(F.lit(1)).alias("_k")), doc).filter("_k > 1")
    if min_shared > 1:
        often = seen.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_shared).select(entity)
        sized = sized.join(often, entity, "left_semi")
    sized = stash_in(sized.withColumn("_w", 1.0 / (F.col("_k") - 1)), parts)
    met = sized.groupBy(doc).agg(F.count(F.lit(1)).alias("_c")).agg(F.sum(F.expr("_c * (_c - 1) div 2"))).first()[0]
    made = _pairs(sized, doc, entity, "_w").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared_docs"), F.sum("_w").alias("strength"))
    made = stash_in(made.filter(F.col("shared_docs") >= min_shared), parts_for(spark, met))
    return made.withColumn("confidence", F.least(F.lit(1.0), 0.3 + 0.1 * F.col("shared_docs")))


def affiliation_projection(edges: DataFrame, actors: tuple[str, ...] = ("PERSON",), groups: tuple[str, ...] = ("ORG", "INSTITUTION", "EVENT"), min_shared: int = 1) -> DataFrame:
    """(a, b, shared_groups, strength, confidence): actors tied through groups that they belong to or took part in.

    edges: source, target, rel_type, tie_class, source_label, target_label."""
    ties = edges.filter(F.col("tie_class").isin("affiliation", "participation") & ~F.lower("rel_type").isin(*NON_PROJECTING))
    forward = F.col("target_label").isin(*groups) & F.col("source_label").isin(*actors)
    backward = F.col("source_label").isin(*groups) & F.col("target_label").isin(*actors)
    member = ties.filter(forward | backward).select(
        F.when(forward, F.col("target")).otherwise(F.col("source")).alias("g"), F.when(forward, F.col("source")).otherwise(F.col("target")).alias("m")
    )
    return project(member.filter("g <> m"), "g", "m", min_shared)


def project(members: DataFrame, group: str, member: str, min_shared: int = 1) -> DataFrame:
    """The one-mode projection of (group, member), with the size-discounted weight."""
    made = cooccurrence(members, group, member, min_shared).withColumnRenamed("shared_docs", "shared_groups")
    return made.withColumn("confidence", F.least(F.lit(1.0), 0.4 + 0.1 * F.col("shared_groups")))


def proximity(mentions: DataFrame, window: int, doc: str = "doc_id", entity: str = "entity_id", position: str = "pos", min_count: int = 1) -> DataFrame:
    """(a, b, n_docs, n_pairs, min_gap, confidence): different entities at most ``window`` apart in a document.

    A range join: positions fall into bins of the window's width and meet their own and the next bin."""
    if window <= 0:
        return proximity(mentions.limit(0), 1, doc, entity, position, min_count)
    spots = mentions.select(doc, entity, position).filter(F.col(position).isNotNull())
    bin_of = F.floor(F.col(position) / window)
    left = spots.select(F.col(doc).alias("d"), F.col(entity).alias("x"), F.col(position).alias("p"), F.explode(F.array(bin_of, bin_of + 1)).alias("bin"))
    right = spots.select(F.col(doc).alias("d"), F.col(entity).alias("y"), F.col(position).alias("q"), bin_of.alias("bin"))
    near = left.join(right, ["d", "bin"]).filter((F.col("q") - F.col("p")).between(0, window) & (F.col("x") != F.col("y")))
    near = near.filter((F.col("q") > F.col("p")) | (F.col("x") < F.col("y")))
    made = near.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(
        F.count_distinct("d").alias("n_docs"), F.count(F.lit(1)).alias("n_pairs"), F.min(F.col("q") - F.col("p")).alias("min_gap")
    )
    made = made.filter(F.col("n_pairs") >= max(1, min_count))
    return made.withColumn("confidence", F.least(F.lit(0.6), 0.3 + 0.05 * F.col("n_pairs")))


def scene_copresence(scenes: DataFrame, scene: str = "scene_id", who: str = "speaker", least: int = 2, most: int = 25) -> DataFrame:
    """(a, b, scene_weight, scene_count) of those together in scenes of ``least`` to ``most`` people."""
    seen = scenes.select(F.col(scene).alias("s"), F.col(who).alias("w")).distinct()
    sized = seen.join(seen.groupBy("s").agg(F.count(F.lit(1)).alias("_k")).filter(F.col("_k").between(least, most)), "s").withColumn("_w", 1.0 / (F.col("_k") - 1))
    return _pairs(sized, "s", "w", "_w").groupBy("a", "b").agg(F.sum("_w").alias("scene_weight"), F.count(F.lit(1)).alias("scene_count"))


def disparity(pairs: DataFrame, alpha: float = 0.0, weight: str = "strength") -> DataFrame:
    """pairs (a, b, weight) with disparity_alpha: how likely a tie as strong would be by chance, the smaller of
    both ends' (1 - w / s) ** (k - 1); an end of degree 1 gives 0.  alpha > 0 drops ties at or above it."""
    ends = pairs.select(F.col("a").alias("n"), weight).unionByName(pairs.select(F.col("b").alias("n"), weight))
    nodes = ends.groupBy("n").agg(F.sum(weight).alias("_s"), F.count(F.lit(1)).alias("_k"))
    side = lambda end: nodes.select(F.col("n").alias(end), F.col("_s").alias(f"_s{end}"), F.col("_k").alias(f"_k{end}"))
    chance = lambda end: F.when(F.col(f"_k{end}") <= 1, 0.0).otherwise(F.pow(F.greatest(F.lit(0.0), 1 - F.col(weight) / F.col(f"_s{end}")), F.col(f"_k{end}") - 1))
    scored = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("disparity_alpha", F.round(F.least(chance("a"), chance("b")), 5))
    scored = scored.drop("_sa", "_ka", "_sb", "_kb")
    return stash_in(scored.filter(F.col("disparity_alpha") < alpha) if alpha > 0 else scored, parts_for(pairs.sparkSession, pairs.count()))


def aggregate_edges(edges: DataFrame) -> DataFrame:
    """Parallel edges as one, by (source, target, rel_type), ends in order where the relation has no direction.

    edges: source, target, rel_type, directed, doc_id, origin, edge_source, confidence, evidence, year, ord.
    weight: documents; first: that of the smallest ord that has the value."""
    left = F.when(F.col("directed"), F.col("source")).otherwise(F.least("source", "target"))
    right = F.when(F.col("directed"), F.col("target")).otherwise(F.greatest("source", "target"))
    first = lambda c: F.min_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col("ord")))
    return (
        edges.withColumns({"_l": left, "_r": right})
        .groupBy(F.col("_l").alias("source"), F.col("_r").alias("target"), "rel_type")
        .agg(
            F.count(F.lit(1)).alias("n_mentions"),
            F.greatest(F.lit(1), F.count_distinct("doc_id")).alias("weight"),
            F.array_join(F.array_sort(F.collect_set("origin")), ";").alias("origin"),
            F.array_join(F.array_sort(F.collect_set("edge_source")), ";").alias("edge_source"),
            F.round(F.max("confidence"), 3).alias("confidence"),
            first("evidence").alias("evidence"),
            F.min_by("year", F.when(F.col("year").isNotNull(), F.col("ord"))).alias("year"),
        )
    )


def degrees(edges: DataFrame) -> DataFrame:
    """(id, deg_<class> for each tie class, first_year, last_year): both ends of every edge count."""
    ends = edges.select(F.col("source").alias("id"), "tie_class", "year").unionByName(edges.select(F.col("target").alias("id"), "tie_class", "year"))
    counts = [F.count(F.when(F.col("tie_class") == c, 1)).alias(f"deg_{c}") for c in CLASSES]
    return ends.groupBy("id").agg(*counts, F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def simple_graph(edges: DataFrame, weight: str = "weight", classes: tuple[str, ...] | None = None) -> DataFrame:
    """(a, b, weight): undirected, loops left out, weights summed, of the given tie classes."""
    some = edges.filter(F.col("tie_class").isin(*classes)) if classes else edges
    return some.filter("source <> target").groupBy(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")).agg(F.sum(weight).alias("weight"))


def _signed(edges: DataFrame) -> DataFrame:
    sign = F.when(F.col("polarity") == "positive", 1).when(F.col("polarity") == "negative", -1).otherwise(0)
    return edges.filter("source <> target").select(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b"), sign.alias("s"), "rel_type").filter("s <> 0")


def _upward(edges: DataFrame, weight: str) -> DataFrame:
    """(x, y, weight) of simple edges (a, b, weight), from the end of lower degree to the other, ties by id; x, y:
    structs of degree, id, total and largest weight.  No end has more than sqrt(2 * edges) edges going out."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("id"), weight).groupBy("id").agg(F.count(F.lit(1)).alias("d"), F.sum(weight).alias("t"), F.max(weight).alias("m"))
    side = lambda end, name: ends.select(F.col("id").alias(end), F.struct("d", "id", "t", "m").alias(name))
    both = edges.join(side("a", "_a"), "a").join(side("b", "_b"), "b")
    return both.select(F.least("_a", "_b").alias("x"), F.greatest("_a", "_b").alias("y"), weight)


def _triangles(upward: DataFrame, weight: str) -> DataFrame:
    """(u, v, w, uv, uw, vw): every triangle once, with its sides' weights."""
    one = upward.select(F.col("x.id").alias("_u"), F.col("x").alias("u"), F.col("y").alias("v"), F.col(weight).alias("uv"))
    two = upward.select(F.col("x.id").alias("_u"), F.col("y").alias("w"), F.col(weight).alias("uw"))
    wedges = one.join(two, "_u").filter("v < w").withColumns({"_v": F.col("v.id"), "_w": F.col("w.id")})
    closing = upward.select(F.col("x.id").alias("_v"), F.col("y.id").alias("_w"), F.col(weight).alias("vw"))
    return wedges.join(closing, ["_v", "_w"]).select("u", "v", "w", "uv", "uw", "vw")


def signed_balance(edges: DataFrame) -> DataFrame:
    """(balanced, unbalanced, balance_pct): triangles of net signs, each once."""
    net = stash(_signed(edges).groupBy("a", "b").agg(F.signum(F.sum("s")).alias("s")).filter("s <> 0"))
    product = _triangles(_upward(net, "s"), "s").select((F.col("uv") * F.col("uw") * F.col("vw")).alias("p"))
    found = product.agg(F.count(F.when(F.col("p") > 0, 1)).alias("balanced"), F.count(F.when(F.col("p") < 0, 1)).alias("unbalanced"))
    return found.withColumn("balance_pct", F.round(100.0 * F.col("balanced") / F.nullif(F.col("balanced") + F.col("unbalanced"), F.lit(0)), 1))


def polarity_conflicts(edges: DataFrame) -> DataFrame:
    """(a, b, positive, negative): dyads with relations of both signs, each side's relations sorted."""
    of = lambda s: F.array_join(F.array_sort(F.collect_set(F.when(F.col("s") == s, F.col("rel_type")))), ";")
    return _signed(edges).groupBy("a", "b").agg(of(1).alias("positive"), of(-1).alias("negative")).filter("positive <> '' AND negative <> ''")


def graph_quality(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(nodes, edges, components, isolates, largest_pct, density) of nodes (id) and simple edges (a, b)."""
    edges = stash(edges.select("a", "b"))
    roots = connected_components(edges)
    all_nodes = nodes.select("id").distinct().join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    sizes = all_nodes.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.agg(F.sum("n").alias("nodes"), F.count(F.lit(1)).alias("components"), F.max("n").alias("_most"))
    joined = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().agg(F.count(F.lit(1)).alias("_tied"))
    count = edges.agg(F.count(F.lit(1)).alias("edges"))
    n = F.col("nodes")
    return totals.crossJoin(joined).crossJoin(count).select(  # three single rows
        "nodes",
        "edges",
        "components",
        (n - F.col("_tied")).alias("isolates"),
        F.round(100.0 * F.col("_most") / n, 1).alias("largest_pct"),
        F.round(2.0 * F.col("edges") / F.nullif(n * (n - 1), F.lit(0)), 6).alias("density"),
    )


def quality_pillars(edges: DataFrame, asserted: tuple[str, ...]) -> DataFrame:
    """(asserted_pct, provenance_pct, dated_pct, violations): shares of edges, one row."""
    named = F.coalesce("edge_source", F.lit("")) != ""
    in_tier = F.arrays_overlap(F.split(F.coalesce("edge_source", F.lit("")), ";"), F.array(*[F.lit(a) for a in asserted]))
    share = lambda c: F.round(100.0 * F.count_if(c) / F.nullif(F.count(F.lit(1)), F.lit(0)), 1)
    return edges.agg(share(in_tier).alias("asserted_pct"), share(named).alias("provenance_pct"), share(F.col("year").isNotNull()).alias("dated_pct"), F.count_if("type_violation").alias("violations"))


def constraint(edges: DataFrame) -> DataFrame:
    """(id, constraint, effective_size): Burt's measures of a weighted simple graph (a, b, weight).

    p_ij is i's share of weight to j, m_jq j's weight to q over j's largest; constraint = sum over contacts j of
    (p_ij + sum over q of p_iq p_qj) ** 2, effective size = sum over j of 1 - sum over q of p_iq m_jq."""
    upward = stash(_upward(stash(edges.select("a", "b", "weight")), "weight"))
    found = _triangles(upward, "weight")
    sides = {("u", "v"): "uv", ("u", "w"): "uw", ("v", "w"): "vw"}
    side = lambda x, y: F.col(sides.get((x, y)) or sides[y, x])
    shares = []
    for i, j, q in permutations("uvw"):  # contact j of i, reached through their shared contact q
        to_q = side(i, q) / F.col(f"{i}.t")
        shares.append(F.struct(F.col(f"{i}.id").alias("i"), F.col(f"{j}.id").alias("j"), (to_q * side(q, j) / F.col(f"{q}.t")).alias("ind"), (to_q * side(j, q) / F.col(f"{j}.m")).alias("red")))
    indirect = found.select(F.inline(F.array(*shares))).groupBy("i", "j").agg(F.sum("ind").alias("ind"), F.sum("red").alias("red"))
    ends = [F.struct(F.col(f"{i}.id").alias("i"), F.col(f"{j}.id").alias("j"), (F.col("weight") / F.col(f"{i}.t")).alias("p")) for i, j in ("xy", "yx")]
    reached = upward.select(F.inline(F.array(*ends))).join(indirect, ["i", "j"], "left").fillna(0.0, ["ind", "red"])
    return reached.groupBy(F.col("i").alias("id")).agg(F.sum(F.pow(F.col("p") + F.col("ind"), 2)).alias("constraint"), (F.count(F.lit(1)) - F.sum("red")).alias("effective_size"))


def cut_points(edges: DataFrame) -> DataFrame:
    """(kind, a, b): bridges (kind 'bridge', ends in order) and articulation nodes (kind 'node', in a).

    Depth-first search by component; a component has to fit in a task's memory, as any exact cut search needs
    its whole graph: an edge costs about 200 bytes."""
    edges = stash(edges.select("a", "b"))
    roots = connected_components(edges)
    placed = edges.join(roots.withColumnRenamed("node", "a"), "a").select("root", "a", "b")
    kind = dict(edges.dtypes)["a"]

    def search(part: pd.DataFrame) -> pd.DataFrame:
        links: dict = {}
        for a, b in zip(part["a"].tolist(), part["b"].tolist(), strict=True):
            if a != b:
                links.setdefault(a, set()).add(b)
                links.setdefault(b, set()).add(a)
        found = [("bridge", min(a, b), max(a, b)) for a, b in _bridges(links)] + [("node", x, None) for x in _articulation(links)]
        return pd.DataFrame(found, columns=["kind", "a", "b"])

    return placed.groupBy("root").applyInPandas(search, f"kind string, a {kind}, b {kind}")


def _visit(links: dict) -> Iterator[tuple]:
    """(parent, node, low, order, root) of every tree edge, children first, without recursion."""
    order, low = {}, {}
    for root in sorted(links):
        if root in order:
            continue
        order[root] = low[root] = len(order)
        stack = [(root, None, iter(sorted(links[root])))]
        while stack:
            node, parent, rest = stack[-1]
            for other in rest:
                if other == parent:
                    continue
                if other in order:
                    low[node] = min(low[node], order[other])
                else:
                    order[other] = low[other] = len(order)
                    stack.append((other, node, iter(sorted(links[other]))))
                    break
            else:
                stack.pop()
                if parent is not None:
                    low[parent] = min(low[parent], low[node])
                    yield parent, node, low[node], order[parent], root


def _bridges(links: dict) -> list[tuple]:
    return [(p, n) for p, n, low, at, _ in _visit(links) if low > at]


def _articulation(links: dict) -> list:
    found, children = set(), {}
    for p, _, low, at, root in _visit(links):
        if p == root:
            children[p] = children.get(p, 0) + 1
        elif low >= at:
            found.add(p)
    return sorted(found | {r for r, n in children.items() if n > 1})


def first_by(column: Column, order: Column) -> Column:
    return F.min_by(column, order)


def nearest_rank(values: DataFrame, column: str, shares: tuple[float, ...] = (0.5, 0.85)) -> DataFrame:
    """One row: p50, p85, ... as the value at index round(p * (n - 1)), halves to even, in ascending order.

    Counts by value come first, so what is ordered is as small as the number of distinct values."""
    counts = values.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_upto", F.sum("c").over(upto)).withColumn("_n", F.sum("c").over(Window.partitionBy()))
    at = lambda p: F.min(F.when(F.col("_upto") > F.bround(F.lit(p) * (F.col("_n") - 1)), F.col("v")))
    return ranked.agg(*[at(p).alias(f"p{round(100 * p)}") for p in shares])
