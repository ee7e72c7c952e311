"""Leiden communities at a resolution, on tables of edges.

A level deals the nodes into blocks of bounded size along the graph's edges. In each block one task moves nodes to the
community that raises modularity most, and then refines: inside each community, nodes that start alone merge with
well-connected neighbours. All members of a community lie in one block, so what a move gains is known exactly there. Refined
communities are the nodes of the next, smaller graph, whose blocks lie elsewhere, and the graph that fits one block is taken
to its end, level by level, in one task. A node's weight counts all its edges, those that leave the block too, and a node
that has less than INSIDE of it in its block waits for another level.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellgrid.plans.store import cut, forget

#: Nodes of a block, about; a task holds them and the edges between them.
BLOCK = 50_000
#: Nodes for each seed of a region, and rounds in which regions grow.
REGION, GROWTH = 64, 3
#: Share of a node's weight that its block must hold; halved after a level that has not merged a tenth of the nodes.
INSIDE = 0.6
#: Gains under this are rounding.
LEAST = 1e-12

Adjacency = list[dict[int, float]]


def undirected(graph: DataFrame) -> DataFrame:
    """a, b, w: both directions of each edge (id, other and, if there is one, weight; the greater of two counts), without loops."""
    w = F.col("weight").cast("double") if "weight" in graph.columns else F.lit(1.0)
    one = graph.where("id <> other").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), w.alias("w"))
    one = one.groupBy("a", "b").agg(F.max("w").alias("w")).where("w > 0")
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))


def modularity(graph: DataFrame, clusters: DataFrame, resolution: float = 1.0) -> float:
    """Share of weight inside clusters (id, cluster), less resolution times what their weights alone would give."""
    edges = undirected(graph)
    named = edges.join(clusters.select(F.col("id").alias("a"), F.col("cluster").alias("ca")), "a").join(clusters.select(F.col("id").alias("b"), F.col("cluster").alias("cb")), "b")
    per = named.groupBy("ca").agg(F.sum("w").alias("k"), F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w"))).alias("inside"))
    row = per.agg(F.sum("inside").alias("inside"), F.sum("k").alias("all"), F.sum(F.col("k") * F.col("k")).alias("squares")).first()
    return float((row["inside"] or 0.0) / row["all"] - resolution * row["squares"] / row["all"] ** 2) if row["all"] else 0.0


def move(near: Adjacency, k: list[float], comm: list[int], rate: float, free: list[bool] | None = None) -> None:
    """Nodes (the free ones) in turn to the community of greatest gain, in place; neighbours of a node that moved have their turn again."""
    size: dict[int, float] = {}
    for i, c in enumerate(comm):
        size[c] = size.get(c, 0.0) + k[i]
    empty = max(comm, default=-1) + 1
    waiting = deque(i for i in range(len(near)) if free is None or free[i])
    queued = [True] * len(near) if free is None else [True if f else None for f in free]  # None: never
    while waiting:
        i = waiting.popleft()
        queued[i] = False
        to: dict[int, float] = {}
        for j, w in near[i].items():
            to[comm[j]] = to.get(comm[j], 0.0) + w
        own = comm[i]
        size[own] -= k[i]
        best, top = own, to.get(own, 0.0) - rate * k[i] * size[own]
        for c, w in to.items():
            gain = w - rate * k[i] * size[c]
            if gain > top + LEAST:
                best, top = c, gain
        if top < -LEAST:
            best, empty = empty, empty + 1
        size[best] = size.get(best, 0.0) + k[i]
        if best != own:
            comm[i] = best
            for j in near[i]:
                if comm[j] != best and queued[j] is False:
                    queued[j] = True
                    waiting.append(j)


def refine(near: Adjacency, k: list[float], comm: list[int], rate: float, free: list[bool] | None = None) -> list[int]:
    """Communities within `comm`: nodes (the free ones) that are alone join the well-connected neighbour community of greatest gain."""
    whole: dict[int, float] = {}
    for i, c in enumerate(comm):
        whole[c] = whole.get(c, 0.0) + k[i]
    inner = [sum(w for j, w in n.items() if comm[j] == comm[i]) for i, n in enumerate(near)]
    part, size, edge, alone = list(range(len(near))), list(k), list(inner), [True] * len(near)
    for i, n in enumerate(near):
        rest = whole[comm[i]]
        if not alone[i] or (free is not None and not free[i]) or inner[i] < rate * k[i] * (rest - k[i]):
            continue
        to: dict[int, float] = {}
        for j, w in n.items():
            if comm[j] == comm[i]:
                to[part[j]] = to.get(part[j], 0.0) + w
        best, top = i, 0.0
        for p, w in to.items():
            gain = w - rate * k[i] * size[p]
            if p != i and gain > top + LEAST and edge[p] >= rate * size[p] * (rest - size[p]):
                best, top = p, gain
        if best != i:
            part[i] = best
            size[best] += k[i]
            edge[best] += inner[i] - 2 * to[best]
            alone[i] = alone[best] = False
    return part


def merged(near: Adjacency, k: list[float], part: list[int]) -> tuple[Adjacency, list[float], list[int]]:
    """The graph of the parts, its weights, and each node's part as a number from 0."""
    number: dict[int, int] = {}
    at = [number.setdefault(p, len(number)) for p in part]
    out: Adjacency = [{} for _ in number]
    weight = [0.0] * len(number)
    for i, n in enumerate(near):
        weight[at[i]] += k[i]
        mine = out[at[i]]
        for j, w in n.items():
            if at[j] != at[i]:
                mine[at[j]] = mine.get(at[j], 0.0) + w
    return out, weight, at


def connected(near: Adjacency, comm: list[int]) -> list[int]:
    """comm with communities that are in several pieces split into these."""
    out = [-1] * len(near)
    for first in range(len(near)):
        if out[first] < 0:
            out[first], todo = first, [first]
            while todo:
                for j in near[todo.pop()]:
                    if out[j] < 0 and comm[j] == comm[first]:
                        out[j] = first
                        todo.append(j)
    return out


def communities(near: Adjacency, k: list[float], rate: float) -> list[int]:
    """All levels on one graph: moves, refinement and aggregation until communities are single nodes."""
    place, comm = list(range(len(near))), list(range(len(near)))
    while True:
        move(near, k, comm, rate)
        part = refine(near, k, comm, rate) if len(set(comm)) < len(near) else comm
        if len(set(part)) == len(near):
            comm = connected(near, comm)
            return [comm[p] for p in place]
        near, k, at = merged(near, k, part)
        first = {a: comm[i] for i, a in enumerate(at)}
        comm = [first[a] for a in range(len(near))]
        place = [at[p] for p in place]


def _in_block(rate: float, last: bool, inside: float):
    def run(nodes: pa.Table, edges: pa.Table) -> pa.Table:
        t = nodes.sort_by("id")
        ids = t.column("id").to_numpy()
        k = t.column("k").to_pylist()
        near: Adjacency = [{} for _ in k]
        a, b = (np.searchsorted(ids, edges.column(c).to_numpy()).tolist() for c in ("a", "b"))
        for i, j, w in sorted(zip(a, b, edges.column("w").to_pylist(), strict=True)):
            near[i][j] = w
        if last:
            found = communities(near, k, rate)
        else:
            comm, free = list(range(len(k))), [sum(n.values()) >= inside * x for n, x in zip(near, k, strict=True)]
            move(near, k, comm, rate, free)
            found = refine(near, k, comm, rate, free)
        return pa.table({"id": ids, "comm": ids[np.array(found, dtype=np.int64)] if len(ids) else ids})

    return run


def _dealt(nodes: DataFrame, edges: DataFrame, n: int, level: int) -> DataFrame:
    """nodes with block: regions grow from hashed seeds along the heaviest edges; a block is the regions, or pieces of them, of one hash."""
    blocks = -(-n // BLOCK)
    if blocks == 1:
        return nodes.withColumn("block", F.lit(0).cast("long"))
    own = cut(nodes.select("id", F.when(F.pmod(F.xxhash64("id", F.lit(level)), F.lit(REGION)) == 0, F.col("id")).alias("region")), "regions")
    for _ in range(GROWTH):
        offers = edges.join(own.where("region is not null").select(F.col("id").alias("b"), "region"), "b").groupBy(F.col("a").alias("id"), "region").agg(F.sum("w").alias("w"))
        best = offers.groupBy("id").agg(F.max(F.struct("w", "region"))["region"].alias("offer"))
        grown = cut(own.join(best, "id", "left").select("id", F.coalesce("region", "offer").alias("region")), "regions")
        forget(own)
        own = grown
    named = own.select("id", F.coalesce("region", "id").alias("region"))
    sizes = named.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK // 4)
    large = F.broadcast(sizes)  # at most 4 n / BLOCK rows
    piece = F.pmod(F.xxhash64("id", F.lit(-level)), F.ceil(F.coalesce("n", F.lit(1)) / (BLOCK // 4)))
    block = F.pmod(F.xxhash64("region", piece), F.lit(blocks))
    return nodes.join(named.join(large, "region", "left").select("id", block.alias("block")), "id")


def leiden(graph: DataFrame, resolution: float = 1.0) -> DataFrame:
    """id, cluster: Leiden communities of a graph (id, other and, if there is one, weight), numbered by falling size as text.

    ids are whole numbers. A greater resolution gives more and smaller clusters. Nodes without edges are not in the graph.
    The driver holds counts only. The result does not depend on how rows are dealt.
    """
    edges = cut(undirected(graph), "edges")
    nodes = cut(edges.groupBy(F.col("a").alias("id")).agg(F.sum("w").alias("k")), "nodes")
    member = cut(nodes.select(F.col("id").alias("node"), F.col("id").alias("at")), "members")
    n, total = nodes.agg(F.count(F.lit(1)), F.sum("k")).first()
    inside, level = INSIDE, 0
    while n:
        last = n <= BLOCK
        dealt = cut(_dealt(nodes, edges, n, level), "blocks")
        side = lambda c: dealt.select(F.col("id").alias(c), F.col("block").alias(f"{c}_in"))  # noqa: B023, E731
        inner = edges.join(side("a"), "a").join(side("b"), "b").where("a_in = b_in").select("a", "b", "w", F.col("a_in").alias("block"))
        found = cut(dealt.groupBy("block").cogroup(inner.groupBy("block")).applyInArrow(_in_block(resolution / total, last, inside), "id long, comm long"), "moves")
        to = lambda c: found.select(F.col("id").alias(c), F.col("comm").alias(f"{c}_to"))  # noqa: B023, E731
        new_member = cut(member.join(to("at"), "at").select("node", F.col("at_to").alias("at")), "members")
        forget(member, dealt)
        member = new_member
        if last:
            break
        smaller = edges.join(to("a"), "a").join(to("b"), "b").where("a_to <> b_to").groupBy(F.col("a_to").alias("a"), F.col("b_to").alias("b")).agg(F.sum("w").alias("w"))
        new_edges, new_nodes = cut(smaller, "edges"), cut(nodes.join(found, "id").groupBy(F.col("comm").alias("id")).agg(F.sum("k").alias("k")), "nodes")
        forget(edges, nodes, found)
        edges, nodes = new_edges, new_nodes
        before, n, level = n, nodes.count(), level + 1
        if n > 0.9 * before:
            inside = inside / 2 if inside > 0.05 else 0.0
        if n == before and not inside:
            break  # no merge raises modularity any more, though the graph does not fit one block
    sizes = member.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least"))
    named = sizes.select("at", (F.row_number().over(W.orderBy(F.desc("n"), "least")) - 1).cast("string").alias("cluster"))
    return member.join(named, "at").select(F.col("node").alias("id"), "cluster")
