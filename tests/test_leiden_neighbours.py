import random

import numpy as np
import pytest

from cellgrid.operators import learn, leiden, neighbours


def graph_of(spark, edges):
    return spark.createDataFrame(sorted(edges), "id long, other long")


def planted(rng, groups, inside, between):
    """Groups of groups: `inside` by how near two nodes' groups are, `between` for all others."""
    nodes = [(i, g) for i, g in enumerate(g for g, n in groups for _ in range(n))]
    edges = set()
    for i, a in nodes:
        for j, b in nodes[i + 1 :]:
            p = inside[0] if a == b else inside[1] if a[0] == b[0] else between
            if rng.random() < p:
                edges.add((i, j))
    return [g for _, g in nodes], edges


def plain_louvain(edges, resolution):
    """Nodes one by one, then communities as nodes, until nothing moves; modularity of the result."""
    w = {}
    for a, b in edges:
        w.setdefault(a, {})[b] = w.setdefault(b, {})[a] = 1.0
    first = {i: {j: 1.0 for j in n} for i, n in w.items()}
    member = {i: i for i in w}
    loops = dict.fromkeys(w, 0.0)
    total = sum(sum(n.values()) for n in w.values())
    while True:
        k = {i: sum(n.values()) + loops[i] for i, n in w.items()}
        comm, size, moved = {i: i for i in w}, dict(k), True
        while moved:
            moved = False
            for i in sorted(w):
                to = {}
                for j, x in w[i].items():
                    to[comm[j]] = to.get(comm[j], 0) + x
                size[comm[i]] -= k[i]
                best = max([comm[i], *sorted(to)], key=lambda c: to.get(c, 0) - resolution * k[i] * size.get(c, 0) / total + (1e-9 if c == comm[i] else 0))
                moved |= best != comm[i]
                comm[i] = best
                size[best] = size.get(best, 0) + k[i]
        member = {i: comm[c] for i, c in member.items()}
        if len(set(comm.values())) == len(w):
            break
        new, new_loops = {c: {} for c in set(comm.values())}, dict.fromkeys(set(comm.values()), 0.0)
        for i, n in w.items():
            new_loops[comm[i]] += loops[i]
            for j, x in n.items():
                if comm[i] == comm[j]:
                    new_loops[comm[i]] += x
                else:
                    new[comm[i]][comm[j]] = new[comm[i]].get(comm[j], 0) + x
        w, loops = new, new_loops
    inside = sum(1 for i, n in first.items() for j in n if member[i] == member[j]) / total
    weight = {}
    for i, n in first.items():
        weight[member[i]] = weight.get(member[i], 0) + len(n)
    return inside - resolution * sum(x * x for x in weight.values()) / total**2


def test_leiden_finds_groups_at_two_resolutions(spark):
    rng = random.Random(1)
    groups, edges = planted(rng, [((a, b), 20) for a in range(3) for b in range(2)], (0.7, 0.25), 0.01)
    g = graph_of(spark, edges)
    for resolution, name in ((0.5, lambda x: x[0]), (2.0, lambda x: x)):
        found = {r.id: r.cluster for r in leiden.leiden(g, resolution).collect()}
        assert len({(name(groups[i]), c) for i, c in found.items()}) == len(set(found.values())) == len(set(map(name, groups)))


@pytest.mark.parametrize("block", [50_000, 300])
def test_leiden_is_no_worse_than_plain_moves_and_connected(spark, monkeypatch, block):
    """In one block, and in many: then a level or two come before the graph fits one."""
    monkeypatch.setattr(leiden, "BLOCK", block)
    rng = random.Random(2)
    _, edges = planted(rng, [((a, b), 25) for a in range(10) for b in range(2)], (0.3, 0.05), 0.004)
    edges |= {(i, i + 1000) for i in range(3)}  # nodes on one edge each
    g = graph_of(spark, edges)
    found = leiden.leiden(g)
    got = leiden.modularity(g, found)
    assert got >= plain_louvain(edges, 1.0) - (0.0 if block > 500 else 0.01)
    cluster = {r.id: r.cluster for r in found.collect()}
    assert set(cluster) == {i for e in edges for i in e}
    near = {}
    for a, b in edges:
        if cluster[a] == cluster[b]:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for c in set(cluster.values()):
        mine = {i for i, x in cluster.items() if x == c}
        seen, todo = set(), [next(iter(mine))]
        while todo:
            i = todo.pop()
            if i not in seen:
                seen.add(i)
                todo += near.get(i, set()) - seen
        assert seen == mine


def test_modularity_and_odd_graphs(spark):
    g = spark.createDataFrame([(1, 2, 2.0), (2, 1, 1.0), (3, 3, 5.0), (3, 4, 2.0)], "id long, other long, weight double")
    c = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b")], "id long, cluster string")
    assert leiden.modularity(g, c) == pytest.approx(0.5) and leiden.modularity(g.where("false"), c) == 0.0
    assert sorted(map(tuple, leiden.leiden(g).collect())) == [(1, "0"), (2, "0"), (3, "1"), (4, "1")]
    assert leiden.leiden(g.where("false")).count() == 0


@pytest.mark.parametrize("cosine", [False, True])
def test_index_is_exact_and_measures_few_pairs(spark, monkeypatch, cosine):
    monkeypatch.setattr(neighbours, "CELL", 40)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(30, 8)) * 10
    x = np.concatenate([middles[rng.integers(30, size=1500)] + rng.normal(size=(1500, 8)), np.repeat(middles[:1], 150, axis=0), np.zeros((2, 8))])
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    queries = points.where("id % 10 = 0 or id > 1640")
    rows = lambda df: sorted((r["id"], r["rank"], r["other"], round(r["dist"], 6)) for r in df.collect())
    index = neighbours.build_index(points, cosine)
    assert index.counts.sum() == len(x)
    assert rows(index.search(queries, 5, exclude_self=True)) == rows(learn.nearest(queries, points, 5, cosine, exclude_self=True))
    found, second = index.visits(queries.where("id % 10 = 0 and id < 1500"), 5, True)
    pairs = sum(int(index.counts[r["cell"]]) for r in second.collect())
    assert pairs / 150 < len(x) / 3  # beside the first cells
    few = index.search(queries, 5, exclude_self=True, shrink=0.5)
    exact = {r[:1] + r[2:3] for r in rows(index.search(queries, 5, exclude_self=True))}
    assert len({r[:1] + r[2:3] for r in rows(few)} & exact) >= 0.9 * len(exact)


def test_index_of_few_points(spark):
    points = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0])], "id long, v array<double>")
    assert sorted((r["id"], r["other"], r["dist"]) for r in neighbours.nearest(points, points, 5, exclude_self=True).collect()) == [(1, 2, 5.0), (2, 1, 5.0)]
    assert neighbours.nearest(points.where("false"), points, 2).count() == 0
    assert neighbours.nearest(points, points.where("false"), 2).count() == 0
