import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.fixtures import one_graph, ring_window, shared_device_window, transactions
from txgraph.operators import graph as G
from txgraph.operators.betweenness import betweenness
from txgraph.operators import betweenness as between_module
from txgraph.operators import communities, triangles
from txgraph.operators import core as core_module
from txgraph.operators import pagerank as rank_module
from txgraph.operators.communities import colour_rounds, greedy_colours, propagate_labels
from txgraph.operators.components import component_sizes, connected_components
from txgraph.operators.features import graph_features
from txgraph.operators.pagerank import pagerank, settled
from txgraph.operators.rings import (
    account_rings,
    detect_rings,
    distinct_rings,
    member_pages,
    rank_rings,
)
from txgraph.operators.triangles import clustering
from txgraph.schema import GRAPH_FEATURES


def by_id(graph, table, column):
    rows = graph.vertices.join(table, ["graph_id", "node"]).collect()
    return {(r["graph_id"], r["id"]): r[column] for r in rows}


@pytest.fixture(scope="module")
def small(spark):
    return G.build_graph(one_graph(shared_device_window(spark)))


def test_edges_accumulate_count_and_amount(spark):
    edges = G.keyed_edges(G.edge_table(one_graph(shared_device_window(spark))))
    got = {(r.src, r.dst): (r.weight, r.amount) for r in edges.collect()}
    assert got[("acct:A1", "dev:D1")] == (2, 190.0)
    assert got[("acct:A2", "mer:M1")] == (1, 120.0)
    assert len(got) == 6


def test_node_types_and_order(spark):
    order = G.vertex_order(one_graph(shared_device_window(spark))).orderBy("ord").collect()
    assert [r.node for r in order] == [
        "acct:A1", "dev:D1", "mer:M1", "acct:A2", "acct:A9", "dev:D9", "mer:M9",
    ]
    assert {r.ntype for r in order} == {"account", "device", "merchant"}


@pytest.mark.parametrize("kernel", [512, 0])
def test_pagerank_golden(small, kernel):
    ranks = by_id(small, pagerank(small, kernel_nodes=kernel), "pagerank")
    want = {"A1": 0.18333, "D1": 0.14286, "M1": 0.14286, "A2": 0.10238, "A9": 0.20849,
            "D9": 0.11004, "M9": 0.11004}
    for node, value in want.items():
        assert ranks[(0, node)] == pytest.approx(value, abs=1e-5)
    assert sum(ranks.values()) == pytest.approx(1.0)


@pytest.mark.parametrize("kernel", [512, 0])
def test_betweenness_golden(small, kernel):
    between = by_id(small, betweenness(small, kernel_nodes=kernel), "betweenness")
    want = {"A1": 1 / 30, "D1": 1 / 30, "M1": 1 / 30, "A2": 1 / 30, "A9": 2 / 30, "D9": 0, "M9": 0}
    for node, value in want.items():
        assert between[(0, node)] == pytest.approx(value)


def test_components(small):
    parts = connected_components(small)
    sizes = by_id(small, parts.join(component_sizes(parts), ["graph_id", "component"]), "component_size")
    assert sizes[(0, "A2")] == 4 and sizes[(0, "M9")] == 3


def test_features_golden(spark):
    rows = {r.tx_id: r for r in graph_features(one_graph(shared_device_window(spark))).collect()}
    assert len(rows) == 4
    assert rows["T1"].velocity_ring_score == 2 and rows["T4"].velocity_ring_score == 1
    assert rows["T1"].device_shared_account_count == 2 == rows["T1"].device_degree
    assert rows["T1"].component_size == 4 and rows["T4"].component_size == 3
    for row in rows.values():
        assert row.account_degree == (
            row.unique_devices_per_account + row.unique_merchants_per_account
        )
        assert row.account_clustering_coef == 0.0 == row.merchant_cluster_coefficient


def test_empty_window(spark):
    empty = one_graph(shared_device_window(spark)).where("false")
    features = graph_features(empty)
    assert features.columns[2:] == GRAPH_FEATURES
    assert features.count() == 0
    found, members = detect_rings(G.build_graph(empty))
    assert found.count() == 0 and members.count() == 0


def test_rows_outside_the_graph_get_defaults(spark):
    tx = one_graph(shared_device_window(spark))
    window = tx.where("account_id = 'A9'")
    rows = {r.tx_id: r for r in graph_features(tx, window).collect()}
    assert rows["T1"].account_degree == 0 and rows["T1"].component_size == 1
    assert rows["T1"].account_pagerank == 0.0 and rows["T1"].velocity_ring_score == 2
    assert rows["T4"].account_degree == 2


def test_ring_golden(spark):
    graph = G.build_graph(one_graph(ring_window(spark)))
    found, members = detect_rings(graph)
    ring = found.collect()
    assert len(ring) == 1
    ring = ring[0]
    assert (ring["size"], ring.n_devices, ring.n_merchants, ring.n_edges) == (4, 1, 1, 8)
    assert ring.shared_device_ratio == 0.75
    assert ring.density == pytest.approx(8 / 15)
    assert ring.risk_score == pytest.approx(0.641666667)
    pages = {r.ntype: r.members for r in member_pages(members).collect()}
    assert pages["account"] == ["A1", "A2", "A3", "A4"]
    assert pages["device"] == ["D_SHARED"]
    two = member_pages(members.where("ntype = 'account'"), page=3).orderBy("page").collect()
    assert [r.members for r in two] == [["A1", "A2", "A3"], ["A4"]]
    assert detect_rings(graph, min_accounts=99)[0].count() == 0
    labels = propagate_labels(graph)
    assert labels.select("label").distinct().count() == 9


def test_ring_without_device_has_full_ratio(spark):
    from txgraph.functions.scalars import shared_device_ratio

    row = spark.range(1).select(
        shared_device_ratio(F.lit(0), F.lit(3)).alias("a"),
        shared_device_ratio(F.lit(5), F.lit(3)).alias("b"),
    ).first()
    assert row.a == 1.0 and row.b == 0.0


def test_rings_across_graphs(spark):
    tx = ring_window(spark)
    both = one_graph(tx, 0).unionByName(one_graph(tx, 1))
    found, members = detect_rings(G.build_graph(both))
    assert found.count() == 2
    first = distinct_rings(found, members).collect()
    assert len(first) == 1 and first[0].graph_id == 0
    last = {r.account_id: r.graph_id for r in account_rings(members).collect()}
    assert last["A1"] == 1
    assert rank_rings(found).first().graph_id == 0


def test_clustering_triangle_and_path(spark):
    pairs = spark.createDataFrame(
        [(0, a, b) for a in "abcd" for b in "abcd" if a < b] + [(1, "x", "y"), (1, "z", "y")],
        "graph_id bigint, a string, b string",
    )
    got = {(r.graph_id, r.node): r.clustering for r in clustering(pairs).collect()}
    assert got[(0, "a")] == 1.0 and got[(0, "d")] == 1.0
    assert got[(1, "y")] == 0.0 and got[(1, "x")] == 0.0


def test_transaction_graph_has_no_triangles(spark):
    edges = G.keyed_edges(G.edge_table(one_graph(ring_window(spark))))
    found = clustering(edges.selectExpr("graph_id", "src as a", "dst as b"))
    assert found.where("clustering <> 0").isEmpty()


# --- brute force on random windows ------------------------------------------


def random_rows(seed, n, accounts, devices, merchants):
    rng = random.Random(seed)
    return [
        (
            f"T{i:04d}",
            f"A{rng.randrange(accounts)}",
            f"D{rng.randrange(devices)}",
            f"M{rng.randrange(merchants)}",
            rng.randrange(1, 100),
            i,
        )
        for i in range(n)
    ]


class Plain:
    """A window graph in plain Python, in order of first appearance."""

    def __init__(self, rows):
        self.nodes, self.adj = [], {}
        for _, a, d, m, *_ in rows:
            for node in (a, d, m):
                if node not in self.adj:
                    self.adj[node] = {}
                    self.nodes.append(node)
            for other in (d, m):
                for u, v in ((a, other), (other, a)):
                    self.adj[u][v] = self.adj[u].get(v, 0) + 1
        self.ord = {n: i for i, n in enumerate(self.nodes)}

    def colours(self):
        out = {}
        for n in sorted(self.nodes, key=lambda n: (-len(self.adj[n]), self.ord[n])):
            used = {out[m] for m in self.adj[n] if m in out}
            out[n] = next(c for c in range(len(self.nodes)) if c not in used)
        return out

    def labels(self):
        colours = self.colours()
        label = dict(self.ord)

        def best(n):
            votes = {}
            for m in self.adj[n]:
                votes[label[m]] = votes.get(label[m], 0) + 1
            top = max(votes.values())
            return {k for k, v in votes.items() if v == top}

        while not all(label[n] in best(n) for n in self.nodes):
            for colour in sorted(set(colours.values())):
                for n in self.nodes:
                    if colours[n] == colour:
                        options = best(n)
                        if label[n] not in options:
                            label[n] = max(options)
        return label

    def between(self, sources, scale):
        total = dict.fromkeys(self.nodes, 0.0)
        for s in sources:
            dist, paths, order, before = {s: 0}, {s: 1.0}, [s], {}
            for u in order:
                for v in self.adj[u]:
                    if v not in dist:
                        dist[v] = dist[u] + 1
                        paths[v] = 0.0
                        order.append(v)
                    if dist[v] == dist[u] + 1:
                        paths[v] += paths[u]
                        before.setdefault(v, []).append(u)
            depend = dict.fromkeys(order, 0.0)
            for v in reversed(order):
                for u in before.get(v, []):
                    depend[u] += paths[u] / paths[v] * (1 + depend[v])
                if v != s:
                    total[v] += depend[v]
        n = len(self.nodes)
        return {k: v * scale / ((n - 1) * (n - 2)) for k, v in total.items()}

    def component_sizes(self):
        out = {}
        for n in self.nodes:
            if n in out:
                continue
            seen, todo = {n}, [n]
            while todo:
                for m in self.adj[todo.pop()]:
                    if m not in seen:
                        seen.add(m)
                        todo.append(m)
            out.update(dict.fromkeys(seen, len(seen)))
        return out


CASES = [(1, 40, 20, 15, 10), (2, 120, 40, 12, 30), (3, 25, 25, 25, 25), (4, 60, 8, 30, 6)]


@pytest.fixture(scope="module")
def randoms(spark):
    plain, parts = {}, None
    for gid, case in enumerate(CASES):
        rows = random_rows(*case)
        plain[gid] = Plain(rows)
        part = one_graph(transactions(spark, rows), gid)
        parts = part if parts is None else parts.unionByName(part)
    return plain, parts.withColumn("tx_id", F.concat(F.col("graph_id"), F.lit("-"), "tx_id"))


@pytest.mark.parametrize("hub_degree", [10**9, 6])
def test_graph_operators_against_brute_force(spark, randoms, hub_degree):
    """The second run treats every node of degree 6 and more as a hub."""
    plain, tx = randoms
    graph = G.build_graph(tx, hub_min_degree=hub_degree, busy_min_rows=hub_degree)
    assert (graph.hubs is None) == (hub_degree > 100)
    colours = by_id(graph, greedy_colours(graph, heavy_min_rows=hub_degree), "colour")
    labels = by_id(graph, propagate_labels(graph), "label")
    swept = by_id(graph, propagate_labels(graph, kernel_arcs=0), "label")
    parts = connected_components(graph, heavy_min_rows=hub_degree)
    sizes = by_id(graph, parts.join(component_sizes(parts), ["graph_id", "component"]), "component_size")
    kernel = by_id(graph, betweenness(graph), "betweenness")
    levels = by_id(graph, betweenness(graph, kernel_nodes=0), "betweenness")
    ranks = by_id(graph, pagerank(graph, iterations=20), "pagerank")
    joined = by_id(graph, pagerank(graph, iterations=20, kernel_nodes=0), "pagerank")
    for gid, p in plain.items():
        want = p.colours()
        assert {n: colours[(gid, n)] for n in p.nodes} == want
        want = p.labels()
        assert {n: labels[(gid, n)] for n in p.nodes} == want
        assert {n: swept[(gid, n)] for n in p.nodes} == want
        want = p.component_sizes()
        assert {n: sizes[(gid, n)] for n in p.nodes} == want
        want = p.between(p.nodes, 1.0)
        for n in p.nodes:
            assert kernel[(gid, n)] == pytest.approx(want[n], abs=1e-12)
            assert levels[(gid, n)] == pytest.approx(want[n], abs=1e-12)
        assert sum(ranks[(gid, n)] for n in p.nodes) == pytest.approx(1.0)
        for n in p.nodes:
            assert ranks[(gid, n)] == pytest.approx(joined[(gid, n)], abs=1e-12)
    features = {r.tx_id: r for r in graph_features(tx, graph=graph).collect()}
    row = features["1-T0000"]
    first = next(iter(plain[1].nodes))
    assert row.account_degree == len(plain[1].adj[first])
    assert row.component_size == plain[1].component_sizes()[first]


def test_pivot_sampling(spark, randoms):
    plain, tx = randoms
    graph = G.build_graph(tx)
    got = by_id(graph, betweenness(graph, cutoff_nodes=30, pivots=10), "betweenness")
    for gid, p in plain.items():
        n = len(p.nodes)
        if n > 30:
            picks = random.Random(7).sample(p.nodes, 10)
            want = p.between(picks, n / 10)
        else:
            want = p.between(p.nodes, 1.0)
        for node in p.nodes:
            assert got[(gid, node)] == pytest.approx(want[node], abs=1e-12)


def test_long_path_components(spark):
    """A chain of 400 nodes settles in a number of rounds that is logarithmic in its length."""
    rng = random.Random(5)
    rows = [(f"T{i:04d}", f"A{i // 2}", f"D{(i + 1) // 2}", f"M{i // 2}", 1.0, rng.randrange(10**6)) for i in range(130)]
    graph = G.build_graph(one_graph(transactions(spark, rows)))
    parts = connected_components(graph, max_rounds=12)
    assert parts.select("component").distinct().count() == 1


def test_colouring_a_long_chain(spark):
    """Nodes in a row, all of degree 2, seen in order: the colours of a chain of 400 nodes depend
    on each other from end to end, yet the rounds follow its logarithm."""
    rows = [(f"T{i:04d}", f"A{i}", f"D{(i + 1) // 2}", f"M{i // 2}", 1.0, i) for i in range(200)]
    plain = Plain(rows)
    graph = G.build_graph(one_graph(transactions(spark, rows)))
    assert colour_rounds(graph) <= 14
    assert by_id(graph, greedy_colours(graph), "colour") == {(0, n): c for n, c in plain.colours().items()}


@pytest.mark.parametrize("hub_degree", [10**9, 12])
def test_frontier_sweeps(spark, monkeypatch, randoms, hub_degree):
    """With the frontier from the second sweep on, labels are the same and few nodes are asked."""
    monkeypatch.setattr(communities, "FRONTIER_SHARE", 1)
    chain = [(f"T{i:04d}", f"A{i // 2}", f"D{(i + 1) // 2}", f"M{i // 2}", 1.0, i) for i in range(120)]
    plain = {1: randoms[0][1], 99: Plain(chain)}
    tx = one_graph(transactions(spark, chain), 99).withColumn("tx_id", F.concat(F.lit("99-"), "tx_id"))
    graph = G.build_graph(randoms[1].where("graph_id = 1").unionByName(tx), hub_min_degree=hub_degree)
    assert (graph.hubs is None) == (hub_degree > 100)
    trace = []
    got = by_id(graph, propagate_labels(graph, kernel_arcs=0, trace=trace), "label")
    for gid, p in plain.items():
        assert {n: got[(gid, n)] for n in p.nodes} == p.labels()
    assert any(frontier for _, _, frontier in trace) and trace[-1][1] == 0


@pytest.mark.parametrize("kernel", [512, 0])
def test_ranks_at_the_cap_are_flagged_and_refused(small, kernel):
    capped = pagerank(small, max_iter=1, kernel_nodes=kernel)
    assert {r.converged for r in capped.collect()} == {False}
    with pytest.raises(Exception, match="did not converge"):
        settled(capped).collect()
    whole = pagerank(small, kernel_nodes=kernel)
    assert sorted(settled(whole).collect()) == sorted(whole.drop("converged").collect())


def test_sketches_of_panes_unite_within_the_bound(spark):
    """A merchant with 30,000 accounts over 40 panes; repeats and nulls change nothing."""
    from txgraph.operators import sketches as SK

    rows = spark.range(30_000).selectExpr(
        "concat('A', id) as account_id", "concat('D', id % 3) as device_id", "'M' as merchant_id", "id % 40 as hour"
    )
    tx = rows.unionByName(rows.where("hour < 9").withColumn("hour", F.col("hour") + 1))
    tx = tx.unionByName(tx.limit(5).withColumn("account_id", F.lit(None).cast("string")))
    panes = SK.pane_sketches(tx, F.col("hour"))
    got = {(r.ntype, r.id, r.side): r.estimate for r in SK.united(panes).where("ntype <> 'account'").collect()}
    assert set(got) == {("merchant", "M", "account"), *[("device", f"D{i}", "account") for i in range(3)]}
    for key, estimate in got.items():
        exact = 30_000 if key[0] == "merchant" else 10_000
        assert abs(estimate - exact) <= 5 * 1.04 / 64 * exact
    accounts = SK.united(panes).where("ntype = 'account'")
    assert accounts.count() == 60_000 and accounts.where("estimate <> 1").count() == 0
    assert panes.where("ntype = 'merchant'").agg(F.max(F.length("sketch"))).first()[0] < 5_000


def test_betweenness_of_a_graph_beyond_the_dense_kernel(spark, monkeypatch):
    """More than 512 nodes: blocks of sources along the arcs, without a join per level."""
    rows = random_rows(6, 900, 500, 70, 60)
    plain, graph = Plain(rows), G.build_graph(one_graph(transactions(spark, rows)))
    assert len(plain.nodes) > G.KERNEL_NODES

    def never(*_):
        raise AssertionError("levels by joins")

    monkeypatch.setattr(between_module, "_by_levels", never)
    monkeypatch.setattr(between_module, "BLOCK_VISITS", 1)
    monkeypatch.setattr(between_module, "BLOCK_SOURCES", 100)
    got, want = by_id(graph, betweenness(graph), "betweenness"), plain.between(plain.nodes, 1.0)
    assert got.keys() == {(0, n) for n in want}
    for n, value in want.items():
        assert got[(0, n)] == pytest.approx(value, abs=1e-12)


def test_betweenness_over_the_smaller_side(spark, monkeypatch):
    """More than 512 nodes, few devices and merchants: no source runs its levels along all arcs."""
    rows = random_rows(8, 900, 800, 25, 20)
    plain, graph = Plain(rows), G.build_graph(one_graph(transactions(spark, rows)))
    assert len(plain.nodes) > G.KERNEL_NODES

    def never(*_):
        raise AssertionError("levels along the arcs")

    for name in ("_along_arcs", "_by_levels"):
        monkeypatch.setattr(between_module, name, never)
    # Several blocks of sources, each with a part of the sums.
    monkeypatch.setattr(between_module, "CORE_VISITS", 500_000)
    got, want = by_id(graph, betweenness(graph), "betweenness"), plain.between(plain.nodes, 1.0)
    assert got.keys() == {(0, n) for n in want}
    for n, value in want.items():
        assert got[(0, n)] == pytest.approx(value, abs=1e-12)


@pytest.mark.parametrize("chunk, width", [(512, 64), (3, 2)])
def test_core_against_dense_sources(monkeypatch, chunk, width):
    """Many shapes: leaves alike, wide leaves, several components, either side the smaller one."""
    monkeypatch.setattr(core_module, "CHUNK", chunk)
    monkeypatch.setattr(core_module, "WIDTH", width)
    rng = np.random.default_rng(4)
    for _ in range(25):
        ones, others, m = rng.integers(1, 60), rng.integers(1, 60), rng.integers(1, 150)
        pairs = np.unique(np.stack([rng.integers(0, ones, m), rng.integers(0, others, m)]), axis=1)
        a, b = (np.unique(side, return_inverse=True)[1] for side in pairs)
        first, n = a.max() + 1, a.max() + b.max() + 2
        arcs = {"graph_id": 0, "size": n, "src": np.append(a, b + first), "dst": np.append(b + first, a)}
        want = between_module._all_sources(pd.DataFrame(arcs))["betweenness"].to_numpy() * max(1, (n - 1) * (n - 2))
        got = [core_module.betweenness_sums(a, b, part, 3) for part in range(3)]
        got = np.concatenate([sum(side) for side in zip(*got, strict=True)])
        assert np.allclose(got, want, rtol=1e-11, atol=1e-9)


def test_long_chains_and_wide_cores_go_along_the_arcs(spark, monkeypatch):
    """Distances beyond a double's exponent, or a core beyond its bound."""
    chain = np.arange(60)
    ends = np.append(chain, chain), np.append(chain, chain + 1)
    assert core_module.betweenness_sums(*ends) is None
    rows = [(f"T{i}{d}", f"A{i}", f"D{i + d}", "M" if i == 0 else f"M{i}", 1.0) for i in range(60) for d in (0, 1)]
    plain, graph = Plain(rows), G.build_graph(one_graph(transactions(spark, rows)))
    want = plain.between(plain.nodes, 1.0)
    for core in (core_module.CORE_NODES, 5):
        monkeypatch.setattr(between_module, "CORE_NODES", core)
        got = by_id(graph, betweenness(graph, kernel_nodes=0), "betweenness")
        for n, value in want.items():
            assert got[(0, n)] == pytest.approx(value, abs=1e-12)


@pytest.mark.parametrize("hub_degree", [10**9, 15])
def test_ranks_of_a_graph_beyond_the_dense_kernel(spark, monkeypatch, hub_degree):
    """More than 512 nodes: along the edges in one task, without a join per iteration."""
    rows = random_rows(7, 900, 500, 70, 60)
    graph = G.build_graph(one_graph(transactions(spark, rows)), hub_min_degree=hub_degree)
    assert graph.n_vertices > G.KERNEL_NODES and (graph.hubs is None) == (hub_degree > 1000)
    want = by_id(graph, pagerank(graph, kernel_nodes=0), "pagerank")

    def never(*_):
        raise AssertionError("iterations by joins")

    monkeypatch.setattr(rank_module, "_distributed", never)
    found = pagerank(graph)
    assert found.where("not converged").isEmpty()
    got = by_id(graph, found, "pagerank")
    assert got.keys() == want.keys() and sum(got.values()) == pytest.approx(1.0)
    for n, value in want.items():
        assert got[n] == pytest.approx(value, abs=1e-12)
    assert pagerank(graph, max_iter=1).where("converged").isEmpty()


def test_betweenness_by_joins(spark, randoms):
    """Graphs of more arcs than a task gets: one join per level."""
    plain, tx = randoms
    graph = G.build_graph(tx.where("graph_id = 0"))
    got = by_id(graph, betweenness(graph, kernel_nodes=0, block_arcs=0), "betweenness")
    for n, value in plain[0].between(plain[0].nodes, 1.0).items():
        assert got[(0, n)] == pytest.approx(value, abs=1e-12)


def test_labels_of_a_day_settle_in_one_task(spark):
    """A graph of more than 200,000 arcs, as a day of a large log has: no sweeps by joins."""
    ids = spark.range(60_000)
    tx = ids.selectExpr(
        "0L as graph_id",
        "concat('T', id) as tx_id",
        "concat('A', id * 7919 % 20011) as account_id",
        "concat('D', id * 31 % 9973) as device_id",
        "concat('M', id * 17 % 9967) as merchant_id",
        "1.0D as amount",
        "timestamp_seconds(id) as event_time",
    )
    graph = G.build_graph(tx)
    assert graph.n_arcs > 200_000
    trace = []
    label = {r.node: r.label for r in propagate_labels(graph, trace=trace).collect()}
    assert trace == [] and len(label) == graph.n_vertices
    votes = {}
    for r in graph.arcs.where("not own").select("src", "dst").toLocalIterator():
        mine = votes.setdefault(r.src, {})
        mine[label[r.dst]] = mine.get(label[r.dst], 0) + 1
    assert all(v.get(label[n]) == max(v.values()) for n, v in votes.items())


def test_wedges_of_a_dense_middle_are_not_walked_from_every_leaf(spark, monkeypatch):
    """Leaves that hang on a device and a merchant each: one pair of neighbours a leaf, not one per device-merchant edge."""
    rows = [(0, f"A{i:05d}", f"D{i % 30:02d}", f"M{i // 30 % 30:02d}") for i in range(9000)]
    tx = spark.createDataFrame(rows, "graph_id long, a string, d string, m string")
    pairs = tx.selectExpr("graph_id", "explode(array(struct(a as a, d as b), struct(a as a, m as b), struct(d as a, m as b))) as e")
    pairs = pairs.select("graph_id", "e.a", "e.b")
    wedges, walked = triangles._wedges, []
    monkeypatch.setattr(triangles, "_wedges", lambda oriented: walked.append(wedges(oriented)) or walked[-1])
    found = {r.node: r.triangles for r in clustering(pairs).collect()}
    # Leaf by leaf 9,000, of the middle 30 * 29 / 2 for each device; a path over the middle makes 270,000.
    assert walked[0].count() == 9000 + 30 * 435
    assert found["A00000"] == 1 and found["D00"] == 300 == found["M00"]
    busy = {r.node: r.triangles for r in clustering(pairs, heavy_min_rows=5).collect()}
    assert busy == found
