import random

import numpy as np
from pyspark.sql import types as T

from txgraph.llm import hnsw

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("rep", T.StringType()),
    ]
)


def brute(rows):
    def usable(v, label):
        return label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links, top = [0] * n, list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(n):
        for j in range(i):
            (a, v, k, _), (b, w, m, _) = rows[i], rows[j]
            if a is None or b is None or not usable(v, k) or not usable(w, m) or k != m or len(v) != len(w):
                continue
            x, y = np.array(v), np.array(w)
            if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                links[i] += 1
                links[j] += 1
                top[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], links[i], least.get(find(i)), r[0] is None or least[find(i)] == r[0]) for i, r in enumerate(rows)]


def check(spark, rows, s=hnsw.Settings()):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in hnsw.near_duplicates(df, s).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_links_and_components_over_several_shards(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 14))):
            rows.append((len(rows), (centre + rng.normal(size=16) * 0.07).tolist(), int(c % 2), "x"))
    rows += [(1000 + i, rows[5][1], rows[5][2], "x") for i in range(8)]
    random.Random(1).shuffle(rows)
    check(spark, rows, hnsw.Settings(shard_rows=30))


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(1, None, 1, ""), (2, [0.0, 0.0], 1, ""), (3, [1.0, nan], 1, ""), (4, [1.0, None], 1, ""), (5, [1.0, 1.0], None, "")]
    rows += [(6, [1.0, 1.0], 1, ""), (7, [2.0, 2.0], 1, ""), (8, [1.0, 1.0], 1, ""), (9, [1.0, 1.0], 2, ""), (10, [1.0], 1, "")]
    rows += [(11, [1e200, 1e200], 1, ""), (None, [1.0, 1.0], 1, ""), (6, [1.0, 1.0], 1, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(df).collect()}
    assert {g for g in got if g[0] in (6, 7, 8, 11)} == {(6, 4, 6, True), (7, 4, 6, False), (8, 4, 6, False), (11, 4, 6, False)}
    assert {g for g in got if g[0] not in (6, 7, 8, 11)} == {(i, 0, i, True) for i in (1, 2, 3, 4, 5, 9, 10)} | {(None, 0, None, True)}
    assert hnsw.near_duplicates(df.where("false")).count() == 0


def test_recall_of_a_graph_and_its_packed_form():
    rng = np.random.default_rng(8)
    v = hnsw.unit(np.concatenate([rng.normal(size=(900, 24)), np.repeat(rng.normal(size=(20, 24)), 15, axis=0) + rng.normal(size=(300, 24)) * 0.05]))
    v = v[rng.permutation(len(v))]
    graph = hnsw.Graph(v, hnsw.Settings()).build()
    assert graph.audit() >= 0.98
    again = hnsw.Graph.unpack(*graph.pack(), 24, hnsw.Settings())
    truth = v @ v.T >= 0.98
    found = sum(len(set(again.search(q)) & set(np.flatnonzero(truth[i]).tolist())) for i, q in enumerate(v))
    assert found >= 0.95 * truth.sum()
    assert all(truth[i, x] for i, q in enumerate(v[:50]) for x in again.search(q))


def test_a_search_without_a_hit_goes_on_over_close_neighbours():
    angles = np.radians([12.0, 15.0, -10.0])
    graph = hnsw.Graph(np.column_stack([np.cos(angles), np.sin(angles)]), hnsw.Settings(beam=1))
    graph.near, graph.entry, graph.top = [{0: [1], 1: [0, 2], 2: [1]}], 0, 0
    assert graph.search(np.array([1.0, 0.0])) == [2]


def test_audit_asks_for_links_and_nearest_vectors_of_other_shards():
    rng = np.random.default_rng(5)
    v = hnsw.unit(rng.normal(size=(200, 16)))
    graph = hnsw.Graph(v, hnsw.Settings()).build()
    assert graph.audit() >= 0.98 and graph.audit(hnsw.unit(rng.normal(size=(60, 16)))) >= 0.98
    graph.near[0] = {node: [] for node in range(200)}
    foreign = hnsw.unit(v[:40] + rng.normal(size=(40, 16)) * 0.01)
    assert graph.audit() < 0.98 and graph.audit(foreign) < 0.98
    assert [set(x) for x in graph.compare(foreign)] == [set(np.flatnonzero(v @ q >= 0.98).tolist()) for q in foreign]


def test_a_beam_that_fails_is_not_asked_for_the_whole_sample():
    """The audit ends at the same beam and recall, with fewer lookups."""
    rng = np.random.default_rng(6)
    s = hnsw.Settings(links=4, build_beam=8, beam=1, audit_rows=400, most_beam=64)
    graph = hnsw.Graph(hnsw.unit(rng.normal(size=(600, 32))), s).build()
    asked = []

    def counted(q, walk=graph._from_top):
        asked.append(graph.beam)
        return walk(q)

    graph._from_top = counted
    recall = graph.audit()
    assert graph.beam > 1 and asked.count(1) < 400 and asked.count(graph.beam) == 400
    rows = np.unique(np.linspace(0, 599, 400).astype(int))
    near = (graph.v @ graph.v.T - 4 * np.eye(600)).max(axis=1)
    met = [max(sim for sim, x in graph._from_top(graph.v[r]) if x != r) >= near[r] - 1e-12 for r in rows]
    assert recall == np.mean(met)


def test_poor_graphs_are_replaced_by_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + rng.normal(size=16) * 0.07).tolist(), 1, "x") for i in range(240)]
    check(spark, rows, hnsw.Settings(shard_rows=60, links=2, build_beam=1, beam=1, audit_recall=1.0))


def test_ground_walk_by_arrays_is_as_good_as_node_by_node():
    """A beam finds no worse nodes, in far fewer numpy calls, and leaves no marks behind."""
    rng = np.random.default_rng(12)
    v = hnsw.unit(rng.normal(size=(1500, 32)))
    graph = hnsw.Graph(v, hnsw.Settings(beam=64)).build()
    again = hnsw.Graph.unpack(*graph.pack(), 32, hnsw.Settings(beam=64))
    ours = theirs = 0.0
    for q in hnsw.unit(rng.normal(size=(60, 32))):
        start = (float(v[graph.entry] @ q), graph.entry)
        got, want = graph._on_ground(q, start, 64), graph._walk(q, [start], 64, 0)
        assert len(got) == len(set(x for _, x in got)) == len(want) == 64
        assert all(abs(sim - v[x] @ q) < 1e-12 for sim, x in got) and got == sorted(got, key=lambda x: -x[0])
        assert again._on_ground(q, start, 64) == got == graph._on_ground(q, start, 64)
        ours, theirs = ours + got[-1][0], theirs + want[-1][0]
    assert ours >= theirs - 1e-9
