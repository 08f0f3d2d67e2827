import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from txgraph.llm import parity
from txgraph.llm.common import frugal, scratch_uri
from txgraph.llm.components import components


def shingled(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets, top = [shingled(text) for _, text in rows], list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            inter = len(a & sets[j])
            if inter and 100 * inter >= 75 * (len(a) + len(sets[j]) - inter):
                top[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        key = (doc_id is None, doc_id or 0)
        least[find(i)] = min(least.get(find(i), key), key)
    return [(d, len(sets[i]), None if least[find(i)][0] else least[find(i)][1]) for i, (d, _) in enumerate(rows)]


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, parity.join(docs).collect()), key=repr) == sorted(brute(rows), key=repr)


def near_copies(rng, groups, copies, boiler=True):
    words = [f"w{i}" for i in range(2000)]
    common = " ".join(rng.choice(words) for _ in range(40))
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([1, 4, 5, 6, 15, 16, 17, 63, 64, 65, 120, 260]))]
        for _ in range(rng.choice(copies)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                at = rng.randrange(len(text))
                text[at : at + rng.randint(0, 2)] = [rng.choice(words)]
            rows.append(" ".join(text) + (" " + common if boiler and rng.random() < 0.4 else ""))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, make_docs, seed):
    rows = near_copies(random.Random(seed), 14, [1, 2, 3, 9])
    check(make_docs(rows).repartition(3))


def test_chunked_groups(spark, make_docs, monkeypatch):
    monkeypatch.setattr(parity, "CHUNK", 3)
    check(make_docs(near_copies(random.Random(7), 4, [12])).repartition(2))


def test_odd_rows(spark, make_docs, odd_rows):
    check(make_docs(odd_rows))
    check(make_docs([(1, "a b c d e f"), (1, "u v"), (None, "A b c d e f"), (None, "u v"), (3, "U V")]))
    assert parity.join(make_docs(odd_rows).where("false")).count() == 0


def test_bounds_hold_for_every_linked_pair():
    """Pigeonhole and Hamming: similar sets share a key, and the sketches tell no more than they may."""
    rng = np.random.default_rng(4)
    for _ in range(400):
        n = int(rng.choice([1, 2, 3, 5, 12, 16, 17, 60, 64, 70, 255, 257, 900]))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        cut = int(rng.integers(0, n // 4 + 1))
        fresh = rng.integers(0, 2**63, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)
        b = np.unique(np.concatenate([a[cut:], fresh]))
        inter = len(np.intersect1d(a, b))
        if not len(b) or not parity.linked(inter, len(a), len(b)):
            continue
        often = np.zeros(len(a), int), np.zeros(len(b), int)
        keys = parity.keys_of(a, often[0])[0], parity.keys_of(b, often[1])[0]
        assert len(np.intersect1d(*keys))
        difference = len(a) + len(b) - 2 * inter
        assert parity.hamming(parity.parities(a), parity.parities(b)) <= difference
        assert 7 * difference <= len(a) + len(b)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()))
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(30)} | {200: 200, 300: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_with_partner_equals_all_pairs():
    rng = np.random.default_rng(4)
    for n in (2, 5, 33, 70, 200):
        s = rng.integers(20, 60, n)
        place = rng.integers(0, 20, n)
        a, b = s[:, None], s[None, :]
        fits = (4 * a >= 3 * b) & (4 * b >= 3 * a) & (a + b >= 7 * np.maximum(place[:, None], place[None, :]))
        np.fill_diagonal(fits, False)
        assert (parity.with_partner(s, place) == fits.any(axis=1)).all()


def test_first_shared_key_of_linked_sets_is_near_the_front():
    rng = np.random.default_rng(6)
    for _ in range(300):
        s = int(rng.integers(4, 300))
        a = np.unique(rng.integers(0, 1 << 63, s).astype(np.uint64))
        gone = int(rng.integers(0, len(a) // 4 + 1))
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, 3))).astype(np.uint64)]))
        inter = len(np.intersect1d(a, b))
        if not parity.linked(inter, len(a), len(b)):
            continue
        (ka, ia), (kb, ib) = (parity.keys_of(x, np.zeros(len(x), np.int64)) for x in (a, b))
        shared, at, to = np.intersect1d(ka, kb, return_indices=True)
        assert len(shared) and (7 * np.maximum(ia[at], ib[to])).min() <= len(a) + len(b)


def test_sets_of_a_run_equal_sets_one_by_one():
    """Keys, places and parities of many sets at once, those of one or two shingles among them."""
    rng = np.random.default_rng(12)
    sizes = np.array([1, 2, 3, 3, 4, 5, 15, 16, 17, 21, 63, 64, 65, 85, 86, 255, 256, 257, 300, 1024, 1100] * 3)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in sizes]
    own, upto = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    often = rng.integers(0, 3, len(own)) * rng.integers(0, 30, len(own))
    key, place, n = parity.keys_of_many(own, upto, often)
    want = [parity.keys_of(x, often[a : a + len(x)]) for x, a in zip(sets, upto[:-1], strict=True)]
    assert n.tolist() == [len(k) for k, _ in want]
    assert (key == np.concatenate([k for k, _ in want])).all()
    assert (place == np.concatenate([p for _, p in want])).all()
    assert parity.parities_of(own, upto) == [parity.parities(x).tobytes() for x in sets]


def test_pairs_of_one_component_are_not_compared_again(spark):
    """Two families of copies in one group: a centre meets members of the other family only."""
    rng = np.random.default_rng(2)
    sets = {i: np.unique(rng.integers(0, 1 << 63, 40).astype(np.uint64)) for i in (0, 50)}
    told = [(i, 40, parity.parities(sets[i - i % 50]).tobytes(), i) for i in range(100)]
    told = spark.createDataFrame(told, "uid long, n long, bits binary, first long")
    labels = spark.createDataFrame([(i, i - i % 50) for i in range(100)], "node long, component long")
    members = np.arange(1, 100).astype("<i8").tobytes()
    open_ = spark.createDataFrame([(1, 0, members, [60, 61])], "gid long, chunk long, members binary, centres array<long>")
    assert parity._around(open_, told, labels).count() == 0
    apart = labels.where("node <> 70")
    assert sorted(map(tuple, parity._around(open_, told, apart).collect())) == [(60, 70), (61, 70)]


@pytest.mark.parametrize("parts", [1, 40])
def test_documents_that_share_a_passage_only_are_no_group(spark, make_docs, parts):
    """120 words in common and 60 of their own each: no link, and no pairs either, however spread."""
    passage = " ".join(f"p{i}" for i in range(120))
    rows = [(n, passage + " " + " ".join(f"w{n}x{i}" for i in range(60))) for n in range(160)]
    given = make_docs(rows).select(F.col("doc_id").alias("uid"), "text").repartition(parts)
    folder = scratch_uri(spark, "test")
    _, frequent = parity.profiles(given, folder)
    assert len(frequent[0]) == 116  # exactly the passage's shingles, wherever they lie
    found = parity.groups(given, frequent, 4)
    members = [len(r.members) // 8 for r in found.collect()]
    assert sum(m * (m + 1) // 2 for m in members) <= 160
    assert {r.component_id for r in parity.join(make_docs(rows)).collect()} == set(range(160))


def test_groups_of_a_bucket_equal_brute_force():
    """Documents that share a key are together, whatever the number of keys that none shares."""
    rng = np.random.default_rng(9)
    keys = {uid: np.unique(rng.integers(1 << 42, 1 << 43, 30)) for uid in range(40)}
    for uid in range(20, 40):  # each of these shares a key with the one before
        keys[uid][0] = keys[uid - 20][5]
    held = []
    for some in (range(0, 25), range(25, 40)):
        own = np.concatenate([keys[u] for u in some]).astype("<u8")
        place = np.zeros(len(own), "<u2").tobytes()
        short = own.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
        uid, size = np.array(some, "<i8").tobytes(), np.full(len(some), 30, "<i8").tobytes()
        times = np.array([len(keys[u]) for u in some], "<i4").tobytes()
        held.append({"key": short, "place": place, "uid": uid, "size": size, "times": times})
    found = [r for batch in parity._grouped(held) for r in batch.to_pylist()]
    pairs = sorted((r["hub"], int(np.frombuffer(r["members"], "<i8")[0])) for r in found)
    assert pairs == [(u, u + 20) for u in range(20)]
    assert list(parity._grouped([])) == []


def test_stars_leave_a_task_in_large_batches(spark, monkeypatch):
    rows = [(hub, 0, np.array(m, "<i8").tobytes()) for hub in range(300) for m in ([hub + 1000, hub + 2000], [hub + 2000, hub + 3000])]
    found = spark.createDataFrame(rows, "hub long, chunk long, members binary")
    for most in (1, 20_000):
        monkeypatch.setattr(parity, "STAR_ROWS", most)
        got = sorted(map(tuple, parity._stars(found).collect()))
        assert got == sorted((hub, hub + n * 1000) for hub in range(300) for n in (1, 2, 3))


def test_a_worker_gives_back_what_a_task_has_freed():
    from pathlib import Path

    def resident():
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 2**20

    pins = []

    def run(batches):
        for n in batches:
            held = [np.ones(12_000) for _ in range(n)]
            pins.append(np.ones(12_000))  # lies behind the others, which the allocator keeps then
            yield len(held)

    before = resident()
    assert list(frugal(run)([2000])) == [2000]
    assert resident() - before < 100
