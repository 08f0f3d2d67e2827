import random
import tempfile

import numpy as np
from pyspark.sql import functions as F

from txgraph.llm import langid, packing, quality
from txgraph.llm.common import read_table

SF = "/root/testdata/sf0.01"


def test_language_on_the_held_out_fold(spark):
    docs = read_table(spark, SF, "documents")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = found.count(), found.where("lang = lang_pred").count()
    assert n > 150 and right / n >= 0.98
    assert found.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_rows(spark, make_docs, odd_rows):
    rows = [(*r, "en") for r in odd_rows] + [(1000 + i, "le chat est sur la table " * 3, "fr") for i in range(20)]
    rows += [(2000 + i, "der Hund läuft über die Straße " * 3, "de") for i in range(20)]
    rows += [(3000, "12345 !!", "fr"), (3001, "le chat est", None)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(make_docs(rows)).collect()}
    assert got[1] == got[2] == got[3] == got[3000] == ("und", 0.0)
    assert got[3001][0] == "fr" and got[2003][0] == "de"
    assert langid.identify(make_docs(rows).where("false")).count() == 0
    none = langid.identify(make_docs([(i, "some text") for i in range(9)])).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, 4000)
    sure = np.where(rng.random(4000) < 0.8, labels, 1 - labels)  # right in 80 %
    logits = np.stack([-10.0 * sure, 10.0 * sure], axis=1) - 5.0
    t = langid.temperature(np.stack([10.0 * (sure == 0), 10.0 * (sure == 1)], axis=1), labels)
    assert logits.shape == (4000, 2) and abs(10.0 / t - np.log(4)) < 0.2


def test_quality_on_the_held_out_fold(spark):
    docs, labels = read_table(spark, "/root/testdata/sf0.1", "documents"), read_table(spark, "/root/testdata/sf0.1", "labels")
    rows = quality.classify(docs, labels).join(labels, "doc_id").where(langid.fold() == 0)
    n, right = rows.count(), rows.where("quality = quality_pred").count()
    assert n > 500 and right / n >= 0.97


def test_quality_of_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    labels = spark.createDataFrame([(1, 0), (2, 1), (4, 1), (4, 0), (5, None), (None, 1)], "doc_id long, quality int")
    for given in (labels, labels.where("quality = 1"), labels.where("false")):
        got = quality.classify(docs, given).collect()
        assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.classify(docs.where("false"), labels).count() == 0


def test_co_training_learns_from_the_other_view():
    rng = np.random.default_rng(2)
    truth = rng.integers(0, 2, 600)
    text = [(np.array([t * 5 + rng.integers(0, 5), 20]), np.ones(2)) for t in truth]
    meta = [(np.array([t * 300 + rng.integers(0, 300), 700]), np.ones(2)) for t in truth]
    views = quality.View(text, 21), quality.View(meta, 701)
    labels, checks = {i: int(truth[i]) for i in range(40)}, {i: int(truth[i]) for i in range(40, 100)}
    quality.co_train(*views, labels, checks, list(range(100, 600)), quality.Settings(take=200, sure=0.9))
    # 40 labels show 40 of 600 metadata values; the text view has taught most of the others.
    right = [(m >= 0) == t for m, t in zip(views[1].margins(range(300, 600)), truth[300:], strict=True)]
    assert np.mean(right) > 0.75


def naive_best_fit(items, capacity, per_source):
    bins = []
    for need, source, cluster in items:
        fitting = [
            (capacity - sum(x[0] for x in b), i)
            for i, b in enumerate(bins)
            if capacity - sum(x[0] for x in b) >= need
            and all(x[2] != cluster for x in b)
            and (source is None or sum(x[1] == source for x in b) < per_source)
        ]
        if fitting:
            bins[min(fitting)[1]].append((need, source, cluster))
        else:
            bins.append([(need, source, cluster)])
    return [sorted(x[0] for x in b) for b in bins]


def test_packing_equals_naive_best_fit():
    import pandas as pd

    rng = random.Random(4)
    for per_source in (1, 3):
        rows = [(rng.randint(1, 100), rng.choice(["a", "a", "b", "c", None]), rng.choice([*range(30), 7, 7, 7]), i) for i in range(250)]
        pdf = pd.DataFrame(rows, columns=["need", "source", "cluster", "row"])
        done = packing.pack_shard(pdf, 100, per_source)
        got = [sorted(g["need"].tolist()) for _, g in done.groupby("number")]
        items = sorted(rows, key=lambda r: (-r[0], r[3]))
        assert got == naive_best_fit([(n, s, c) for n, s, c, _ in items], 100, per_source)


def test_packed_documents(spark, make_docs, odd_rows):
    rows = [(i, "w " * (i % 90), "en", "s1" if i % 3 else None) for i in range(100, 400)] + [(*r, None, "s2") for r in odd_rows]
    rows += [(900, "x " * 205, "en", "s1"), (901, "same text here", "en", "s3"), (902, "same text here", "en", "s3")]
    docs = make_docs(rows)
    got = packing.pack(docs, capacity=100, per_source=2, shard_rows=100).cache()
    words = {i: 0 for i, *_ in rows}
    for doc_id, text, *_ in rows:
        words[doc_id] += len((text or "").split())
    assert {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()} == words
    assert got.where("bin_id IS NULL").count() == sum(not (t or "").split() for _, t, *_ in rows)
    bins = got.where("bin_id IS NOT NULL").groupBy("bin_id").agg(F.sum("n_tokens").alias("n"), F.sort_array(F.collect_list(F.struct("start", "n_tokens"))).alias("p"))
    for row in bins.collect():
        assert row.n <= 100
        at = 0
        for piece in row.p:
            assert piece.start == at
            at += piece.n_tokens
    held = got.join(docs.select("doc_id", "source").distinct(), "doc_id").where("source IS NOT NULL AND bin_id IS NOT NULL")
    assert held.where("bin_id NOT LIKE 'f%'").groupBy("bin_id", "source").count().where("count > 2").count() == 0
    same = got.where("doc_id IN (901, 902)").select("bin_id").distinct().count()
    assert same == 2 and packing.pack(docs.where("false")).count() == 0


def test_near_copies_never_share_a_bin(spark, make_docs):
    """Groups of near copies in documents of unique, repeated and null ids, from one source or more."""
    import re

    from txgraph.llm.queries import QUERIES

    rng = random.Random(6)
    rows = []
    for group in range(12):
        words = [f"g{group}w{rng.randint(0, 10**6)}" for _ in range(60)]
        for copy in range(4):
            changed = [*words[:-1], f"end{copy}"]
            text = " ".join(changed).upper() if copy == 1 else ("  " if copy == 2 else " ").join(changed)
            rows.append((None if group == 3 else 7 if group == 4 else len(rows) + 100, text, "en", f"s{copy % 2}"))
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    docs = make_docs(rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op5_packing"](spark, folder).collect()
    assert len(got) == len(rows)
    told = {i: re.match(r"g(\d+)w", t.lower()).group(1) for i, t, *_ in rows if i not in (None, 7)}
    told |= {None: "3", 7: "4"}
    bins = [(r.bin_id, told[r.doc_id]) for r in got]
    assert len(bins) == len(set(bins)) and len({b for b, _ in bins}) < len(bins)


def test_metadata_values_are_hashed_whole():
    pairs = [quality.meta_features(lang, "some.host.example.org", 9)[3] for lang in ("en", "de", "fr", "es")]
    hosts = [quality.meta_features("en", f"{x}.host.example.org", 9)[1] for x in "abcdefgh"]
    assert len(set(pairs)) == 4 and len(set(hosts)) == 8


def test_pseudo_labels_come_from_all_documents(spark, make_docs):
    """Few labels and take per round: each choice is the surest of all unlabelled documents, in new rounds new ones."""
    rows = [(i, ("good words here " if i % 2 else "bad junk !! 11 ") * 5 + f"x{i}", "en", f"s{i % 2}") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    asked = []
    plain = quality.surest

    def told(pool, *rest):
        found = plain(pool, *rest)
        asked.append((pool.count(), {x[0] for x in found}))
        return found

    quality.surest = told
    try:
        quality.fit(make_docs(rows), labels, quality.Settings(rounds=3, take=20, sure=0.6))
    finally:
        quality.surest = plain
    outside = make_docs(rows).where(langid.fold() != 0).count()
    assert len(asked) == 3 and all(n == outside for n, _ in asked)
    assert all(0 < len(x) <= 40 for _, x in asked) and len(set().union(*(x for _, x in asked))) == sum(len(x) for _, x in asked)


def test_words_are_counted_in_the_pass_of_the_join(spark, make_docs, odd_rows, monkeypatch):
    """No further pass over the texts; control characters part words here, unlike in shingles."""

    def refused(docs):
        raise AssertionError("texts read again")

    monkeypatch.setattr(packing, "word_counts", refused)
    rows = [(i, f"a{i}\x01b c\x1fd " + "w " * (i % 7), "en", "s") for i in range(40)] + [(50, None), (51, ""), (52, "x " * 25)]
    for given in (rows, [*rows, *odd_rows], [*rows, (0, "another text of an id")]):
        docs = make_docs(given)
        want = {}
        for doc_id, text, *_ in given:
            spaced = "".join(c if c > " " else " " for c in text or "")
            want[doc_id] = want.get(doc_id, 0) + sum(word != "" for word in spaced.split(" "))
        got = packing.pack_apart(docs, capacity=10, per_source=2)
        assert {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()} == want
        assert got.where("piece = 0").count() == len(given)
