"""Quality classifier by co-training of two views.

The text view sees hashed words, hashed triples of character classes and some ratios; the
metadata view sees language, source and stated length. Both start from the labelled documents.
In each round all unlabelled documents are scored, a view labels those it is most sure of, and
the other view learns from them. Each view is then calibrated (Platt) on labelled documents kept back, and the
calibrated log-odds are combined by a logistic fit on the same documents.

Fitting uses bounded rows: ``per_class`` labelled documents of each class, chosen by hash, and the
``take`` surest of all others per round and view. Scores are given for every document.

Null texts count as empty, null metadata is a value of its own. Labels other than 0 and 1 are
left out; a document with several labels has the more frequent one, 1 if equal. Without labels
of both classes every score is the share of ones, or one half if there is none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.llm.common import chunks, freeze
from txgraph.llm.langid import Ftrl, fold
from txgraph.llm.langid import Settings as FtrlSettings
from txgraph.llm.words import mix, word_hashes

WORD_BITS, CLASS_BITS, META_BITS = 13, 12, 12
BUCKETS = 16
RATIOS = 6
TEXT_FEATURES = (1 << WORD_BITS) + (1 << CLASS_BITS) + RATIOS * BUCKETS + 1


@dataclass(frozen=True)
class Settings:
    per_class: int = 3000
    rounds: int = 4
    take: int = 600  # pseudo-labels a view gives per round, in proportion to the classes
    sure: float = 0.97
    epochs: int = 2


def _class_table() -> np.ndarray:
    """Byte to character class: letters, digits, blanks; other ASCII signs are their own."""
    table = np.arange(256, dtype=np.uint32) + 16
    for low, high, kind in ((97, 122, 1), (65, 90, 2), (48, 57, 3), (0x80, 0xFF, 4)):
        table[low : high + 1] = kind
    table[32], table[10] = 5, 6
    return table


_CLASSES = _class_table()


def _bucket(x: np.ndarray | float, top: float) -> int:
    return int(min(BUCKETS - 1, max(0, x / top * BUCKETS)))


def text_features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, values) of each text of a chunk; the last feature is the bias."""
    words, before = word_hashes(data, offsets)
    word_at = (words >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    kinds = _CLASSES[data]
    triple = np.zeros(len(data), dtype=np.uint32)
    triple[1:-1] = (
        kinds[:-2] * np.uint32(0x9E3779B1) + kinds[1:-1] * np.uint32(0x85EBCA77) + kinds[2:] * np.uint32(0xC2B2AE3D)
    ) if len(data) > 2 else 0
    class_at = ((triple * np.uint32(0x27D4EB2F)) >> np.uint32(32 - CLASS_BITS)).astype(np.int64)
    ratio_at = (1 << WORD_BITS) + (1 << CLASS_BITS)
    for row in range(len(offsets) - 1):
        a, b = offsets[row], offsets[row + 1]
        own = word_at[before[row] : before[row + 1]]
        inner = class_at[a + 1 : b - 1] if b - a > 2 else class_at[:0]
        found = np.bincount(
            np.concatenate([own, inner + (1 << WORD_BITS)]), minlength=ratio_at
        )
        used = np.flatnonzero(found)
        values = 1.0 + np.log(found[used])
        values /= max(1e-9, np.sqrt((values * values).sum()))
        k, n = kinds[a:b], max(1, b - a)
        n_words = max(1, len(own))
        ratios = (
            _bucket(np.count_nonzero(k >= 16) / n, 0.5),
            _bucket(np.count_nonzero(k == 3) / n, 0.5),
            _bucket(np.count_nonzero(k == 2) / n, 0.5),
            _bucket(n / n_words, 24),
            _bucket(len(np.unique(own)) / n_words, 1.0),
            _bucket(np.log2(n), 20),
        )
        extra = [ratio_at + i * BUCKETS + r for i, r in enumerate(ratios)] + [TEXT_FEATURES - 1]
        yield np.append(used, extra), np.append(values, [0.3] * RATIOS + [0.2])


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed metadata: each value alone and in pairs, and the bias (the last feature)."""
    size = -1 if n_chars is None else int(2 * np.log2(max(1, n_chars) + 1))
    names = [f"l{lang!r}", f"s{source!r}", f"n{size}", f"{lang!r}|{source!r}", f"{lang!r}|{size}"]
    codes = [int.from_bytes(hashlib.blake2b(x.encode("utf-8"), digest_size=8).digest(), "big") for x in names]
    hashed = mix(np.array(codes, dtype=np.uint64)) >> np.uint64(64 - META_BITS)
    return np.append(hashed.astype(np.int64), 1 << META_BITS)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, text features, values, metadata features) of each row (text, lang, source, n_chars)."""
    lang, source, n_chars = (batch.column(i).to_pylist() for i in (2, 3, 4))
    for first, _, data, offsets in chunks(batch.column(1)):
        for row, (used, values) in enumerate(text_features(data, offsets), start=first):
            yield row, used, values, meta_features(lang[row], source[row], n_chars[row])


def _margin(weights: np.ndarray, used: np.ndarray, values: np.ndarray) -> float:
    return float(values @ weights[used])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (bias last) of a small logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


class View:
    """One view's examples: features, values, and the model fitted on any of them."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], features: int):
        self.rows, self.features = rows, features
        self.weights = np.zeros(features, dtype=np.float32)

    def fit(self, labels: dict[int, int], epochs: int) -> None:
        model = Ftrl(self.features, 2, FtrlSettings(alpha=0.3, l1=0.01))
        order = np.array(sorted(labels))
        for epoch in range(epochs):
            for i in np.random.default_rng(epoch).permutation(order):
                model.learn(*self.rows[i], labels[int(i)])
        w = model.weights(slice(None))
        self.weights = (w[:, 1] - w[:, 0]).astype(np.float32)

    def margins(self, which: list[int]) -> np.ndarray:
        return np.array([_margin(self.weights, *self.rows[i]) for i in which])


def co_train(
    text: View, meta: View, labels: dict[int, int], checks: dict[int, int], pool: list[int], s: Settings
) -> np.ndarray:
    """Fit both views in rounds; returns (calibration of each view, combination) as 2 + 2 + 3."""
    given = (dict(labels), dict(labels))
    views, seen = (text, meta), ([*checks], np.array([*checks.values()], dtype=float))
    share = sum(labels.values()) / max(1, len(labels))
    left = set(pool)
    for turn in range(s.rounds + 1):
        calibrations = _fit_views(views, given, seen, s)
        if turn == s.rounds or not left:
            break
        for teacher, calibration, pupil in zip(views, calibrations, reversed(given), strict=True):
            open_ = sorted(left)
            p = _sigmoid(teacher.margins(open_) * calibration[0] + calibration[1])
            for label, sure, most in ((1, p, share), (0, 1 - p, 1 - share)):
                best = np.argsort(-sure, kind="stable")[: max(1, int(s.take * most))]
                for i in best[sure[best] >= s.sure]:
                    pupil[open_[i]] = label
                    left.discard(open_[i])
    return _combined(views, calibrations, seen)


def _fit_views(views: tuple, given: tuple, seen: tuple, s: Settings) -> list[np.ndarray]:
    """Fit each view to its labels; their calibrations on the documents kept back."""
    for view, own in zip(views, given, strict=True):
        view.fit(own, s.epochs)
    return [_logistic(view.margins(seen[0])[:, None], seen[1]) for view in views]


def _combined(views: tuple, calibrations: list[np.ndarray], seen: tuple) -> np.ndarray:
    odds = np.column_stack(
        [v.margins(seen[0]) * c[0] + c[1] for v, c in zip(views, calibrations, strict=True)]
    )
    return np.concatenate([*calibrations, _logistic(odds, seen[1])])


def surest(pool: DataFrame, known: DataFrame, taken: DataFrame, model: tuple, share: float, s: Settings) -> list:
    """(key, pupil, y): what each view is surest of among all unlabelled documents not taken yet."""
    shared = pool.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, meta = (np.frombuffer(x, np.float32) for x in shared.value[:2])
        a = shared.value[2]
        for batch in batches:
            odds = np.zeros((batch.num_rows, 2))
            for i, used, values, found in _rows(batch):
                odds[i] = _margin(text, used, values), 0.4 * float(meta[found].sum())
            p = _sigmoid(odds * [a[0], a[2]] + [a[1], a[3]])
            row, teacher = np.nonzero(np.maximum(p, 1 - p) >= s.sure)
            mine = p[row, teacher]
            y = (mine >= 0.5).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(j).take(pa.array(row)) for j in (0, 5)]
                + [pa.array((1 - teacher).astype(np.int32)), pa.array(y), pa.array(np.maximum(mine, 1 - mine))],
                names=["doc_id", "key", "pupil", "y", "sure"],
            )

    told = pool.mapInArrow(run, "doc_id long, key long, pupil int, y int, sure double")
    told = freeze(told.join(known.select("doc_id"), "doc_id", "left_anti").join(F.broadcast(taken), "key", "left_anti"))
    found: dict[int, tuple[int, int]] = {}
    for pupil in (1, 0):  # the text view chooses first
        for y, part in ((1, share), (0, 1 - share)):
            most = max(1, int(s.take * part))
            best = told.where((F.col("pupil") == pupil) & (F.col("y") == y)).select("key", "sure").distinct()
            if pupil == 0 and found:
                before = pool.sparkSession.createDataFrame([(k,) for k in found], "key long")
                best = best.join(F.broadcast(before), "key", "left_anti")
            for row in best.orderBy(F.desc("sure"), "key").limit(most).collect():
                found.setdefault(row.key, (pupil, y))
    return [(key, *x) for key, x in found.items()]


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> tuple[bytes, bytes, list[float]]:
    """Weights of the text view and the metadata view, and the seven calibration numbers."""
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    )
    given = _given(docs).where(F.col("doc_id").isNotNull() & (fold() != 0))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(sizes) < 2:
        p = 0.5 if not sizes else min(0.999, max(0.001, float(next(iter(sizes)))))
        zero = np.zeros(TEXT_FEATURES, np.float32), np.zeros((1 << META_BITS) + 1, np.float32)
        return zero[0].tobytes(), zero[1].tobytes(), [0, 0, 0, 0, 0, 0, float(np.log(p / (1 - p)))]
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000)) / 1e6
    rate = F.when(F.col("y") == 1, min(1.0, s.per_class / sizes[1])).otherwise(min(1.0, s.per_class / sizes[0]))
    # Bounded by the settings, so a broadcast; texts stay where they are read.
    labelled = given.join(F.broadcast(freeze(known.where(draw < rate))), "doc_id")
    pool = given.withColumn("key", F.xxhash64("doc_id", "text", "lang", "source", "n_chars"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "y", "pupil", "used", "values", "meta"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            doc_id, y, pupil = (batch.column(j).to_pylist() for j in (0, 5, 6))
            out = [
                (doc_id[i], y[i], pupil[i], used.astype("<i4").tobytes(), values.astype("<f4").tobytes(), meta.astype("<i4").tobytes())
                for i, used, values, meta in _rows(batch)
            ]
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "y", "pupil"], kind="stable").reset_index(drop=True)
        text = View(
            [(np.frombuffer(u, "<i4"), np.frombuffer(v, "<f4").astype(float)) for u, v in zip(pdf["used"], pdf["values"], strict=True)],
            TEXT_FEATURES,
        )
        meta = View([(np.frombuffer(m, "<i4"), np.full(len(m) // 4, 0.4)) for m in pdf["meta"]], (1 << META_BITS) + 1)
        known_ = {i: int(y) for i, y in enumerate(pdf["y"]) if pdf["pupil"][i] < 0}
        checks = {i: y for n, (i, y) in enumerate(known_.items()) if n % 4 == 3}
        labels_ = {i: y for i, y in known_.items() if i not in checks} or known_
        checks = checks or known_
        taught = [{i: int(y) for i, y in enumerate(pdf["y"]) if pdf["pupil"][i] == pupil} for pupil in (0, 1)]
        seen = ([*checks], np.array([*checks.values()], dtype=float))
        calibrations = _fit_views((text, meta), tuple(labels_ | x for x in taught), seen, s)
        numbers = _combined((text, meta), calibrations, seen)
        numbers = np.append(numbers, sum(labels_.values()) / len(labels_))
        return pd.DataFrame(
            {"text": [text.weights.tobytes()], "meta": [meta.weights.tobytes()], "numbers": [numbers.tolist()]}
        )

    def featured(rows: DataFrame) -> DataFrame:
        columns = rows.select("doc_id", "text", "lang", "source", "n_chars", "y", "pupil")
        return freeze(columns.mapInArrow(features, "doc_id long, y int, pupil int, used binary, values binary, meta binary"))

    spark = docs.sparkSession
    sample = featured(labelled.withColumn("pupil", F.lit(-1)))
    taken: list[tuple[int, int, int]] = []  # at most 2 * take a round
    for turn in range(s.rounds + 1):
        # The rows are bounded by the settings, so one task may fit both views.
        rows = (
            sample.groupBy(F.lit(0).alias("all"))
            .applyInPandas(lambda pdf: train(pdf), "text binary, meta binary, numbers array<double>")
            .collect()
        )
        if not rows:
            zero = np.zeros(TEXT_FEATURES, np.float32), np.zeros((1 << META_BITS) + 1, np.float32)
            return zero[0].tobytes(), zero[1].tobytes(), [0.0] * 7
        model = bytes(rows[0].text), bytes(rows[0].meta), list(rows[0].numbers)[:7]
        if turn == s.rounds:
            break
        before = spark.createDataFrame([x[:1] for x in taken], "key long")
        fresh = surest(pool, known, before, model, rows[0].numbers[7], s)
        if not fresh:
            break
        taken += fresh
        chosen = F.broadcast(spark.createDataFrame(fresh, "key long, pupil int, y int"))
        sample = sample.unionByName(featured(pool.join(chosen, "key").dropDuplicates(["key"])))
    return model


def _given(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def score(docs: DataFrame, model: tuple[bytes, bytes, list[float]]) -> DataFrame:
    """(doc_id, p_text, p_meta, score, quality_pred) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size, about 70 kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, meta = (np.frombuffer(x, np.float32) for x in shared.value[:2])
        a = shared.value[2]
        for batch in batches:
            odds = np.zeros((batch.num_rows, 2))
            for i, used, values, found in _rows(batch):
                odds[i] = _margin(text, used, values), 0.4 * float(meta[found].sum())
            odds = odds * [a[0], a[2]] + [a[1], a[3]]
            both = _sigmoid(odds @ a[4:6] + a[6])
            each = _sigmoid(odds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x) for x in (each[:, 0], each[:, 1], both)), pa.array((both >= 0.5).astype(np.int64))],
                names=["doc_id", "p_text", "p_meta", "score", "quality_pred"],
            )

    return _given(docs).mapInArrow(run, "doc_id long, p_text double, p_meta double, score double, quality_pred long")


def classify(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Fit on the labelled documents outside the held-out fold, score all documents."""
    return score(docs, fit(docs, labels, s))
