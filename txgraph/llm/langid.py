"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, characters other than letters count as blanks, and n-grams of one to
three characters are hashed to a fixed number of features. Document frequencies come from all
training documents. The weights are fitted by follow-the-regularised-leader with L1 and L2
penalties on a bounded sample (``per_language`` documents of each language, chosen by hash),
of which a fifth is kept back for the temperature.

A null text, or one without a letter, is ``und`` with score 0; so is every text if there is
nothing to learn from. Null languages are not learned. Long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDETERMINED = "und"
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_LETTERS: list[np.ndarray] = []


@dataclass(frozen=True)
class Settings:
    bits: int = 15
    per_language: int = 1000
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 1e-3


@dataclass
class Model:
    """Languages in order, (features + 1 for the bias) x languages weights, idf, temperature."""

    languages: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None
    idf: np.ndarray | None = None
    temperature: float = 1.0


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def counts(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(features, 1 + log of their counts) of a text; None without a letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return None
    padded = np.zeros(len(points) + 2, dtype=np.uint32)
    padded[1:-1] = np.where(letter, points, 0)
    shift = np.uint32(32 - bits)
    one = padded * MIX[0]
    two = one[:-1] + padded[1:] * MIX[1]
    three = two[:-1] + padded[2:] * MIX[2]
    grams = np.concatenate([(x * MIX[1]) >> shift for x in (one, two, three)])
    found = np.bincount(grams, minlength=1 << bits)
    used = np.flatnonzero(found)
    return used, (1.0 + np.log(found[used])).astype(np.float32)


def _vector(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> np.ndarray:
    values = found[1] * idf[found[0]]
    return values / max(float(np.sqrt((values * values).sum())), 1e-12)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow the regularised leader for softmax regression; one row per feature."""

    def __init__(self, features: int, classes: int, s: Settings):
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))
        self.s = s

    def weights(self, rows) -> np.ndarray:
        z, n, s = self.z[rows], self.n[rows], self.s
        shrunk = np.sign(z) * s.l1 - z
        return np.where(np.abs(z) <= s.l1, 0.0, shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def learn(self, rows: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(rows)
        error = _softmax(values @ w)
        error[label] -= 1.0
        gradient = np.outer(values, error)
        grown = self.n[rows] + gradient**2
        sigma = (np.sqrt(grown) - np.sqrt(self.n[rows])) / self.s.alpha
        self.z[rows] += gradient - sigma * w
        self.n[rows] = grown


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden-section search."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean())

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def document_frequencies(docs: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """Documents that hold each feature, over all rows, and the number of documents with any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << bits) + 1, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                found = counts(value.as_py(), bits)
                if found is not None:
                    total[found[0]] += 1
                    total[-1] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["feature", "n"]
        )

    parts = docs.select(F.col("text").cast("string")).mapInArrow(run, "feature long, n long")
    total = np.zeros((1 << bits) + 1, dtype=np.int64)
    for row in parts.groupBy("feature").agg(F.sum("n").alias("n")).collect():  # at most 2^bits + 1
        total[row.feature] = row.n
    return total[:-1], int(total[-1])


def fit(rows: DataFrame, s: Settings = Settings()) -> Model:
    """Learn from ``rows`` (doc_id, text, lang); rows of null language are left out."""
    rows = rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model()
    df, n = document_frequencies(rows, s.bits)
    idf = (np.log((1.0 + n) / (1.0 + df)) + 1.0).astype(np.float32)
    # A hash of the row decides, at a rate that gives the wanted number of each language.
    rate = F.create_map(
        *[F.lit(x) for lang in languages for x in (lang, min(1.0, s.per_language / sizes[lang]))]
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) / 1e6
    sample = rows.where(draw < rate[F.col("lang")])
    bits, context = s.bits, rows.sparkSession.sparkContext

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = counts(text, bits)
                if found is not None:
                    out.append((doc_id or 0, lang, found[0].astype("<u4").tobytes(), found[1].tobytes()))
            names = ["doc_id", "lang", "rows", "tf"]
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary()]
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    shared = context.broadcast(idf)

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        own_idf = shared.value
        order = {lang: i for i, lang in enumerate(languages)}
        pdf = pdf.sort_values("doc_id", kind="stable")
        items = []
        for lang, rows_, tf in zip(pdf["lang"], pdf["rows"], pdf["tf"], strict=True):
            found = (np.frombuffer(rows_, "<u4").astype(np.int64), np.frombuffer(tf, np.float32))
            index = np.append(found[0], 1 << bits)
            items.append((index, np.append(_vector(found, own_idf), 0.1), order[lang]))
        shuffle = np.random.default_rng(7).permutation(len(items))
        kept_back = set(shuffle[: len(items) // 5].tolist()) if len(items) >= 50 else set()
        model = Ftrl((1 << bits) + 1, len(languages), s)
        for epoch in range(s.epochs):
            for i in np.random.default_rng(epoch).permutation(len(items)):
                if int(i) not in kept_back:
                    model.learn(*items[i])
        weights = model.weights(slice(None)).astype(np.float32)
        tests = [items[i] for i in sorted(kept_back)]
        logits = np.array([x @ weights[r] for r, x, _ in tests]).reshape(len(tests), len(languages))
        heat = temperature(logits, np.array([y for _, _, y in tests], dtype=int))
        return pd.DataFrame({"weights": [weights.tobytes()], "temperature": [heat]})

    # The sample is bounded by its settings, so one task may fit the weights.
    fitted = (
        sample.mapInArrow(features, "doc_id long, lang string, rows binary, tf binary")
        .groupBy(F.lit(0).alias("all"))
        .applyInPandas(lambda pdf: train(pdf), "weights binary, temperature double")
        .collect()
    )
    if not fitted:
        return Model()
    weights = np.frombuffer(fitted[0].weights, np.float32).reshape((1 << bits) + 1, len(languages))
    return Model(languages, weights, idf, fitted[0].temperature)


def predict(docs: DataFrame, model: Model, bits: int = Settings.bits) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; only the text is read."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return annotate(given, model, bits).select("doc_id", "lang_pred", "score")


def annotate(docs: DataFrame, model: Model, bits: int = Settings.bits) -> DataFrame:
    """All columns of ``docs`` and lang_pred and score (which replace columns of these names)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^bits x languages floats
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            names, scores = [], []
            for value in batch.column(at):
                found = counts(value.as_py(), bits) if m.languages else None
                if found is None:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                logits = _vector(found, m.idf) @ m.weights[found[0]] + 0.1 * m.weights[-1]
                p = _softmax(logits.astype(np.float64) / m.temperature)
                best = int(p.argmax())
                names.append(m.languages[best])
                scores.append(float(min(1.0, p[best])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def identify(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Learn from the folds 1 to 4 of labelled rows, predict all rows; fold 0 is held out."""
    model = fit(docs.where(fold() != 0), s)
    out = predict(docs, model, s.bits)
    return out.select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")
