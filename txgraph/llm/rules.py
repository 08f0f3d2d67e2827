"""Quality rules whose cutoffs are certified on labelled documents.

A rule is a ratio of two counts of a text, in thousandths, and a list of cutoffs from lenient to
strict; a text above the cutoff is rejected. For each stratum and rule, the good documents of the
labelled holdout that pass the base rules are counted above every cutoff. With k of n good
documents rejected, "more than the limit of the good ones are rejected" is refuted by the exact
binomial tail P(Bin(n, limit) <= k), which is the test behind the Clopper-Pearson bound. Cutoffs
are tested from lenient to strict and the last one before the first failure is taken (fixed
sequence, k only grows), at a level divided by the number of strata and rules (Bonferroni). So with
a chance of 1 - alpha no rule rejects more than its limit of the good documents of any stratum.
Strata without enough labels to certify a rule do not use it.

The cutoffs to choose from are fixed beforehand, so the whole labelled set serves as holdout.
Counts cover all documents; every text is read once, and the counts go on as a small table.

Words are runs of bytes other than blank and \\x09-\\x0D, told apart by 64-bit hashes within a text.
A null text has no words. A null stratum is a stratum of its own. Labels that are null, or differ
for one id, and documents of null id are not used in the holdout; repeated rows of one id count
once there if their counts agree. Repeated documents give a row each. Without labels or documents,
only the base rules apply.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txgraph.llm.common import freeze, small

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Rejects a text if floor(1000 * over / under) is above the cutoff."""

    name: str
    over: str
    under: str
    cutoffs: Sequence[int]  # lenient to strict

    def value(self) -> Column:
        ratio = F.floor(1000 * F.col(self.over) / F.greatest(F.col(self.under), F.lit(1)))
        # Beyond the most lenient cutoff all values are alike.
        return F.least(ratio, F.lit(max(self.cutoffs) + 1)).cast("int")


RULES = (
    Rule("symbols", "n_symbols", "n_words", range(1000, 9, -10)),
    Rule("dup_lines", "n_dup_lines", "n_lines", range(1000, 9, -10)),
    Rule("repeats", "n_repeat_words", "n_words", range(500, 4, -5)),
    Rule("long_words", "word_chars", "n_words", range(20_000, 3_999, -100)),
    Rule("short_words", "n_words", "word_chars", range(1000, 99, -5)),
)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = h[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ (h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) << np.uint64(1))
    window = (window ^ (window >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    covered = np.zeros(len(words), dtype=bool)
    for side in (order[1:][same], order[:-1][same]):
        for shift in range(3):
            covered[side + shift] = True
    return int(covered.sum())


def count(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return (0,) * len(COUNTS)
    blanks = len(data) - len(data.translate(None, SPACE))
    seen, lines, again = set(), 0, 0
    for line in data.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            again += line in seen
            seen.add(line)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), len(text) - blanks, symbols, lines, again, repeat_words(words)


def counts(docs: DataFrame, stratum_column: str) -> DataFrame:
    """doc_id, stratum and the counts of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = np.array([count(text.as_py()) for text in batch.column(2)], np.int64).reshape(-1, len(COUNTS))
            columns = [batch.column(0), batch.column(1), *(pa.array(told[:, i]) for i in range(len(COUNTS)))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "stratum", *COUNTS])

    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(stratum_column).cast("string").alias("stratum"),
        F.col("text").cast("string").alias("text"),
    )
    return given.mapInArrow(run, "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed(least_words: int = 50, repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed exactly from its largest term down; 1 from the mean on."""
    if k >= n * p:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    term = math.exp(log + k * math.log(p) + (n - k) * math.log1p(-p))
    total, ratio = 0.0, (1 - p) / p
    for j in range(k, -1, -1):
        total += term
        term *= j / (n - j + 1) * ratio
        if term < total * 1e-18:
            break
    return min(1.0, total)


def certify(
    holdout: DataFrame, rules: Sequence[Rule] = RULES, limit: float = 0.02, alpha: float = 0.05
) -> DataFrame:
    """stratum, rule, cutoff, n, k: the strictest certified cutoff of each stratum and rule.

    ``holdout`` has the stratum and the counts of the good documents.
    """
    spark = holdout.sparkSession
    values = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), r.value().alias("value")) for r in rules]))
    found = freeze(holdout.select("stratum", values.alias("x")).groupBy("stratum", "x.rule", "x.value").count())
    level = alpha / max(1, found.select("stratum").distinct().count() * len(rules))
    grid = spark.createDataFrame([(r.name, c) for r in rules for c in r.cutoffs], "rule string, cutoff int")
    # Values are cut at the most lenient cutoff, so a stratum has a few hundred rows per rule.
    tests = found.join(F.broadcast(grid), "rule").groupBy("stratum", "rule", "cutoff").agg(
        F.sum("count").alias("n"), F.sum(F.when(F.col("value") > F.col("cutoff"), F.col("count")).otherwise(0)).alias("k")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            tails = [binomial_tail(int(k), int(n), limit) for k, n in zip(rows.k, rows.n, strict=True)]
            yield rows[np.array(tails, dtype=float) <= level]

    passed = tests.mapInPandas(run, tests.schema)
    best = F.min(F.struct("cutoff", "n", "k")).alias("b")
    return passed.groupBy("stratum", "rule").agg(best).select("stratum", "rule", "b.cutoff", "b.n", "b.k")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule] = RULES,
    limit: float = 0.02,
    alpha: float = 0.05,
    stratum_column: str = "lang",
) -> DataFrame:
    """Every document's counts, ``base_failed``, ``rejected_by`` (names of rules) and ``kept``."""
    told = freeze(counts(docs, stratum_column).withColumn("base_failed", base_failed()))
    good = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"), F.count("quality").alias("n"))
        .where("low = 1 AND high = 1 AND doc_id IS NOT NULL")
        .select("doc_id")
    )
    holdout = told.where("NOT base_failed").join(good, "doc_id", "left_semi")
    chosen = certify(holdout.select("doc_id", "stratum", *COUNTS).distinct(), rules, limit, alpha)
    by_rule = [F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"cut_{r.name}") for r in rules]
    wide = freeze(chosen.groupBy(F.col("stratum").alias("of")).agg(*by_rule))
    over = [F.when(r.value() > F.col(f"cut_{r.name}"), F.lit(r.name)) for r in rules]
    judged = told.join(small(wide, wide.count()), F.col("stratum").eqNullSafe(F.col("of")), "left")
    judged = judged.withColumn("rejected_by", F.array_compact(F.array(*over)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).select(
        "doc_id", "stratum", *COUNTS, "base_failed", "rejected_by", "kept"
    )
