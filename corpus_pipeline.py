"""Corpus pipeline: language ID, near-duplicate join, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet
into the shared folder and reads again as the next stage's documents. All but the last return
the columns of ``documents``; the last one returns the packed pieces.

Columns beyond those of ``documents`` pass through unchanged, whatever their names. Null and empty
texts have no language and go in the first stage; if no document tells its language, there is
nothing to learn from and all stay. Null ids are documents of their own. An empty table gives an
empty one. Rows that repeat an id and its text are one document from the second stage on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txgraph.llm import langid, packing, parity, pii, suffix
from txgraph.llm.common import freeze, read_table, scratch_uri, small

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
REST = "columns beyond those of a document"
LEAST_SCORE = 0.5  # of the language, below which a document goes
# The stages as a whole are no SQL: a model is fitted and bins are filled one by one.
ORACLE_SQL = None


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keeps_columns(stage: Stage) -> Stage:
    """The stage sees the columns of a document; all others travel as one struct and come back."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in DOCUMENT]
        if not others:
            return stage(spark, docs, sf_dir)
        known = [c for c in docs.columns if c in DOCUMENT]
        out = stage(spark, docs.select(*known, F.struct(*others).alias(REST)), sf_dir)
        if REST not in out.columns:
            return out
        return out.select(*[F.col(c) if c in known else F.col(f"`{REST}`")[c].alias(c) for c in docs.columns])

    return run


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars stated anew for the text at hand."""
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long"))


@keeps_columns
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of no recognisable language; texts stay as they are."""
    known = docs.where((langid.fold() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    if known.isEmpty():
        return docs
    model = langid.fit(docs.where(langid.fold() != 0))
    told = langid.annotate(docs, model)
    kept = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return told.where(kept).select(docs.columns)


@keeps_columns
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of smallest id, null last; equal rows once."""
    found = parity.clusters(docs)
    gone = freeze(found.where("uid <> component").select(F.col("doc_id").alias("gone"), F.col("text_hash").alias("gone_hash")))
    doc_id, text_hash = parity.row_key()
    same = doc_id.eqNullSafe(F.col("gone")) & (text_hash == F.col("gone_hash"))
    kept = docs.join(small(gone, gone.count()), same, "left_anti")
    return kept if found.count() == docs.count() else kept.dropDuplicates(["doc_id", "text"])


@keeps_columns
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of 100 bytes or more that occur earlier; no document goes."""
    return _sized(suffix.strip(docs))


@keeps_columns
def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data as placeholders, disclosing terms generalised or removed; no document goes."""
    return _sized(pii.sanitise(docs).select(docs.columns))


@keeps_columns
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document in bins of 2048 words: (doc_id, piece, n_tokens, bin_id, start)."""
    return packing.pack_apart(docs, capacity=2048, per_source=4)


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("pii", sanitise),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_uri(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
