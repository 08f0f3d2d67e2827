"""Best-fit packing of documents into bins of fixed capacity, under conflicts.

A document longer than a bin gives full bins of its own and a remainder; remainders are packed
by decreasing length. Bins are ordered by residual space. The successor search starts at the
tightest bin that has room and goes on until one is compatible: a bin may hold one document of
a duplicate cluster, and ``per_source`` of one source. Bins carry these as bitmaps, a plane for
each allowed document of a source.

Rows are dealt to shards of bounded size by hash; each shard is packed by one task. Rows of one
cluster or source spread over all shards, so no hot group meets in one.

Tokens are words: runs of bytes above 0x20 in the UTF-8 text. Null and empty texts have no
tokens and no bin (one row with null bin). A null source never conflicts. Repeated rows are
packed one by one; they share a cluster, so never a bin. ``pack_apart`` takes near copies
(components of the Jaccard join) as clusters. Ties go by input order.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.llm import parity
from txgraph.llm.common import TEXTS_PER_BATCH, chunks, freeze, partitions_for
from txgraph.session import session_conf

OUT = "doc_id long, piece int, n_tokens long, bin_id string, start long"


def words_in(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The number of words of each of several texts, which lie in ``data`` one after another."""
    inside = data > 0x20
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = inside[cuts]
    return np.diff(np.searchsorted(np.flatnonzero(begins), offsets))


def word_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, source, cluster, n_tokens) of every row, the text read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            for first, end, data, offsets in chunks(batch.column(3), 512 << 10):
                counts[first:end] = words_in(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts)], names=["doc_id", "source", "cluster", "n_tokens"]
            )

    return docs.select("doc_id", "source", "cluster", "text").mapInArrow(
        run, "doc_id long, source string, cluster long, n_tokens long"
    )


class Bins:
    """Open bins in order of residual space."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []  # (residual, bin)
        self.clusters: list[int] = []
        self.planes: list[list[int]] = []

    def place(self, need: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and start of a piece; ``source`` and ``cluster`` are bits, 0 for no conflict."""
        at = bisect_left(self.order, (need, -1))
        while at < len(self.order):
            residual, number = self.order[at]
            if not self.clusters[number] & cluster and not self.planes[number][-1] & source:
                del self.order[at]
                break
            at += 1
        else:
            residual, number = self.capacity, len(self.clusters)
            self.clusters.append(0)
            self.planes.append([0] * self.per_source)
        self.clusters[number] |= cluster
        carry = source
        for level, plane in enumerate(self.planes[number]):
            self.planes[number][level], carry = plane | carry, plane & carry
        if residual > need:
            insort(self.order, (residual - need, number))
        return number, self.capacity - residual


def pack_shard(pdf: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """Bins of one shard's remainders (columns source, cluster, need, row)."""
    pdf = pdf.sort_values(["need", "row"], ascending=[False, True], kind="stable")
    shared = pdf["cluster"].value_counts()
    cluster_bit = {c: 1 << i for i, c in enumerate(shared.index[shared > 1])}
    source_bit = {x: 1 << i for i, x in enumerate(sorted(pdf["source"].dropna().unique()))}
    bins, numbers, starts = Bins(capacity, per_source), [], []
    for need, source, cluster in zip(pdf["need"], pdf["source"], pdf["cluster"], strict=True):
        number, start = bins.place(int(need), source_bit.get(source, 0), cluster_bit.get(cluster, 0))
        numbers.append(number)
        starts.append(start)
    return pdf.assign(number=numbers, start=starts)


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    per_source: int = 4,
    shard_rows: int = 8192,
    cluster: str | None = None,
    clusters: DataFrame | None = None,
) -> DataFrame:
    """(doc_id, piece, n_tokens, bin_id, start) of every piece of every document.

    ``cluster`` names a column with the duplicate cluster; ``clusters`` is a table of them by
    document, as ``parity.clusters`` gives it. Without either, equal texts are a cluster.
    """
    same = F.col(cluster).cast("long") if cluster else F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        same.alias("cluster"),
        F.col("text").cast("string").alias("text"),
    )
    with session_conf(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        counted = freeze(word_counts(given).withColumn("row", F.monotonically_increasing_id()))
    if clusters is not None:  # by null-safe id and hash of the text, which the column holds so far
        told = clusters.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "component")
        joined = counted.join(told, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("cluster") == F.col("h")))
        counted = freeze(joined.select("doc_id", "source", F.col("component").alias("cluster"), "n_tokens", "row"))
    return _packed(counted, capacity, per_source, shard_rows)


def _packed(counted: DataFrame, capacity: int, per_source: int, shard_rows: int) -> DataFrame:
    """The pieces of rows (doc_id, source, cluster, n_tokens, row), all their words counted."""
    shards = -(-counted.count() // shard_rows)
    whole = (F.col("n_tokens") / capacity).cast("long")
    name = F.concat(F.lit("f"), F.col("row").cast("string"), F.lit("-"), F.col("piece").cast("string"))
    full = (
        counted.where(F.col("n_tokens") >= capacity)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), (whole - 1).cast("int"))))
        .select("doc_id", "piece", F.lit(capacity).cast("long").alias("n_tokens"), name.alias("bin_id"), F.lit(0).cast("long").alias("start"))
    )
    none = counted.where("n_tokens = 0").select(
        "doc_id", F.lit(0).alias("piece"), "n_tokens", F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("long").alias("start")
    )
    rest = counted.withColumn("need", F.col("n_tokens") % capacity).where("need > 0").select(
        F.col("doc_id").cast("string"), "source", "cluster", "need", "row", whole.cast("int").alias("piece"),
        F.pmod(F.xxhash64("row"), F.lit(max(1, shards))).alias("shard"),
    )

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        done = pack_shard(pdf, capacity, per_source)
        return pd.DataFrame(
            {
                "doc_id": done["doc_id"],
                "piece": done["piece"],
                "n_tokens": done["need"],
                "bin_id": [f"s{key[0]}-{n}" for n in done["number"]],
                "start": done["start"],
            }
        )

    tasks = partitions_for(counted.sparkSession, shards, 1)
    packed = rest.repartition(tasks, "shard").groupBy("shard").applyInPandas(run, OUT.replace("doc_id long", "doc_id string"))
    packed = packed.withColumn("doc_id", F.col("doc_id").cast("long"))
    return full.unionByName(none).unionByName(packed)


def pack_apart(docs: DataFrame, capacity: int = 2048, per_source: int = 4, shard_rows: int = 8192) -> DataFrame:
    """``pack`` with the components of near copies as duplicate clusters.

    The words are counted where the join reads the texts; rows meet their counts by the id, and
    by the text's hash too only where ids do not tell all documents apart.
    """
    found = parity.clusters(docs, words_in)
    doc_id, text_hash = parity.row_key()
    rows = docs.select(doc_id.alias("doc_id"), F.col("source").cast("string").alias("source"), text_hash.alias("th"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    told = found.select(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h"),
        F.col("component").alias("cluster"), F.col("measured").alias("n_tokens"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("d"))
    if not found.where("doc_id IS NULL OR doc_id <> uid").isEmpty():
        same = same & (F.col("th") == F.col("h"))
    counted = freeze(rows.join(told, same).select("doc_id", "source", "cluster", "n_tokens", "row"))
    return _packed(counted, capacity, per_source, shard_rows)
