"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import hashlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txgraph.session import MAX_BROADCAST_ROWS, ensure_checkpoint_dir, freeze

__all__ = [
    "TEXTS_PER_BATCH", "chunks", "freeze", "frugal", "new_texts", "numbered", "partitions_for", "read_table", "scratch_uri", "small",
    "discard", "written",
]

# Rows of whole texts that go to a Python worker at once; bounds the memory on both sides.
TEXTS_PER_BATCH = "2000"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """URI of the folder that the session names for files all executors share."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def scratch_uri(spark: SparkSession, purpose: str) -> str:
    """A new sub-folder of the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows as a Parquet table below the shared folder."""
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def discard(uri: str) -> None:
    """Delete a scratch folder; where Python has no access to the store, it stays."""
    with suppress(pa.ArrowInvalid, OSError):
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.delete_dir(path)


def partitions_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Enough partitions for ``rows``, and never fewer than the session's setting."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // rows_per_task), 1)


def chunks(
    column: pa.Array, max_bytes: int = 2 << 20
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole texts of about ``max_bytes`` bytes.

    Yields (first row, end row, the UTF-8 bytes of these rows, row offsets into them).
    Nulls count as empty texts. A text longer than ``max_bytes`` is a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, off_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(off_buffer, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + max_bytes, side="right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, after which the worker gives the memory it freed back.

    Workers wait for further tasks beside the executor's JVM; what their allocators keep is taken
    from that of the stages that follow, even if these have no Python.
    """

    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with suppress(AttributeError, OSError):  # where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return task


def new_texts(texts: list[bytes], uids: list[int], seen: dict[bytes, int]) -> list[bool]:
    """Which texts are new in this task, or of a smaller uid than all their copies so far.

    The copy of smallest uid always is among them. The memory of digests is bounded.
    """
    out = []
    for text, uid in zip(texts, uids, strict=True):
        digest = hashlib.blake2b(text, digest_size=16).digest()
        if len(seen) > 100_000:
            seen.clear()
        least = seen.get(digest)
        new = least is None or uid < least
        if new:
            seen[digest] = uid
        out.append(new)
    return out


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(uid, text) in the order of documents; the numbering if ids could not serve as uid; and
    (uid, doc_id, text_hash) of every document, once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    told = freeze(
        given.select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id").agg(
            F.min("h").alias("low"), F.max("h").alias("high")
        )
    )
    if told.where("doc_id IS NULL OR low <> high").limit(1).count() == 0:
        keys = told.select(F.col("doc_id").alias("uid"), "doc_id", F.col("low").alias("text_hash"))
        return given.withColumnRenamed("doc_id", "uid"), None, keys
    pairs = given.select("doc_id", F.xxhash64("text").alias("h")).distinct()
    ordered = pairs.orderBy(F.col("doc_id").asc_nulls_last(), "h").rdd.zipWithIndex()
    schema = "d long, h long, uid long"
    numbers = freeze(docs.sparkSession.createDataFrame(ordered.map(lambda x: (*x[0], x[1])), schema))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.xxhash64("text") == F.col("h"))
    keys = numbers.select("uid", F.col("d").alias("doc_id"), F.col("h").alias("text_hash"))
    return given.join(numbers, same).select("uid", "text"), numbers, keys


def small(df: DataFrame, rows: int) -> DataFrame:
    """To be broadcast if its counted rows stay within the package's bound, else shuffled."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df
