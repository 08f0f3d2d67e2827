"""Session construction and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager, suppress

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

# Upper bound on the rows of anything this package broadcasts by hint.
MAX_BROADCAST_ROWS = 200_000


def build_session(
    app: str = "txgraph", master: str | None = None, **conf: str
) -> SparkSession:
    """Create a session with the settings the operators rely on.

    Sizes (shuffle partitions, memory) are left to the cluster unless passed in.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Drop checkpoint files once nothing refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder of the session; set one only where there is none.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; a machine-local
    fallback is taken for ``local`` masters alone.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="txgraph-ck-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def freeze(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint that survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables of an iteration in a folder of their own below the checkpoint folder.

    A checkpoint keeps the size estimate of its plan; where a round joins a state with itself,
    the estimates multiply from round to round until planning takes longer than the work. A
    written table has the size of its files. The folder goes when the block ends; where Python
    has no access to the store, it stays.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        ensure_checkpoint_dir(spark)
        folder = spark.sparkContext.getCheckpointDir().rstrip("/")
        self.spark, self.uri, self.count = spark, f"{folder}/{purpose}-{uuid.uuid4().hex}", 0

    def __enter__(self) -> Scratch:
        return self

    def write(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path, schema = f"{self.uri}/{self.count}", df.schema
        df.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def __exit__(self, *_) -> None:
        with suppress(pa.ArrowInvalid, OSError):
            fs, path = pafs.FileSystem.from_uri(self.uri)
            fs.delete_dir(path)


@contextmanager
def session_conf(spark: SparkSession, **conf: str):
    """Set SQL settings (dots written as ``__``) for the length of a block."""
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
