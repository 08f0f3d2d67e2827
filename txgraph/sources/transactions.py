"""Transaction sources: columnar and text files, Kafka, replayed directories."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from txgraph.schema import KEY_COLUMNS, LABELLED_SCHEMA, TRANSACTION_SCHEMA


def conform(
    df: DataFrame,
    mapping: Mapping[str, str] | None = None,
    schema: T.StructType = LABELLED_SCHEMA,
) -> DataFrame:
    """Rename and cast the columns of an external table to the event schema.

    ``mapping`` is target name -> source name; targets absent from the table become null.
    """
    mapping = dict(mapping or {})
    present = set(df.columns)
    return df.select(
        *[
            (
                F.col(mapping.get(f.name, f.name))
                if mapping.get(f.name, f.name) in present
                else F.lit(None)
            )
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def read_transactions(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    mapping: Mapping[str, str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read a Parquet, ORC, CSV or JSON transaction table into the event schema."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return conform(reader.format(fmt).load(path), mapping)


def parse_json(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to typed rows; text that does not parse gives an all-null row."""
    parsed = F.from_json(F.col(value).cast("string"), TRANSACTION_SCHEMA)
    return raw.select(parsed.alias("tx")).select("tx.*")


def valid_keys():
    """Predicate: all four identifiers and the event time are present."""
    predicate = F.lit(True)
    for name in [*KEY_COLUMNS, "event_time"]:
        predicate = predicate & F.col(name).isNotNull()
    return predicate


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows fit for the graph, and rows with a null identifier or event time."""
    return df.filter(valid_keys()), df.filter(~valid_keys())


def stream_source(
    spark: SparkSession,
    *,
    kafka_servers: str | None = None,
    topic: str = "transactions",
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    path: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType = TRANSACTION_SCHEMA,
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A streaming transaction table from Kafka or from a replayed directory.

    ``starting_offsets="earliest", fail_on_data_loss=False`` gives the tolerant consumer.
    Kafka needs the public connector package on the classpath.
    """
    if kafka_servers:
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", kafka_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .load()
        )
        return parse_json(raw)
    if path is None:
        raise ValueError("name Kafka servers or a directory")
    text = fmt == "json-lines"
    reader = spark.readStream.format("text" if text else fmt)
    if not text:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    loaded = reader.load(path)
    return parse_json(loaded) if text else loaded
