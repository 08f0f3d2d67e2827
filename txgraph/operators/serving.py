"""Online feature view: latest vector per transaction, and look-ups on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txgraph.schema import ALL_FEATURES


def latest_vectors(versions: DataFrame, key: str = "tx_id", version: str = "batch_id") -> DataFrame:
    """Last write wins: the row of the highest version per key, by partial aggregation."""
    rest = [c for c in versions.columns if c not in (key, version)]
    newest = F.max_by(F.struct(*rest), F.col(version)).alias("row")
    return (
        versions.groupBy(key)
        .agg(F.max(version).alias(version), newest)
        .select(key, version, "row.*")
    )


def lookup(view: DataFrame, keys: DataFrame, key: str = "tx_id") -> DataFrame:
    """Rows of the view for a set of keys. The key filter prunes a view bucketed by key."""
    return view.join(keys.select(key).distinct(), key, "left_semi")


def payload(matrix: DataFrame, names: list[str] | None = None) -> DataFrame:
    """tx_id and the vector as a name-to-value map."""
    names = names or [c for c in ALL_FEATURES if c in matrix.columns]
    pairs = [x for n in names for x in (F.lit(n), F.col(n).cast("double"))]
    return matrix.select("tx_id", F.create_map(*pairs).alias("features"))


def parity_mismatches(training: DataFrame, serving: DataFrame) -> DataFrame:
    """Vectors present in one path but not, or not equally, in the other."""
    columns = ["tx_id", *[c for c in ALL_FEATURES if c in training.columns]]
    left, right = training.select(*columns), serving.select(*columns)
    return (
        left.exceptAll(right)
        .withColumn("side", F.lit("training"))
        .unionByName(right.exceptAll(left).withColumn("side", F.lit("serving")))
    )
