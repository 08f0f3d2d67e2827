"""Exploratory profile: columns, moments, quantiles, frequencies, histograms, densities."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from txgraph.operators.prefix import exact_quantiles
from txgraph.schema import CHANNEL_CODES, GRAPH_FEATURES, TX_TYPE_CODES


def column_kinds(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and string column names."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return numeric, text


def unpivot(df: DataFrame, columns: Sequence[str], cast: str, keep: Sequence[str] = ()) -> DataFrame:
    """Long form: kept columns, column, value."""
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias("value")) for c in columns
    ]
    return df.select(*keep, F.explode(F.array(*pairs)).alias("cell")).select(
        *keep, "cell.column", "cell.value"
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return unpivot(counted, df.columns, "bigint").withColumnRenamed("value", "n_null")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in full."""
    distinct = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return distinct.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates")
    )


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max, and bias-corrected skewness and kurtosis.

    The moments take one scan of all columns; the quartiles are exact.
    """
    columns = list(columns or column_kinds(df)[0])
    cells = unpivot(df, columns, "double").where("value is not null")
    moments = cells.groupBy("column").agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.skewness("value").alias("g1"),
        F.kurtosis("value").alias("g2"),
    )
    quartiles = exact_quantiles(cells, "value", [0.25, 0.5, 0.75], ["column"])
    n = F.col("count").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(
        n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + F.lit(6.0))
    )
    return moments.join(quartiles, "column").select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        F.col("quantiles")[0].alias("p25"),
        F.col("quantiles")[1].alias("p50"),
        F.col("quantiles")[2].alias("p75"),
        "max",
        skew.alias("skewness"),
        kurt.alias("kurtosis"),
    )


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top value (smallest on a tie) and its frequency per string column."""
    columns = list(columns or column_kinds(df)[1])
    counted = (
        unpivot(df, columns, "string")
        .where("value is not null")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    return counted.groupBy("column").agg(
        F.sum("n").cast("bigint").alias("count"),
        F.count("*").alias("unique"),
        F.min(F.struct((-F.col("n")).alias("neg"), "value")).getField("value").alias("top"),
        F.max("n").alias("freq"),
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Class counts and percentages."""
    counted = frequencies(df, column)
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("pct", 100.0 * F.col("n") / total)


def rate_by(df: DataFrame, column: str, label: str = "is_fraud") -> DataFrame:
    """Mean label per category, highest first."""
    return df.groupBy(column).agg(F.avg(label).alias("rate")).orderBy(F.desc("rate"), column)


def _bounded(df: DataFrame, value: Column) -> DataFrame:
    """``v`` with its overall smallest and largest value beside it (one-row subquery)."""
    rows = df.withColumn("v", value).where("v is not null")
    # A constant column gets a range of width one around its value.
    half = F.when(F.min("v") == F.max("v"), 0.5).otherwise(0.0)
    bounds = rows.agg(
        F.struct((F.min("v") - half).alias("lo"), (F.max("v") + half).alias("hi")).alias("b")
    )
    return rows.withColumn("b", bounds.scalar())


def _bin(bins: int) -> Column:
    """Equal-width bin number; the last bin is closed on the right."""
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    return F.least(
        F.lit(bins - 1), F.floor((F.col("v") - F.col("b.lo")) / width).cast("int")
    ).cast("bigint")


def histogram(df: DataFrame, value: Column, bins: int = 60) -> DataFrame:
    """Counts per equal-width bin: bin, left, n (bins without rows are absent)."""
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    return (
        _bounded(df, value)
        .select(_bin(bins).alias("bin"), F.col("b.lo").alias("lo"), width.alias("w"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.first("lo").alias("lo"), F.first("w").alias("w"))
        .select("bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("left"), "n")
    )


def class_histogram(df: DataFrame, value: Column, label: str, bins: int = 50) -> DataFrame:
    """Histogram density per class: bin counts over (class rows times bin width)."""
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    binned = (
        _bounded(df, value)
        .select(label, _bin(bins).alias("bin"), width.alias("w"))
        .groupBy(label, "bin")
        .agg(F.count("*").alias("n"), F.first("w").alias("w"))
    )
    totals = binned.groupBy(label).agg(F.sum("n").alias("total"))
    return binned.join(totals, label).select(
        label, "bin", "n", (F.col("n") / (F.col("total") * F.col("w"))).alias("density")
    )


def kernel_density(
    df: DataFrame, value: Column, label: str, points: int = 200, cut: float = 3.0
) -> DataFrame:
    """Gaussian kernel density per class on an even grid, Scott bandwidth.

    Equal values are counted first; each distinct value then adds its weighted kernel to
    the grid points of its class in one partial aggregation. Columns: class, point, x, density.
    """
    counted = (
        df.select(F.col(label).alias("class"), value.alias("v"))
        .where("v is not null")
        .groupBy("class", "v")
        .agg(F.count("*").alias("w"))
    )
    rows = df.select(F.col(label).alias("class"), value.alias("v")).where("v is not null")
    stats = rows.groupBy("class").agg(
        F.count("*").alias("n"),
        (F.stddev_samp("v") * F.pow(F.count("*").cast("double"), F.lit(-0.2))).alias("bw"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
    )
    # One row per class of a label: a handful.
    grid = F.broadcast(
        stats.where("bw > 0").select(
            "class",
            "n",
            "bw",
            (F.col("lo") - cut * F.col("bw")).alias("start"),
            ((F.col("hi") - F.col("lo") + 2 * cut * F.col("bw")) / (points - 1)).alias("step"),
        )
    )
    x = F.col("start") + F.col("point") * F.col("step")
    z = (x - F.col("v")) / F.col("bw")
    kernel = F.exp(-0.5 * z * z) / (math.sqrt(2 * math.pi) * F.col("bw") * F.col("n"))
    return (
        counted.join(grid, "class")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .groupBy("class", "point")
        .agg(F.min(x).alias("x"), F.sum(F.col("w") * kernel).alias("density"))
    )


def class_separation(
    df: DataFrame, features: Sequence[str] = GRAPH_FEATURES, label: str = "is_fraud"
) -> DataFrame:
    """Mean of each feature by class and their ratio; a zero mean gives a null ratio."""
    means = df.agg(
        *[F.avg(F.when(F.col(label) == c, F.col(f))).alias(f"{f}__{c}") for f in features for c in (0, 1)]
    )
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f"{f}__0").alias("legitimate"),
            F.col(f"{f}__1").alias("fraud"),
        )
        for f in features
    ]
    return (
        means.select(F.explode(F.array(*cells)).alias("c"))
        .select("c.*")
        .withColumn("ratio", F.try_divide(F.col("fraud"), F.col("legitimate")))
        .orderBy(F.desc_nulls_last("ratio"), "feature")
    )


def one_hot(
    df: DataFrame, categories: Mapping[str, tuple[str, Sequence[str]]] | None = None
) -> DataFrame:
    """0/1 columns per known category: ``type_*`` and ``chan_*``; the schema is static."""
    categories = categories or {
        "tx_type": ("type", list(TX_TYPE_CODES)),
        "channel": ("chan", list(CHANNEL_CODES)),
    }
    columns = [
        F.coalesce(F.col(column) == value, F.lit(False)).cast("int").alias(f"{prefix}_{value}")
        for column, (prefix, values) in categories.items()
        for value in values
    ]
    return df.select(*[c for c in df.columns if c not in categories], *columns)


def profile(df: DataFrame, label: str = "is_fraud") -> dict[str, DataFrame]:
    """The exploratory report as named, lazily computed tables."""
    numeric, text = column_kinds(df)
    return {
        "nulls": null_counts(df),
        "duplicates": duplicate_rows(df),
        "numeric": numeric_profile(df, numeric),
        "categorical": categorical_profile(df, text),
        "class_balance": shares(df, label),
        "amount_histogram": histogram(df, F.col("amount")),
        "amount_log_histogram": histogram(df.where("amount > 0"), F.log10("amount")),
        "amount_density": kernel_density(df.where("amount > 0"), F.log10("amount"), label),
        "rate_by_type": rate_by(df, "tx_type", label),
    }
