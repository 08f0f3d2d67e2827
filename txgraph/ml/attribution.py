"""Per-transaction attribution by ablation.

Answers the question of a Shapley explainer (which feature drove this score?) by setting one
feature at a time to its reference median. The numbers differ from Shapley values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from txgraph.ml.score import positive_probability
from txgraph.operators.prefix import exact_quantiles
from txgraph.operators.profile import unpivot
from txgraph.schema import ALL_FEATURES


def feature_medians(reference: DataFrame, features: Sequence[str] = ALL_FEATURES) -> DataFrame:
    """One row, a map from feature to exact median."""
    cells = unpivot(reference, features, "double")
    medians = exact_quantiles(cells, "value", [0.5], ["column"])
    return medians.agg(
        F.map_from_entries(
            F.collect_list(F.struct("column", F.col("quantiles")[0].alias("m")))
        ).alias("medians")
    )


def attributions(
    matrix: DataFrame,
    model: PipelineModel,
    reference: DataFrame,
    features: Sequence[str] = ALL_FEATURES,
) -> DataFrame:
    """tx_id, feature, contribution = score minus score with the feature at its median."""
    medians = feature_medians(reference, features).scalar()
    base = matrix.select("tx_id", *features).withColumn("medians", medians)
    variants = base.withColumn(
        "feature", F.explode(F.array(F.lit(""), *[F.lit(name) for name in features]))
    ).select(
        "tx_id",
        "feature",
        *[
            F.when(F.col("feature") == name, F.col("medians")[name])
            .otherwise(F.col(name).cast("double"))
            .alias(name)
            for name in features
        ],
    )
    scored = model.transform(variants).select(
        "tx_id", "feature", positive_probability().alias("p")
    )
    whole = scored.where("feature = ''").select("tx_id", F.col("p").alias("full"))
    return (
        scored.where("feature <> ''")
        .join(whole, "tx_id")
        .select("tx_id", "feature", (F.col("full") - F.col("p")).alias("contribution"))
    )
