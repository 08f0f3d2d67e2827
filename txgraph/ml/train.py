"""Boosted trees with and without graph features, on one shared split."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from txgraph.ml.ensemble import averaged, learners
from txgraph.ml.score import positive_probability
from txgraph.ml.split import seeded_order, stratified_split
from txgraph.operators.metrics import average_precision, class_weight, roc_auc
from txgraph.schema import ALL_FEATURES, TABULAR_FEATURES, ModelParams
from txgraph.session import ensure_checkpoint_dir, freeze


@dataclass
class TrainResult:
    model: PipelineModel
    tabular_model: PipelineModel
    auc_tabular: float
    auc_graph: float
    ap_tabular: float
    ap_graph: float
    n_train: int
    n_test: int
    fraud_rate: float
    importance: list[tuple[str, int, float]]

    @property
    def auc_uplift(self) -> float:
        return self.auc_graph - self.auc_tabular

    def importance_rows(self, spark) -> DataFrame:
        return spark.createDataFrame(
            self.importance, "feature string, position int, importance double"
        )

    def metadata(self, spark) -> DataFrame:
        """One row: feature names, AUCs and importances."""
        gains = {name: float(gain) for name, _, gain in self.importance}
        row = ([n for n, _, _ in self.importance], self.auc_tabular, self.auc_graph, gains)
        return spark.createDataFrame(
            [row],
            "feature_names array<string>, auc_tabular double, auc_graph double,"
            " feature_importance map<string,double>",
        )


def split_matrix(labelled: DataFrame, params: ModelParams = ModelParams()) -> DataFrame:
    """Add ``is_test`` and the class weight ``weight`` (negatives per positive of the training rows)."""
    ordered = labelled.withColumn("__order", seeded_order("tx_id", params.seed))
    keyed = ordered.select("tx_id", "is_fraud", "__order")
    marked = stratified_split(keyed, "is_fraud", ["__order", "tx_id"], params.test_share)
    whole = labelled.join(marked.select("tx_id", "is_test"), "tx_id")
    ratio = class_weight(marked.where("not is_test")).select("scale_pos_weight").scalar()
    return whole.withColumn("weight", F.when(F.col("is_fraud") == 1, ratio).otherwise(1.0))


def boosted_trees(features: Sequence[str], params: ModelParams) -> Pipeline:
    trees = GBTClassifier(
        featuresCol="features",
        labelCol="is_fraud",
        weightCol="weight",
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.learning_rate,
        subsamplingRate=params.row_share,
        featureSubsetStrategy=str(params.column_share),
        seed=params.seed,
        checkpointInterval=10,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), trees])


def second_member(features: Sequence[str], params: ModelParams) -> Pipeline:
    """A random forest, to be averaged with the boosted trees."""
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="is_fraud",
        weightCol="weight",
        numTrees=params.trees,
        maxDepth=params.depth,
        subsamplingRate=params.row_share,
        seed=params.seed,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), forest])


def two_members(features: Sequence[str], params: ModelParams) -> Pipeline:
    """Boosted trees and a random forest, averaged in one pipeline."""
    return averaged(
        {"trees": boosted_trees(features, params), "forest": second_member(features, params)}
    )


def importances(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, int, float]]:
    """(feature, place in the feature order, gain), highest first; the mean over the members."""
    gains = sum(m.featureImportances.toArray() for m in learners(model)) / len(learners(model))
    rows = [(name, i, float(gains[i])) for i, name in enumerate(features)]
    return sorted(rows, key=lambda r: (-r[2], r[1]))


def held_out_scores(model: PipelineModel, test: DataFrame) -> DataFrame:
    scored = model.transform(test)
    return scored.select(
        "tx_id", positive_probability().alias("score"), F.col("is_fraud").alias("label")
    )


def train_model(
    labelled: DataFrame,
    params: ModelParams = ModelParams(),
    features: Sequence[str] = ALL_FEATURES,
    tabular: Sequence[str] = TABULAR_FEATURES,
    build: Callable[[Sequence[str], ModelParams], Pipeline] = boosted_trees,
) -> TrainResult:
    """Fit both models on the same rows and compare them on the same held-out rows.

    ``build`` is the untrained pipeline: ``boosted_trees``, or ``two_members``.
    """
    ensure_checkpoint_dir(labelled.sparkSession)
    data = freeze(split_matrix(labelled, params))
    train, test = data.where("not is_test"), data.where("is_test")
    fitted = {}
    for name, columns in (("tabular", tabular), ("graph", features)):
        model = build(columns, params).fit(train)
        scores = freeze(held_out_scores(model, test))
        auc = roc_auc(scores).first()["roc_auc"]
        fitted[name] = (model, auc, average_precision(scores).first()["average_precision"])
    sizes = data.agg(
        F.count_if(~F.col("is_test")), F.count_if("is_test"), F.avg("is_fraud")
    ).first()
    return TrainResult(
        model=fitted["graph"][0],
        tabular_model=fitted["tabular"][0],
        auc_tabular=fitted["tabular"][1],
        auc_graph=fitted["graph"][1],
        ap_tabular=fitted["tabular"][2],
        ap_graph=fitted["graph"][2],
        n_train=sizes[0],
        n_test=sizes[1],
        fraud_rate=sizes[2],
        importance=importances(fitted["graph"][0], features),
    )
