"""Several members behind one probability, as one pipeline that trains, scores, streams and saves."""

from __future__ import annotations

from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from txgraph.ml.score import positive_probability


class MeanProbability(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Even mean of the members' probabilities; members that gave none are left out.

    Rows without any probability keep a null. The member columns are dropped.
    """

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str | None = None):  # noqa: N803
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        members = self.getInputCols()
        given = [F.when(F.col(name).isNotNull(), positive_probability(name)) for name in members]
        total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in given])
        count = reduce(lambda a, b: a + b, [p.isNotNull().cast("int") for p in given])
        mean = total / F.nullif(count, F.lit(0))
        both = F.when(mean.isNotNull(), array_to_vector(F.array(1.0 - mean, mean)))
        return dataset.withColumn(self.getOutputCol(), both).drop(*members)


def averaged(members: dict[str, Pipeline]) -> Pipeline:
    """One pipeline of the members' stages; the first stage (features) is taken once."""
    first = next(iter(members.values()))
    stages = [first.getStages()[0]]
    names = []
    for name, pipeline in members.items():
        learner = pipeline.getStages()[-1].copy()
        # Each member writes columns of its own, so that they can follow each other.
        learner.setProbabilityCol(f"__p_{name}")
        learner.setRawPredictionCol(f"__raw_{name}").setPredictionCol(f"__class_{name}")
        stages.append(learner)
        names.append(f"__p_{name}")
    return Pipeline(stages=[*stages, MeanProbability(inputCols=names, outputCol="probability")])


def learners(model: PipelineModel) -> list:
    """The fitted members of a single or averaged model."""
    return [stage for stage in model.stages if hasattr(stage, "featureImportances")]
