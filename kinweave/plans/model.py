"""The pair classifier: gradient-boosted trees over the 47 features, its threshold, predictions and evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.functions.features import FEATURES
from kinweave.operators.labels import group_split
from kinweave.operators.metrics import best_threshold, full_evaluation, threshold_sweep


def train(rows: DataFrame, kind: str = "gbt", rounds: int = 20, depth: int = 5, step: float = 0.1) -> PipelineModel:
    """rows: features, label and s1_id. Trees stop early on the held-out fifth of the entities."""
    split = group_split(rows).withColumn("label", F.col("label").cast("double"))
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    if kind == "gbt":
        learner = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, seed=42, validationIndicatorCol="is_val")
    else:
        learner = LogisticRegression(regParam=0.01)
        split = split.where("not is_val")
    return Pipeline(stages=[assemble, learner]).fit(split)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(s1_id, cand_id, score)."""
    return model.transform(rows).select("s1_id", "cand_id", vector_to_array("probability")[1].alias("score"))


def best_round(model: PipelineModel) -> int:
    """The number of trees that the held-out entities left, 0 for a model without trees."""
    return getattr(model.stages[-1], "getNumTrees", 0)


def feature_importance(model: PipelineModel) -> DataFrame:
    from pyspark.sql import SparkSession

    values = model.stages[-1].featureImportances.toArray().tolist()
    return SparkSession.active().createDataFrame(sorted(zip(FEATURES, values, strict=True), key=lambda x: (-x[1], x[0])), "feature string, importance double")


def choose_threshold(model: PipelineModel, rows: DataFrame, true: DataFrame) -> tuple[float, float, DataFrame]:
    """(threshold, its macro_f05, sweep) on the held-out entities."""
    held = group_split(rows).where("is_val")
    ids = held.select("s1_id").distinct()
    sweep = threshold_sweep(ids, predict(model, held), true.join(ids, "s1_id", "left_semi")).persist()
    return *best_threshold(sweep), sweep


def evaluate(model: PipelineModel, rows: DataFrame, pairs: DataFrame, true: DataFrame, entities: DataFrame, threshold: float) -> DataFrame:
    return full_evaluation(entities, predict(model, rows).where(F.col("score") >= threshold), pairs, true, threshold)
