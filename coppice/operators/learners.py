"""Estimators by name: Spark ML's own, and one put together from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.operators.features import FEATURES, INDEXED_FEATURES, INDEXED_LABEL
from coppice.operators.kernels import KernelSVC
from coppice.operators.rows import ranked
from coppice.settings import TrainSettings

WEIGHT = "weight"


def _weighted(estimator: Estimator, settings: TrainSettings) -> Estimator:
    if settings.class_weight == "balanced":
        estimator.setWeightCol(WEIGHT)
    return estimator


def forest(settings: TrainSettings, features: str = INDEXED_FEATURES) -> Estimator:
    """Random forest. Node ids are cached, and checkpointed, so that deep trees are not resent."""
    return _weighted(
        RandomForestClassifier(
            labelCol=INDEXED_LABEL,
            featuresCol=features,
            numTrees=settings.trees,
            maxDepth=settings.depth,
            featureSubsetStrategy=settings.subset,
            impurity=settings.impurity,
            bootstrap=settings.bootstrap,
            seed=settings.seed,
            maxBins=settings.max_bins,
            maxMemoryInMB=settings.max_memory_mb,
            cacheNodeIds=settings.depth > 10,
        ),
        settings,
    )


def logistic(settings: TrainSettings, features: str = FEATURES) -> Estimator:
    return _weighted(
        LogisticRegression(
            labelCol=INDEXED_LABEL,
            featuresCol=features,
            maxIter=settings.max_iter,
            regParam=settings.reg_param,
            aggregationDepth=settings.aggregation_depth,
        ),
        settings,
    )


def linear_svc(settings: TrainSettings, features: str = FEATURES) -> Estimator:
    """Linear support vector machine, two classes; it gives no probabilities."""
    return _weighted(
        LinearSVC(
            labelCol=INDEXED_LABEL,
            featuresCol=features,
            maxIter=settings.max_iter,
            regParam=settings.reg_param,
            aggregationDepth=settings.aggregation_depth,
        ),
        settings,
    )


def kernel_svc(settings: TrainSettings, features: str = FEATURES) -> Estimator:
    """Support vector machine with a Gaussian kernel, any number of classes, with probabilities."""
    return _weighted(
        KernelSVC(
            labelCol=INDEXED_LABEL,
            featuresCol=features,
            maxIter=settings.max_iter,
            regParam=settings.reg_param,
            aggregationDepth=settings.aggregation_depth,
            features=settings.kernel_features,
            gamma=settings.gamma,
            seed=settings.seed,
        ),
        settings,
    )


LEARNERS: dict[str, Callable[..., Estimator]] = {
    "forest": forest,
    "logistic": logistic,
    "linear_svc": linear_svc,
    "kernel_svc": kernel_svc,
}


def learner(name: str, settings: TrainSettings, features: str | None = None) -> Estimator:
    if name not in LEARNERS:
        raise ValueError(f"unknown learner {name!r}; known: {', '.join(sorted(LEARNERS))}")
    make = LEARNERS[name]
    return make(settings) if features is None else make(settings, features)


def feature_ranking(model: PipelineModel, names: Sequence[str], df: DataFrame) -> DataFrame:
    """``(feature, importance, percent)`` of a fitted forest, most important first."""
    weights = model.stages[-1].featureImportances.toArray()
    spark = df.sparkSession
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("feature"), F.lit(float(w)).alias("importance"))
            for n, w in zip(names, weights, strict=True)
        ]
    )
    table = spark.range(1).select(F.inline(pairs))
    percent = (F.round("importance", 3) * 100).alias("percent")
    return ranked(table.select("feature", "importance", percent), "importance", "feature")
