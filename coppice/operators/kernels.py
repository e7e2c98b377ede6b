"""A support vector classifier with a Gaussian kernel, as stages that Spark can save.

Inputs are standardised and mapped to random Fourier features, whose inner products approximate the
kernel; a linear machine per class is fitted on them, one against the rest; a sigmoid per class, fitted
on rows that the machines have not seen, turns margins into probabilities.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasAggregationDepth,
    HasFeaturesCol,
    HasInputCol,
    HasLabelCol,
    HasMaxIter,
    HasOutputCol,
    HasRegParam,
    HasSeed,
    HasWeightCol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.functions.columns import once
from coppice.operators.small import localised

SCALED = "_scaled"
MAPPED = "_mapped"
RAW = "rawPrediction"
PROBABILITY = "probability"

#: Where the linear machines stop: margins need not be exact, as the sigmoids are fitted to them.
TOLERANCE = 1e-3
MACHINES_AT_ONCE = 8

#: One row in so many is kept for the probabilities.
CALIBRATION_SHARE = 4


class RandomFourierMap(
    Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """``sqrt(2 / D) · cos(Wx + b)`` for D random rows of W; the seed is all that is stored of W."""

    features = Param(Params._dummy(), "features", "D", TypeConverters.toInt)
    size = Param(Params._dummy(), "size", "numbers in an input vector", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "of exp(-gamma |x - y|²)", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, features=256, size=1, gamma=1.0, seed=21):
        super().__init__()
        self._set(**self._input_kwargs)

    def _rows(self) -> str:
        rng = np.random.default_rng(self.getSeed())
        n, size = self.getOrDefault("features"), self.getOrDefault("size")
        weights = rng.normal(size=(n, size)) * math.sqrt(2 * self.getOrDefault("gamma"))
        shifts = rng.uniform(0, 2 * math.pi, n)
        rows = (
            f"struct(array({', '.join(f'{w!r}D' for w in row.tolist())}) AS w, {shift!r}D AS b)"
            for row, shift in zip(weights, shifts.tolist(), strict=True)
        )
        return f"array({', '.join(rows)})"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scale = math.sqrt(2 / self.getOrDefault("features"))

        def mapped(x: Column) -> Column:
            return F.transform(
                F.expr(self._rows()),
                lambda r: scale
                * F.cos(
                    F.aggregate(F.zip_with(r["w"], x, lambda a, b: a * b), r["b"], lambda s, v: s + v)
                ),
            )

        vector = array_to_vector(once(vector_to_array(F.col(self.getInputCol())), mapped))
        return dataset.withColumn(self.getOutputCol(), vector)


class MarginCalibration(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Probabilities from the margin of each class, and an end to the columns made on the way."""

    slopes = Param(Params._dummy(), "slopes", "per class", TypeConverters.toListFloat)
    intercepts = Param(Params._dummy(), "intercepts", "per class", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, slopes=None, intercepts=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        lines = list(zip(self.getOrDefault("slopes"), self.getOrDefault("intercepts"), strict=True))

        def shares(margins: Column) -> Column:
            each = F.array(*[1 / (1 + F.exp(-(margins[i] * a + b))) for i, (a, b) in enumerate(lines)])
            return once(each, normalised)

        def normalised(each: Column) -> Column:
            total = F.aggregate(each, F.lit(0.0), lambda s, p: s + p)
            even = F.lit(1 / len(lines))
            return F.transform(each, lambda p: F.coalesce(F.try_divide(p, total), even))

        vector = array_to_vector(once(vector_to_array(RAW), shares))
        return dataset.withColumn(PROBABILITY, vector).drop(SCALED, MAPPED)


class KernelSVC(
    Estimator,
    HasFeaturesCol,
    HasLabelCol,
    HasWeightCol,
    HasSeed,
    HasMaxIter,
    HasRegParam,
    HasAggregationDepth,
):
    """Fits to a ``PipelineModel`` of scaler, random Fourier map, linear machines and calibration.

    Labels are codes from 0. ``gamma`` 0 takes one over the number of inputs, for inputs that have
    been standardised. Rows for the calibration are chosen by a hash of their inputs, whatever the layout.
    """

    features = Param(Params._dummy(), "features", "random features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "of exp(-gamma |x - y|²)", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", weightCol=None, seed=21, maxIter=100,
        regParam=0.0, aggregationDepth=2, features=256, gamma=0.0,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setWeightCol(self, value: str) -> KernelSVC:
        return self._set(weightCol=value)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        label = self.getLabelCol()
        weight = [self.getWeightCol()] if self.isSet("weightCol") else []
        scaler = StandardScaler(
            inputCol=self.getFeaturesCol(), outputCol=SCALED, withMean=True, withStd=True
        ).fit(dataset)
        size = len(scaler.mean)
        mapping = RandomFourierMap(
            inputCol=SCALED, outputCol=MAPPED, features=self.getOrDefault("features"), size=size,
            gamma=self.getOrDefault("gamma") or 1 / size, seed=self.getSeed(),
        )
        mapped = mapping.transform(scaler.transform(dataset))
        held = F.pmod(F.xxhash64(vector_to_array(self.getFeaturesCol())), F.lit(CALIBRATION_SHARE)) == 0
        machines = LinearSVC(
            featuresCol=MAPPED, labelCol=label, maxIter=self.getMaxIter(), tol=TOLERANCE,
            regParam=self.getRegParam(), aggregationDepth=self.getAggregationDepth(),
        )
        classes = int(dataset.agg(F.max(label)).first()[0] or 0) + 1
        if classes > 2:
            # With two classes one machine has the margins of both.
            machines = OneVsRest(
                classifier=machines, featuresCol=MAPPED, labelCol=label, rawPredictionCol=RAW,
                parallelism=min(classes, MACHINES_AT_ONCE),
            )
        if weight:
            machines.setWeightCol(*weight)
        fitted = machines.fit(mapped.filter(~held).select(MAPPED, label, *weight))
        margins = fitted.transform(mapped.filter(held).select(MAPPED, label))
        margins = localised(margins.select(F.col(label).alias("label"), vector_to_array(RAW).alias("margins")))
        lines = [self._line(margins, k) for k in range(max(classes, 2))]
        calibration = MarginCalibration(slopes=[a for a, _ in lines], intercepts=[b for _, b in lines])
        return PipelineModel([scaler, mapping, fitted, calibration])

    @staticmethod
    def _line(margins: DataFrame, code: int) -> tuple[float, float]:
        """Slope and intercept of the sigmoid of one class; the plain one where it has no example."""
        own = margins.select(
            (F.col("label") == code).cast("double").alias("label"),
            array_to_vector(F.array(F.col("margins")[code])).alias("features"),
        )
        if own.agg(F.count_distinct("label")).first()[0] < 2:
            return 1.0, 0.0
        line = LogisticRegression(maxIter=50).fit(own)
        return float(line.coefficients[0]), float(line.intercept)
