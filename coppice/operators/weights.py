"""Class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.operators.small import join_on, localised
from coppice.operators.split import class_counts


def balanced_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Add ``N / (K · n_class)``, which gives every class the same total weight.

    A null label is no class: it counts nowhere and its weight is null.
    """
    counts = localised(class_counts(df.filter(F.col(label).isNotNull()), label))
    totals = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    weights = counts.select(
        label, (F.lit(totals["rows"]) / (F.lit(totals["classes"]) * F.col("n"))).alias(weight)
    )
    return join_on(df, weights, [label], "left")
