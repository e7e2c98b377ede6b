"""Accuracy, confusion matrices, ROC curves and AUC as aggregations over a scored table.

Rows without a truth or without a prediction count nowhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.operators.rows import running_totals
from coppice.operators.small import join_on, localised


def _judged(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())


def accuracy(
    df: DataFrame,
    actual: str,
    predicted: str,
    by: Sequence[str] = (),
    weight: str | None = None,
    normalize: bool = True,
    output: str = "accuracy",
) -> DataFrame:
    """Share of right predictions, per group of ``by``; their number or weight if not normalized.

    The share over no rows is null.
    """
    hit = (F.col(actual) == F.col(predicted)).cast("double")
    each: Column = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    right = F.sum(hit * each)
    value = right / F.sum(each) if normalize else right
    return _judged(df, actual, predicted).groupBy(*by).agg(value.alias(output))


def confusion_counts(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """The non-empty cells, ``(…by, actual, predicted, n)``."""
    return (
        _judged(df, actual, predicted)
        .groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def confusion_matrix(
    df: DataFrame,
    actual: str,
    predicted: str,
    classes: Sequence[object] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """All cells, ``(…by, actual, predicted, n, share)``; share is of all rows of the group.

    Classes are those given, or the union of truths and predictions. The table is aggregated once;
    the grid and the cells are both made from the counts. A prediction outside the given classes
    is an error, not a lost row.
    """
    return matrix_from_counts(confusion_counts(df, actual, predicted, by), classes, by)


def matrix_from_counts(
    counts: DataFrame, classes: Sequence[object] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """The full grid of ``confusion_counts``."""
    if classes is None:
        seen = F.array_union(F.collect_set("actual"), F.collect_set("predicted"))
    else:
        kind = counts.schema["actual"].dataType
        listed = F.array(*[F.lit(c).cast(kind) for c in classes])
        found = F.array_union(F.collect_set("actual"), F.collect_set("predicted"))
        unlisted = F.array_except(found, listed)
        message = F.concat(F.lit("classes outside the list: "), unlisted.cast("string"))
        seen = F.when(F.size(unlisted) == 0, listed).otherwise(F.raise_error(message))
    # The filter keeps the counts in both branches, so that they share one aggregation whatever
    # columns are used later.
    groups = (
        counts.groupBy(*by)
        .agg(seen.alias("_classes"), F.sum("n").alias("_rows"))
        .filter("_rows > 0")
    )
    grid = groups.select(*by, "_rows", "_classes", F.explode("_classes").alias("actual")).select(
        *by, "_rows", "actual", F.explode("_classes").alias("predicted")
    )
    n = F.coalesce("n", F.lit(0))
    return grid.join(counts, [*by, "actual", "predicted"], "left").select(
        *by,
        "actual",
        "predicted",
        n.alias("n"),
        (n / F.col("_rows")).alias("share"),
    )


def accuracy_from_counts(
    counts: DataFrame, by: Sequence[str] = (), output: str = "accuracy"
) -> DataFrame:
    """The share on the diagonal of ``confusion_counts``."""
    right = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    return counts.groupBy(*by).agg((right / F.sum("n")).alias(output))


def confusion_wide(
    matrix: DataFrame, classes: Sequence[object], value: str = "n", by: Sequence[str] = ()
) -> DataFrame:
    """One row per true class and one column per predicted class, ``pred_<class>``.

    A prediction outside the given classes is an error, not a lost count.
    """
    kind = matrix.schema["predicted"].dataType
    listed = F.col("predicted").isin(*[F.lit(c).cast(kind) for c in classes])
    message = F.concat(F.lit("class outside the list: "), F.col("predicted").cast("string"))
    matrix = matrix.withColumn(
        value, F.when(listed | (F.col(value) == 0), F.col(value)).otherwise(F.raise_error(message))
    )
    # Without a list of columns to make, so that no row is left out before it is looked at.
    matrix = matrix.filter(F.col(value).isNotNull())
    wide = matrix.groupBy(*by, "actual").pivot("predicted", list(classes)).agg(F.first(value))
    return wide.select(
        *by, "actual", *[F.col(f"`{c}`").alias(f"pred_{c}") for c in classes]
    )


def confusion_named(matrix: DataFrame, names: DataFrame) -> DataFrame:
    """Add ``actual_name`` and ``predicted_name`` from a ``(label, name)`` table."""
    names = localised(names)
    for side in ("actual", "predicted"):
        named = names.select(
            F.col("label").alias(side), F.col("name").alias(f"{side}_name")
        )
        matrix = join_on(matrix, named, [side], "left")
    return matrix


def roc_auc(df: DataFrame, label: str, score: str, weight: str | None = None) -> float:
    """Exact area under the ROC curve; ties count half."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=0
    )
    if weight is not None:
        evaluator.setWeightCol(weight)
    return evaluator.evaluate(_judged(df, label, score))


def score_points(
    df: DataFrame,
    label: str,
    score: str,
    positive: object = 1,
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """``(…by, score, positives, negatives)``: the rows, or weights, of each distinct score.

    Equal scores are added up in every task before they move, so a score that very many rows have is
    one row per task. A score of -0.0 counts as 0.0, and one that is not a number counts nowhere.
    """
    value = F.col(score).cast("double")
    hit = F.col(label) == F.lit(positive)
    each = F.lit(1) if weight is None else F.col(weight).cast("double")
    return (
        _judged(df, label, score)
        .filter(~F.isnan(value))
        .groupBy(*by, F.when(value == 0, 0.0).otherwise(value).alias("score"))
        .agg(
            F.sum(F.when(hit, each).otherwise(0)).alias("positives"),
            F.sum(F.when(hit, 0).otherwise(each)).alias("negatives"),
        )
    )


def _cumulated(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Points with the counts of their score and all above, and the totals of their group."""
    counts = ["positives", "negatives"]
    upto = running_totals(points, by, [F.desc("score")], counts)
    totals = localised(
        points.groupBy(*by).agg(*[F.sum(c).alias(f"all_{c}") for c in counts])
    )
    if not by:
        upto, totals = upto.withColumn("_one", F.lit(1)), totals.withColumn("_one", F.lit(1))
    return join_on(upto, totals, [*by] or ["_one"], "inner")


def roc_curve(
    df: DataFrame,
    label: str,
    score: str,
    positive: object = 1,
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """``(…by, threshold, fpr, tpr)`` for every distinct score, and for a threshold of infinity.

    ``fpr`` and ``tpr`` are the shares of negative and positive rows whose score is at least the
    threshold; a share of no rows is null. Groups may be model versions; each has its own curve.
    """
    points = localised(score_points(df, label, score, positive, by, weight))
    cumulated = _cumulated(points, by)
    tpr = F.try_divide("positives_upto", "all_positives").alias("tpr")
    fpr = F.try_divide("negatives_upto", "all_negatives").alias("fpr")
    curve = cumulated.select(*by, F.col("score").alias("threshold"), fpr, tpr)
    groups = points.groupBy(*by).agg(
        *[F.sum(c).alias(f"all_{c}") for c in ("positives", "negatives")]
    )
    zero = [
        F.try_divide(F.lit(0.0), F.col(f"all_{c}")).alias(name)
        for c, name in (("negatives", "fpr"), ("positives", "tpr"))
    ]
    starts = groups.filter("all_positives IS NOT NULL").select(
        *by, F.lit(float("inf")).alias("threshold"), *zero
    )
    return curve.unionByName(starts)


def auc_by(
    df: DataFrame,
    label: str,
    score: str,
    positive: object = 1,
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """``(…by, auc)``: the area under each group's ROC curve; ties count half.

    Null for a group without positive or without negative rows.
    """
    points = localised(score_points(df, label, score, positive, by, weight))
    above = F.col("positives_upto") - F.col("positives") / 2
    area = F.try_divide(
        F.sum(F.col("negatives") * above), F.max("all_positives") * F.max("all_negatives")
    )
    return _cumulated(points, by).groupBy(*by).agg(area.alias("auc"))
