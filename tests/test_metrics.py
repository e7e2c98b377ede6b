"""Accuracy, matrices and AUC: the recorded 45-row result, and the edges."""

import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from coppice.operators import metrics
from coppice.operators.rows import running_totals
from coppice.operators.weights import balanced_weights

# The recorded result on 45 held-out rows, (truth, prediction): count.
GOLDEN = {
    (0.0, 0.0): 15,
    (1.0, 1.0): 14,
    (1.0, 2.0): 1,
    (2.0, 1.0): 2,
    (2.0, 2.0): 13,
}
GOLDEN_ACCURACY = 0.9333333333333333
GOLDEN_SHARES = {
    (0.0, 0.0): 0.333333,
    (0.0, 1.0): 0.0,
    (0.0, 2.0): 0.0,
    (1.0, 0.0): 0.0,
    (1.0, 1.0): 0.311111,
    (1.0, 2.0): 0.022222,
    (2.0, 0.0): 0.0,
    (2.0, 1.0): 0.044444,
    (2.0, 2.0): 0.288889,
}
NAMES = [(0.0, "setosa"), (1.0, "versicolor"), (2.0, "virginica")]


@pytest.fixture(scope="module")
def golden(spark):
    rows = [pair for pair, n in GOLDEN.items() for _ in range(n)]
    return spark.createDataFrame(rows, "y_test double, y_pred double")


def cells(matrix, value):
    return {(r["actual"], r["predicted"]): r[value] for r in matrix.collect()}


def test_golden_accuracy(golden):
    assert metrics.accuracy(golden, "y_test", "y_pred").first()[0] == GOLDEN_ACCURACY
    right = metrics.accuracy(golden, "y_test", "y_pred", normalize=False).first()[0]
    assert right == 42.0
    counts = metrics.confusion_counts(golden, "y_test", "y_pred")
    assert metrics.accuracy_from_counts(counts).first()[0] == GOLDEN_ACCURACY
    evaluator = MulticlassClassificationEvaluator(
        labelCol="y_test", predictionCol="y_pred", metricName="accuracy"
    )
    assert evaluator.evaluate(golden) == pytest.approx(GOLDEN_ACCURACY, abs=1e-12)


def test_golden_matrix(golden):
    matrix = metrics.confusion_matrix(golden, "y_test", "y_pred")
    assert {k: n for k, n in cells(matrix, "n").items() if n} == GOLDEN
    assert {k: round(v, 6) for k, v in cells(matrix, "share").items()} == GOLDEN_SHARES


def test_golden_named_and_wide(spark, golden):
    matrix = metrics.confusion_matrix(golden, "y_test", "y_pred")
    names = spark.createDataFrame(NAMES, "label double, name string")
    named = {
        (r["actual_name"], r["predicted_name"]): r["n"]
        for r in metrics.confusion_named(matrix, names).collect()
    }
    assert named["versicolor", "virginica"] == 1 and named["virginica", "versicolor"] == 2
    wide = metrics.confusion_wide(matrix.withColumn("predicted", F.col("predicted").cast("int")), [0, 1, 2])
    assert sorted(tuple(r) for r in wide.collect()) == [
        (0.0, 15, 0, 0),
        (1.0, 0, 14, 1),
        (2.0, 0, 2, 13),
    ]


def test_class_never_predicted_keeps_its_cells(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "t string, p string")
    assert cells(metrics.confusion_matrix(df, "t", "p"), "n") == {
        ("a", "a"): 1,
        ("a", "b"): 0,
        ("b", "a"): 1,
        ("b", "b"): 0,
    }


def test_given_classes_fill_the_grid_and_refuse_others(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "t string, p string")
    full = metrics.confusion_matrix(df, "t", "p", classes=["a", "b", "c"])
    assert full.count() == 9
    with pytest.raises(Exception, match="classes outside the list"):
        metrics.confusion_matrix(df, "t", "p", classes=["a"]).collect()


def test_mixed_types(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0)], "t int, p double")
    assert metrics.accuracy(df, "t", "p").first()[0] == 0.5
    assert cells(metrics.confusion_matrix(df, "t", "p"), "n") == {
        (0, 0): 0,
        (0, 1): 1,
        (1, 0): 0,
        (1, 1): 1,
    }


def test_empty_table(spark):
    df = spark.createDataFrame([], "t double, p double")
    assert metrics.accuracy(df, "t", "p").first()[0] is None
    assert metrics.confusion_matrix(df, "t", "p").count() == 0


def test_nulls_count_nowhere(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, None), (None, 1.0)], "t double, p double")
    assert metrics.accuracy(df, "t", "p").first()[0] == 1.0
    assert cells(metrics.confusion_matrix(df, "t", "p"), "n") == {(1.0, 1.0): 1}


def test_groups_are_judged_apart(spark):
    rows = [("v1", 0, 0), ("v1", 1, 0), ("v2", 0, 0), ("v2", 1, 1)]
    df = spark.createDataFrame(rows, "v string, t int, p int")
    got = {r["v"]: r["accuracy"] for r in metrics.accuracy(df, "t", "p", by=["v"]).collect()}
    assert got == {"v1": 0.5, "v2": 1.0}
    matrix = metrics.confusion_matrix(df, "t", "p", by=["v"]).collect()
    assert len(matrix) == 8
    assert all(r["share"] == r["n"] / 2 for r in matrix)


@pytest.mark.parametrize("columns", [["n"], ["share"], ["actual", "predicted", "n", "share"]])
@pytest.mark.parametrize("classes", [None, [0, 1]])
def test_table_is_aggregated_once(spark, sf_dir, columns, classes):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    matrix = metrics.confusion_matrix(labels, "quality", "toxic", classes).select(*columns)
    matrix.collect()
    final = matrix._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_weighted_accuracy(spark):
    df = spark.createDataFrame([(0, 0)] * 9 + [(1, 0)], "t int, p int")
    weighted = balanced_weights(df, "t")
    assert metrics.accuracy(weighted, "t", "p", weight="weight").first()[0] == pytest.approx(0.5)
    totals = weighted.groupBy("t").agg(F.sum("weight").alias("w")).collect()
    assert all(r["w"] == pytest.approx(5.0) for r in totals)


def test_roc_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)], "y double, s double")
    assert metrics.roc_auc(df, "y", "s") == pytest.approx(3.5 / 4)


def test_wide_matrix_refuses_classes_outside_the_list(spark):
    cells = spark.createDataFrame(
        [(0, 0, 2), (0, 2, 1), (1, 1, 1)], "actual int, predicted int, n long"
    )
    with pytest.raises(Exception, match="class outside the list: 2"):
        metrics.confusion_wide(cells, [0, 1]).collect()
    wide = metrics.confusion_wide(cells, [0, 1, 2]).orderBy("actual").collect()
    assert [r["pred_2"] for r in wide] == [1, None]


def test_auc_passes_over_nulls(spark):
    rows = [(1.0, 0.9), (0.0, 0.1), (None, 0.5), (1.0, None)]
    df = spark.createDataFrame(rows, "label double, score double")
    assert metrics.roc_auc(df, "label", "score") == 1.0


def slow_curve(rows):
    """Curve and area of ``(label, score, weight)`` by definition."""
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[1] == r[1]]
    sides = {y: [(s, w) for t, s, w in rows if t == y] for y in (0, 1)}
    total = {y: sum(w for _, w in side) for y, side in sides.items()}

    def share(y, threshold):
        return sum(w for s, w in sides[y] if s >= threshold) / total[y] if total[y] else None

    thresholds = {float("inf"), *(s + 0.0 for _, s, _ in rows)} if rows else set()
    curve = {(t, share(0, t), share(1, t)) for t in thresholds}
    wins = sum(w * v * ((s > t) + (s == t) / 2) for s, w in sides[1] for t, v in sides[0])
    return curve, wins / (total[0] * total[1]) if all(total.values()) else None


def rounded(values):
    return tuple(v if v is None else round(v, 9) for v in values)


@pytest.mark.parametrize("weight", [None, "w"])
def test_roc_curves_by_definition(spark, weight):
    """Ties, one score that most rows have, nulls, NaN, -0.0, one-sided groups, spread over ranges."""
    rng = random.Random(3)
    rows = [("v1", rng.randrange(2), rng.randrange(60) / 7, 1.0 + rng.randrange(3)) for _ in range(800)]
    rows += [("v2", rng.randrange(2), 0.5, 1.0) for _ in range(500)] + [("v2", 1, 0.25, 2.0)]
    rows += [("v3", 1, 0.0, 1.0), ("v3", 1, -0.0, 1.0), (None, 0, 1.0, 1.0), (None, 1, 2.0, 1.0)]
    rows += [("v1", None, 0.1, 1.0), ("v1", 1, None, 1.0), ("v1", 1, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "v string, y int, s double, w double").repartition(5)
    curves = metrics.roc_curve(df, "y", "s", by=["v"], weight=weight).collect()
    areas = {r["v"]: r["auc"] for r in metrics.auc_by(df, "y", "s", by=["v"], weight=weight).collect()}
    for v in ("v1", "v2", "v3", None):
        own = [(y, s, w if weight else 1) for g, y, s, w in rows if g == v]
        curve, area = slow_curve(own)
        got = [rounded((r["threshold"], r["fpr"], r["tpr"])) for r in curves if r["v"] == v]
        assert len(got) == len(curve) and set(got) == {rounded(c) for c in curve}
        assert rounded([areas[v]]) == rounded([area])
    one = metrics.roc_curve(df, "y", "s", weight=weight)
    assert one.count() == len(slow_curve([r[1:] for r in rows])[0])
    assert metrics.roc_curve(df.limit(0), "y", "s", by=["v"]).count() == 0


def test_area_equals_the_evaluator_of_spark(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    df = labels.join(documents, "doc_id").selectExpr("double(quality) AS y", "double(n_chars) AS s")
    area = metrics.auc_by(df, "y", "s").first()["auc"]
    assert area == pytest.approx(metrics.roc_auc(df, "y", "s"), abs=1e-12)


def test_a_hot_score_moves_as_one_row_per_task(spark):
    df = spark.range(0, 200_000, 1, 8).selectExpr("id % 2 AS y", "CASE WHEN id % 3 = 0 THEN id ELSE 7 END AS s")
    plan = metrics.score_points(df, "y", "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")
    curve = metrics.roc_curve(df, "y", "s")._jdf.queryExecution().optimizedPlan().toString()
    for window in [line for line in curve.split("\n") if "Window" in line]:
        assert "_range" in window


def test_running_totals_over_ranges(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), i, rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, n long").repartition(7)
    got = running_totals(df, ["g"], [F.desc("i")], ["n"]).collect()
    for r in got:
        assert r["n_upto"] == sum(n for g, i, n in rows if g == r["g"] and i >= r["i"])
    assert len(got) == 500
