import pytest
from pyspark.sql import functions as F

from coppice.functions.columns import cast_columns, class_name, equals_all
from coppice.operators.features import attach_names
from coppice.settings import FULL_FOREST, SMALL_FOREST, TrainSettings


def test_published_settings_parse():
    small = {"fraction": "0.7", "numTrees": "12", "maxDepth": "10"}
    assert TrainSettings.from_strings(small) == SMALL_FOREST
    full = {
        "max_depth": "20",
        "n_estimators": "100",
        "max_features": "auto",
        "criterion": "gini",
        "class_weight": "balanced",
        "bootstrap": "True",
        "random_state": "21",
    }
    assert TrainSettings.from_strings(full) == FULL_FOREST


def test_false_is_false():
    assert TrainSettings.from_strings({"bootstrap": "False"}).bootstrap is False
    with pytest.raises(ValueError, match="not a boolean"):
        TrainSettings.from_strings({"bootstrap": "maybe"})


@pytest.mark.parametrize(
    "values", [{"colour": "red"}, {"fraction": "1.5"}, {"fraction": "x"}, {"class_weight": "odd"}]
)
def test_bad_settings_are_refused(values):
    with pytest.raises(ValueError):
        TrainSettings.from_strings(values)


def test_params_are_text():
    params = SMALL_FOREST.as_params()
    assert params["trees"] == "12" and params["fraction"] == "0.7"
    assert TrainSettings.from_strings(params) == SMALL_FOREST


def test_class_name_uses_the_row_itself(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.0,), (None,)], "label double")
    name = class_name(F.col("label"), {0: "setosa", 1: "versicolor", 2: "virginica"})
    got = [r["n"] for r in df.select(name.alias("n")).collect()]
    assert got == ["setosa", "versicolor", None, None]
    assert df.select(class_name(F.col("label"), {}).alias("n")).first()["n"] is None


def test_equality_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df = orders.filter(equals_all({"o_orderstatus": "F", "o_orderkey": 3})).select("o_custkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "EqualTo(o_orderkey,3)" in plan
    assert "o_totalprice" not in plan.split("ReadSchema")[1]


def test_cast_columns(spark):
    df = spark.createDataFrame([("1", 2.9)], "a string, b double")
    assert cast_columns(df, {"a": "int", "b": "int"}).first() == (1, 2)


def test_names_can_come_from_a_table(spark):
    df = spark.createDataFrame([(0.0,), (9.0,), (None,)], "label double")
    names = spark.createDataFrame([(0.0, "setosa"), (1.0, "versicolor")], "label double, name string")
    named = attach_names(df, "label", names)
    assert named.columns == ["label", "name"]
    assert {(r["label"], r["name"]) for r in named.collect()} == {
        (0.0, "setosa"),
        (9.0, None),
        (None, None),
    }
