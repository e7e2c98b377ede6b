"""Folds by class, dictionaries of many labels, exchanged columns, and rows that cannot be scored."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from coppice.operators import features as feat
from coppice.operators.learners import learner
from coppice.operators.split import stratified_folds
from coppice.plans import jobs
from coppice.settings import SMALL_FOREST, TrainSettings
from coppice.sources.registry import ModelRegistry
from coppice.sources.tables import TableRef
from coppice.sources.workspace import scratch_path


def sizes(df, label, fold="fold"):
    return {(r[label], r[fold]): r["count"] for r in df.groupBy(label, fold).count().collect()}


@pytest.mark.parametrize("folds", [2, 5, 9])
def test_folds_share_each_class_evenly(spark, folds):
    rows = [(i, "big") for i in range(1003)] + [(5000 + i, "small") for i in range(7)]
    rows += [(9000, "one"), (9001, None), (9002, None)]
    df = spark.createDataFrame(rows, "id long, kind string").withColumn("_class", F.lit("mine"))
    found = stratified_folds(df.repartition(5), "kind", ["id"], folds)
    assert found.columns == [*df.columns, "fold"] and found.count() == len(rows)
    got = sizes(found, "kind")
    for kind, n in Counter(kind for _, kind in rows).items():
        for fold in range(folds):
            expected = (fold + 1) * n // folds - fold * n // folds
            assert got.get((kind, fold), 0) == expected
        assert sum(v for (k, _), v in got.items() if k == kind) == n
    again = stratified_folds(df.repartition(2), "kind", ["id"], folds)
    assert found.exceptAll(again).isEmpty()


def test_rows_of_one_key_share_a_fold(spark):
    df = spark.range(3000).selectExpr("id % 300 AS k", "id % 2 AS y")
    found = stratified_folds(df, "y", ["k"], 4)
    assert found.groupBy("k").agg(F.count_distinct("fold").alias("n")).filter("n > 1").isEmpty()
    with pytest.raises(ValueError, match="at least 2"):
        stratified_folds(df, "y", ["k"], 1)
    assert stratified_folds(df.limit(0), "y", ["k"], 4).count() == 0


def test_folding_moves_no_row(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plan = stratified_folds(labels, "quality", ["doc_id"], 5)._jdf.queryExecution().executedPlan()
    assert "Exchange hashpartitioning" not in plan.toString()


@pytest.mark.parametrize("order", ["alphabetAsc", "alphabetDesc", "frequencyDesc", "frequencyAsc"])
def test_dictionary_equals_the_indexer_of_spark(spark, order):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot", *[f"w{rng.randrange(200)}" for _ in range(2)]])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, word string").repartition(4)
    expected = feat.label_indexer("word", order, output="code").fit(df).transform(df)
    dictionary = feat.label_dictionary(df, "word", order)
    got = feat.with_label_index(df, dictionary, "word", "code")
    assert got.exceptAll(expected).isEmpty() and got.count() == 3000


def test_a_million_labels_with_a_hot_one(spark):
    n = 1_000_000
    label = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("%07d", "id"))
    df = spark.range(0, n, 1, 8).select(label.alias("word"))
    dictionary = feat.label_dictionary(df, "word")
    assert dictionary.count() == 1 + n - (n + 2) // 3
    got = feat.with_label_index(df, dictionary, "word", "code")
    totals = got.agg(F.count("code"), F.count_distinct("code"), F.max("code")).first()
    assert tuple(totals) == (n, dictionary.count(), float(dictionary.count() - 1))
    assert got.filter("word = 'hot'").select("code").distinct().count() == 1


def test_unknown_labels(spark):
    known = spark.createDataFrame([("a",), ("b",)], "word string")
    rows = spark.createDataFrame([("a",), ("c",), (None,)], "word string")
    dictionary = feat.label_dictionary(known, "word")
    keep = feat.with_label_index(rows, dictionary, "word", "i", "keep").collect()
    assert {r["word"]: r["i"] for r in keep} == {"a": 0.0, "c": 2.0, None: 2.0}
    assert [tuple(r) for r in feat.with_label_index(rows, dictionary, "word", "i", "skip").collect()] == [("a", 0.0)]
    with pytest.raises(Exception, match="unknown label"):
        feat.with_label_index(rows, dictionary, "word", "i").collect()


@pytest.fixture(scope="module")
def signal(spark):
    """Two columns that tell the class, one more than the other, and one of noise."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        y = i % 2
        rows.append((i, y + rng.gauss(0, 0.3), y + rng.gauss(0, 1.5), rng.gauss(0, 1), "ab"[y]))
    return spark.createDataFrame(rows, "id long, strong double, weak double, noise double, y string").coalesce(2)


INPUTS = ["strong", "weak", "noise"]


@pytest.mark.parametrize("name", ["forest", "logistic"])
def test_noise_ranks_last(spark, signal, name):
    settings = TrainSettings(depth=4)
    stages = jobs.tabular_pipeline(INPUTS, "y", settings, learner(name, settings))
    model = jobs.fit(signal, INPUTS, "y", stages, settings)
    rows = jobs.permutation_importance(model, signal, INPUTS, ["id"]).collect()
    assert [r["feature"] for r in rows][0] == "strong" and rows[0]["importance"] > 0.25
    assert {r["feature"]: r["importance"] for r in rows}["noise"] < 0.05
    assert all(r["spread"] >= 0 for r in rows)


def test_every_row_is_held_out_once(spark, signal):
    settings = TrainSettings()
    scored, accuracy = jobs.cross_validate(signal, learner("logistic", settings), INPUTS, "y", ["id"], settings, folds=4)
    assert sorted(r["id"] for r in scored.select("id").collect()) == list(range(600))
    folds = {r["fold"]: (r["n"], r["accuracy"]) for r in accuracy.collect()}
    assert {n for n, _ in folds.values()} == {150} and min(a for _, a in folds.values()) > 0.85


def test_accepted_and_rejected_rows_are_the_input(spark, signal):
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    table = signal.withColumn("noise", F.floor(F.col("noise") * 0 + F.col("id") % 3).cast("double"))
    version = jobs.train(
        spark, table, TableRef(path=scratch_path(spark, "heldout")), registry, "m",
        scratch_path(spark, "models"), INPUTS, "y", ["id"], SMALL_FOREST.but(trees=3, depth=3),
    )
    registry.set_stage("m", version.version, "Staging")
    broken = table.withColumns(
        {
            "strong": F.when(F.col("id") == 1, None).when(F.col("id") == 2, float("nan")).otherwise(F.col("strong")),
            "noise": F.when(F.col("id").isin(2, 3), 7.0).otherwise(F.col("noise")),
            "y": F.when(F.col("id") == 4, "new").when(F.col("id") == 5, None).otherwise(F.col("y")),
        }
    )
    source = TableRef(path=scratch_path(spark, "broken"))
    source.write(broken)
    sink = jobs.outcome_table(scratch_path(spark, "outcomes"))
    for truth, extra in ((True, {4: ["unknown: y"], 5: ["null: y"]}), (False, {})):
        found = jobs.score_or_reject(spark, source, sink, registry, "m", "Staging", truth)
        reasons = {r["id"]: r["reasons"] for r in found.rejected.collect()}
        assert reasons == {
            1: ["null: strong"], 2: ["not a number: strong", "unknown: noise"], 3: ["unknown: noise"], **extra
        }
        both = found.accepted.select(*broken.columns).unionByName(found.rejected.select(*broken.columns))
        assert both.exceptAll(broken).isEmpty() and broken.exceptAll(both).isEmpty()
        assert found.accepted.filter("prediction IS NULL").isEmpty()
        good = broken.filter(~F.col("id").isin(*reasons))
        plain = TableRef(path=scratch_path(spark, "good"))
        plain.write(good)
        direct = TableRef(path=scratch_path(spark, "direct"))
        jobs.score(spark, plain, direct, registry, "m", "Staging", truth=truth)
        columns = ["id", "prediction", "predicted_label"]
        same = direct.read(spark).select(*columns).exceptAll(found.accepted.select(*columns))
        assert same.isEmpty() and found.accepted.count() == good.count()


def test_folds_of_random_classes(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("abcde")) for i in range(400)]
    found = stratified_folds(spark.createDataFrame(rows, "id long, c string"), "c", ["id"], 3)
    per = defaultdict(list)
    for (c, _), n in sizes(found, "c").items():
        per[c].append(n)
    assert all(max(v) - min(v) <= 1 and len(v) == 3 for v in per.values())
