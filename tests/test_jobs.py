"""Training, scoring and evaluation end to end, and what they refuse."""

from pathlib import Path

import pyspark
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from coppice.__main__ import run as run_command
from coppice.operators import features as feat
from coppice.operators.learners import feature_ranking, learner
from coppice.operators.rows import numbered
from coppice.operators.split import hash_split
from coppice.plans import jobs
from coppice.settings import FULL_FOREST, SMALL_FOREST, TrainSettings
from coppice.sources.models import load_model
from coppice.sources.registry import ModelRegistry
from coppice.sources.tables import TableRef
from coppice.sources.workspace import scratch_path

INPUTS = ["f0", "f1", "f2", "f3"]
SMALL = SMALL_FOREST.but(fit_partitions=2)


@pytest.fixture(scope="module")
def flowers(spark):
    """The 150-row three-class sample that ships with PySpark, as a plain table."""
    path = Path(pyspark.__file__).parent / "data/mllib/sample_multiclass_classification_data.txt"
    if not path.exists():
        pytest.skip("sample data not installed")
    raw = spark.read.format("libsvm").option("numFeatures", "4").load(str(path))
    slots = vector_to_array("features")
    table = raw.select(
        F.monotonically_increasing_id().alias("id"),
        *[slots[i].alias(name) for i, name in enumerate(INPUTS)],
        "label",
    )
    stored = TableRef(path=scratch_path(spark, "flowers"))
    stored.write(table.coalesce(1))
    return stored


def run_train(spark, source, registry, settings=SMALL, **changes):
    heldout = TableRef(path=scratch_path(spark, "heldout"))
    args = dict(name="flowers", model_root=scratch_path(spark, "models"), inputs=INPUTS)
    args.update(label="label", keys=["id"], settings=settings, **changes)
    return jobs.train(spark, source, heldout, registry, **args), heldout


def test_train_score_evaluate(spark, flowers):
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    first, heldout = run_train(spark, flowers, registry)
    assert first.version == 1
    registry.set_stage("flowers", 1, "Staging")
    rest = heldout.read(spark)
    assert rest.count() == 45
    assert {r["count"] for r in rest.groupBy("label").count().collect()} == {15}

    scored = TableRef(path=scratch_path(spark, "scored"), fmt="orc")
    result = jobs.evaluate(spark, heldout, scored, registry, "flowers", "Staging")
    accuracy = result.accuracy.first()
    assert accuracy["model_version"] == 1 and accuracy["accuracy"] > 0.85
    assert result.confusion.agg(F.sum("n"), F.sum("share")).first()[0] == 45
    board = registry.leaderboard("Accuracy").first()
    assert (board["run_id"], board["value"]) == (first.run_id, accuracy["accuracy"])
    params = {r["key"]: r["value"] for r in registry.params().collect()}
    assert (params["fraction"], params["trees"], params["depth"]) == ("0.7", "12", "10")

    table = scored.read(spark)
    assert set(rest.columns) < set(table.columns)
    assert {r["model_name"] for r in table.select("model_name").collect()} == {"flowers"}
    assert table.select("id").exceptAll(rest.select("id")).isEmpty()
    assert table.filter(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).isEmpty()

    # A second version joins the history, and both are judged in one pass.
    second, _ = run_train(spark, flowers, registry, SMALL.but(trees=3, depth=2))
    registry.set_stage("flowers", second.version, "Production")
    jobs.score(spark, heldout, scored, registry, "flowers", "Production", mode="append", truth=True)
    both = jobs.evaluate(spark, heldout, scored, registry, "flowers", "Staging", scoring=False)
    assert sorted(r["model_version"] for r in both.accuracy.collect()) == [1, 2]
    assert registry.leaderboard("Accuracy").count() == 2
    assert {r["n"] for r in both.confusion.groupBy("model_version").agg(F.sum("n").alias("n")).collect()} == {45}


def test_new_data_needs_no_known_label(spark, flowers):
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    run_train(spark, flowers, registry)
    registry.set_stage("flowers", 1, "Production")
    fresh = TableRef(path=scratch_path(spark, "fresh"))
    fresh.write(flowers.read(spark).withColumn("label", F.when(F.col("id") % 2 == 0, F.lit(77.0))))
    sink = TableRef(path=scratch_path(spark, "sink"))
    jobs.score(spark, fresh, TableRef(path=scratch_path(spark, "all")), registry, "flowers", "Production")
    keep = ["id", "prediction", "probability"]
    jobs.score(spark, fresh, sink, registry, "flowers", "Production", keep=keep)
    out = sink.read(spark)
    assert out.columns == [*keep, "model_name", "model_version"]
    assert out.count() == 150
    short = TableRef(path=scratch_path(spark, "short"))
    short.write(fresh.read(spark).drop("f2"))
    with pytest.raises(ValueError, match="missing input columns: f2"):
        jobs.score(spark, short, sink, registry, "flowers", "Production")


def test_hash_split_and_a_frame_as_source(spark, flowers):
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    table = flowers.read(spark)
    _, heldout = run_train(spark, table, registry, SMALL.but(stratified=False))
    rest = heldout.read(spark)
    wanted = hash_split(table, ["id"], 0.7, seed=42).filter("NOT is_train").drop("is_train")
    assert rest.exceptAll(wanted).isEmpty() and wanted.exceptAll(rest).isEmpty()
    registry.set_stage("flowers", 1, "Staging")
    judged = TableRef(path=scratch_path(spark, "judged"))
    keep = ["actual_label", "predicted_label"]
    jobs.evaluate(spark, heldout, judged, registry, "flowers", "Staging", keep=keep)
    assert judged.read(spark).columns == [*keep, "model_name", "model_version"]


def predictions(model, df):
    return {r["id"]: r["prediction"] for r in model.transform(df).select("id", "prediction").collect()}


def test_same_seed_same_forest_on_any_layout(spark, flowers):
    table = flowers.read(spark)
    stages = jobs.tabular_pipeline(INPUTS, "label", SMALL)
    fits = [
        predictions(jobs.fit(table.repartition(n), INPUTS, "label", stages, SMALL), table)
        for n in (1, 7)
    ]
    assert fits[0] == fits[1]


def test_fit_keeps_no_rows_behind(spark, flowers):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    stages = jobs.tabular_pipeline(INPUTS, "label", SMALL_FOREST)
    jobs.fit(flowers.read(spark), INPUTS, "label", stages, SMALL_FOREST)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_full_forest_and_ranking(spark, flowers):
    table = flowers.read(spark)
    settings = FULL_FOREST.but(trees=20)
    model = jobs.fit(table, INPUTS, "label", jobs.tabular_pipeline(INPUTS, "label", settings), settings)
    forest = model.stages[-1]
    assert forest.getNumTrees == 20 and forest.getOrDefault("maxDepth") == 20
    assert forest.getOrDefault("weightCol") == "weight"
    ranking = feature_ranking(model, INPUTS, table).collect()
    shares = [r["importance"] for r in ranking]
    assert shares == sorted(shares, reverse=True) and sum(shares) == pytest.approx(1.0)
    assert [r["percent"] for r in ranking] == pytest.approx([round(s, 3) * 100 for s in shares])


def test_decoding_uses_the_labels_of_the_model(spark, flowers):
    """Codes by frequency are not codes by name; decoding must follow the model."""
    table = flowers.read(spark).filter("id % 5 > 0 OR label <> 0")
    settings = SMALL.but(label_order="frequencyDesc")
    model = jobs.fit(table, INPUTS, "label", jobs.tabular_pipeline(INPUTS, "label", settings), settings)
    labels = feat.model_labels(model)
    assert sorted(labels) == ["0.0", "1.0", "2.0"] and labels[-1] == "0.0"
    back = feat.decoded(model.transform(table), labels)
    right = back.filter(F.col("predicted_label").cast("double") == F.col("label")).count()
    assert right / table.count() > 0.9


@pytest.mark.parametrize("name", ["forest", "logistic"])
def test_harness_takes_any_learner(spark, flowers, name):
    settings = TrainSettings(max_iter=20)
    estimator = learner(name, settings, feat.INDEXED_FEATURES)
    scored, accuracy = jobs.fit_and_test(flowers.read(spark), estimator, INPUTS, "label", ["id"], settings)
    pairs = jobs.truth_and_prediction(scored)
    assert pairs.columns == ["y_test", "y_pred"] and pairs.count() == 45
    assert accuracy.first()["accuracy"] > 0.8


def test_unknown_learner():
    with pytest.raises(ValueError, match="unknown learner"):
        learner("oracle", SMALL_FOREST)


def test_text_pipeline(spark):
    rows = [
        (0, "spark makes short work of wide tables", 1.0),
        (1, "rain again", 0.0),
        (2, "Spark sorts tables", 1.0),
        (3, "more rain and wind", 0.0),
    ]
    df = spark.createDataFrame(rows, "id bigint, text string, label double")
    settings = TrainSettings(text_features=1 << 10)
    stages = jobs.text_pipeline("text", "label", settings)
    model = jobs.fit(df, ["text"], "label", stages, settings)
    path = scratch_path(spark, "text-model")
    model.write().save(path)
    scored = jobs.predict(PipelineModel.load(path), df)
    assert [r["prediction"] for r in scored.orderBy("id").collect()] == [1.0, 0.0, 1.0, 0.0]
    stored = TableRef(path=scratch_path(spark, "text-scored"), fmt="orc")
    stored.write(scored)
    totals = stored.read(spark).select(F.size("words").alias("n"), "features.values")
    assert all(r["n"] == sum(r["values"]) for r in totals.collect())


def test_null_feature_is_refused_or_skipped(spark, flowers):
    table = flowers.read(spark).withColumn("f1", F.when(F.col("id") != 3, F.col("f1")))
    with pytest.raises(Exception, match="(?i)null"):
        jobs.fit(table, INPUTS, "label", jobs.tabular_pipeline(INPUTS, "label", SMALL), SMALL)
    skip = SMALL.but(invalid="skip")
    model = jobs.fit(table, INPUTS, "label", jobs.tabular_pipeline(INPUTS, "label", skip), skip)
    assert model.transform(table).count() == 149


def test_unseen_label_and_category(spark, flowers):
    table = flowers.read(spark).withColumn("f3", F.col("id") % 3)
    new_label = table.limit(1).withColumn("label", F.lit(9.0))
    new_category = table.limit(1).withColumn("f3", F.lit(7))
    strict = jobs.fit(table, INPUTS, "label", jobs.tabular_pipeline(INPUTS, "label", SMALL), SMALL)
    for odd in (new_label, new_category):
        with pytest.raises(Exception, match="(?i)unseen|unknown|invalid|key not found"):
            strict.transform(odd).collect()
    keep = SMALL.but(invalid="keep")
    model = jobs.fit(table, INPUTS, "label", jobs.tabular_pipeline(INPUTS, "label", keep), keep)
    assert model.transform(new_label).first()["indexedLabel"] == 3.0
    assert model.transform(new_category).count() == 1


def test_labels_sort_as_text(spark):
    df = spark.createDataFrame([(2,), (10,), (1,)], "label int")
    assert feat.label_indexer("label").fit(df).labels == ["1", "10", "2"]


def test_single_class(spark):
    df = spark.range(20).select(
        "id", *[(F.col("id") * i).cast("double").alias(c) for i, c in enumerate(INPUTS)], F.lit("a").alias("label")
    )
    scored, accuracy = jobs.fit_and_test(df, learner("forest", SMALL), INPUTS, "label", ["id"], SMALL)
    assert scored.count() == 6
    assert accuracy.first()["accuracy"] == 1.0


def test_saved_model_predicts_the_same(spark, flowers):
    table = flowers.read(spark)
    model = jobs.fit(table, INPUTS, "label", jobs.tabular_pipeline(INPUTS, "label", SMALL), SMALL)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    assert predictions(load_model(path), table) == predictions(model, table)


def test_scoring_reads_only_what_it_writes(spark, flowers):
    table = flowers.read(spark).withColumn("unused", F.lit(1))
    stored = TableRef(path=scratch_path(spark, "wide"))
    stored.write(table)
    model = jobs.fit(table, INPUTS, "label", jobs.tabular_pipeline(INPUTS, "label", SMALL), SMALL)
    # The assembler holds back later filters: filter before scoring.
    scored = jobs.predict(model, stored.read(spark).filter("id > 100")).select("id", "prediction")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema")[1]
    assert "unused" not in read and "label" not in read
    assert "GreaterThan(id,100)" in plan


def test_command_line(spark, flowers):
    root = scratch_path(spark, "cli")
    base = ["--registry", f"{root}/registry", "--model", "flowers"]

    def call(*argv):
        return run_command(spark, [*base, *argv])

    trained = call(
        *["train", "--source", flowers.path, "--heldout", f"{root}/heldout"],
        *["--model-root", f"{root}/models", "--inputs", *INPUTS, "--label", "label"],
        *["--keys", "id", "--set", "numTrees=5", "maxDepth=4", "fit_partitions=2"],
    )
    assert trained["version"] == 1
    call("stage", "--version", "1", "--stage", "Staging")
    call("score", "--source", flowers.path, "--sink", f"{root}/all", "--stage", "Staging")
    assert spark.read.parquet(f"{root}/all").count() == 150
    places = ["--source", f"{root}/heldout", "--sink", f"{root}/scored", "--stage", "Staging"]
    judged = call("evaluate", *places)
    assert judged["accuracy"]["1"] > 0.8
    assert call("evaluate", *places, "--skip-scoring") == judged


def test_history_of_other_codes_is_judged_by_label(spark):
    """Label 10 is the rarer one: by text it has code 0, by frequency code 1."""
    x = F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.lit(0.0)) + F.col("id") / 1000
    df = spark.range(90).select(
        "id", *[(x * i).alias(c) for i, c in enumerate(INPUTS, 1)],
        F.when(F.col("id") % 3 == 0, F.lit(10)).otherwise(F.lit(2)).alias("label"),
    )
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    scored = TableRef(path=scratch_path(spark, "scored"))
    for version, order in enumerate(("alphabetAsc", "frequencyDesc"), 1):
        _, heldout = run_train(spark, df, registry, SMALL.but(label_order=order))
        registry.set_stage("flowers", version, "Staging")
        jobs.score(spark, heldout, scored, registry, "flowers", "Staging", mode="append", truth=True)
    names = spark.createDataFrame([("2", "two"), ("10", "ten")], "label string, name string")
    result = jobs.evaluate(
        spark, heldout, scored, registry, "flowers", "Staging", scoring=False, names=names
    )
    cells = {
        (r["model_version"], r["actual_name"], r["predicted_name"]): r["n"]
        for r in result.confusion.filter("n > 0").collect()
    }
    assert cells == {(v, name, name): n for v in (1, 2) for name, n in (("two", 18), ("ten", 9))}
    assert result.counts.count() == 4


def test_position_follows_the_order(spark):
    df = spark.range(1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("v"))
    placed = numbered(df.orderBy(F.desc("v"))).collect()
    assert all(r["position"] == 1000 - r["v"] for r in placed)
    assert numbered(df.filter("v < 0").orderBy("v")).count() == 0
