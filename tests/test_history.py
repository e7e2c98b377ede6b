"""Batches that are scored again, and evaluations that read only what is new."""

import pytest
from pyspark.sql import functions as F

from coppice.operators import metrics
from coppice.plans import history, jobs
from coppice.sources.registry import ModelRegistry
from coppice.sources.tables import TableRef
from coppice.sources.workspace import scratch_path

MODEL = "m"


@pytest.fixture
def registry(spark):
    found = ModelRegistry(spark, scratch_path(spark, "registry"))
    for run in ("r1", "r2"):
        found.register_one(MODEL, run, run)
    return found


def batch(spark, version, name, cells, model=MODEL):
    """Rows of one batch from ``{(actual, predicted): n}``."""
    rows = [(a, p) for (a, p), n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "actual_label string, predicted_label string")
    return df.withColumns(
        {"model_name": F.lit(model), "model_version": F.lit(version), "batch": F.lit(name)}
    )


def cells(evaluation):
    return {(r["model_version"], r["actual"], r["predicted"]): r["n"] for r in evaluation.counts.collect()}


def full(spark, scored):
    rows = scored.read(spark).filter(F.col("model_name") == MODEL)
    counts = metrics.confusion_counts(rows, "actual_label", "predicted_label", ["model_version"])
    return {(r["model_version"], r["actual"], r["predicted"]): r["n"] for r in counts.collect()}


@pytest.mark.parametrize("place", ["path", "name"])
def test_partitions_are_replaced_not_added(spark, place):
    where = scratch_path(spark, "history") if place == "path" else "replaced_history"
    scored = jobs.history_table(**{place: where})
    scored.replace_partitions(batch(spark, 1, "007", {("a", "a"): 3}))
    scored.replace_partitions(batch(spark, 1, "2024-01-02", {("a", "b"): 2}))
    scored.replace_partitions(batch(spark, 1, "007", {("a", "a"): 4}))
    scored.replace_partitions(batch(spark, 2, "007", {("a", "a"): 1}))
    table = scored.read(spark)
    got = {(r["model_version"], r["batch"]): r["count"] for r in table.groupBy("model_version", "batch").count().collect()}
    assert got == {(1, "007"): 4, (1, "2024-01-02"): 2, (2, "007"): 1}
    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    assert (kinds["model_version"], kinds["batch"]) == ("bigint", "string")
    if place == "name":
        spark.sql(f"DROP TABLE {where}")


def test_a_table_without_partitions_is_not_replaced_in_part(spark):
    with pytest.raises(ValueError, match="without partitions"):
        TableRef(path=scratch_path(spark, "t")).replace_partitions(spark.range(1))


def test_a_failed_write_leaves_the_batch_as_it_was(spark):
    scored = jobs.history_table(scratch_path(spark, "history"))
    scored.replace_partitions(batch(spark, 1, "a", {("x", "x"): 3}))
    broken = batch(spark, 1, "a", {("x", "x"): 5}).withColumn(
        "predicted_label", F.when(F.rand(1) < 0, "x").otherwise(F.raise_error(F.lit("stopped")))
    )
    with pytest.raises(Exception, match="stopped"):
        scored.replace_partitions(broken)
    assert scored.read(spark).count() == 3


def test_only_new_batches_are_read(spark, registry):
    scored = jobs.history_table(scratch_path(spark, "history"))
    counts = history.counts_table(scratch_path(spark, "counts"))

    def evaluate():
        found = history.evaluate_new_batches(spark, scored, counts, registry, MODEL)
        assert cells(found.evaluation) == full(spark, scored)
        return found

    scored.replace_partitions(batch(spark, 1, "a", {("x", "x"): 3, ("x", "y"): 1}))
    scored.replace_partitions(batch(spark, 2, "a", {("y", "y"): 2}))
    scored.replace_partitions(batch(spark, 1, "z", {("x", "x"): 9}, model="other"))
    assert evaluate().batches_read == 2
    assert evaluate().batches_read == 0
    scored.replace_partitions(batch(spark, 1, "b", {("y", "x"): 5, (None, "x"): 2}))
    assert evaluate().batches_read == 1
    scored.replace_partitions(batch(spark, 1, "a", {("y", "y"): 3, ("x", "y"): 1}))
    assert evaluate().batches_read == 1
    scored.replace_partitions(batch(spark, 2, "none", {(None, "x"): 4}))
    assert evaluate().batches_read == 1
    found = evaluate()
    assert found.batches_read == 0
    board = {r["version"]: r["value"] for r in registry.leaderboard("Accuracy").collect()}
    assert board == {r["model_version"]: r["accuracy"] for r in found.evaluation.accuracy.collect()}
    assert board == {1: 3 / 9, 2: 1.0}


def test_many_batches_are_counted_by_several_scans(spark, registry, monkeypatch):
    monkeypatch.setattr(history, "BATCHES_PER_SCAN", 3)
    scored = jobs.history_table(scratch_path(spark, "history"))
    counts = history.counts_table(scratch_path(spark, "counts"))
    rows = [("x", "xy"[i % 2], MODEL, 1 + i % 2, f"b{i}") for i in range(8)]
    scored.replace_partitions(
        spark.createDataFrame(rows, "actual_label string, predicted_label string, model_name string, model_version long, batch string")
    )
    found = history.evaluate_new_batches(spark, scored, counts, registry, MODEL)
    assert found.batches_read == 8 and cells(found.evaluation) == full(spark, scored)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_scan_opens_the_named_batches_and_stamps_read_no_column(spark):
    scored = jobs.history_table(scratch_path(spark, "history"))
    for name in ("a", "b", "c"):
        scored.replace_partitions(batch(spark, 1, name, {("x", "x"): 3}))
    table = scored.read(spark)
    chosen = table.select(*history.KEYS).distinct().filter("batch = 'b'").collect()
    counted = history.batch_counts(table, chosen, "actual_label", "predicted_label")
    plan = plan_of(counted)
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "(batch" in pruned and "(model_version" in pruned and "batch" not in plan.split("PushedFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<>" in plan_of(history.batch_stamps(table))


def test_an_empty_history(spark, registry):
    scored = jobs.history_table(scratch_path(spark, "history"))
    scored.replace_partitions(batch(spark, 1, "a", {("x", "x"): 1}, model="other"))
    counts = history.counts_table(scratch_path(spark, "counts"))
    found = history.evaluate_new_batches(spark, scored, counts, registry, MODEL)
    assert found.batches_read == 0 and found.evaluation.accuracy.count() == 0
