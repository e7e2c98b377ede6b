"""Model versions, stages, runs, and model files."""

import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coppice.sources.commits import CommitLog
from coppice.sources.models import check_contract
from coppice.sources.registry import ModelRegistry, VersionNotFound
from coppice.sources.tables import TableRef, rows_to_table
from coppice.sources.workspace import scratch_path, shared_dir


@pytest.fixture
def registry(spark):
    return ModelRegistry(spark, scratch_path(spark, "registry"))


def test_versions_count_up_by_name(registry):
    assert registry.versions().count() == 0
    assert registry.register_one("forest", "r1", "p1").version == 1
    assert registry.register_one("forest", "r2", "p2").version == 2
    assert registry.register_one("other", "r3", "p3").version == 1


def test_a_name_twice_in_one_call_is_refused(spark, registry):
    twice = spark.createDataFrame(
        [("a", "r1", "p1"), ("a", "r2", "p2")], "name string, run_id string, source string"
    )
    with pytest.raises(Exception, match="registered twice in one call: a"):
        registry.register(twice)


def test_lookup_takes_the_highest_version_at_the_stage(registry):
    for run in ("r1", "r2", "r3"):
        registry.register_one("forest", run, f"models/{run}")
    with pytest.raises(VersionNotFound, match="'forest' at stage 'Staging'"):
        registry.lookup("forest", "Staging")
    registry.set_stage("forest", 1, "Staging")
    registry.set_stage("forest", 2, "Staging")
    found = registry.lookup("forest", "Staging")
    assert (found.version, found.run_id, found.source) == (2, "r2", "models/r2")
    registry.set_stage("forest", 2, "Production")
    assert registry.lookup("forest", "Staging").version == 1
    assert registry.lookup("forest", "Production").version == 2
    with pytest.raises(VersionNotFound):
        registry.lookup("nothing", "Staging")


def test_stage_of_an_unknown_version(registry):
    registry.register_one("forest", "r1", "p1")
    with pytest.raises(VersionNotFound, match="no version 5"):
        registry.set_stage("forest", 5, "Staging")


def test_params_and_metrics(spark, registry):
    registry.log_run_params("r1", {"trees": "12", "depth": "10"})
    assert {r["key"]: r["value"] for r in registry.params().collect()} == {
        "trees": "12",
        "depth": "10",
    }
    registry.register_one("forest", "r1", "p1")
    registry.register_one("forest", "r2", "p2")
    scores = spark.createDataFrame(
        [(1, "Accuracy", 0.9), (2, "Accuracy", 0.8)],
        "model_version bigint, key string, value double",
    )
    registry.log_version_metrics("forest", scores)
    registry.log_version_metrics("forest", scores.filter("model_version = 2").withColumn("value", F.lit(0.95)))
    board = {r["version"]: r["value"] for r in registry.leaderboard("Accuracy").collect()}
    assert board == {1: 0.9, 2: 0.95}


def test_latest_stage_is_limited_before_the_shuffle(registry):
    registry.register_one("forest", "r1", "p1")
    registry.set_stage("forest", 1, "Staging")
    plan = registry.current_stages()._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_contract(spark):
    contract = T.StructType.fromDDL("a double, b string")
    check_contract(spark.createDataFrame([(1, "x", 2.0)], "extra int, b string, a double"), contract)
    with pytest.raises(ValueError, match="missing input columns: b"):
        check_contract(spark.createDataFrame([(1.0,)], "a double"), contract)
    with pytest.raises(ValueError, match="a is int, expected double"):
        check_contract(spark.createDataFrame([(1, "x")], "a int, b string"), contract)


def test_rows_to_table_keeps_the_declared_schema(spark):
    df = rows_to_table(spark, [(0.0, "setosa")], "label double, species string")
    assert df.schema == T.StructType.fromDDL("label double, species string")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_paths_are_overwritten(spark, fmt):
    ref = TableRef(path=scratch_path(spark, "table"), fmt=fmt)
    ref.write(spark.range(5))
    ref.write(spark.range(3))
    assert sorted(r["id"] for r in ref.read(spark).collect()) == [0, 1, 2]
    ref.write(spark.range(3, 4), mode="append")
    assert ref.read(spark).count() == 4


def test_catalog_tables_are_overwritten(spark):
    ref = TableRef(name="scored_rows", fmt="ORC")
    ref.write(spark.range(5))
    ref.write(spark.range(2))
    assert spark.table("scored_rows").count() == 2
    spark.sql("DROP TABLE scored_rows")


def test_a_table_needs_a_place():
    with pytest.raises(ValueError):
        TableRef()


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert scratch_path(spark, "x").startswith(configured)


def test_one_file_per_run(spark, registry):
    for run in ("r1", "r2"):
        registry.log_run_params(run, {"trees": "12", "depth": "10"})
    assert len(spark.read.parquet(f"{registry.root}/run_params").inputFiles()) == 2


def test_a_key_given_twice_for_a_run_is_refused(spark, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "twice"))
    twice = spark.createDataFrame([("r", "k", 1.0), ("r", "k", 2.0)], "run_id string, key string, value double")
    for log in (registry.log_params, registry.log_metrics):
        with pytest.raises(Exception, match="logged twice in one call: k"):
            log(twice)


def test_the_last_logged_value_wins_whatever_the_clock_says(spark, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "last"))
    for value in (3.0, 9.0, 1.0):
        registry.log_metrics(
            spark.createDataFrame([("r", "k", value)], "run_id string, key string, value double")
        )
    assert [r["value"] for r in registry.metrics().collect()] == [1.0]


def in_threads(jobs):
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def test_eight_writers_give_versions_one_to_eight(spark):
    root = scratch_path(spark, "registry")
    given = in_threads(
        [lambda i=i: ModelRegistry(spark, root).register_one("forest", f"r{i}", f"p{i}") for i in range(8)]
    )
    registry = ModelRegistry(spark, root)
    assert sorted(v.version for v in given) == list(range(1, 9))
    rows = {(r["version"], r["run_id"], r["source"]) for r in registry.versions().collect()}
    assert rows == {(v.version, v.run_id, v.source) for v in given} and registry.versions().count() == 8


def test_no_stage_of_two_writers_is_lost(spark):
    root = scratch_path(spark, "registry")
    registry = ModelRegistry(spark, root)
    registry.register_one("forest", "r", "p")
    in_threads(
        [lambda s=s: ModelRegistry(spark, root).set_stage("forest", 1, s) for s in ("a", "b", "c", "d")]
    )
    events = registry._read("model_stages").collect()
    assert sorted(e["seq"] for e in events) == [1, 2, 3, 4]
    assert {e["stage"] for e in events} == {"a", "b", "c", "d"}
    last = max(events, key=lambda e: e["seq"])
    assert [r["stage"] for r in registry.current_stages().collect()] == [last["stage"]]


def test_a_stopped_writer_leaves_nothing_visible(spark, registry):
    registry.register_one("forest", "r1", "p1")
    lost = registry._single(name="forest", version=2, run_id="r2", source="p2")
    registry._stored("model_versions", lost)
    CommitLog(spark, f"{registry.root}/model_versions")._put("_half", "{")
    assert registry.versions().count() == 1
    assert registry.register_one("forest", "r3", "p3").version == 2
    folder = Path(registry.root.removeprefix("file:")) / "model_versions"
    assert len(list(folder.glob("rows=*"))) == 3


def test_a_number_is_taken_once(spark):
    log = CommitLog(spark, scratch_path(spark, "log"))
    taken = in_threads([lambda i=i: log.commit(1, [f"f{i}"]) for i in range(16)])
    assert sum(taken) == 1
    assert log.snapshot().folders == (f"f{taken.index(True)}",)
    assert log.commit(2, ["g"]) and log.snapshot(1).number == 1
    with pytest.raises(LookupError, match="no commit 3"):
        log.snapshot(3)


def test_merged_commits_keep_rows_numbers_and_history(spark):
    registry = ModelRegistry(spark, scratch_path(spark, "registry"), merge_after=3)
    for i in range(7):
        registry.register_one("forest", f"r{i}", f"p{i}")
    assert sorted(r["version"] for r in registry.versions().collect()) == list(range(1, 8))
    log = CommitLog(spark, f"{registry.root}/model_versions")
    assert len(log.snapshot().folders) < 4
    assert [registry.versions(commit=n).count() for n in range(4)] == [0, 1, 2, 3]


def test_merging_keeps_what_others_commit_meanwhile(spark, monkeypatch):
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    registry.register_one("forest", "r1", "p1")
    store = registry._stored

    def slow(table, rows):
        folder = store(table, rows)
        monkeypatch.setattr(registry, "_stored", store)
        registry.register_one("forest", "r2", "p2")
        return folder

    monkeypatch.setattr(registry, "_stored", slow)
    registry.merge("model_versions")
    assert sorted(r["run_id"] for r in registry.versions().collect()) == ["r1", "r2"]
    assert registry.register_one("forest", "r3", "p3").version == 3


def test_numbers_are_taken_by_rename_where_links_are_unknown(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.tests.link./at", f"file://{tmp_path}")
    log = CommitLog(spark, "viewfs://tests/at/table")
    assert log.snapshot().number == 0
    assert [log.commit(1, ["a"]), log.commit(1, ["b"]), log.commit(2, ["b"])] == [True, False, True]
    assert log.snapshot().folders == ("a", "b")
    assert sorted(p.name for p in (tmp_path / "table/_commits").glob("[0-9_]*")) == [f"{n:020d}" for n in (1, 2)]


def test_stages_at_a_past_time(registry):
    moments = [datetime.now()]
    registry.register_one("forest", "r1", "p1")
    registry.register_one("forest", "r2", "p2")
    for version, stage in ((1, "Staging"), (2, "Staging"), (2, "Production")):
        registry.set_stage("forest", version, stage)
        time.sleep(0.05)
        moments.append(datetime.now())
        time.sleep(0.05)
    assert [registry.stage_commit(m) for m in moments] == [0, 1, 2, 3]
    found = [registry.lookup("forest", "Staging", at=m).version for m in moments[1:]]
    assert found == [1, 2, 1] and registry.lookup("forest", "Staging").version == 1
    with pytest.raises(VersionNotFound):
        registry.lookup("forest", "Staging", at=moments[0])
    assert registry.at_stage(commit=1).count() == 1
