"""Model versions, their stages, and run parameters and metrics, kept as append-only tables.

Every call appends rows for whole tables of models as well as for a single one. Numbers are given as
``max + 1`` of the table as the call found it, and the rows count only if no other call has committed
in between; otherwise they are made again. So several jobs may write to one registry.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.functions.columns import equals_all
from coppice.operators.rows import latest_per_key
from coppice.operators.timelines import as_of, highest_over_time, spans
from coppice.sources.commits import CommitLog, Snapshot

SCHEMAS = {
    "model_versions": "name string, version bigint, run_id string, source string",
    "model_stages": "name string, version bigint, stage string, seq bigint",
    "run_params": "run_id string, key string, value string, seq bigint",
    "run_metrics": "run_id string, key string, value double, seq bigint",
}


#: Commits after which the data folders of a table are merged.
MERGE_AFTER = 64

#: Times a call makes its rows anew before it gives up, and the longest wait in between, in seconds.
ATTEMPTS = 100
LONGEST_WAIT = 2.0


class VersionNotFound(LookupError):
    """No version of the model is at the stage."""


class CommitConflict(RuntimeError):
    """Other writers were faster every time."""


@dataclass(frozen=True)
class ModelVersion:
    name: str
    version: int
    run_id: str
    source: str
    stage: str | None = None


def stage_timeline(changes: DataFrame) -> DataFrame:
    """``(name, stage, at, version)`` from ``changes(name, version, stage, seq, at)``.

    The highest version at the stage from each moment on, up to the next one of that name and stage;
    null if the stage is empty then.
    """
    held = spans(changes, ["name", "version"], "at", ["seq"])
    return highest_over_time(held, ["name", "stage"], "version")


class ModelRegistry:
    def __init__(
        self, spark: SparkSession, root: str, fmt: str = "parquet", merge_after: int = MERGE_AFTER
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.merge_after = merge_after

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _log_of(self, table: str) -> CommitLog:
        return CommitLog(self.spark, self._path(table))

    def _rows(self, table: str, at: Snapshot) -> DataFrame:
        schema = SCHEMAS[table]
        if not at.folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self._path(table)}/{folder}" for folder in at.folders]
        return self.spark.read.schema(schema).format(self.fmt).load(paths)

    def _read(self, table: str, commit: int | None = None) -> DataFrame:
        return self._rows(table, self._log_of(table).snapshot(commit))

    def _stored(self, table: str, rows: DataFrame) -> str:
        """Write rows to a folder that no commit names yet."""
        folder = f"rows={uuid.uuid4().hex}"
        rows.write.format(self.fmt).save(f"{self._path(table)}/{folder}")
        return folder

    def _append(self, table: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Commit the rows that ``make`` derives from the table, and return them.

        If another writer commits first, they are derived again from what the table is then.
        """
        log = self._log_of(table)
        for attempt in range(ATTEMPTS):
            found = log.snapshot()
            folder = self._stored(table, make(self._rows(table, found)))
            if log.commit(found.number + 1, [folder]):
                if found.since_whole + 1 >= self.merge_after:
                    self.merge(table)
                return self._rows(table, Snapshot(found.number + 1, (folder,), 0))
            log.discard(folder)
            time.sleep(random.uniform(0, min(LONGEST_WAIT, 0.05 * 2**attempt)))
        raise CommitConflict(f"{ATTEMPTS} attempts to write to {self._path(table)}")

    def merge(self, table: str) -> None:
        """Put the rows of all commits so far into one folder, which readers then start from.

        Commits of other writers meanwhile keep their own folders.
        """
        log = self._log_of(table)
        merged = log.snapshot()
        folder = self._stored(table, self._rows(table, merged))
        for _ in range(ATTEMPTS):
            now = log.snapshot()
            if not set(merged.folders) <= set(now.folders):
                break  # another writer has merged them
            later = [f for f in now.folders if f not in merged.folders]
            if log.commit(now.number + 1, [folder, *later], whole=True):
                return
        log.discard(folder)

    def _single(self, **values: object) -> DataFrame:
        one = self.spark.range(0, 1, 1, numPartitions=1)
        return one.select(*[F.lit(v).alias(k) for k, v in values.items()])

    # Versions

    def versions(self, commit: int | None = None) -> DataFrame:
        """All versions, or those that ``commit`` left."""
        return self._read("model_versions", commit)

    def register(self, models: DataFrame) -> DataFrame:
        """Append the next version of each model in ``models(name, run_id, source)``; returns them.

        A name given twice in one call is an error: its versions would have no order.
        """
        once = F.when(F.col("_given") == 1, F.col("run_id")).otherwise(
            F.raise_error(F.concat(F.lit("registered twice in one call: "), "name"))
        )
        batch = models.groupBy("name").agg(
            F.max("run_id").alias("run_id"),
            F.max("source").alias("source"),
            F.count(F.lit(1)).alias("_given"),
        )

        def numbered(known: DataFrame) -> DataFrame:
            last = known.groupBy("name").agg(F.max("version").alias("_last"))
            return batch.join(last, "name", "left").select(
                "name",
                (F.coalesce("_last", F.lit(0)) + 1).alias("version"),
                once.alias("run_id"),
                "source",
            )

        return self._append("model_versions", numbered)

    def register_one(self, name: str, run_id: str, source: str) -> ModelVersion:
        given = self.register(self._single(name=name, run_id=run_id, source=source)).first()
        return ModelVersion(name, given["version"], run_id, source)

    # Stages

    def set_stages(self, changes: DataFrame) -> None:
        """Append a stage change for each row of ``changes(name, version, stage)``."""
        key = ["name", "version"]
        once = F.when(F.col("_given") == 1, F.col("stage")).otherwise(
            F.raise_error(F.concat(F.lit("stage changed twice in one call: "), "name"))
        )
        batch = changes.groupBy(*key).agg(
            F.max("stage").alias("stage"), F.count(F.lit(1)).alias("_given")
        )

        def numbered(known: DataFrame) -> DataFrame:
            last = known.groupBy(*key).agg(F.max("seq").alias("_last"))
            return batch.join(last, key, "left").select(
                "name",
                F.col("version").cast("bigint").alias("version"),
                once.alias("stage"),
                (F.coalesce("_last", F.lit(0)) + 1).alias("seq"),
            )

        self._append("model_stages", numbered)

    def set_stage(self, name: str, version: int, stage: str) -> None:
        known = self.versions().filter(equals_all({"name": name, "version": version}))
        if known.isEmpty():
            raise VersionNotFound(f"no version {version} of model {name!r}")
        self.set_stages(self._single(name=name, version=version, stage=stage))

    def stage_commit(self, moment: datetime) -> int:
        """The last commit of stage changes at or before ``moment``."""
        return self._log_of("model_stages").number_at(moment)

    def current_stages(self, commit: int | None = None) -> DataFrame:
        """The latest stage of each version, ``(name, version, stage)``, or that after ``commit``."""
        events = self._read("model_stages", commit)
        return latest_per_key(events, ["name", "version"], [F.desc("seq")]).drop("seq")

    def at_stage(self, commit: int | None = None) -> DataFrame:
        """The highest version of each model at each stage, with its run and source.

        ``commit`` looks at the stages as that commit of stage changes left them.
        """
        staged = self.current_stages(commit).join(self.versions(), ["name", "version"])
        return latest_per_key(staged, ["name", "stage"], [F.desc("version")])

    def lookup(self, name: str, stage: str, at: datetime | None = None) -> ModelVersion:
        """The highest version at a stage, now or at a past time."""
        found = self.at_stage(None if at is None else self.stage_commit(at))
        row = found.filter(equals_all({"name": name, "stage": stage})).first()
        if row is None:
            raise VersionNotFound(f"no version of model {name!r} at stage {stage!r}")
        return ModelVersion(**row.asDict())

    def stage_changes(self) -> DataFrame:
        """All stage changes with their time, ``(name, version, stage, seq, at)``.

        The time is that of the commit; what a merge has put together is read where it was first.
        """
        schema = "_folder string, _millis bigint"
        log, table = self._log_of("model_stages"), self._path("model_stages")
        taken = [(folder, millis) for _, millis, folders in log.added() for folder in folders]
        times = self.spark.createDataFrame(taken, schema)
        rows = self._rows("model_stages", Snapshot(0, tuple(folder for folder, _ in taken), 0))
        if not taken:
            return rows.withColumn("at", F.lit(None).cast("timestamp"))
        folder = F.regexp_extract(F.col("_metadata.file_path"), "(rows=[0-9a-f]+)/[^/]*$", 1)
        timed = rows.withColumn("_folder", folder).join(times, "_folder")
        return timed.withColumn("at", F.timestamp_millis("_millis")).drop("_folder", "_millis")

    def stage_timeline(self) -> DataFrame:
        """``(name, stage, at, version)``: the version that a lookup finds from each moment on."""
        return stage_timeline(self.stage_changes())

    def versions_as_of(self, rows: DataFrame, at: str) -> DataFrame:
        """``rows(name, stage, …)`` with the ``version`` that a lookup found at the time in ``at``.

        Null where no version was at the stage then.
        """
        timeline = self.stage_timeline().withColumnRenamed("at", "_since")
        return as_of(rows, timeline, ["name", "stage"], at, "_since")

    # Runs

    def log_params(self, params: DataFrame) -> None:
        """Append ``params(run_id, key, value)``; a key given twice for a run is an error."""
        self._log("run_params", params, "string")

    def log_run_params(self, run_id: str, params: Mapping[str, str]) -> None:
        pairs = F.array(
            *[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in params.items()]
        )
        self.log_params(self._single(run_id=run_id).select("run_id", F.inline(pairs)))

    def log_metrics(self, metrics: DataFrame) -> None:
        """Append ``metrics(run_id, key, value)``; a key given twice for a run is an error."""
        self._log("run_metrics", metrics, "double")

    def _log(self, table: str, values: DataFrame, kind: str) -> None:
        """Append values, numbered behind the earlier ones of their run and key."""
        key = ["run_id", "key"]
        once = F.when(F.col("_given") == 1, F.col("value")).otherwise(
            F.raise_error(F.concat(F.lit("logged twice in one call: "), "key")).cast(kind)
        )
        batch = (
            values.select(*key, F.col("value").cast(kind).alias("value"))
            .groupBy(*key)
            .agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("_given"))
        )

        def numbered(known: DataFrame) -> DataFrame:
            last = known.groupBy(*key).agg(F.max("seq").alias("_last"))
            return batch.join(last, key, "left").select(
                *key, once.alias("value"), (F.coalesce("_last", F.lit(0)) + 1).alias("seq")
            )

        self._append(table, numbered)

    def log_version_metrics(self, name: str, metrics: DataFrame) -> None:
        """Append ``metrics(model_version, key, value)`` under the run of each version."""
        runs = self.versions().filter(equals_all({"name": name})).select("version", "run_id")
        scored = metrics.withColumnRenamed("model_version", "version")
        self.log_metrics(scored.join(runs, "version").select("run_id", "key", "value"))

    def params(self) -> DataFrame:
        """The last value of each parameter of each run."""
        return self._last_logged("run_params")

    def metrics(self) -> DataFrame:
        """The last value of each metric of each run."""
        return self._last_logged("run_metrics")

    def _last_logged(self, table: str) -> DataFrame:
        return latest_per_key(self._read(table), ["run_id", "key"], [F.desc("seq")]).drop("seq")

    def leaderboard(self, key: str, columns: Sequence[str] = ("name", "version")) -> DataFrame:
        """Versions with their last value of one metric."""
        values = self.metrics().filter(equals_all({"key": key})).select("run_id", "value")
        return self.versions().join(values, "run_id").select(*columns, "run_id", "value")
