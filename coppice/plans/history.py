"""Judging a scoring history that grows batch by batch.

Confusion counts can be added up, so each batch is counted once: its counts are kept in a table with
the same partitions as the history, and a later evaluation reads only batches that are new or were
scored again. Which ones these are is told by the files of the history, without reading a column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from coppice.operators import features as feat
from coppice.operators import metrics
from coppice.operators.small import localised
from coppice.plans.jobs import ACCURACY, HISTORY, Evaluation
from coppice.sources.registry import ModelRegistry
from coppice.sources.tables import TableRef

KEYS = [column for column, _ in HISTORY]

#: Batches named in one scan's partition filter; more are counted by several scans.
BATCHES_PER_SCAN = 500


@dataclass(frozen=True)
class Increment:
    """The evaluation, and how many batches had to be read for it."""

    evaluation: Evaluation
    batches_read: int


def counts_table(path: str | None = None, name: str | None = None, fmt: str = "parquet") -> TableRef:
    return TableRef(path, name, fmt, HISTORY)


def batch_stamps(history: DataFrame) -> DataFrame:
    """``(…KEYS, stamp)`` per batch: the number of its files, their bytes and the newest one's time.

    ``history`` is a table as read: the columns come from its file listing.
    """
    files = history.select(
        *KEYS,
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("time"),
    ).groupBy(*KEYS, "path").agg(F.max("size").alias("size"), F.max("time").alias("time"))
    stamp = F.concat_ws(
        "/", F.count("path"), F.sum("size"), F.unix_micros(F.max("time"))
    )
    return files.groupBy(*KEYS).agg(stamp.alias("stamp"))


def _among(batches: Sequence[Row]) -> Column:
    """A predicate on the partition columns alone, so that other batches are not even opened."""
    return reduce(
        lambda a, b: a | b,
        [reduce(lambda a, b: a & b, [F.col(k) == F.lit(batch[k]) for k in KEYS]) for batch in batches],
    )


def batch_counts(
    history: DataFrame, batches: Sequence[Row], actual: str, predicted: str
) -> DataFrame:
    """``(…KEYS, actual, predicted, n)`` of the given batches."""
    return metrics.confusion_counts(history.filter(_among(batches)), actual, predicted, KEYS)


def refresh_counts(
    spark: SparkSession,
    scored: TableRef,
    counts: TableRef,
    name: str,
    actual: str = feat.ACTUAL_LABEL,
    predicted: str = feat.PREDICTED_LABEL,
) -> tuple[DataFrame, int]:
    """Count the batches of one model that are new or changed; returns the model's counts.

    A batch none of whose rows can be judged is remembered by a row without classes.
    """
    history = scored.read(spark).filter(F.col("model_name") == name)
    stamps = localised(batch_stamps(history))
    pending = stamps
    if counts.exists(spark):
        known = counts.read(spark).select(*KEYS, "stamp").distinct()
        pending = stamps.join(known, [*KEYS, "stamp"], "left_anti")
    pending = localised(pending)
    read = 0
    while batches := pending.orderBy(*KEYS).offset(read).limit(BATCHES_PER_SCAN).collect():
        cells = batch_counts(history, batches, actual, predicted)
        counts.replace_partitions(
            pending.filter(_among(batches)).join(cells, KEYS, "left").fillna(0, ["n"])
        )
        read += len(batches)
    if not read and not counts.exists(spark):
        return metrics.confusion_counts(history, actual, predicted, KEYS), 0
    there = counts.read(spark).filter(F.col("model_name") == name)
    return there.join(stamps, [*KEYS, "stamp"], "left_semi").filter("n > 0").drop("stamp"), read


def evaluate_new_batches(
    spark: SparkSession,
    scored: TableRef,
    counts: TableRef,
    registry: ModelRegistry,
    name: str,
    actual: str = feat.ACTUAL_LABEL,
    predicted: str = feat.PREDICTED_LABEL,
    names: DataFrame | None = None,
) -> Increment:
    """Judge every version of a model over its whole history, reading only what was not judged yet.

    The result equals :func:`coppice.plans.jobs.evaluate` over the same history. Batches that were
    removed from the history no longer count.
    """
    batches, read = refresh_counts(spark, scored, counts, name, actual, predicted)
    by = ["model_version"]
    cells = localised(
        batches.groupBy(*by, "actual", "predicted").agg(F.sum("n").alias("n"))
    )
    accuracy = metrics.accuracy_from_counts(cells, by)
    logged = accuracy.withColumnRenamed("accuracy", "value").withColumn("key", F.lit(ACCURACY))
    registry.log_version_metrics(name, logged)
    confusion = metrics.matrix_from_counts(cells, by=by)
    if names is not None:
        confusion = metrics.confusion_named(confusion, names)
    return Increment(Evaluation(accuracy, cells, confusion), read)
