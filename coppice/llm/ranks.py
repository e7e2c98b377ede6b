"""Positions in a global order, without bringing the table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coppice.llm.text import stored

_IN_PARTITION = (1 << 33) - 1


def with_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``name``, the position from 0 in the given order, which must leave no ties that matter.

    Range partitions are sorted and numbered by themselves; the offset of a partition is the number
    of rows before it. Only one row per partition meets in one task.
    """
    placed = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))),
        "ranked",
    )
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", before.alias("_before"))
    )
    return (
        placed.join(offsets, "_part")
        .withColumn(name, F.col("_before") + F.col("_at"))
        .drop("_part", "_at", "_before")
    )
