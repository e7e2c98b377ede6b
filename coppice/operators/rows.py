"""Row order, copies and layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coppice.functions.hashing import content_hash, split_hash
from coppice.operators.small import join_on, localised
from coppice.sources.workspace import scratch_path, shared_dir

COPIES_PER_ROW = 100_000


def _in_random_order(df: DataFrame, keys: Sequence[str], seed: int) -> tuple[DataFrame, list[str]]:
    """Add sort columns: the seeded key hash, and the content of rows that share a key."""
    added = {"_order": split_hash(seed, keys), "_content": content_hash(df.columns)}
    return df.withColumns(added), ["_order", *keys, "_content"]


def shuffled(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """Rows in a random order that depends on seed and rows only, not on layout.

    A row number as the last sort column lets the range partitioner cut through copies of one row,
    of which there may be very many. It is given after a local sort, so that a task that runs again
    numbers its rows as before and loses none.
    """
    tagged, order = _in_random_order(df, keys, seed)
    numbered = tagged.sortWithinPartitions(*order).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    return numbered.orderBy(*order, "_row").select(*df.columns)


def first_shuffled(df: DataFrame, n: int, keys: Sequence[str], seed: int) -> DataFrame:
    """The first ``n`` rows of the shuffled order: a top-n per task, no global sort."""
    tagged, order = _in_random_order(df, keys, seed)
    return tagged.orderBy(*order).limit(n).select(*df.columns)


def preview(df: DataFrame, n: int = 5, order: Sequence[str | Column] = ()) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(n)


def ranked(df: DataFrame, value: str, tie: str) -> DataFrame:
    """Rows by falling value; ties by name."""
    return df.orderBy(F.desc(value), F.asc(tie))


def numbered(df: DataFrame, output: str = "position") -> DataFrame:
    """The place of every row in the order that ``df`` has, from 1.

    The rows are written once; tasks are counted, and each row adds its place in its task to the rows
    of the tasks before. Only one row per task meets in a window.
    """
    path = scratch_path(df.sparkSession, "numbered")
    df.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumns(
        {"_task": F.shiftright("_at", 33), "_in_task": F.col("_at").bitwiseAND((1 << 33) - 1)}
    )
    tasks = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_in_task") + 1
    return rows.join(starts, "_task").select(*df.columns, place.alias(output))


def running_totals(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], values: Sequence[str]
) -> DataFrame:
    """Add ``<value>_upto``, the sum over the rows of the group up to and with this one.

    The rows are placed by ranges of group and order and written once; sums run within a range, and
    what a group brings from the ranges before is added from a table with a row for each group and
    range. So no task holds more than a range, whatever the size of a group. ``order`` must leave no
    ties within a group that matter.
    """
    by = [*groups, *order]
    path = scratch_path(df.sparkSession, "ranges")
    placed = df.repartitionByRange(*by) if by else df
    placed.sortWithinPartitions(*by).withColumns(
        {"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}
    ).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    within = Window.partitionBy("_range", *groups).orderBy("_at")
    sums = {f"{v}_upto": F.sum(v).over(within) for v in values}

    totals = rows.groupBy("_range", *groups).agg(*[F.sum(v).alias(f"_{v}") for v in values])
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "_range", *groups, *[F.sum(f"_{v}").over(earlier).alias(f"_{v}") for v in values]
    ).filter(F.col(f"_{values[0]}").isNotNull())
    joined = join_on(rows.withColumns(sums), localised(before), ["_range", *groups], "left")
    added = {f"{v}_upto": F.col(f"{v}_upto") + F.coalesce(f"_{v}", F.lit(0)) for v in values}
    return joined.withColumns(added).select(*df.columns, *added)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each group to one row inside every map task before the shuffle, so a key with
    very many rows reaches its reducer as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _chunks(df: DataFrame, times: str, partitions: int, chunk: int) -> DataFrame:
    """One row per ``chunk`` copies, placed by chunk number and content."""
    columns = [c for c in df.columns if c != times]
    last = F.floor((F.col(times) - 1) / chunk).cast("int")
    numbered = df.filter(F.col(times) > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), last))
    )
    return numbered.repartition(partitions, "_chunk", content_hash(columns))


def _grown(chunks: DataFrame, times: str, chunk: int) -> DataFrame:
    """The copies of every chunk, where the chunk lies."""
    columns = [c for c in chunks.columns if c not in (times, "_chunk")]
    size = F.least(F.lit(chunk), F.col(times) - F.col("_chunk") * chunk).cast("int")
    return chunks.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), size))).select(*columns)


def repeated(df: DataFrame, times: str, partitions: int, chunk: int = COPIES_PER_ROW) -> DataFrame:
    """Every row ``times`` times, the copies spread over the cluster in chunks.

    The copies made from one chunk differ in nothing, so only the chunks move.
    """
    return _grown(_chunks(df, times, partitions, chunk), times, chunk)


def stable_layout(df: DataFrame, partitions: int, chunk: int = COPIES_PER_ROW) -> DataFrame:
    """The same rows in the same partitions and order, however ``df`` was laid out.

    Rows are placed by their whole content, so a key with many different rows spreads out. Copies
    are counted before they move, placed in chunks, and grown again afterwards. The placed chunks are
    checkpointed: a lost executor costs a read, not a new shuffle, and later passes see the same
    order.
    """
    shared_dir(df.sparkSession)
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    placed = (
        _chunks(counted, "_copies", partitions, chunk)
        .sortWithinPartitions(*columns, "_chunk")
        .checkpoint()
    )
    return _grown(placed, "_copies", chunk)
