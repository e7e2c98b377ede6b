"""Values over time: which value held at which moment, and rows joined to the value of their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coppice.functions.hashing import content_hash
from coppice.operators.rows import numbered
from coppice.operators.small import join_on, localised
from coppice.sources.workspace import scratch_path


def spans(
    changes: DataFrame, member: Sequence[str], at: str, order: Sequence[str] = ()
) -> DataFrame:
    """``changes`` with ``since`` and ``until`` for ``at``: the time up to the member's next change.

    ``until`` is exclusive, and null for what still holds. Of changes at one moment the last in
    ``order`` counts; a change without a time takes no part.
    """
    following = Window.partitionBy(*member).orderBy(at, *order)
    return (
        changes.filter(F.col(at).isNotNull())
        .withColumn("until", F.lead(at).over(following))
        .filter(F.col("until").isNull() | (F.col("until") > F.col(at)))
        .withColumnRenamed(at, "since")
        .drop(*order)
    )


#: Blocks of 2^k neighbouring positions that together make up the positions from _first to before _last.
_BLOCKS = """
    filter(
        flatten(transform(
            transform(
                sequence(0, cast(floor(log2(_last)) AS int)),
                k -> named_struct(
                    'k', k,
                    'l', shiftright(_first + shiftleft(1L, k) - 1, k),
                    'r', shiftright(_last, k)
                )
            ),
            x -> array(
                named_struct('level', x.k, 'block', x.l, 'used', x.l < x.r AND x.l % 2 = 1),
                named_struct('level', x.k, 'block', x.r - 1, 'used', x.l < x.r AND x.r % 2 = 1)
            )
        )),
        b -> b.used
    )
"""


def highest_over_time(held: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(…keys, at, value)``: the highest value that holds from each moment on at which that may change.

    ``held(…keys, value, since, until)`` has overlapping spans. All moments are numbered in the order
    of key and time; a span covers a stretch of numbers, which is cut into at most two blocks of each
    power of two. The highest value of a block is one aggregation, and a moment looks up the blocks it
    lies in. So n spans make n log n rows, however many of them overlap. The value is null where none
    holds.
    """
    held = localised(held.select(*keys, value, "since", "until"))
    moments = (
        held.select(*keys, F.explode(F.array("since", "until")).alias("at"))
        .filter(F.col("at").isNotNull())
        .distinct()
    )
    placed = localised(numbered(moments.orderBy(*keys, "at")))
    ends = localised(
        placed.groupBy(*keys).agg(
            (F.max("position") + 1).alias("_end"),
            F.floor(F.log2(F.count(F.lit(1)).cast("double"))).cast("int").alias("_levels"),
        )
    )

    def at_position(rows: DataFrame, time: str, output: str) -> DataFrame:
        side = placed.select(*keys, F.col("at").alias(time), F.col("position").alias(output))
        return join_on(rows, side, [*keys, time], "left")

    covered = at_position(at_position(held, "since", "_first"), "until", "_last")
    covered = join_on(covered, ends, keys, "left").withColumn("_last", F.coalesce("_last", "_end"))
    best = (
        covered.select(value, F.inline(F.expr(_BLOCKS)))
        .groupBy("level", "block")
        .agg(F.max(value).alias(value))
    )
    looked_up = join_on(placed, ends, keys, "left").select(
        *keys, "at", "position", F.explode(F.sequence(F.lit(0), F.col("_levels"))).alias("level")
    )
    looked_up = looked_up.withColumn("block", F.expr("shiftright(position, level)"))
    return (
        looked_up.join(best, ["level", "block"], "left")
        .groupBy(*keys, "at")
        .agg(F.max(value).alias(value))
    )


def as_of(
    rows: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    order: Sequence[str] = (),
) -> DataFrame:
    """Every row with the other columns of its key's last change at or before its time.

    Rows and changes are put in the order of key and time together, placed by ranges of that order and
    written once. A row takes the last change before it in its range; if there is none there, the last
    one of the key in the ranges before, from a table with one row for each key and range. A key or a
    moment of any size is thus cut into ranges, and no interval is spread over the time it covers.

    Of changes at one moment the last in ``order`` counts. A row without a time, or before all changes
    of its key, gets nulls; a change without a time takes no part. Null keys are equal to each other.
    """
    values = [c for c in changes.columns if c not in (*keys, since, *order)]
    clash = sorted(set(values) & set(rows.columns))
    if clash or not values:
        raise ValueError(f"columns on both sides: {clash}" if clash else "changes have no values")
    names = [f"_key{i}" for i in range(len(keys))]

    kept = rows.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.col(at).alias("_time"),
        F.lit(True).alias("_asks"),
        content_hash(rows.columns).alias("_content"),
        F.struct(*rows.columns).alias("_row"),
    )
    given = changes.filter(F.col(since).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.col(since).alias("_time"),
        F.lit(False).alias("_asks"),
        F.struct(*order, *[F.col(v) for v in values]).alias("_change"),
    )
    both = given.unionByName(kept, allowMissingColumns=True)
    # Changes sort before the rows of their moment, by order first; the number cuts through copies.
    # It is given after a local sort, so that a task that runs again numbers its rows as before.
    by = [*names, "_time", "_asks", "_change", "_content"]
    path = scratch_path(rows.sparkSession, "timeline")
    (
        both.sortWithinPartitions(*by)
        .withColumn("_n", F.monotonically_increasing_id())
        .repartitionByRange(*by, "_n")
        .sortWithinPartitions(*by, "_n")
        .withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
        .drop("_n", "_content")
        .write.parquet(path)
    )
    timeline = rows.sparkSession.read.parquet(path)

    within = Window.partitionBy("_range", *names).orderBy("_at")
    here = F.last("_change", ignorenulls=True).over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last_of_range = timeline.groupBy("_range", *names).agg(
        F.max_by("_change", F.when(F.col("_change").isNotNull(), F.col("_at"))).alias("_change")
    )
    earlier = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    brought = last_of_range.select(
        "_range", *names, F.last("_change", ignorenulls=True).over(earlier).alias("_brought")
    ).filter(F.col("_brought").isNotNull())
    found = join_on(
        timeline.withColumn("_here", here).filter("_asks"),
        localised(brought),
        ["_range", *names],
        "left",
    ).withColumn("_found", F.coalesce("_here", "_brought"))
    return found.select("_row.*", *[F.col(f"_found.{v}").alias(v) for v in values])
