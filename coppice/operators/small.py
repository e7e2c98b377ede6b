"""Joins with a side that is usually small: broadcast once its size is known, shuffled otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.sources.workspace import scratch_path


def localised(df: DataFrame) -> DataFrame:
    """Compute ``df`` once: written to the shared folder and read back, whatever its size.

    The files tell Catalyst the exact size, by which it broadcasts the table or shuffles it.
    """
    path = scratch_path(df.sparkSession, "side")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_on(big: DataFrame, side: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join that also matches null keys; keeps one copy of the key columns.

    No hint is given: Catalyst broadcasts a side by its size, or shuffles with adaptive skew
    splitting.
    """
    renamed = side.select(
        *[F.col(k).alias(f"_side_{k}") for k in keys],
        *[F.col(c) for c in side.columns if c not in keys],
    )
    match = [F.col(k).eqNullSafe(F.col(f"_side_{k}")) for k in keys]
    return big.join(renamed, match, how).drop(*[f"_side_{k}" for k in keys])
