"""Scalar expressions: class names, equality predicates, casts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def class_name(label: Column, names: Mapping[object, str]) -> Column:
    """Name of a class code; null where no name is given."""
    if not names:
        return F.lit(None).cast("string")
    codes = iter(names.items())
    code, name = next(codes)
    return reduce(
        lambda chain, item: chain.when(label == F.lit(item[0]), F.lit(item[1])),
        codes,
        F.when(label == F.lit(code), F.lit(name)),
    )


def equals_all(values: Mapping[str, object]) -> Column:
    """``a = x AND b = y AND …``: a conjunction the scan can take as pushed filters."""
    return reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in values.items()])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where a lambda in ``body`` names it."""
    return F.transform(F.array(value), body)[0]
