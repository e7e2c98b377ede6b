"""Column expressions that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.sources.workspace import scratch_path

SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def whole_text(name: str = "text") -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_CLASS)).cast("long")


def count_chars(text: Column, chars: str) -> Column:
    """How many code points of ``text`` are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer merges projections and would copy an expression into a lambda that names it, to be
    computed anew for every element; a lambda's own argument is only read.
    """
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: a lost executor costs a read. The files also give Catalyst the exact size, by
    which it decides about broadcasts.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` stored with a number for every row, and the name of that column.

    Ids may be null or repeat; the stored number tells rows apart in every later read.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "keyed"), name


def without_rows(keyed: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """``keyed`` without the rows whose key is in ``dropped(_row)``, and without the key.

    The keys are written first: their exact size lets Catalyst broadcast few and shuffle many.
    """
    keys = stored(dropped.select(F.col("_row").alias(key)), "dropped")
    return keyed.join(keys, key, "left_anti").drop(key)


def beyond_first(members: DataFrame, group: list[str]) -> DataFrame:
    """``(_row)``: rows of ``members`` that are not the one that stays of their group.

    Rows with ``kept`` have the group's smallest ``doc_id``, which several rows may have; the first of
    them stays.
    """
    stays = members.filter("kept").groupBy(*group).agg(F.min("_row").alias("_row"))
    return members.select("_row").join(stays.select("_row"), "_row", "left_anti")


def salt(salts: int) -> Column:
    """A part of a group of rows, by the hash of ``doc_id``."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")


def salts_seen(salt_column: str) -> Column:
    """Aggregate: a long with one bit for every salt that occurs; for up to 62 salts."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col(salt_column)))


def each_salt(mask: str, salts: int) -> Column:
    """One row for every salt in a mask of :func:`salts_seen`."""
    numbers = F.sequence(F.lit(0), F.lit(salts - 1))
    return F.explode(F.filter(numbers, lambda s: F.getbit(F.col(mask), s) == 1))
