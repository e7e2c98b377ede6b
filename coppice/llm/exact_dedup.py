"""Exact deduplication in three combining steps, safe for huge groups of copies.

1. Every task combines its own copies (the partial aggregation by digest, salt and text).
2. The winners of the tasks meet by digest, salt and text: a group of copies is spread over as many
   tasks as there are salts.
3. The winners of the salts meet by digest and text: at most one row per salt.

Text is a grouping key in every step, so texts are told apart by their whole content and the digest
only places them. Only built-in functions are used.

Defined cases: a null text counts as empty; ties take the smallest ``doc_id``, nulls last; rows that
repeat a ``doc_id`` count each time in ``group_size`` and are flagged alike, but only one of them stays
in :func:`without_copies`; an empty table gives an empty result. Other columns are ignored, or kept by
:func:`without_copies`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coppice.llm.text import (
    SPACE_CLASS,
    beyond_first,
    each_salt,
    salt,
    salts_seen,
    stored,
    whole_text,
    with_row_key,
    without_rows,
)

SALTS = 32
DIGEST_BITS = 256


def normalised(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, f"{SPACE_CLASS}+", " ")


def _digest(text: Column, bits: int) -> Column:
    """Leading bits of the SHA-256 digest; fewer than 256 only serve to test collisions."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, bits // 8)


def _rows(docs: DataFrame, salts: int, bits: int, carried: list[Column]) -> DataFrame:
    return (
        docs.select("doc_id", *carried, normalised(whole_text()).alias("_text"))
        .withColumn("_digest", _digest(F.col("_text"), bits))
        .withColumn("_salt", salt(salts))
    )


def _groups(rows: DataFrame) -> DataFrame:
    """One row per text: ``(_digest, keep_id, group_size, _salts, _texts)``, without the text.

    ``_salts`` has a bit for every salt that occurs; ``_texts`` counts the texts of the digest.
    """
    by_salt = rows.groupBy("_digest", "_salt", "_text").agg(
        F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    by_text = by_salt.groupBy("_digest", "_text").agg(
        F.min("_first").alias("keep_id"),
        F.sum("_n").alias("group_size"),
        salts_seen("_salt").alias("_salts"),
    )
    texts = F.count(F.lit(1)).over(Window.partitionBy("_digest"))
    return by_text.drop("_text").withColumn("_texts", texts)


def _collided(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of digests that stand for several texts, grouped again and joined by text."""
    digests = groups.select("_digest").distinct()
    part = rows.join(digests, "_digest")
    by_salt = part.groupBy("_digest", "_salt", "_text").agg(
        F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    by_text = by_salt.groupBy("_digest", "_text").agg(
        F.min("_first").alias("keep_id"), F.sum("_n").alias("group_size")
    )
    return part.join(by_text, ["_digest", "_text"])


def _result(carried: list[str]) -> list[Column]:
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    names = ("doc_id", *carried, "keep_id", "group_size")
    return [*map(F.col, names), kept.alias("kept"), F.col("text_sha256")]


def marked_copies(docs: DataFrame, salts: int = SALTS, digest_bits: int = DIGEST_BITS) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row; ``salts`` up to 62.

    The text moves twice, each time without the copies found before. The rows are then joined to
    their groups by digest and salt without the text. Should a digest stand for several texts, its
    rows are joined by text instead.
    """
    return _marked(docs, salts, digest_bits, None)


def _marked(docs: DataFrame, salts: int, digest_bits: int, key: str | None) -> DataFrame:
    """The result of :func:`marked_copies`, with the column ``key`` as ``_row`` if there is one."""
    names = ["_row"] if key else []
    rows = _rows(docs, salts, digest_bits, [F.col(key).alias("_row")] if key else [])
    groups = stored(_groups(rows), "copies")
    slim = rows.select(
        "doc_id", *names, "_digest", "_salt", F.sha2("_text", 256).alias("text_sha256")
    )
    single = groups.filter("_texts = 1").select(
        "_digest", "keep_id", "group_size", each_salt("_salts", salts).alias("_salt")
    )
    result = slim.join(single, ["_digest", "_salt"]).select(*_result(names))
    several = groups.filter("_texts > 1")
    if several.isEmpty():
        return result
    apart = _collided(rows.withColumn("text_sha256", F.sha2("_text", 256)), several)
    return result.unionByName(apart.select(*_result(names)))


def without_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row of each text stays, with all its columns; only keys of dropped rows are joined."""
    keyed, key = with_row_key(docs)
    marked = _marked(keyed, salts, DIGEST_BITS, key).select("_row", "kept", "text_sha256")
    return without_rows(keyed, key, beyond_first(stored(marked, "marked"), ["text_sha256"]))
