"""Row hashes: a seeded key hash for splits, a content hash for telling rows apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_hash(seed: int, keys: Sequence[str]) -> Column:
    """md5 hex of ``seed|key|…``; the same in every engine for integer and string keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_below(hash_hex: Column, fraction: float) -> Column:
    """Whether the first 32 bits of a hash fall below a fraction of their range.

    Hex digits of equal case sort like the numbers they stand for, so no number is made.
    """
    if not 0.0 < fraction < 1.0:
        raise ValueError(f"fraction must lie between 0 and 1, not {fraction}")
    return hash_hex < F.lit(f"{int(fraction * (1 << 32)):08x}")


def hash_prefix(hash_hex: Column, digits: int) -> Column:
    return F.substring(hash_hex, 1, digits)


def content_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over whole rows as text that tells nulls, also inner ones, and microseconds apart."""
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    fields = [F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]
    return F.sha2(F.to_json(F.struct(*fields), options), 256)
