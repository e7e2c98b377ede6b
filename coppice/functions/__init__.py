"""Column expressions shared by the operators."""

from coppice.functions.columns import cast_columns, class_name, equals_all
from coppice.functions.hashing import content_hash, hash_below, hash_prefix, split_hash

__all__ = [
    "cast_columns",
    "class_name",
    "content_hash",
    "equals_all",
    "hash_below",
    "hash_prefix",
    "split_hash",
]
