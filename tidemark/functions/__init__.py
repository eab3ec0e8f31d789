"""Column functions; every one is a composition of built-in Spark expressions."""

from tidemark.functions.nulls import NULLS_OF, is_null_value, normalise
from tidemark.functions.text import clean_blob, clean_name, file_stem, int_or_text, op_split
from tidemark.functions.time import (
    micros,
    ns_join,
    ns_split,
    shard_of,
    timestamp,
    to_utc,
    trunc_ms,
)

__all__ = [
    "NULLS_OF", "is_null_value", "normalise", "clean_blob", "clean_name", "file_stem",
    "int_or_text", "op_split", "micros", "ns_join", "ns_split", "shard_of", "timestamp",
    "to_utc", "trunc_ms",
]
