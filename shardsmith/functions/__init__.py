"""Column-level building blocks (hashing, JSON helpers), re-exported."""

from shardsmith.functions.hashing import (  # noqa: F401
    bucket_of_hash,
    bucket_py,
    djb2_hash,
    djb2_py,
    hash_bucket,
    utf16_units,
)
from shardsmith.functions.jsonfn import compact_json, is_json_object, json_path, object_keys, variant_kind  # noqa: F401

__all__ = [
    "bucket_of_hash", "bucket_py", "djb2_hash", "djb2_py", "hash_bucket", "utf16_units",
    "compact_json", "is_json_object", "json_path", "object_keys", "variant_kind",
]
