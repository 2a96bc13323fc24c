from shardloom.functions.hashing import segment_of, shard_of
from shardloom.functions.names import (
    base36, bundle_name, bundle_path, is_completed_file, last_part, map_field_name,
    retention_name, snapshot_date,
)
from shardloom.functions.values import cast_failed, java_text, render_value

__all__ = [
    "base36", "bundle_name", "bundle_path", "cast_failed", "is_completed_file", "java_text",
    "last_part", "map_field_name", "render_value", "retention_name", "segment_of", "shard_of",
    "snapshot_date",
]
