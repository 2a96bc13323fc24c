from shardloom.sinks.files import (
    append_state, append_states, bulk_lines, claim_generation, commit_manifest, commit_refused, delete_path,
    next_generation, numbered, one_path, read_deletes, refused_counts, read_ledger, read_manifest,
    read_published, read_versions, write_bulk, write_mapping, write_sharded, write_versions,
)

__all__ = [
    "append_state", "append_states", "bulk_lines", "claim_generation", "commit_manifest", "commit_refused", "delete_path",
    "next_generation", "numbered", "one_path", "read_deletes", "read_ledger", "refused_counts",
    "read_manifest", "read_published", "read_versions", "write_bulk", "write_mapping", "write_sharded",
    "write_versions",
]
