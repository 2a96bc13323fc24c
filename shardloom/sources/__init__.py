from shardloom.sources.bundles import (
    completed_bundles, largest_bundle, list_bundles, list_files, mapping_fields, read_mapping,
)
from shardloom.sources.side_tables import deny_list, load_rules, type_overrides
from shardloom.sources.tables import json_fields, read_delimited, scan

__all__ = [
    "completed_bundles", "deny_list", "json_fields", "largest_bundle", "list_bundles",
    "list_files", "load_rules", "mapping_fields", "read_delimited", "read_mapping", "scan", "type_overrides",
]
