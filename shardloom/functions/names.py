"""Rules about names: fields, versions, segments, bundles."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


# fixed values: what a map column name ends with if it prefixes its fields, and what the name
# of a file still being written ends with
PREFIXING_SUFFIX = "_map"
UNFINISHED_SUFFIX = "_tmp"


def last_part(name: Column, sep: str = "_") -> Column:
    return F.substring_index(name, sep, -1)


def snapshot_date(index_name: Column) -> Column:
    return last_part(index_name, "_")


def map_field_name(source_column: str, key: Column) -> Column:
    """Document field of one map entry: ``<column>-<key>`` for ``*_map`` columns, else the key."""
    key = key.cast("string")
    full = F.concat(F.lit(f"{source_column}-"), key) if source_column.endswith(PREFIXING_SUFFIX) else key
    return F.translate(F.lower(full), "&$", "--")


def quoted(column: str) -> str:
    """A column name as Spark takes it whole, dots and all."""
    return "`" + column.replace("`", "``") + "`"


def could_name(source_column: str, field: str) -> bool:
    """Whether an entry of this map column can ever become ``field``."""
    if field != field.lower() or "&" in field or "$" in field:
        return False
    if not source_column.endswith(PREFIXING_SUFFIX):
        return True
    prefix = f"{source_column}-".lower().replace("&", "-").replace("$", "-")
    return field.startswith(prefix)


def retention_name(index_name: Column, days: int, sep: str = "_") -> Column:
    """The version name ``days`` away; a suffix that is no date becomes empty."""
    trimmed = F.rtrim(index_name, F.lit(sep))
    suffix = last_part(trimmed, sep)
    prefix = F.substring(trimmed, F.lit(1), F.length(trimmed) - F.length(suffix))
    day = F.when(suffix.rlike("^[0-9]{8}$"), F.try_to_date(suffix, "yyyyMMdd"))
    shifted = F.date_format(F.date_add(day, days), "yyyyMMdd")
    return F.concat(prefix, F.coalesce(shifted, F.lit("")))


def base36(number: Column) -> Column:
    return F.lower(F.conv(number.cast("string"), 10, 36))


def bundle_name(segment: Column) -> Column:
    return F.concat(F.lit("p_"), segment.cast("string"))


def bundle_path(root: str, shard: Column, segment: Column) -> Column:
    shard, segment = shard.cast("string"), segment.cast("string")
    return F.concat(F.lit(f"{root}/"), shard, F.lit("/p"), segment, F.lit("_"), shard, F.lit(".zip"))


def is_completed_file(path: Column, length: Column) -> Column:
    return (length > 0) & ~F.endswith(path, F.lit(UNFINISHED_SUFFIX))
