"""Any column name: columns that would clash get another one and remember their field."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shardloom.functions.names import quoted

FIELD = "shardloom.field"  # metadata key: the field that a renamed column stands for

# names that placement and intake put beside the source columns; Spark does not tell cases apart
RESERVED = frozenset({"doc_id", "shard", "segment", "slot", "_dynamic", "_rank", "_bad", "_malformed", "_tie",
                      "row", "refused", "reason", "fields"})


def field_of(f: T.StructField) -> str:
    return (f.metadata or {}).get(FIELD, f.name)


def column_of(f: T.StructField) -> Column:
    return F.col(quoted(f.name))


def sheltered(df: DataFrame) -> DataFrame:
    """``df`` with reserved and unusual column names replaced by ``_column_<n>``.

    The operators on documents and fields go by ``field_of``, so a renamed column still
    gives the field it is called after.
    """
    columns, taken = [], {f.name.lower() for f in df.schema.fields}
    for i, f in enumerate(df.schema.fields):
        if f.name.lower() in RESERVED or not re.fullmatch(r"\w+", f.name):
            free = f"_column_{i}"
            while free in taken:
                free = f"_{free}"
            taken.add(free)
            columns.append(column_of(f).alias(free, metadata={FIELD: field_of(f)}))
        else:
            columns.append(column_of(f))
    return df.select(*columns)


def columns_by_field(schema: T.StructType) -> dict[str, str]:
    """Field names, as written and in lower case, to the names their columns have now."""
    by_case = {field_of(f).lower(): f.name for f in schema.fields}
    return {**by_case, **{field_of(f): f.name for f in schema.fields}}


def column_named(schema: T.StructType, field: str) -> str:
    """The column that a field of the source is in; an unknown name stays as it is."""
    names = columns_by_field(schema)
    return names.get(field, names.get(field.lower(), field))


def row_json(schema: T.StructType) -> Column:
    """A whole source row as JSON text under its own field names."""
    return F.to_json(F.struct(*[column_of(f).alias(field_of(f)) for f in schema.fields]))


def is_exact(f: T.StructField) -> bool:
    """Whether values that compare as equal are the same value, so that rows can be grouped by
    them (a zero has two signs, a text of a collation several spellings, a map no order)."""
    name = f.dataType.simpleString()
    return name in ("string", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp") \
        or isinstance(f.dataType, T.DecimalType)


def row_hash(schema: T.StructType) -> Column:
    """A hash of a whole source row; JSON texts are made of those columns alone that need them."""
    exact = [f for f in schema.fields if is_exact(f)]
    others = [f for f in schema.fields if not is_exact(f)]
    parts = [part for f in exact for part in (column_of(f).isNull(), column_of(f))]
    if others:
        parts.append(row_json(T.StructType(others)))
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")
