"""Which fields an index has: plain columns from the schema, map keys from the data."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shardloom.functions.names import map_field_name
from shardloom.sources.columns import column_of, field_of


def map_columns(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if isinstance(f.dataType, T.MapType)]


def plain_columns(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if not isinstance(f.dataType, T.MapType)]


def _field_row(field, src_type: str, is_plain: bool, src_col: str):
    return F.struct(field.alias("field"), F.lit(src_type).alias("src_type"),
                    F.lit(is_plain).alias("is_plain"), F.lit(src_col).alias("src_col"))


def plain_fields(df: DataFrame) -> DataFrame:
    """Schema-only: present even when the table has no rows."""
    rows = [_field_row(F.lit(field_of(f)), f.dataType.simpleString(), True, field_of(f))
            for f in plain_columns(df.schema)]
    if not rows:
        rows_type = "array<struct<field:string,src_type:string,is_plain:boolean,src_col:string>>"
        return df.sparkSession.range(1).select(F.inline(F.array().cast(rows_type)))
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def plain_coverage(df: DataFrame) -> DataFrame:
    """Plain fields with the number of rows that have a value: one global aggregate."""
    fields = plain_columns(df.schema)
    counts = df.agg(*[F.count(column_of(f)).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(field_of(f)).alias("field"), F.lit(f.dataType.simpleString()).alias("src_type"),
                     F.lit(True).alias("is_plain"), F.lit(field_of(f)).alias("src_col"),
                     F.col(f"c{i}").alias("docs")) for i, f in enumerate(fields)]
    return counts.select(F.inline(F.array(*rows)))


def map_fields(df: DataFrame, by: Column | None = None) -> DataFrame:
    """Distinct fields that map keys turn into; reads only the map columns, once.

    With ``by`` they are distinct for each of its values, which come first as ``part``.

    Raw keys are made distinct first (partial aggregation on each task), so names are
    built once per key and not once per row.
    """
    columns = map_columns(df.schema)
    kept = [] if by is None else [by.alias("part")]
    names = ["part"] if kept else []
    if not columns:
        none = plain_fields(df).where(F.lit(False))
        return none.select(*[F.lit(None).cast("string").alias(n) for n in names], "*")
    # (column number, key array) pairs, unfolded twice: generated code all the way
    pairs = [F.struct(F.lit(i).alias("src"), F.map_keys(column_of(f)).cast("array<string>").alias("keys"))
             for i, f in enumerate(columns)]
    keys = df.select(*kept, F.inline(F.array(*pairs))) \
        .select(*names, "src", F.explode("keys").alias("key")).distinct()
    named = F.lit(None).cast("struct<field:string,src_type:string,is_plain:boolean,src_col:string>")
    for i, f in enumerate(columns):
        row = _field_row(map_field_name(field_of(f), F.col("key")),
                         f.dataType.valueType.simpleString(), False, field_of(f))
        named = F.when(F.col("src") == i, row).otherwise(named)
    return keys.select(*names, named.alias("f")).select(*names, "f.*").where(F.col("field").isNotNull()).distinct()


def discover_fields(df: DataFrame) -> DataFrame:
    """All field facts: (field, src_type, is_plain, src_col), distinct."""
    return plain_fields(df).unionByName(map_fields(df))
