"""Table, delimited-text and JSON-column sources."""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shardloom.functions.names import quoted


def scan(spark: SparkSession, table: str, where: str | None = None,
         columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table or a Parquet path; no predicate means all rows."""
    df = spark.read.parquet(table) if "/" in table else spark.read.table(table)
    if where and where.strip():
        df = df.where(where)
    return df.select(*[quoted(c) if c in df.columns else c for c in columns]) if columns else df


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t",
                   partition_columns: Sequence[str] = ("dt",)) -> DataFrame:
    """Delimited text files; ``key=value`` folders below ``path`` become partition columns.

    A field is whatever stands between two separators: quotes mean nothing, an empty field
    is an empty text, ``\\N`` is null, and so is a missing field or one of another type.
    """
    fields = T.StructType.fromDDL(schema).fields
    folders = [f for f in fields if f.name in partition_columns]
    lines = spark.read.schema(T.StructType([T.StructField("value", T.StringType()), *folders])).text(path)
    parts = F.split("value", re.escape(sep))
    texts = [(f, F.get(parts, F.lit(i))) for i, f in enumerate(f for f in fields if f not in folders)]
    columns = [F.when(text != "\\N", text).try_cast(f.dataType).alias(f.name) for f, text in texts]
    return lines.select(*columns, *[f.name for f in folders])


def json_fields(df: DataFrame, column: str, into: str | None = None,
                malformed: str | None = None) -> DataFrame:
    """Replace a string column of JSON objects by a map column of its fields.

    A text that is no JSON object has no fields.  ``malformed`` names a column that then
    holds the text, so that the row can be refused; null, empty and ``null`` texts are no
    error.
    """
    target = into or column
    text = F.col(quoted(column))
    parsed = F.from_json(text, "map<string,string>")
    kept = [quoted(c) for c in df.columns if c not in (column, target)]
    about = df.schema[column].metadata if target == column else {}
    refused = [] if malformed is None else [_unparsed(text, parsed).alias(malformed)]
    return df.select(*kept, parsed.alias(target, metadata=about), *refused)


def _unparsed(text: Column, parsed: Column) -> Column:
    return F.when(parsed.isNull() & ~F.trim(text).isin("", "null"), text)
