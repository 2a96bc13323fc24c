"""Field mapping: from discovered field facts to types, index flags and JSON."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shardloom.sources.bundles import FIELD_PROPERTIES

# fixed values: the day format, the target type names that differ from the source type names,
# and the endings of map columns whose fields are stored but not indexed
DATE_FORMAT = "yyyyMMdd"
CONVERTED = {"bigint": "long", "int": "integer"}
CONVERTED_STRICT = {"smallint": "short", "tinyint": "byte", "timestamp": "date",
                    "timestamp_ntz": "date"}
UNINDEXED_SUFFIXES = ("_map", "_ex")


def convert_type(src_type: Column, compat: bool = True) -> Column:
    """Mapping type of a source type; unknown names pass through unchanged."""
    low = F.lower(src_type)
    chain = F.when(F.startswith(low, F.lit("array")), F.lit("string")) \
        .when(F.startswith(low, F.lit("decimal")), F.lit("double"))
    if not compat:
        chain = chain.when(F.startswith(low, F.lit("struct")), F.lit("string"))
    for source, target in {**CONVERTED, **({} if compat else CONVERTED_STRICT)}.items():
        chain = chain.when(low == source, F.lit(target))
    return chain.otherwise(src_type)


def is_indexable(is_plain: Column, src_col: Column) -> Column:
    unindexed = F.lit(False)
    for suffix in UNINDEXED_SUFFIXES:
        unindexed = unindexed | F.endswith(src_col, F.lit(suffix))
    return is_plain | ~unindexed


def index_attribute(indexable: Column, field_type: Column) -> Column:
    return F.when(~indexable, F.lit("no")) \
        .when(F.lower(field_type) == "string", F.lit("not_analyzed"))


def date_format_attribute(field_type: Column) -> Column:
    return F.when(F.lower(field_type) == "date", F.lit(DATE_FORMAT))


def resolve_conflicts(fields: DataFrame) -> DataFrame:
    """One row per field: plain beats map, then the smallest type name, then column.

    ``conflict`` tells whether the sources disagreed on the type.
    """
    best = F.min(F.struct((~F.col("is_plain")).alias("later"), "src_type", "src_col"))
    return fields.groupBy("field").agg(
        best.alias("b"), F.min("src_type").alias("lo"), F.max("src_type").alias("hi"),
    ).select("field", F.col("b.src_type").alias("src_type"), (~F.col("b.later")).alias("is_plain"),
             F.col("b.src_col").alias("src_col"), (F.col("lo") != F.col("hi")).alias("conflict"))


def infer_mapping(fields: DataFrame, overrides: DataFrame | None = None,
                  explicit: DataFrame | None = None,
                  index_fields: Sequence[str] | None = None,
                  index_source_columns: Sequence[str] | None = None,
                  compat: bool = True) -> DataFrame:
    """(field, type, index, format, indexable) of every field.

    Overrides are matched by document field name and beat conversion.  ``explicit`` rows
    (field, type, index, format) replace what was inferred, property by property, and may
    add fields.  If index lists are given only listed fields are indexable.
    """
    one = resolve_conflicts(fields)
    converted = convert_type(F.col("src_type"), compat)
    if overrides is not None:
        one = one.join(overrides.select("field", F.col("type").alias("override")), "field", "left")
        converted = F.coalesce(F.col("override"), converted)
    indexable = is_indexable(F.col("is_plain"), F.col("src_col"))
    if index_fields is not None or index_source_columns is not None:
        listed = F.lit(False)
        if index_fields is not None:
            listed = listed | F.col("field").isin(*index_fields)
        if index_source_columns is not None:
            listed = listed | F.col("src_col").isin(*index_source_columns)
        indexable = listed
    typed = one.select("field", converted.alias("type"), indexable.alias("indexable"),
                       F.startswith(F.lower("src_type"), F.lit("timestamp")).alias("stamp"))
    fmt = date_format_attribute(F.col("type"))
    if not compat:  # timestamps keep their time of day, so no day format
        fmt = F.when(~F.col("stamp"), fmt)
    result = typed.select("field", "type",
                          index_attribute(F.col("indexable"), F.col("type")).alias("index"),
                          fmt.alias("format"), "indexable")
    return result if explicit is None else _apply_explicit(result, explicit)


def _apply_explicit(inferred: DataFrame, explicit: DataFrame) -> DataFrame:
    wanted = explicit.select("field", F.struct("type", "index", "format").alias("e"))
    both = inferred.join(wanted, "field", "full_outer")
    index = F.coalesce(F.col("e.index"), F.col("index"))
    return both.select(
        "field", F.coalesce(F.col("e.type"), F.col("type")).alias("type"), index.alias("index"),
        F.coalesce(F.col("e.format"), F.col("format")).alias("format"),
        F.when(F.col("e.index").isNotNull(), F.col("e.index") != "no")
        .otherwise(F.coalesce(F.col("indexable"), F.lit(True))).alias("indexable"))


def mapping_summary(mapping: DataFrame) -> DataFrame:
    return mapping.agg(F.count_if(F.col("indexable")).alias("indexed_fields"),
                       F.count(F.lit(1)).alias("all_fields"))


def mapping_json(mapping: DataFrame, wrap: bool = False) -> DataFrame:
    """The whole mapping as one JSON string, fields in name order, absent properties left out.

    A mapping is metadata, one entry per field name; the file is one JSON object.
    """
    entry = F.struct("field", F.struct("type", "index", "format").alias("properties"))
    fields = F.map_from_entries(F.array_sort(F.collect_list(entry)))
    body = F.struct(fields.alias("properties"),
                    F.struct(F.lit(False).alias("enabled")).alias("_all")) if wrap else fields
    return mapping.agg(F.to_json(body).alias("json"))


def explicit_fields(spark, mapping_text: str) -> DataFrame:
    """Rows of an explicitly given mapping JSON."""
    parsed = F.from_json(F.lit(mapping_text), f"map<string,{FIELD_PROPERTIES}>")
    return spark.range(1).select(F.explode(parsed).alias("field", "p")).select(
        "field", "p.type", "p.index", "p.format")


def indexed_fields(mapping: DataFrame) -> DataFrame:
    """(field) of the indexable fields: terms are joined to it."""
    return mapping.where("indexable").select("field")


def indexed_field_names(mapping: DataFrame) -> frozenset[str]:
    """Names of the indexable fields, one per field, for plans that read single fields."""
    return frozenset(r["field"] for r in indexed_fields(mapping).collect())


def field_budget(fields: DataFrame) -> DataFrame:
    """Distinct fields per source column: shows which map column explodes a mapping."""
    return fields.groupBy("src_col").agg(F.count_distinct("field").alias("fields"))
