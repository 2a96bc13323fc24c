"""Field discovery that reads each partition of a source once, over any number of versions.

Layout below ``<work_dir>/_facts/<source>/``, where ``source`` stands for the table, its
columns and the types of its map columns::

    facts/take=<t>/   (part, field, src_type, src_col): fields of the maps, per partition
    seen/take=<t>/    (part, mark): the partitions of that take; written last
    claims/           a marker for every take's number

``mark`` says what a partition's files were: their number, bytes and newest time.  A
partition that was rewritten or has got files since is read again, and its newest take alone
counts.  Partitions that are gone, or not selected, give no fields.
"""
from __future__ import annotations

import hashlib
import json
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shardloom.functions.names import quoted
from shardloom.operators.discovery import map_columns, map_fields, plain_fields
from shardloom.sinks.files import claim, read_or_empty
from shardloom.sources.columns import column_named, field_of
from shardloom.spec import BuildSpec

FACTS_SCHEMA = "part string, field string, src_type string, is_plain boolean, src_col string, take bigint"
SEEN_SCHEMA = "part string, mark string, take bigint"


def partition_marks(spark: SparkSession, table: str, by: str, where: str | None = None) -> DataFrame:
    """(part, mark) of the selected partitions, from the file listing; no file of a path is opened.

    ``where`` may only ask for the partition column: what is stored has to hold for whole
    partitions.
    """
    if "/" in table:
        files = spark.read.format("binaryFile").load(table).select(
            F.col(quoted(by)), "path", "modificationTime", "length")
    else:
        about = F.col("_metadata")
        files = spark.read.table(table).select(
            F.col(quoted(by)), about["file_path"].alias("path"),
            about["file_modification_time"].alias("modificationTime"), about["file_size"].alias("length")).distinct()
    mark = F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.max(F.unix_micros("modificationTime")))
    marks = files.groupBy(F.col(quoted(by))).agg(mark.alias("mark"))
    if where and where.strip():
        try:
            marks = marks.select(quoted(by), F.col("mark").alias("_mark")).where(where).withColumnRenamed("_mark", "mark")
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                raise
            raise ValueError(f"with facts_by, the predicate may only ask for {by!r}: {where}") from error
    return marks.select(F.col(quoted(by)).cast("string").alias("part"), "mark")


def facts_folder(spec: BuildSpec, source: DataFrame) -> str:
    about = [spec.table, spec.facts_by, spec.json_source, sorted(spec.input_columns or ()),
             sorted([field_of(f), f.dataType.simpleString()] for f in map_columns(source.schema))]
    return f"{spec.work_dir.rstrip('/')}/_facts/{hashlib.sha256(json.dumps(about).encode()).hexdigest()[:24]}"


def newest_takes(spark: SparkSession, folder: str) -> DataFrame:
    """(part, mark, take) of the newest take of each partition."""
    newest = Window.partitionBy("part").orderBy(F.desc("take"))
    return read_or_empty(spark, f"{folder}/seen", SEEN_SCHEMA) \
        .withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def incremental_fields(spark: SparkSession, spec: BuildSpec, source: DataFrame, rows_of) -> tuple[DataFrame, list]:
    """Field facts as ``discover_fields`` gives them, and the partitions that were read for them.

    ``rows_of(spark, spec)`` gives the rows of a spec.  Only names of partitions reach the
    driver, so that the scan is pruned to those not seen.
    """
    folder = facts_folder(spec, source)
    marks = partition_marks(spark, spec.table, spec.facts_by, spec.where)
    seen = newest_takes(spark, folder).withColumnsRenamed({"part": "_part", "mark": "_mark"})
    stale = marks.join(seen, F.col("part").eqNullSafe(F.col("_part")), "left") \
        .where(~F.col("mark").eqNullSafe(F.col("_mark"))).select("part", "mark").collect()
    if stale:
        take = claim(spark, f"{folder}/claims", 1)
        columns = spec.input_columns and tuple(dict.fromkeys((*spec.input_columns, spec.facts_by)))
        rows = rows_of(spark, replace(spec, input_columns=columns))
        part = F.col(quoted(column_named(rows.schema, spec.facts_by))).cast("string")
        names = [r["part"] for r in stale if r["part"] is not None]
        wanted = part.isin(names) if names else F.lit(False)
        if len(names) < len(stale):
            wanted = part.isNull() | F.coalesce(wanted, F.lit(False))
        map_fields(rows.where(wanted), part).write.mode("overwrite").parquet(f"{folder}/facts/take={take}")
        spark.createDataFrame(stale, "part string, mark string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{folder}/seen/take={take}")
    current = newest_takes(spark, folder).join(marks.select(F.col("part").alias("_part")),
                                               F.col("part").eqNullSafe(F.col("_part")), "left_semi")
    facts = read_or_empty(spark, f"{folder}/facts", FACTS_SCHEMA).alias("f").join(
        current.alias("c"), (F.col("f.take") == F.col("c.take")) & F.col("f.part").eqNullSafe(F.col("c.part")), "left_semi")
    found = facts.select("field", "src_type", "is_plain", "src_col").distinct()
    return plain_fields(source).unionByName(found), [r["part"] for r in stale]
