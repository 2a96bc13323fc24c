"""Listings of bundle folders and the published mapping file."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shardloom.functions.names import is_completed_file

_FILE_SCHEMA = "path string, length bigint"
FIELD_PROPERTIES = "struct<type:string,index:string,format:string>"


def _files(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def list_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Path and length of the files below ``folder``; a missing folder lists nothing.

    The file content column is pruned, so nothing but metadata is read.  Spark's reader
    leaves empty files out by itself.
    """
    files = _files(spark, folder)
    return spark.createDataFrame([], _FILE_SCHEMA) if files is None else files.select("path", "length")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path of every file below ``folder``, empty ones too.

    The names come from the file index, which the driver holds for any scan of the folder.
    """
    files = _files(spark, folder)
    names = [] if files is None else files.inputFiles()
    return spark.createDataFrame([(n,) for n in names], "path string")


def completed_bundles(listing: DataFrame) -> DataFrame:
    """Files that are finished: not empty and not still being written (``_tmp``)."""
    return listing.where(is_completed_file(F.col("path"), F.col("length")))


def largest_bundle(listing: DataFrame, *group: str | Column) -> DataFrame:
    """Largest non-empty file of each folder; '' where every file is empty."""
    sized = F.when(F.col("length") > 0, F.struct("length", "path"))
    return listing.groupBy(*group).agg(
        F.coalesce(F.max_by("path", sized), F.lit("")).alias("path"),
        F.max("length").alias("length"))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The mapping file as one JSON string."""
    return spark.read.text(path, wholetext=True).select(F.trim("value").alias("json"))


def mapping_fields(mapping_json: DataFrame) -> DataFrame:
    """One row per field of a mapping JSON."""
    parsed = F.from_json("json", f"map<string,{FIELD_PROPERTIES}>")
    return mapping_json.select(F.explode(parsed).alias("field", "p")).select(
        "field", "p.type", "p.index", "p.format")
