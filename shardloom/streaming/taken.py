"""Intake that keeps its own record of what it took, beside the checkpoint.

Layout below ``target``::

    rows/run=<r>/batch=<b>/     rows of one micro-batch, with the ``bundle`` each came from
    ledger/run=<r>/batch=<b>/   paths of the bundles of that batch; written after the rows

A run is a checkpoint: it keeps its name when it is started again, and a batch that is run
again replaces its own folders.  Each batch leaves out the bundles that another batch's
ledger names, so a new checkpoint over the same folder (the old one lost, or moved) takes
nothing twice.  Rows count only if the ledger names their batch: what a batch wrote before
it broke off is never read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shardloom.sinks.files import read_or_empty
from shardloom.streaming.intake import bundle_stream

TAKEN_SCHEMA = "bundle string, run string, batch bigint"


def read_taken(spark: SparkSession, target: str) -> DataFrame:
    """(bundle, run, batch): which batch took each bundle; a row per bundle."""
    return read_or_empty(spark, f"{target}/ledger", TAKEN_SCHEMA)


def taken_rows(spark: SparkSession, target: str, schema: T.StructType | str) -> DataFrame:
    """All rows taken, each with its ``bundle``; those of batches that broke off are left out."""
    source = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*source.fields, *T.StructType.fromDDL(TAKEN_SCHEMA).fields])
    rows = read_or_empty(spark, f"{target}/rows", whole)
    return rows.join(read_taken(spark, target), ["bundle", "run", "batch"], "left_semi").drop("run", "batch") \
        .select(*[f.name for f in source.fields], "bundle")


def stream_bundles_once(spark: SparkSession, folder: str, schema: T.StructType | str, checkpoint: str,
                        target: str, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Take in all bundles that no batch has taken yet, then stop.

    The anti join meets the ledger, a row per bundle and not per row, by path.  Empty
    bundles hold no rows and are not recorded.  Two runs on one target at the same time are
    not told apart: start one after the other.
    """
    rows = bundle_stream(spark, folder, schema, max_files_per_trigger) \
        .select("*", F.col("_metadata.file_path").alias("bundle"))

    def take(batch_rows: DataFrame, batch: int) -> None:
        session = batch_rows.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"run={run}/batch={batch}"
        others = read_taken(session, target).where(~((F.col("run") == run) & (F.col("batch") == batch)))
        batch_rows.join(others.select("bundle"), "bundle", "left_anti").select(*batch_rows.columns) \
            .write.mode("overwrite").parquet(f"{target}/rows/{place}")
        session.read.schema("bundle string").parquet(f"{target}/rows/{place}").distinct() \
            .write.mode("overwrite").parquet(f"{target}/ledger/{place}")

    return rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
