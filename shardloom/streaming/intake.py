"""Incremental intake of finished bundles.

The checkpoint remembers which files were taken, so each is handled once over any number
of runs, however old a file's time is.  A bundle is known by its whole path.  Files still being written (``*_tmp``) do not match the name filter and empty
files hold no rows.  A run started after the completed record sees every bundle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

# The file source forgets files older than this against the newest one: longer than any
# clock can tell, so that none is passed over.
NO_AGE = "36500d"


def bundle_stream(spark: SparkSession, folder: str, schema: T.StructType | str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet") \
        .option("maxFileAge", NO_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def stream_bundles(spark: SparkSession, folder: str, schema: T.StructType | str,
                   checkpoint: str, target: str, max_files_per_trigger: int | None = None
                   ) -> StreamingQuery:
    """Take in all bundles that are there, then stop; adds the ``bundle`` each row came from."""
    rows = bundle_stream(spark, folder, schema, max_files_per_trigger)
    return rows.select("*", F.col("_metadata.file_path").alias("bundle")) \
        .writeStream.format("parquet").option("checkpointLocation", checkpoint) \
        .option("path", target).trigger(availableNow=True).start()


def run_to_end(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for an available-now query; with a ``timeout`` in seconds one that does not end
    in time is stopped and raises."""
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            raise TimeoutError(f"streaming query {query.id} did not end in {timeout} s")
    finally:
        query.stop()
