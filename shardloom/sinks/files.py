"""File sinks: sharded documents, bulk text, mapping, manifest and build ledger.

Every data write goes through Spark's file committer, so readers never see half a task.
A version becomes visible only by the manifest rows, which are written last.
"""
from __future__ import annotations

from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shardloom.operators.segments import latest_generation

LEDGER_SCHEMA = ("idx string, state string, num_shards int, type_name string, "
                 "work_dir string, ts timestamp")
MANIFEST_SCHEMA = ("shard int, segment int, name string, position bigint, docs bigint, "
                   "deleted bigint, shard_docs bigint, shard_deleted bigint, generation bigint, "
                   "path string, deletes string, refused map<string,bigint>")
ROW_GROUP = 16 << 20  # bytes of a row group of documents before it is compressed
DELETES_SCHEMA = "shard int, segment int, block bigint, ords array<bigint>"


def _file_system(spark: SparkSession, path: str):
    """The cluster's own file system for ``path``, and the path as it takes it."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The Parquet files in ``path``, or no rows where there is no such folder."""
    files, target = _file_system(spark, path)
    return spark.read.schema(schema).parquet(path) if files.exists(target) else spark.createDataFrame([], schema)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the cluster's own file system; False if there was none."""
    files, target = _file_system(spark, path)
    return files.delete(target, True)


def write_sharded(docs: DataFrame, path: str, columns: tuple[str, ...] = ("doc_id", "doc_json")) -> None:
    """One Parquet file per (shard, segment), documents in id order; replaces ``path``.

    The sort also is the one a partitioned write would need anyway.  Row groups are small, so
    that many tasks can read one segment; a row's number in the file does not depend on them.
    """
    docs.select(*columns, "shard", "segment") \
        .sortWithinPartitions("shard", "segment", "doc_id") \
        .write.mode("overwrite").option("parquet.block.size", ROW_GROUP) \
        .partitionBy("shard", "segment").parquet(path)


def bulk_lines(doc_id: Column, doc_json: Column) -> Column:
    """A create-action line and the document line."""
    action = F.to_json(F.struct(F.struct(doc_id.alias("_id")).alias("create")))
    return F.concat(action, F.lit("\n"), doc_json)


def write_bulk(docs: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Bulk text below ``shard=/segment=`` folders, one request body per file if limited."""
    docs.sortWithinPartitions("shard", "segment", "doc_id") \
        .select(bulk_lines(F.col("doc_id"), F.col("doc_json")).alias("value"), "shard", "segment") \
        .write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file) \
        .partitionBy("shard", "segment").text(path)


def write_mapping(mapping_json: DataFrame, path: str) -> None:
    mapping_json.select("json").write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, MANIFEST_SCHEMA)


def next_generation(spark: SparkSession, path: str) -> int:
    """The number after the newest committed generation; writers take it with ``claim_generation``."""
    newest = read_manifest(spark, path).agg(F.max("generation").alias("g")).first()["g"]
    return (newest or 0) + 1


def create_marker(spark: SparkSession, path: str) -> bool:
    """Create an empty file if there is none, in one step of the file system (which is atomic
    where its create-without-overwrite is, as on HDFS); False if it was there."""
    files, target = _file_system(spark, path)
    try:
        files.create(target, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def claim(spark: SparkSession, folder: str, first: int) -> int:
    """The lowest number from ``first`` on that nobody has taken, taken by a marker file."""
    number = first
    while not create_marker(spark, f"{folder}/{number}"):
        number += 1
    return number


def claim_generation(spark: SparkSession, manifest_path: str) -> int:
    """A generation number that no other writer has or gets.

    Two builds of one index at the same time write to folders of their own; readers see the
    one with the higher number once it is committed, whichever ends first.  The number of a
    failed build is not used again.
    """
    folder = f"{manifest_path.rstrip('/').rsplit('/', 1)[0]}/claims"
    return claim(spark, folder, next_generation(spark, manifest_path))


def commit_manifest(manifest: DataFrame, path: str) -> None:
    """Append a segment list, one row per segment, as one file: readers see all of it or nothing."""
    manifest.coalesce(1).write.mode("append").parquet(path)


def commit_refused(manifest: DataFrame, refused: dict[str, int]) -> DataFrame:
    """Segment list with the number of refused rows of each reason beside every segment."""
    pairs = [x for reason, n in sorted(refused.items()) for x in (F.lit(reason), F.lit(n).cast("bigint"))]
    counts = F.create_map(*pairs) if pairs else F.create_map()
    return manifest.withColumn("refused", counts.cast("map<string,bigint>"))


def refused_counts(manifest: DataFrame) -> DataFrame:
    """(generation, reason, refused) of a manifest; nothing of the rejects table is read."""
    return manifest.select("generation", F.explode("refused").alias("reason", "refused")).distinct()


def one_path(manifest: DataFrame, column: str = "path") -> str | None:
    """The one folder that a generation's segment list names."""
    paths = [r[column] for r in manifest.select(column).distinct().collect()]
    if len(paths) != 1:
        raise ValueError(f"{len(paths)} {column} folders in one generation of a manifest")
    return paths[0]


def read_deletes(spark: SparkSession, path: str | None) -> DataFrame:
    """(shard, segment, ord) of the deletion lists in ``path``."""
    if path is None:
        return spark.createDataFrame([], "shard int, segment int, ord bigint")
    return spark.read.schema(DELETES_SCHEMA).parquet(path).select("shard", "segment", F.explode("ords").alias("ord"))


def numbered(docs: DataFrame) -> DataFrame:
    """Stored documents with their ordinal: a segment is one file in id order."""
    return docs.select("*", F.col("_metadata.row_index").alias("ord"))


def read_published(spark: SparkSession, manifest_path: str) -> DataFrame:
    """Documents of the newest committed generation, without deleted ones."""
    newest = latest_generation(read_manifest(spark, manifest_path))
    docs = spark.read.parquet(one_path(newest))
    deletes = one_path(newest, "deletes")
    if deletes is None:
        return docs
    return numbered(docs).join(read_deletes(spark, deletes), ["shard", "segment", "ord"], "left_anti").select(*docs.columns)


def append_states(records: DataFrame, path: str) -> None:
    """Append state records (columns of the ledger) as they come, one file per task."""
    names = [c.split()[0] for c in LEDGER_SCHEMA.split(", ")]
    records.select(*names).write.mode("append").parquet(path)


def append_state(spark: SparkSession, path: str, idx: str, state: str, num_shards: int,
                 type_name: str, work_dir: str) -> None:
    """One build-state record; the index name is the index name in every state."""
    now = datetime.now(timezone.utc)
    record = spark.createDataFrame([(idx, state, num_shards, type_name, work_dir, now)], LEDGER_SCHEMA)
    append_states(record.coalesce(1), path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, LEDGER_SCHEMA)


def write_versions(aliases: DataFrame, versions: DataFrame, path: str) -> int:
    """Alias and version tables as a new generation below ``path``; the row in ``commits``,
    written last, makes both visible at once."""
    spark = aliases.sparkSession
    newest = read_or_empty(spark, f"{path}/commits", "generation bigint").agg(F.max("generation")).first()[0]
    generation = claim(spark, f"{path}/claims", (newest or 0) + 1)
    aliases.write.mode("overwrite").parquet(f"{path}/generation={generation}/aliases")
    versions.write.mode("overwrite").parquet(f"{path}/generation={generation}/versions")
    spark.range(1).select(F.lit(generation).cast("bigint").alias("generation")).coalesce(1) \
        .write.mode("append").parquet(f"{path}/commits")
    return generation


def read_versions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Alias rows (idx, alias) and version rows (idx, status) as last stored."""
    newest = read_or_empty(spark, f"{path}/commits", "generation bigint").agg(F.max("generation")).first()[0]
    if newest is None:
        return (spark.createDataFrame([], "idx string, alias string"),
                spark.createDataFrame([], "idx string, status string"))
    root = f"{path}/generation={newest}"
    return spark.read.parquet(f"{root}/aliases"), spark.read.parquet(f"{root}/versions")
