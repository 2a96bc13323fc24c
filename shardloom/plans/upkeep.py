"""Work on a published index without building it anew: deletions, merged postings, statistics.

All go by the stored files alone.  A deletion is a list of ordinals per segment, written
below ``deletes/generation=<g>`` and named by a new segment list over the same documents;
``read_published`` and the alias view leave those rows out.  Older generations keep what
they were.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shardloom.operators.postings import merged_postings
from shardloom.operators.segments import latest_generation
from shardloom.operators.statistics import merged_statistics, segment_statistics
from shardloom.session import prepare
from shardloom.sinks.files import (
    claim_generation, commit_manifest, numbered, one_path, read_deletes, read_manifest,
)
from shardloom.spec import BuildSpec


def delete_documents(spark: SparkSession, manifest_path: str, ids: DataFrame, block: int = 65_536) -> int:
    """Delete the documents whose ``doc_id`` is in ``ids``; gives the new generation.

    Only the id column of the documents is read.  Unknown and repeated ids change nothing,
    a document deleted before stays deleted, and a null id deletes nothing.  Ordinals are
    kept in sorted lists of at most ``block``.
    """
    prepare(spark)
    newest = latest_generation(read_manifest(spark, manifest_path))
    path, before = one_path(newest), one_path(newest, "deletes")
    generation = claim_generation(spark, manifest_path)
    gone = ids.select(F.col("doc_id").cast("string").alias("doc_id")).where("doc_id is not null")
    found = numbered(spark.read.parquet(path).select("doc_id", "shard", "segment")).join(gone, "doc_id", "left_semi")
    lists = found.select("shard", "segment", "ord").unionByName(read_deletes(spark, before)) \
        .groupBy("shard", "segment", F.floor(F.col("ord") / block).cast("bigint").alias("block")) \
        .agg(F.sort_array(F.collect_set("ord")).alias("ords"))
    deletes = f"{manifest_path.rstrip('/').rsplit('/', 1)[0]}/deletes/generation={generation}"
    lists.write.mode("overwrite").parquet(deletes)
    counts = read_deletes(spark, deletes).groupBy("shard", "segment").agg(F.count(F.lit(1)).alias("_gone"))
    commit_manifest(with_deleted(newest, counts, generation).withColumn("deletes", F.lit(deletes)), manifest_path)
    return generation


def with_deleted(segments: DataFrame, counts: DataFrame, generation: int) -> DataFrame:
    """Segment list of a new generation with (shard, segment, _gone) as its deletions."""
    rows = segments.drop("deleted", "shard_deleted", "generation").join(counts, ["shard", "segment"], "left") \
        .withColumn("deleted", F.coalesce("_gone", F.lit(0)).cast("bigint")).drop("_gone")
    per_shard = rows.groupBy("shard").agg(F.sum("deleted").alias("shard_deleted"))
    return rows.join(per_shard, "shard").withColumn("generation", F.lit(generation).cast("bigint"))


def merge_shards(spark: SparkSession, spec: BuildSpec, postings_path: str, manifest_path: str) -> str:
    """Store one set of posting blocks per shard, made from its segments' blocks; gives the folder.

    Deleted documents keep their ordinals, as in the segments; readers leave them out by
    the deletion lists, which move by the same bases.
    """
    prepare(spark)
    newest = latest_generation(read_manifest(spark, manifest_path))
    path = f"{spec.index_path}/merged/{postings_path.rstrip('/').rsplit('/', 1)[1]}"
    merged_postings(spark.read.parquet(postings_path), newest, spec.postings_block) \
        .repartition("shard", "field", "term").sortWithinPartitions("shard", "field", "term", "block") \
        .write.mode("overwrite").partitionBy("shard").parquet(path)
    return path


def store_statistics(spark: SparkSession, spec: BuildSpec, postings_path: str) -> str:
    """Store the statistics of every segment beside its generation's postings; gives the folder.

    A pass over the posting blocks; no document is read.  Deleted documents still count, as
    in the postings.
    """
    prepare(spark)
    path = f"{spec.index_path}/statistics/{postings_path.rstrip('/').rsplit('/', 1)[1]}"
    segment_statistics(spark.read.parquet(postings_path)).write.mode("overwrite").parquet(path)
    return path


def merged_field_stats(spark: SparkSession, paths: Sequence[str], keys: tuple[str, ...] = ("field",)) -> DataFrame:
    """Statistics of all the indexes whose stored ones are in ``paths``, per ``keys``.

    Reads a row per field and segment, neither documents nor postings.  A document or term
    that two indexes hold counts in ``postings`` for each, in ``terms`` once.
    """
    return merged_statistics(spark.read.parquet(*paths), keys)
