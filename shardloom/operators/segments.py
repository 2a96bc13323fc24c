"""Segment manifest: what each shard consists of, without touching its documents."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shardloom.functions.names import base36, bundle_name


def shard_merge(bundles: DataFrame) -> DataFrame:
    """Order of a shard's bundles after concatenation.

    Bundles sort by folder *text* (``p_10`` before ``p_2``); the first is the base the
    others are appended to.  Empty bundles take no part.  Documents are not merged again.
    """
    window = Window.partitionBy("shard").orderBy("bundle")
    return bundles.where("docs > 0").withColumn("bundle", bundle_name(F.col("segment"))) \
        .withColumn("position", (F.row_number().over(window) - 1).cast("bigint")) \
        .withColumn("is_base", F.col("position") == 0)


def segment_name(position: Column) -> Column:
    return F.concat(F.lit("_"), base36(position))


def segment_manifest(bundles: DataFrame, generation: int | Column = 1) -> DataFrame:
    """(shard, segment, name, position, docs, deleted, shard_docs, shard_deleted, generation)."""
    whole = Window.partitionBy("shard")
    number = F.lit(generation) if isinstance(generation, int) else generation
    return shard_merge(bundles).select(
        "shard", "segment", segment_name(F.col("position")).alias("name"), "position",
        "docs", "deleted", F.sum("docs").over(whole).alias("shard_docs"),
        F.sum("deleted").over(whole).alias("shard_deleted"),
        number.cast("bigint").alias("generation"))


def shard_totals(bundles: DataFrame, num_shards: int) -> DataFrame:
    """Every shard with its totals; a shard without bundles is skipped by the merge."""
    found = bundles.where("docs > 0").groupBy("shard").agg(
        F.count(F.lit(1)).alias("segments"), F.sum("docs").alias("docs"))
    every = bundles.sparkSession.range(num_shards).select(F.col("id").cast("int").alias("shard"))
    return every.join(found, "shard", "left").select(
        "shard", F.coalesce("segments", F.lit(0)).alias("segments"),
        F.coalesce("docs", F.lit(0)).alias("docs"),
        F.col("segments").isNull().alias("skipped"))


def latest_generation(manifest: DataFrame) -> DataFrame:
    """Rows of the newest committed segment list."""
    newest = manifest.agg(F.max("generation").alias("generation"))
    return manifest.join(newest, "generation", "left_semi")
