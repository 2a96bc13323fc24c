"""Queries: shards, segments, first-row-wins, micro-batches."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shardloom.functions import segment_of, shard_of
from shardloom.operators.sharding import (
    bulk_batches, colocate, dedupe_first, dedupe_rejects, nonempty_shards, partition_counts,
    segment_plan, with_segment, with_shard,
)
from shardloom.suite import fixtures as fx
from shardloom.suite.registry import query

_ORDER = ", ".join(fx.LINE_ORDER)


@query("shard_assign", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, {fx.shard_sql('CAST(o_orderkey AS VARCHAR)', 9)} AS shard FROM orders""")
def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_shard(fx.order_ids(spark, sf_dir).select("doc_id"), 9)


_ROUTING_SQL = "CASE WHEN o_custkey % 10 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END"


@query("shard_routing", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, {fx.shard_sql(_ROUTING_SQL, 9)} AS shard FROM orders""")
def shard_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    routing = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey"))
    return with_shard(fx.order_ids(spark, sf_dir), 9, routing).select("doc_id", "shard")


@query("segment_assign", f"""WITH {fx.placed_sql(fx.ORDER_IDS)} SELECT doc_id, shard, segment FROM placed""")
def segment_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.place(fx.order_ids(spark, sf_dir).select("doc_id")).select("doc_id", "shard", "segment")


@query("segment_plan_hot_routing", f"""
    WITH {fx.placed_sql(fx.ORDER_IDS, routing='o_orderstatus', num_shards=9)}
    SELECT shard, segment, count(*) AS docs FROM placed GROUP BY ALL""")
def segment_plan_hot_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three routing values hold all rows: their shards are cut into more segments."""
    return partition_counts(fx.place(fx.order_ids(spark, sf_dir), routing=F.col("o_orderstatus"),
                                     num_shards=9))


@query("segment_fixed_multiples", f"""
    SELECT {fx.shard_sql('CAST(o_orderkey AS VARCHAR)')} AS shard,
           CAST({fx.hash_sql('CAST(o_orderkey AS VARCHAR)', 9)} % 10 AS INTEGER) AS segment, count(*) AS docs
    FROM orders GROUP BY ALL""")
def segment_fixed_multiples(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = with_segment(with_shard(fx.order_ids(spark, sf_dir).select("doc_id"), fx.NUM_SHARDS), 10)
    return partition_counts(placed)


@query("repartition_routing", f"""
    SELECT {fx.shard_sql(_ROUTING_SQL)} AS shard,
           CAST({fx.hash_sql('CAST(o_orderkey AS VARCHAR)', 9)} % 4 AS INTEGER) AS segment,
           count(*) AS docs, CAST(1 AS BIGINT) AS tasks
    FROM orders GROUP BY ALL""")
def repartition_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    routing = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey"))
    sharded = with_shard(fx.order_ids(spark, sf_dir), fx.NUM_SHARDS, routing)
    placed = colocate(with_segment(sharded, 4).select("shard", "segment"), 4, fx.NUM_SHARDS)
    per_task = placed.groupBy("shard", "segment", F.spark_partition_id().alias("task")).count()
    return per_task.groupBy("shard", "segment").agg(
        F.sum("count").alias("docs"), F.count(F.lit(1)).alias("tasks"))


@query("partition_counts", f"""
    SELECT {fx.shard_sql('CAST(l_orderkey AS VARCHAR)', 9)} AS shard,
           CAST({fx.hash_sql('CAST(l_orderkey AS VARCHAR)', 9)} % 4 AS INTEGER) AS segment, count(*) AS docs
    FROM lineitem GROUP BY ALL""")
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.src_lines(spark, sf_dir).select("doc_id")
    return partition_counts(with_segment(with_shard(docs, 9), 4))


@query("dedupe_first", f"""
    SELECT doc_id, {_ORDER} FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY {_ORDER}) AS rn
    FROM ({fx.LINES_SQL}) s) WHERE rn = 1""")
def first_of_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_first(fx.src_lines(spark, sf_dir), fx.LINE_ORDER)


_SCOPED_SQL = f"""SELECT doc_id, {_ORDER}, {fx.shard_sql('CAST(l_partkey AS VARCHAR)')} AS shard,
    CAST({fx.hash_sql('doc_id', 9)} % 4 AS INTEGER) AS segment FROM ({fx.LINES_SQL}) s"""


def _routed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.src_lines(spark, sf_dir)
    return lines.withColumn("shard", shard_of(F.col("l_partkey"), fx.NUM_SHARDS)) \
        .withColumn("segment", segment_of(F.col("doc_id"), 4))


@query("dedupe_segment_scope", f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY shard, segment, doc_id ORDER BY {_ORDER}) AS rn
    FROM ({_SCOPED_SQL}) s) WHERE rn = 1""")
def first_in_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_first(_routed_lines(spark, sf_dir), fx.LINE_ORDER, scope="segment")


@query("dedupe_rejects", f"""
    SELECT doc_id, {_ORDER}, count(*) AS refused FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY {_ORDER}) AS rn FROM ({fx.LINES_SQL}) s)
    WHERE rn > 1 GROUP BY ALL""")
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_rejects(fx.src_lines(spark, sf_dir), fx.LINE_ORDER)


@query("dedupe_rejects_segment_scope", f"""
    SELECT shard, segment, count(*) AS refused FROM (
      SELECT *, row_number() OVER (PARTITION BY shard, segment, doc_id ORDER BY {_ORDER}) AS rn FROM ({_SCOPED_SQL}) s)
    WHERE rn > 1 GROUP BY ALL""")
def rejects_in_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedupe_rejects(_routed_lines(spark, sf_dir), fx.LINE_ORDER, scope="segment")
    return found.groupBy("shard", "segment").agg(F.sum("refused").alias("refused"))


_TEXT_IDS = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents"


@query("bulk_batches", f"""WITH {fx.placed_sql(_TEXT_IDS, 300)},
    sized AS (SELECT *, row_number() OVER w - 1 AS n, sum(strlen(text)) OVER w - strlen(text) AS before
              FROM placed WINDOW w AS (PARTITION BY shard, segment ORDER BY doc_id ROWS UNBOUNDED PRECEDING))
    SELECT doc_id, shard, segment, CAST(n // 100 + CAST(before AS BIGINT) // 200000 AS BIGINT) AS batch FROM sized""")
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    sharded = with_shard(docs, fx.NUM_SHARDS)
    plan = segment_plan(with_shard(docs.select("doc_id"), fx.NUM_SHARDS), 300)
    placed = with_segment(sharded, plan)
    return bulk_batches(placed, 100, 200_000, body="text").select("doc_id", "shard", "segment", "batch")


@query("shard_nonempty", f"""
    WITH n AS (SELECT {fx.shard_sql('o_orderstatus', 9)} AS shard, count(*) AS docs FROM orders GROUP BY ALL)
    SELECT CAST(r.i AS INTEGER) AS shard, coalesce(docs, 0) AS docs, docs IS NOT NULL AS bundled
    FROM range(9) r(i) LEFT JOIN n ON n.shard = r.i""")
def nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nonempty_shards(with_shard(fx.order_ids(spark, sf_dir), 9, F.col("o_orderstatus")), 9)
