"""Queries: bundle intake and state streams, run to their end and read back."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shardloom.operators import lifecycle
from shardloom.session import shared_dir
from shardloom.streaming import (
    latest_from_updates, run_to_end, stream_bundles, stream_bundles_once, stream_latest_states,
    stream_state_events, taken_rows,
)
from shardloom.suite import fixtures as fx
from shardloom.suite.registry import query

_BUNDLE_SCHEMA = "doc_id string, o_orderstatus string, o_custkey bigint, shard int"
_LEDGER_SCHEMA = "idx string, state string, ts timestamp_ntz, event_id bigint"


def _land(spark: SparkSession, sf_dir: str, folder: str, where: str) -> None:
    rows = fx.order_ids(spark, sf_dir).where(where).withColumn("shard", F.col("o_orderkey") % 3)
    rows.select("doc_id", "o_orderstatus", "o_custkey", "shard") \
        .write.mode("append").partitionBy("shard").parquet(folder)


@query("stream_bundles", """
    SELECT o_orderstatus, CAST(o_orderkey % 3 AS INTEGER) AS shard, count(*) AS docs,
           CAST(sum(o_custkey) AS BIGINT) AS keys FROM orders GROUP BY ALL""")
def intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint: the second takes only what landed in between.

    An unfinished file is there all the time and never read.
    """
    folder, target = shared_dir(spark, "landing"), shared_dir(spark, "taken")
    checkpoint = shared_dir(spark, "intake")
    _land(spark, sf_dir, folder, "o_orderstatus <> 'P'")
    fx.put_file(spark, f"{folder}/shard=0/p7_0.parquet_tmp", "half written")
    run_to_end(stream_bundles(spark, folder, _BUNDLE_SCHEMA, checkpoint, target))
    _land(spark, sf_dir, folder, "o_orderstatus = 'P'")
    run_to_end(stream_bundles(spark, folder, _BUNDLE_SCHEMA, checkpoint, target))
    return spark.read.parquet(target).groupBy("o_orderstatus", "shard").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("o_custkey").alias("keys"))


@query("stream_bundles_once", """
    SELECT o_orderstatus, CAST(o_orderkey % 3 AS INTEGER) AS shard, count(*) AS docs,
           CAST(sum(o_custkey) AS BIGINT) AS keys FROM orders GROUP BY ALL""")
def intake_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, the second on a new checkpoint that has forgotten what the first took."""
    folder, target = shared_dir(spark, "landing"), shared_dir(spark, "taken")
    for part in ("o_orderstatus <> 'P'", "o_orderstatus = 'P'"):
        _land(spark, sf_dir, folder, part)
        run_to_end(stream_bundles_once(spark, folder, _BUNDLE_SCHEMA, shared_dir(spark, "intake"), target))
    return taken_rows(spark, target, _BUNDLE_SCHEMA).groupBy("o_orderstatus", "shard").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("o_custkey").alias("keys"))


@query("stream_until_complete", """
    SELECT CAST(o_orderkey % 3 AS INTEGER) AS shard, count(*) AS docs, CAST(0 AS BIGINT) AS pending FROM orders GROUP BY ALL""")
def until_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Started after the completed record, one run leaves no bundle behind."""
    folder, target = shared_dir(spark, "landing"), shared_dir(spark, "taken")
    for part in ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1"):
        _land(spark, sf_dir, folder, part)
    run_to_end(stream_bundles(spark, folder, _BUNDLE_SCHEMA, shared_dir(spark, "intake"), target))
    taken = spark.read.parquet(target)
    listed = spark.read.parquet(folder).select("shard", F.col("_metadata.file_path").alias("path")).distinct()
    left = lifecycle.pending(listed, taken.select(F.col("bundle").alias("path"))) \
        .groupBy("shard").agg(F.count(F.lit(1)).alias("pending"))
    counts = taken.groupBy("shard").agg(F.count(F.lit(1)).alias("docs"))
    return counts.join(left, "shard", "left").select(
        "shard", "docs", F.coalesce("pending", F.lit(0)).alias("pending"))


@query("stream_state_latest", f"""WITH {fx.LEDGER_SQL}
    SELECT idx, arg_max(state, (ts, event_id)) AS state FROM ledger GROUP BY idx""")
def running_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint; the records arrive out of order."""
    path, target, checkpoint = (shared_dir(spark, p) for p in ("ledger", "states", "checkpoint"))
    for part in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        fx.ledger(spark, sf_dir).where(part).write.mode("append").parquet(path)
        run_to_end(stream_latest_states(spark, path, _LEDGER_SCHEMA, checkpoint, target, ("ts", "event_id")))
    return latest_from_updates(spark, target)


@query("stream_state_events", f"""WITH {fx.LEDGER_SQL},
    before AS (SELECT *, lag(state) OVER (PARTITION BY idx ORDER BY ts, event_id) AS prior FROM ledger)
    SELECT event_id, idx, CASE WHEN state = 'deleted' THEN 'log' WHEN prior IS NULL OR prior = 'deleted' THEN 'build'
                               WHEN state = 'completed' THEN 'complete' ELSE 'log' END AS action
    FROM before""")
def state_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in time order over two runs: the first of an index, and the first after it was
    deleted, starts a build."""
    path, target, checkpoint = (shared_dir(spark, p) for p in ("ledger", "events", "checkpoint"))
    for part in ("ts < timestamp_ntz'2024-01-10'", "ts >= timestamp_ntz'2024-01-10'"):
        fx.ledger(spark, sf_dir).where(part).write.mode("append").parquet(path)
        run_to_end(stream_state_events(spark, path, _LEDGER_SCHEMA, checkpoint, target, ("ts", "event_id")))
    return spark.read.parquet(f"{target}/events").select("event_id", "idx", "action")
