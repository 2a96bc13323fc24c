"""State events over deletions, late files, and bundles that share a file name."""
import os
import time

from shardloom.session import shared_dir
from shardloom.streaming import run_to_end, stream_bundles, stream_state_events

STATES = "idx string, state string, ts bigint"


def test_a_deleted_index_is_built_again(spark):
    folder, target, checkpoint = (shared_dir(spark, p) for p in ("ledger", "events", "checkpoint"))
    runs = [[("a", "deleted", 1), ("a", "started", 2), ("a", "completed", 3)],
            [("a", "deleted", 4)], [("a", "started", 5), ("b", "started", 6)], [("a", "completed", 7), ("b", "started", 8)]]
    for rows in runs:
        spark.createDataFrame(rows, STATES).coalesce(1).write.mode("append").parquet(folder)
        run_to_end(stream_state_events(spark, folder, STATES, checkpoint, target))
    events = spark.read.parquet(f"{target}/events").orderBy("ts").collect()
    assert [(r["idx"], r["action"]) for r in events] == [
        ("a", "log"), ("a", "build"), ("a", "complete"), ("a", "log"), ("a", "build"), ("b", "build"),
        ("a", "complete"), ("b", "log")]


def test_only_touched_indexes_are_written(spark):
    folder, target, checkpoint = (shared_dir(spark, p) for p in ("ledger", "events", "checkpoint"))
    idle = spark.range(10_000).selectExpr("concat('i', id) idx", "'started' state", "id ts")
    idle.coalesce(1).write.mode("append").parquet(folder)
    run_to_end(stream_state_events(spark, folder, STATES, checkpoint, target))
    spark.createDataFrame([("i7", "completed", 20_000)], STATES).coalesce(1).write.mode("append").parquet(folder)
    query = stream_state_events(spark, folder, STATES, checkpoint, target)
    run_to_end(query)
    operators = [o for p in query.recentProgress if p["numInputRows"] for o in p["stateOperators"]]
    assert [(o["numRowsTotal"], o["numRowsUpdated"]) for o in operators] == [(10_000, 1)]
    actions = spark.read.parquet(f"{target}/events").groupBy("action").count().collect()
    assert {r["action"]: r["count"] for r in actions} == {"build": 10_000, "complete": 1}


def test_an_index_with_more_records_than_a_chunk(spark):
    """Chunks come in any order; the newest record of all decides, null states are no deletion."""
    folder, target, checkpoint = (shared_dir(spark, p) for p in ("ledger", "events", "checkpoint"))
    rows = spark.range(3_000).selectExpr(
        "'a' idx", "case when id = 2999 then 'deleted' when id % 3 = 1 then null else 'started' end state", "id ts")
    rows.orderBy("ts", ascending=False).coalesce(1).write.mode("append").parquet(folder)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        run_to_end(stream_state_events(spark, folder, STATES, checkpoint, target))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    spark.createDataFrame([("a", "completed", 3_000), ("a", None, 3_001)], STATES).coalesce(1).write.mode("append").parquet(folder)
    run_to_end(stream_state_events(spark, folder, STATES, checkpoint, target))
    events = {r["ts"]: r["action"] for r in spark.read.parquet(f"{target}/events").collect()}
    assert len(events) == 3_002 and sorted(ts for ts, a in events.items() if a == "build") == [0, 3_000]
    assert events[2_999] == events[3_001] == "log"


def test_an_old_file_is_taken_in_a_later_run(spark):
    folder, target, checkpoint = (shared_dir(spark, p) for p in ("landing", "taken", "checkpoint"))
    spark.range(10).coalesce(1).write.mode("append").parquet(folder)
    run_to_end(stream_bundles(spark, folder, "id bigint", checkpoint, target))
    known = set(os.listdir(folder))
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(folder)
    old = time.time() - 60 * 86_400
    for name in set(os.listdir(folder)) - known:
        os.utime(f"{folder}/{name}", (old, old))
    run_to_end(stream_bundles(spark, folder, "id bigint", checkpoint, target))
    assert spark.read.parquet(target).count() == 15


def test_bundles_are_told_apart_by_path(spark):
    folder, target, checkpoint = (shared_dir(spark, p) for p in ("landing", "taken", "checkpoint"))
    rows = spark.range(9).selectExpr("id", "cast(id % 3 as int) shard").coalesce(1)
    rows.write.partitionBy("shard").parquet(folder)
    run_to_end(stream_bundles(spark, folder, "id bigint, shard int", checkpoint, target))
    assert spark.read.parquet(target).select("bundle").distinct().count() == 3
