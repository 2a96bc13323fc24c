"""Intake and state streams over several runs."""
import pytest
from pyspark.sql import functions as F

from shardloom.session import shared_dir
from shardloom.streaming import (
    latest_from_updates, read_taken, run_to_end, stream_bundles, stream_bundles_once, stream_latest_states,
    stream_state_events, taken_rows,
)
from shardloom.suite import fixtures as fx

STATES = "idx string, state string, ts bigint"


def land(spark, folder, rows):
    spark.createDataFrame(rows, STATES).coalesce(1).write.mode("append").parquet(folder)


def test_each_bundle_is_taken_once(spark):
    folder, target, checkpoint = (shared_dir(spark, p) for p in ("landing", "taken", "checkpoint"))
    spark.range(10).selectExpr("id").coalesce(1).write.mode("append").parquet(folder)
    fx.put_file(spark, f"{folder}/p1.parquet_tmp", "half")
    fx.put_file(spark, f"{folder}/p2.parquet", "")
    run_to_end(stream_bundles(spark, folder, "id bigint", checkpoint, target))
    run_to_end(stream_bundles(spark, folder, "id bigint", checkpoint, target))
    assert spark.read.parquet(target).count() == 10
    spark.range(10, 15).selectExpr("id").coalesce(1).write.mode("append").parquet(folder)
    run_to_end(stream_bundles(spark, folder, "id bigint", checkpoint, target))
    taken = spark.read.parquet(target)
    assert sorted(r["id"] for r in taken.collect()) == list(range(15))
    assert taken.select("bundle").distinct().count() == 2


def test_a_lost_checkpoint_takes_no_row_twice(spark):
    folder, target, checkpoint = (shared_dir(spark, p) for p in ("landing", "taken", "checkpoint"))
    spark.range(10).coalesce(1).write.mode("append").parquet(folder)
    run_to_end(stream_bundles_once(spark, folder, "id bigint", checkpoint, target))
    fx.put_file(spark, f"{folder}/p2.parquet", "")
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(folder)
    for at in (checkpoint, checkpoint, shared_dir(spark, "checkpoint"), shared_dir(spark, "checkpoint")):
        run_to_end(stream_bundles_once(spark, folder, "id bigint", at, target))
    taken = taken_rows(spark, target, "id bigint")
    assert sorted(r["id"] for r in taken.collect()) == list(range(15)) and taken.columns == ["id", "bundle"]
    assert read_taken(spark, target).count() == 2


def test_a_batch_that_broke_off_is_not_read(spark):
    folder, target = shared_dir(spark, "landing"), shared_dir(spark, "taken")
    spark.range(5).coalesce(1).write.mode("append").parquet(folder)
    # rows that a run wrote before it could record them, and its checkpoint lost
    spark.read.parquet(folder).select("id", F.col("_metadata.file_path").alias("bundle")) \
        .write.parquet(f"{target}/rows/run=gone/batch=0")
    run_to_end(stream_bundles_once(spark, folder, "id bigint", shared_dir(spark, "checkpoint"), target))
    assert sorted(r["id"] for r in taken_rows(spark, target, "id bigint").collect()) == list(range(5))


def test_latest_state_over_runs(spark):
    folder, target, checkpoint = (shared_dir(spark, p) for p in ("ledger", "states", "checkpoint"))
    land(spark, folder, [("a", "started", 1), ("b", "started", 2), ("a", "completed", 3)])
    run_to_end(stream_latest_states(spark, folder, STATES, checkpoint, target))
    land(spark, folder, [("b", "completed", 5), ("a", "started", 2), ("c", "started", 6)])
    run_to_end(stream_latest_states(spark, folder, STATES, checkpoint, target))
    got = {r["idx"]: r["state"] for r in latest_from_updates(spark, target).collect()}
    assert got == {"a": "completed", "b": "completed", "c": "started"}


def test_first_record_builds_and_later_completed_marks(spark):
    folder, target, checkpoint = (shared_dir(spark, p) for p in ("ledger", "events", "checkpoint"))
    land(spark, folder, [("a", "started", 1), ("a", "completed", 2), ("b", "completed", 3)])
    run_to_end(stream_state_events(spark, folder, STATES, checkpoint, target))
    land(spark, folder, [("a", "started", 4), ("b", "COMPLETED", 5), ("c", "started", 6), ("c", "started", 7)])
    run_to_end(stream_state_events(spark, folder, STATES, checkpoint, target))
    events = spark.read.parquet(f"{target}/events").orderBy("ts").collect()
    assert [(r["idx"], r["action"]) for r in events] == [
        ("a", "build"), ("a", "complete"), ("b", "build"), ("a", "log"), ("b", "complete"),
        ("c", "build"), ("c", "log")]


def test_a_query_that_does_not_end_is_stopped(spark):
    stream = spark.readStream.format("rate").load().writeStream.format("noop") \
        .option("checkpointLocation", shared_dir(spark, "checkpoint")).start()
    with pytest.raises(TimeoutError):
        run_to_end(stream, timeout=1)
    assert not stream.isActive


def test_shared_dir_follows_the_session(spark):
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
