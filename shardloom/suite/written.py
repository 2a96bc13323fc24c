"""Queries: sinks, checked by reading back what was written."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shardloom.operators.discovery import discover_fields
from shardloom.operators.documents import render_documents, with_doc_id
from shardloom.operators.lifecycle import latest_state
from shardloom.operators.mapping import infer_mapping, mapping_json
from shardloom.operators.segments import segment_manifest
from shardloom.operators.sharding import bulk_batches, dedupe_first
from shardloom.session import shared_dir
from shardloom.sinks import (
    append_states, bulk_lines, commit_manifest, next_generation, read_ledger, read_published,
    write_bulk, write_mapping, write_sharded,
)
from shardloom.sources import mapping_fields, read_mapping
from shardloom.spec import Rules
from shardloom.suite import fixtures as fx
from shardloom.suite.registry import query

_RULES = Rules(id_field="pri_key")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the orders view together per segment: rows move, documents are built after."""
    rows = fx.src_orders(spark, sf_dir).select("pri_key", "status", "prio", "odate", "custkey", "tags")
    return render_documents(fx.together(with_doc_id(rows, _RULES)), rows.schema, _RULES,
                            ["shard", "segment", "slot"])


_PLACED_SQL = fx.placed_sql(fx.ORDER_IDS)

_JSON_SQL = """concat('{"custkey":', o_custkey, ',"odate":"', strftime(o_orderdate, '%Y%m%d'), '","pri_key":"', o_orderkey,
    '","prio":"', o_orderpriority, '","status":"', o_orderstatus, '","flag":"', o_orderkey % 2, '"}')"""


@query("sink_overwrite", f"""
    WITH {_PLACED_SQL} SELECT doc_id, shard, segment FROM placed WHERE o_orderstatus = 'F'""")
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "overwrite")
    docs = fx.together(fx.order_ids(spark, sf_dir))
    write_sharded(docs.where("o_orderstatus <> 'F'"), path, ("doc_id",))
    write_sharded(docs.where("o_orderstatus = 'F'"), path, ("doc_id",))
    return spark.read.parquet(path)


@query("documents_placed", f"""
    WITH {_PLACED_SQL} SELECT doc_id, {_JSON_SQL} AS doc_json, shard, segment FROM placed""")
def documents_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan, ids, placement by one shuffle, documents: what a build stores."""
    return _stored(spark, sf_dir).select("doc_id", "doc_json", "shard", "segment")


@query("sink_sharded", f"""
    WITH {_PLACED_SQL} SELECT doc_id, {_JSON_SQL} AS doc_json, shard, segment FROM placed""")
def sink_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "sharded")
    write_sharded(_stored(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("sink_commit", f"""
    WITH {_PLACED_SQL} SELECT doc_id, shard, segment FROM placed WHERE o_orderstatus <> 'P'""")
def sink_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second generation whose segment list was never committed stays invisible."""
    root = shared_dir(spark, "commit")
    docs = fx.together(fx.order_ids(spark, sf_dir))
    first, second = f"{root}/docs/generation=1", f"{root}/docs/generation=2"
    write_sharded(docs.where("o_orderstatus <> 'P'"), first, ("doc_id",))
    stored = spark.read.parquet(first).groupBy("shard", "segment").agg(
        F.count(F.lit(1)).alias("docs"), F.lit(0).cast("bigint").alias("deleted"))
    generation = next_generation(spark, f"{root}/manifest")
    commit_manifest(segment_manifest(stored, generation).withColumn("path", F.lit(first)), f"{root}/manifest")
    write_sharded(docs, second, ("doc_id",))
    return read_published(spark, f"{root}/manifest")


@query("sink_mapping", """
    SELECT 'k' AS field, 'string' AS type, 'not_analyzed' AS index, CAST(NULL AS VARCHAR) AS format FROM events
    UNION SELECT 'day', 'date', NULL, 'yyyyMMdd' FROM events
    UNION SELECT concat('kinds_map-', event_type), 'double', 'no', NULL FROM events""")
def sink_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "mapping")
    rows = fx.table(spark, sf_dir, "events").selectExpr(
        "cast(event_id as string) k", "cast(ts as date) day", "map(event_type, value) kinds_map")
    write_mapping(mapping_json(infer_mapping(discover_fields(rows))), path)
    return mapping_fields(read_mapping(spark, path))


@query("sink_bulk_ndjson", f"""
    WITH {_PLACED_SQL}
    SELECT doc_id, shard, segment, CAST(1 AS BIGINT) AS actions, CAST(1 AS BIGINT) AS documents FROM placed""")
def sink_bulk_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line parses, and each id has one action line and one document line."""
    path = shared_dir(spark, "bulk")
    write_bulk(_stored(spark, sf_dir), path, max_records_per_file=100_000)
    lines = spark.read.text(path)
    action = F.get_json_object("value", "$.create._id")
    return lines.groupBy("shard", "segment", F.coalesce(action, F.get_json_object("value", "$.pri_key")).alias("doc_id")) \
        .agg(F.count(action).alias("actions"), F.count_if(action.isNull()).alias("documents"))


@query("bulk_requests", f"""
    WITH {fx.placed_sql(fx.ORDER_IDS)},
    lines AS (SELECT *, strlen(concat('{{"create":{{"_id":"', doc_id, '"}}}}', chr(10), '{{"pri_key":"', doc_id, '","status":"', o_orderstatus, '"}}')) AS size FROM placed),
    sized AS (SELECT *, row_number() OVER w - 1 AS n, sum(size) OVER w - size AS before FROM lines
              WINDOW w AS (PARTITION BY shard, segment ORDER BY doc_id ROWS UNBOUNDED PRECEDING))
    SELECT shard, segment, CAST(n // 100 + CAST(before AS BIGINT) // 16384 AS BIGINT) AS batch,
           count(*) AS actions, CAST(sum(size) AS BIGINT) AS bytes FROM sized GROUP BY ALL""")
def bulk_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request sizes of the bulk lines: at most 100 actions, cut at 16 KiB marks."""
    rows = fx.src_orders(spark, sf_dir).select("pri_key", "status")
    docs = render_documents(fx.place(with_doc_id(rows, _RULES)), rows.schema, _RULES, ["shard", "segment"])
    lines = docs.withColumn("line", bulk_lines(F.col("doc_id"), F.col("doc_json")))
    return bulk_batches(lines, 100, 16_384, body="line").groupBy("shard", "segment", "batch").agg(
        F.count(F.lit(1)).alias("actions"), F.sum(F.octet_length("line")).alias("bytes"))


@query("sink_dedupe_sharded", f"""
    SELECT {fx.shard_sql('CAST(l_orderkey AS VARCHAR)')} AS shard, count(DISTINCT l_orderkey) AS docs
    FROM lineitem GROUP BY ALL""")
def sink_dedupe_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated ids: the first row of each is stored."""
    path = shared_dir(spark, "deduped")
    lines = fx.src_lines(spark, sf_dir)
    first = dedupe_first(lines, fx.LINE_ORDER)
    write_sharded(fx.together(first, ids=lines.select("doc_id").distinct()), path, ("doc_id", "l_partkey"))
    return spark.read.parquet(path).groupBy("shard").agg(F.count(F.lit(1)).alias("docs"))


@query("sink_state", f"""WITH {fx.LEDGER_SQL}
    SELECT idx, arg_max(state, ts) AS state, max(ts) AS ts, CAST(3 AS INTEGER) AS num_shards, count(*) AS records
    FROM ledger GROUP BY idx HAVING arg_max(state, ts) <> 'deleted'""")
def sink_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Started and deleted records first, completed ones appended later; read back by time."""
    path = shared_dir(spark, "ledger")
    records = fx.ledger(spark, sf_dir).select(
        "idx", "state", F.lit(fx.NUM_SHARDS).alias("num_shards"), F.lit("datum").alias("type_name"),
        F.lit("work").alias("work_dir"), F.col("ts").cast("timestamp").alias("ts"))
    append_states(records.where("state <> 'completed'"), path)
    append_states(records.where("state = 'completed'"), path)
    ledger = read_ledger(spark, path)
    totals = ledger.groupBy("idx", "num_shards").agg(
        F.count(F.lit(1)).alias("records"), F.max("ts").cast("timestamp_ntz").alias("ts"))
    return latest_state(ledger).join(totals, "idx")
