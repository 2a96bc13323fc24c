"""Queries: sources, side tables, bundle listings."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shardloom.functions import bundle_path, snapshot_date
from shardloom.operators.discovery import discover_fields
from shardloom.operators.documents import document_terms
from shardloom.operators.mapping import infer_mapping, mapping_json
from shardloom.operators.sharding import colocate, with_segment, with_shard
from shardloom.session import shared_dir
from shardloom.sinks import write_mapping
from shardloom.sources import (
    completed_bundles, deny_list, json_fields, largest_bundle, list_bundles, list_files,
    mapping_fields,
    read_delimited, read_mapping, scan, type_overrides,
)
from shardloom.spec import Rules
from shardloom.suite import fixtures as fx
from shardloom.suite.registry import query


@query("scan_table", "SELECT * FROM orders")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx.table(spark, sf_dir, "orders").createOrReplaceTempView("scan_table_orders")
    return scan(spark, "scan_table_orders")


@query("scan_where", "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def scan_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/orders.parquet", "o_orderstatus = 'F' and o_totalprice > 100000")


@query("scan_no_predicate", "SELECT count(*) AS docs FROM lineitem")
def scan_no_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/lineitem.parquet", None).agg(F.count(F.lit(1)).alias("docs"))


@query("project_inputs", "SELECT o_orderkey, o_orderpriority FROM orders")
def project_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/orders.parquet", columns=["o_orderkey", "o_orderpriority"])


@query("scan_tsv", """
    SELECT CAST(o_orderkey AS VARCHAR) AS pri_key, o_orderstatus AS value01,
           o_orderpriority AS value02, CAST(strftime(o_orderdate, '%Y%m01') AS VARCHAR) AS dt
    FROM orders""")
def scan_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "tsv")
    line = F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    fx.table(spark, sf_dir, "orders").select(
        line.alias("value"), F.date_format("o_orderdate", "yyyyMM01").alias("dt")) \
        .write.partitionBy("dt").text(path)
    return read_delimited(spark, path, "pri_key string, value01 string, value02 string, dt string")


@query("snapshot_dt", """
    SELECT DISTINCT strftime(ts, '%Y%m%d') AS dt,
           concat('log_', CAST(user_id % 5 AS VARCHAR), '_', strftime(ts, '%Y%m%d')) AS idx
    FROM events""")
def snapshot_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.versions(spark, sf_dir).select("idx", snapshot_date(F.col("idx")).alias("dt"))


@query("denylist_read", f"WITH {fx.DENY_SQL} SELECT name FROM deny")
def denylist_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deny_list(fx.deny_table(spark, sf_dir), "test", fx.SNAPSHOT)


@query("override_read", f"WITH {fx.OVERRIDE_SQL} SELECT field, type FROM overrides")
def override_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_overrides(fx.override_table(spark, sf_dir), fx.SNAPSHOT)


@query("override_read_last_wins", """
    SELECT concat('f', CAST(user_id AS VARCHAR)) AS field, arg_max(event_type, (ts, event_type)) AS type
    FROM events WHERE event_id % 4 <> 0 GROUP BY user_id""")
def override_read_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fx.table(spark, sf_dir, "events").selectExpr(
        "concat('f', cast(user_id as string), '  ') index_name", "concat(' ', event_type) data_type",
        "case when event_id % 4 = 0 then '20990101' else '20991231' end dt", "ts")
    return type_overrides(table, fx.SNAPSHOT, order_by=F.col("ts"))


@query("scan_json_source", """
    SELECT CAST(event_id AS VARCHAR) AS doc_id, 'props_map-k' AS field,
           json_extract_string(props, '$.k') AS term
    FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def scan_json_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), "props")
    docs = document_terms(json_fields(rows, "props", "props_map"), Rules(id_field="id"))
    return docs.where("field <> 'id'").select("doc_id", "field", "term")


# ---- bundle listings -------------------------------------------------------------------

def _written_bundles(spark: SparkSession, sf_dir: str) -> str:
    """Bundle folders: one text file per segment, plus an unfinished and an empty file per shard."""
    path = shared_dir(spark, "bundles")
    placed = with_segment(with_shard(fx.order_ids(spark, sf_dir).select("doc_id"), fx.NUM_SHARDS),
                          fx.BUNDLE_SEGMENTS)
    colocate(placed, fx.BUNDLE_SEGMENTS, fx.NUM_SHARDS) \
        .select(F.col("doc_id").alias("value"), "shard", "segment") \
        .write.partitionBy("shard", "segment").text(path)
    for shard in range(fx.NUM_SHARDS):
        fx.put_file(spark, f"{path}/shard={shard}/segment=0/p0_{shard}.zip_tmp", "unfinished")
        fx.put_file(spark, f"{path}/shard={shard}/segment=0/p9_{shard}.zip")
    return path


def _place_of(path: str) -> list:
    return [F.regexp_extract(path, r"shard=(\d+)", 1).cast("int").alias("shard"),
            F.regexp_extract(path, r"segment=(\d+)", 1).cast("int").alias("segment")]


@query("bundle_list", f"WITH {fx.BUNDLES_SQL} SELECT shard, segment, CAST(1 AS BIGINT) AS files FROM bundles")
def bundle_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = completed_bundles(list_bundles(spark, _written_bundles(spark, sf_dir)))
    return listed.select(*_place_of("path")).groupBy("shard", "segment").agg(
        F.count(F.lit(1)).alias("files"))


@query("bundle_list_all", f"""WITH {fx.BUNDLES_SQL}
    SELECT shard, CAST(count(*) + 2 AS BIGINT) AS files FROM bundles GROUP BY shard""")
def bundle_list_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = list_files(spark, _written_bundles(spark, sf_dir))
    return listed.select(*_place_of("path")).groupBy("shard").agg(F.count(F.lit(1)).alias("files"))


@query("bundle_largest", f"""WITH {fx.BUNDLES_SQL},
    files AS (SELECT shard, segment, CAST(sum(strlen(doc_id) + 1) AS BIGINT) AS length
              FROM bundled GROUP BY ALL)
    SELECT shard, arg_max(segment, (length, CAST(segment AS VARCHAR))) AS segment,
           max(length) AS length FROM files GROUP BY shard""")
def bundle_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = list_bundles(spark, _written_bundles(spark, sf_dir))
    shard, segment = _place_of("path")
    return largest_bundle(listed.withColumn("shard", shard), "shard") \
        .select("shard", segment, "length")


@query("bundle_paths", f"""WITH {fx.BUNDLES_SQL}
    SELECT concat('work/', shard, '/p', segment, '_', shard, '.zip') AS path, docs FROM bundles""")
def bundle_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.bundles(spark, sf_dir).select(
        bundle_path("work", F.col("shard"), F.col("segment")).alias("path"), "docs")


@query("mapping_read", f"""WITH {fx.ORDERS_FIELDS_SQL}
    SELECT field, CASE src_type WHEN 'bigint' THEN 'long' WHEN 'decimal(15,2)' THEN 'double'
                  ELSE src_type END AS type,
           CASE WHEN NOT is_plain AND (src_col LIKE '%\\_map' ESCAPE '\\' OR src_col LIKE '%\\_ex' ESCAPE '\\')
                THEN 'no' WHEN src_type = 'string' THEN 'not_analyzed' END AS index,
           CASE WHEN src_type = 'date' THEN 'yyyyMMdd' END AS format
    FROM facts""")
def mapping_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "mapping")
    mapping = infer_mapping(discover_fields(fx.src_orders(spark, sf_dir)))
    write_mapping(mapping_json(mapping), path)
    return mapping_fields(read_mapping(spark, path))
