"""Source views over the given tables, each with its SQL twin.

All views are row-by-row expressions over whole tables, so their size follows the data.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shardloom.operators.sharding import (
    colocate, planned_segments, segment_plan, with_segment, with_shard,
)
from shardloom.spec import Rules

SNAPSHOT = "20991231"
NUM_SHARDS = 3
TARGET_DOCS = 2_000     # documents per segment of the placement queries
BUNDLE_SEGMENTS = 13    # segments per shard of the bundle listings, however many documents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- orders with plain columns and four map columns ------------------------------------

def src_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) pri_key", "o_orderstatus status",
        "cast(o_totalprice as decimal(15,2)) price", "cast(o_orderdate as date) odate",
        "o_orderpriority prio", "o_custkey custkey",
        "map('Prio$', o_orderpriority, 'CUST&k', cast(o_custkey as string)) attrs_map",
        "map('hint', case when o_orderkey % 3 = 0 then 'null' when o_orderkey % 3 = 1 then ''"
        " else o_orderpriority end) extra_ex",
        "map('flag', cast(o_orderkey % 2 as string)) tags",
        "map(concat(o_orderpriority, '&', o_orderstatus), o_orderstatus) dyn_map")


ORDERS_RULES = Rules(id_field="pri_key", deny=frozenset({"status", "attrs_map-prio-"}),
                     overrides={"custkey": "string", "flag": "integer"})

DYN_FIELD_SQL = "concat('dyn_map-', lower(o_orderpriority), '-', lower(o_orderstatus))"

# fields of every order before any rule drops them: (doc_id, field, term)
ORDERS_LONG_SQL = f"""
src AS (SELECT *, CAST(o_orderkey AS VARCHAR) AS doc_id,
          CASE WHEN o_orderkey % 3 = 0 THEN 'null' WHEN o_orderkey % 3 = 1 THEN ''
               ELSE o_orderpriority END AS hint FROM orders),
long AS (
  SELECT doc_id, 'pri_key' AS field, doc_id AS term FROM src
  UNION ALL SELECT doc_id, 'status', o_orderstatus FROM src
  UNION ALL SELECT doc_id, 'price', CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) FROM src
  UNION ALL SELECT doc_id, 'odate', strftime(o_orderdate, '%Y%m%d') FROM src
  UNION ALL SELECT doc_id, 'prio', o_orderpriority FROM src
  UNION ALL SELECT doc_id, 'custkey', CAST(o_custkey AS VARCHAR) FROM src
  UNION ALL SELECT doc_id, 'attrs_map-prio-', o_orderpriority FROM src
  UNION ALL SELECT doc_id, 'attrs_map-cust-k', CAST(o_custkey AS VARCHAR) FROM src
  UNION ALL SELECT doc_id, 'hint', hint FROM src WHERE hint <> '' AND lower(hint) <> 'null'
  UNION ALL SELECT doc_id, 'flag', CAST(o_orderkey % 2 AS VARCHAR) FROM src
  UNION ALL SELECT doc_id, {DYN_FIELD_SQL}, o_orderstatus FROM src)"""

# discovered field facts of the same view
ORDERS_FIELDS_SQL = f"""
facts AS (
  SELECT DISTINCT 'pri_key' AS field, 'string' AS src_type, true AS is_plain, 'pri_key' AS src_col FROM orders
  UNION SELECT 'status', 'string', true, 'status' FROM orders
  UNION SELECT 'price', 'decimal(15,2)', true, 'price' FROM orders
  UNION SELECT 'odate', 'date', true, 'odate' FROM orders
  UNION SELECT 'prio', 'string', true, 'prio' FROM orders
  UNION SELECT 'custkey', 'bigint', true, 'custkey' FROM orders
  UNION SELECT 'attrs_map-prio-', 'string', false, 'attrs_map' FROM orders
  UNION SELECT 'attrs_map-cust-k', 'string', false, 'attrs_map' FROM orders
  UNION SELECT 'hint', 'string', false, 'extra_ex' FROM orders
  UNION SELECT 'flag', 'string', false, 'tags' FROM orders
  UNION SELECT {DYN_FIELD_SQL}, 'string', false, 'dyn_map' FROM orders)"""


# ---- side tables, one row per order ----------------------------------------------------

def deny_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('dyn_map-', lower(o_orderpriority), '-', lower(o_orderstatus)) name",
        "case when o_orderstatus = 'P' then 'other' else 'test' end theme",
        "case when o_orderpriority = '1-URGENT' then '20990101' else '20991231' end dt")


DENY_SQL = f"""
deny AS (SELECT DISTINCT {DYN_FIELD_SQL} AS name FROM orders
         WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT')"""


def override_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "concat(' dyn_map-', lower(o_orderpriority), '-', lower(o_orderstatus), ' ') index_name",
        "case when o_orderpriority < '3' then ' integer' else 'keyword ' end data_type",
        "case when o_orderstatus = 'F' then '20990101' else '20991231' end dt")


OVERRIDE_SQL = f"""
overrides AS (SELECT DISTINCT {DYN_FIELD_SQL} AS field,
                CASE WHEN o_orderpriority < '3' THEN 'integer' ELSE 'keyword' END AS type
              FROM orders WHERE o_orderstatus <> 'F')"""


# ---- placement -------------------------------------------------------------------------

def hash_sql(value: str, start: int) -> str:
    return f"CAST(concat('0x', substr(md5({value}), {start}, 8)) AS BIGINT)"


def shard_sql(value: str, n: int = NUM_SHARDS) -> str:
    return f"CAST({hash_sql(value, 1)} % {n} AS INTEGER)"


def place(docs: DataFrame, target: int = TARGET_DOCS, routing: Column | None = None,
          num_shards: int = NUM_SHARDS) -> DataFrame:
    sharded = with_shard(docs, num_shards, routing)
    return with_segment(sharded, segment_plan(sharded, target))


def together(docs: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Placed documents, one task per segment; ``ids`` are the documents' ids for sizing."""
    sized = with_shard((docs if ids is None else ids).select("doc_id"), NUM_SHARDS)
    counts = planned_segments(sized, TARGET_DOCS, NUM_SHARDS)
    return colocate(with_segment(with_shard(docs, NUM_SHARDS), counts), counts, NUM_SHARDS)


def placed_sql(source: str, target: int = TARGET_DOCS, routing: str = "doc_id",
               num_shards: int = NUM_SHARDS) -> str:
    """CTEs ending in ``placed``: the rows of ``source`` (has doc_id) with shard and segment."""
    return f"""
sharded AS (SELECT *, {shard_sql(routing, num_shards)} AS shard FROM ({source}) s),
sizes AS (SELECT shard, CAST(greatest(ceil(count(*) / {target}.0), 1) AS BIGINT) AS segments
          FROM sharded GROUP BY shard),
placed AS (SELECT sharded.*, CAST({hash_sql('doc_id', 9)} % segments AS INTEGER) AS segment
           FROM sharded JOIN sizes USING (shard))"""


ORDER_IDS = "SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, * FROM orders"


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("doc_id", F.col("o_orderkey").cast("string"))


# ---- lines: the same id many times -----------------------------------------------------

LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def src_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("doc_id"), *LINE_ORDER)


LINES_SQL = f"SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, {', '.join(LINE_ORDER)} FROM lineitem"


# ---- build states and bundles ----------------------------------------------------------

def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "concat('idx_', cast(user_id % 10 as string), '_2024010', cast(1 + user_id % 3 as string)) idx",
        "case when event_type = 'purchase' then 'completed' when event_type = 'error'"
        " and user_id % 7 = 0 then 'deleted' else 'started' end state", "ts", "event_id")


LEDGER_SQL = """
ledger AS (SELECT concat('idx_', CAST(user_id % 10 AS VARCHAR), '_2024010', CAST(1 + user_id % 3 AS VARCHAR)) AS idx,
             CASE WHEN event_type = 'purchase' THEN 'completed'
                  WHEN event_type = 'error' AND user_id % 7 = 0 THEN 'deleted'
                  ELSE 'started' END AS state, ts, event_id FROM events),
latest AS (SELECT idx, state FROM (SELECT idx, arg_max(state, (ts, event_id)) AS state
           FROM ledger GROUP BY idx) WHERE state <> 'deleted')"""


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(shard, segment, docs, deleted) of the placed orders."""
    docs = order_ids(spark, sf_dir).select("doc_id", "o_orderstatus")
    return with_segment(with_shard(docs, NUM_SHARDS), BUNDLE_SEGMENTS).groupBy("shard", "segment").agg(
        F.count(F.lit(1)).alias("docs"), F.count_if(F.col("o_orderstatus") == "P").alias("deleted"))


BUNDLES_SQL = f"""
bundled AS (SELECT *, {shard_sql('doc_id')} AS shard,
              CAST({hash_sql('doc_id', 9)} % {BUNDLE_SEGMENTS} AS INTEGER) AS segment FROM ({ORDER_IDS}) s),
bundles AS (SELECT shard, segment, count(*) AS docs,
              count(*) FILTER (o_orderstatus = 'P') AS deleted FROM bundled GROUP BY ALL)"""


# ---- versions: one per user group and day ----------------------------------------------

def version_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, shard, err): shard reports of dated versions."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('log_', cast(user_id % 5 as string), '_', date_format(ts, 'yyyyMMdd')) idx",
        "cast(event_id % 3 as int) shard",
        "case when event_type = 'error' and value > 40 then 'broken' end err")


VERSION_SHARDS_SQL = """
vshards AS (SELECT concat('log_', CAST(user_id % 5 AS VARCHAR), '_', strftime(ts, '%Y%m%d')) AS idx,
              CAST(event_id % 3 AS INTEGER) AS shard,
              CASE WHEN event_type = 'error' AND value > 40 THEN 'broken' END AS err FROM events)"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, status) of the versions the reports speak of; the older half is closed."""
    return version_shards(spark, sf_dir).select("idx").distinct().selectExpr(
        "idx", "case when substring_index(idx, '_', -1) < '20240115' then 'closed' else 'open' end status")


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, alias): every base has its live alias on the 15th, and one more on all versions."""
    named = versions(spark, sf_dir).selectExpr("idx", "substring(idx, 1, 5) base")
    live = named.where("idx like '%_20240115'").select("idx", F.col("base").alias("alias"))
    return live.unionByName(named.selectExpr("idx", "concat(base, '_all') alias"))


def new_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, alias): what the 16th takes over."""
    return versions(spark, sf_dir).where("idx like '%_20240116'").selectExpr(
        "idx", "substring(idx, 1, 5) alias")


VERSIONS_SQL = VERSION_SHARDS_SQL + """,
versions AS (SELECT DISTINCT idx, CASE WHEN split_part(idx, '_', 3) < '20240115' THEN 'closed'
                                       ELSE 'open' END AS status FROM vshards),
aliases AS (SELECT idx, substr(idx, 1, 5) AS alias FROM versions WHERE idx LIKE '%20240115'
            UNION ALL SELECT idx, concat(substr(idx, 1, 5), '_all') FROM versions),
targets AS (SELECT idx, substr(idx, 1, 5) AS alias FROM versions WHERE idx LIKE '%20240116')"""


def put_file(spark: SparkSession, path: str, text: str = "") -> None:
    """A small marker file, through the cluster's own file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
