"""Queries: build states and version lifecycle."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shardloom.functions import retention_name
from shardloom.operators import lifecycle
from shardloom.suite import fixtures as fx
from shardloom.suite.registry import query

_ORDER = ("ts", "event_id")


@query("state_latest", f"WITH {fx.LEDGER_SQL} SELECT idx, state FROM latest")
def state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.latest_state(fx.ledger(spark, sf_dir), _ORDER)


@query("state_completed", f"""WITH {fx.LEDGER_SQL},
    names AS (SELECT DISTINCT concat('idx_', CAST(user_id % 12 AS VARCHAR), '_2024010', CAST(1 + user_id % 3 AS VARCHAR)) AS idx FROM events)
    SELECT idx, coalesce(state = 'completed', false) AS completed FROM names LEFT JOIN latest USING (idx)""")
def state_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = fx.table(spark, sf_dir, "events").selectExpr(
        "concat('idx_', cast(user_id % 12 as string), '_2024010', cast(1 + user_id % 3 as string)) idx").distinct()
    return lifecycle.completed(names, fx.ledger(spark, sf_dir), _ORDER)


@query("bundles_pending", f"""WITH {fx.BUNDLES_SQL} SELECT shard, segment FROM bundles WHERE segment % 2 = 1""")
def bundles_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shardloom.functions import bundle_path
    listed = fx.bundles(spark, sf_dir).withColumn("path", bundle_path("work", F.col("shard"), F.col("segment")))
    processed = listed.where("segment % 2 = 0").select("path")
    return lifecycle.pending(listed, processed).select("shard", "segment")


@query("build_barrier", """
    WITH units AS (SELECT DISTINCT concat('idx_', CAST(user_id % 10 AS VARCHAR)) AS idx, user_id AS unit FROM events),
    done AS (SELECT DISTINCT concat('idx_', CAST(user_id % 10 AS VARCHAR)) AS idx, user_id AS unit FROM events
             WHERE event_type = 'purchase' AND (user_id % 10 < 7 OR value > 20))
    SELECT idx, count(*) AS expected, count(*) FILTER (d.unit IS NULL) AS left,
           count(*) FILTER (d.unit IS NULL) = 0 AS released
    FROM units u LEFT JOIN done d USING (idx, unit) GROUP BY idx""")
def build_barrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").selectExpr(
        "concat('idx_', cast(user_id % 10 as string)) idx", "user_id unit", "user_id", "event_type", "value")
    expected = events.select("idx", "unit").distinct()
    done = events.where("event_type = 'purchase' and (user_id % 10 < 7 or value > 20)").select("idx", "unit")
    return lifecycle.build_barrier(expected, done, "idx", "unit")


@query("health_gate", f"""WITH {fx.VERSION_SHARDS_SQL},
    names AS (SELECT DISTINCT concat('log_', CAST(user_id % 6 AS VARCHAR), '_', strftime(ts, '%Y%m%d')) AS idx FROM events),
    report AS (SELECT idx, bool_and(err IS NULL) AND count(DISTINCT shard) = 3 AS good FROM vshards GROUP BY idx)
    SELECT idx, coalesce(good, false) AS healthy FROM names LEFT JOIN report USING (idx)""")
def health_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = fx.table(spark, sf_dir, "events").selectExpr(
        "concat('log_', cast(user_id % 6 as string), '_', date_format(ts, 'yyyyMMdd')) idx").distinct()
    return lifecycle.health_gate(names, fx.version_shards(spark, sf_dir), 3)


@query("count_reconcile", f"""WITH {fx.VERSION_SHARDS_SQL}
    SELECT idx, count(*) FILTER (err IS NULL) = count(*) AS complete FROM vshards GROUP BY idx""")
def count_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.version_shards(spark, sf_dir)
    expected = rows.groupBy("idx").agg(F.count(F.lit(1)).alias("expected_docs"))
    stored = rows.where("err is null").groupBy("idx").agg(F.count(F.lit(1)).alias("stored_docs"))
    return lifecycle.reconciled(expected, stored)


@query("alias_swap", f"""WITH {fx.VERSIONS_SQL}
    SELECT idx, alias FROM aliases WHERE alias NOT IN (SELECT alias FROM targets)
    UNION ALL SELECT idx, alias FROM targets""")
def alias_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.alias_swap(fx.aliases(spark, sf_dir), fx.new_versions(spark, sf_dir))


@query("alias_losers", f"""WITH {fx.VERSIONS_SQL}
    SELECT DISTINCT a.idx FROM aliases a JOIN targets t ON a.alias = t.alias AND a.idx <> t.idx""")
def alias_losers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.alias_losers(fx.aliases(spark, sf_dir), fx.new_versions(spark, sf_dir))


@query("version_close", f"""WITH {fx.VERSIONS_SQL}
    SELECT idx, CASE WHEN idx LIKE '%20240115' THEN 'closed' ELSE status END AS status FROM versions""")
def version_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    losers = lifecycle.alias_losers(fx.aliases(spark, sf_dir), fx.new_versions(spark, sf_dir))
    return lifecycle.version_close(fx.versions(spark, sf_dir), losers)


@query("retention_name", """
    WITH n AS (SELECT DISTINCT concat('orders_', strftime(o_orderdate, '%Y%m%d')) AS idx FROM orders
               UNION SELECT DISTINCT concat('a_b_', strftime(o_orderdate, '%Y%m'), '30') FROM orders
               UNION SELECT DISTINCT o_orderpriority FROM orders UNION SELECT DISTINCT concat('x_', o_orderpriority) FROM orders)
    SELECT idx, concat(CASE WHEN contains(idx, '_') THEN regexp_replace(idx, '[^_]*$', '') ELSE '' END,
             coalesce(strftime(try_strptime(CASE WHEN regexp_full_match(list_last(string_split(idx, '_')), '[0-9]{8}')
                                                 THEN list_last(string_split(idx, '_')) END, '%Y%m%d') - INTERVAL 2 DAY, '%Y%m%d'), '')) AS before
    FROM n""")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    names = orders.select(F.explode(F.array(
        F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd")),
        F.concat(F.lit("a_b_"), F.date_format("o_orderdate", "yyyyMM"), F.lit("30")),
        F.col("o_orderpriority"), F.concat(F.lit("x_"), "o_orderpriority"))).alias("idx")).distinct()
    return names.select("idx", retention_name(F.col("idx"), -2).alias("before"))


@query("version_expire", f"""WITH {fx.VERSIONS_SQL}
    SELECT idx, status FROM versions WHERE idx NOT LIKE '%20240114'""")
def version_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.version_expire(fx.versions(spark, sf_dir), fx.new_versions(spark, sf_dir).select("idx"))


@query("final_properties", f"""WITH {fx.VERSION_SHARDS_SQL},
    report AS (SELECT idx, bool_and(err IS NULL) AS healthy FROM vshards GROUP BY idx)
    SELECT idx, CASE WHEN healthy THEN '1' ELSE '-1' END AS refresh_interval,
           CASE WHEN healthy THEN '2' END AS replicas, '3' AS num_shards FROM report""")
def final_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.version_shards(spark, sf_dir)
    own = F.create_map(F.lit("num_shards"), F.lit("3"), F.lit("refresh_interval"), F.lit("-1"))
    table = rows.select("idx").distinct().withColumn("settings", own)
    wanted = F.create_map(F.lit("refresh_interval"), F.lit("1"), F.lit("replicas"), F.lit("2"))
    after = lifecycle.final_properties(table, lifecycle.health_gate(table.select("idx"), rows), wanted)
    return after.select("idx", *[F.try_element_at("settings", F.lit(k)).alias(k)
                                 for k in ("refresh_interval", "replicas", "num_shards")])


@query("version_create", f"""WITH {fx.VERSION_SHARDS_SQL}
    SELECT DISTINCT idx, 'open' AS status, CAST(9 AS INTEGER) AS num_shards, CAST(0 AS INTEGER) AS replicas,
           CAST(-1 AS INTEGER) AS refresh_interval FROM vshards""")
def version_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.version_create(fx.versions(spark, sf_dir), 9)


@query("shards_by_holder", """
    WITH a AS (SELECT DISTINCT concat('log_', CAST(user_id % 5 AS VARCHAR)) AS idx, concat('node_', CAST(user_id % 7 AS VARCHAR)) AS holder,
                 CAST(user_id % 9 AS INTEGER) AS shard FROM events)
    SELECT idx, holder, string_agg(CAST(shard AS VARCHAR), ',' ORDER BY shard) AS shards FROM a
    WHERE holder IN (SELECT concat('node_', CAST(user_id % 7 AS VARCHAR)) FROM events WHERE event_type = 'signup' AND user_id % 7 <> 3)
    GROUP BY idx, holder""")
def shards_by_holder(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").selectExpr(
        "concat('log_', cast(user_id % 5 as string)) idx", "concat('node_', cast(user_id % 7 as string)) holder",
        "cast(user_id % 9 as int) shard", "event_type", "user_id")
    live = events.where("event_type = 'signup' and user_id % 7 <> 3").select("holder").distinct()
    held = lifecycle.shards_by_holder(events.select("idx", "holder", "shard"), live)
    return held.withColumn("shards", F.array_join(F.col("shards").cast("array<string>"), ","))
