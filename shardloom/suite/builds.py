"""Queries: whole builds, checked by what they store and publish."""
from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from shardloom.operators.postings import field_stats
from shardloom.operators.segments import latest_generation
from shardloom.plans import (
    BuildResult, build_index, delete_documents, merge_shards, merged_field_stats, publish, store_statistics,
)
from shardloom.session import shared_dir
from shardloom.sinks import read_manifest, read_published, read_versions, refused_counts
from shardloom.sources import mapping_fields, read_mapping
from shardloom.spec import BuildSpec
from shardloom.suite import fixtures as fx
from shardloom.suite.registry import query

SEGMENTS = 2


def _spec(spark: SparkSession, rows: DataFrame, name: str, **options) -> BuildSpec:
    view = f"rows_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    return BuildSpec(**{**dict(table=view, index_name=f"{name}_20240116", num_shards=fx.NUM_SHARDS,
                               partition_multiples=SEGMENTS, work_dir=shared_dir(spark, "builds")), **options})


# ---- repeated ids, and columns called like those of placement ----------------------------

def _lines(spark: SparkSession, sf_dir: str, **options) -> BuildSpec:
    rows = fx.table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) pri_key", "l_linenumber `shard`", "l_partkey `Segment`",
        "l_suppkey `slot`", "l_returnflag `doc_id`", "l_linestatus `a.b`")
    return _spec(spark, rows, "lines", id_field="pri_key", order_by=("shard", "Segment", "slot", "doc_id", "a.b"),
                 **options)


_RANKED_SQL = f"""
ranked AS (SELECT *, CAST(l_orderkey AS VARCHAR) AS id, row_number() OVER (PARTITION BY l_orderkey
             ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS rn FROM lineitem),
firsts AS (SELECT *, {fx.shard_sql('id')} AS shard, CAST({fx.hash_sql('id', 9)} % {SEGMENTS} AS INTEGER) AS segment,
             concat('{{"Segment":', l_partkey, ',"a.b":"', l_linestatus, '","doc_id":"', l_returnflag,
                    '","pri_key":"', id, '","shard":', l_linenumber, ',"slot":', l_suppkey, '}}') AS doc_json
           FROM ranked WHERE rn = 1)"""


@query("index_build", f"WITH {_RANKED_SQL} SELECT id AS doc_id, doc_json, shard, segment FROM firsts")
def index_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published documents of a table whose ids repeat and whose names clash."""
    result = build_index(spark, _lines(spark, sf_dir), with_postings=False)
    return read_published(spark, result.manifest_path).select("doc_id", "doc_json", "shard", "segment")


@query("index_build_postings", f"""WITH {_RANKED_SQL}, terms AS (
    SELECT 'pri_key' AS field, id AS term FROM firsts
    UNION ALL SELECT 'shard', CAST(l_linenumber AS VARCHAR) FROM firsts
    UNION ALL SELECT 'Segment', CAST(l_partkey AS VARCHAR) FROM firsts
    UNION ALL SELECT 'slot', CAST(l_suppkey AS VARCHAR) FROM firsts
    UNION ALL SELECT 'doc_id', l_returnflag FROM firsts
    UNION ALL SELECT 'a.b', l_linestatus FROM firsts)
    SELECT field, term, count(*) AS df FROM terms GROUP BY ALL""")
def index_build_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = build_index(spark, _lines(spark, sf_dir, postings_block=500))
    return spark.read.parquet(result.postings_path).groupBy("field", "term").agg(F.sum("df").alias("df"))


@query("index_build_rejects", f"""WITH {_RANKED_SQL}
    SELECT id AS doc_id, 'repeated id' AS reason, CAST(l_partkey AS VARCHAR) AS part, count(*) AS refused
    FROM ranked WHERE rn > 1 GROUP BY ALL""")
def index_build_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that is not the first of its id, with its values."""
    result = build_index(spark, _lines(spark, sf_dir), with_postings=False)
    part = F.get_json_object("row", "$.Segment").alias("part")
    return spark.read.parquet(result.rejects_path).groupBy("doc_id", "reason", part).agg(
        F.sum("refused").alias("refused"))


@query("index_build_manifest", f"""WITH {_RANKED_SQL}
    SELECT shard, segment, count(*) AS docs, CAST(1 AS BIGINT) AS generation FROM firsts GROUP BY ALL""")
def index_build_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = build_index(spark, _lines(spark, sf_dir), with_postings=False)
    return read_manifest(spark, result.manifest_path).select("shard", "segment", "docs", "generation")


@query("manifest_refused", f"""WITH {_RANKED_SQL}
    SELECT CAST(1 AS BIGINT) AS generation, 'repeated id' AS reason, count(*) AS refused FROM ranked WHERE rn > 1""")
def manifest_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused rows by reason as the build counted them, without its rejects table."""
    result = build_index(spark, _lines(spark, sf_dir), with_postings=False)
    return refused_counts(read_manifest(spark, result.manifest_path))


@query("manifest_refused_reasons", """
    SELECT CASE WHEN event_id % 5 = 0 THEN 'malformed json' ELSE 'repeated id' END AS reason, count(*) AS refused
    FROM events, (SELECT 1 UNION ALL SELECT 2) twice(n) WHERE event_id % 5 = 0 OR n = 2 GROUP BY ALL""")
def manifest_refused_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row comes twice, and the texts of a fifth are no JSON objects."""
    rows = fx.table(spark, sf_dir, "events").selectExpr(
        "event_id", "case when event_id % 5 = 0 then substr(props, 1, length(props) - 1) else props end props",
        "explode(array(1, 2)) copy")
    result = build_index(spark, _spec(spark, rows, "events", id_field="event_id", json_source="props",
                                      order_by=("copy",)), with_postings=False)
    return refused_counts(read_manifest(spark, result.manifest_path)).select("reason", "refused")


_MANY = 12  # segments of a shard, so that the tenth comes before the second in manifest order

_MERGED_SQL = f"""{_RANKED_SQL.replace(f'% {SEGMENTS} AS', f'% {_MANY} AS')},
numbered AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY concat('p_', segment), id) - 1 AS ord FROM firsts),
terms AS (SELECT shard, segment, ord, 'pri_key' AS field, id AS term FROM numbered
    UNION ALL SELECT shard, segment, ord, 'shard', CAST(l_linenumber AS VARCHAR) FROM numbered
    UNION ALL SELECT shard, segment, ord, 'Segment', CAST(l_partkey AS VARCHAR) FROM numbered
    UNION ALL SELECT shard, segment, ord, 'slot', CAST(l_suppkey AS VARCHAR) FROM numbered
    UNION ALL SELECT shard, segment, ord, 'doc_id', l_returnflag FROM numbered
    UNION ALL SELECT shard, segment, ord, 'a.b', l_linestatus FROM numbered)"""


@query("merged_postings", f"""WITH {_MERGED_SQL}
    SELECT shard, field, term, CAST(ord // 100 AS BIGINT) AS block, CAST(count(*) AS INTEGER) AS df,
           string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) AS ords FROM terms GROUP BY ALL""")
def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shard's postings made from those of its segments, as if its documents were one list."""
    spec = _lines(spark, sf_dir, postings_block=100, partition_multiples=_MANY)
    result = build_index(spark, spec)
    path = merge_shards(spark, spec, result.postings_path, result.manifest_path)
    return spark.read.parquet(path).select("shard", "field", "term", "block", "df", F.array_join(
        F.col("ords").cast("array<string>"), ",").alias("ords"))


_STATISTICS_SQL = _MERGED_SQL + """,
per_term AS (SELECT shard, segment, field, term, count(*) AS df FROM terms GROUP BY ALL)"""


@query("segment_statistics", f"""WITH {_STATISTICS_SQL}
    SELECT shard, segment, field, CAST(sum(df) AS BIGINT) AS postings, max(df) AS max_df, count(*) AS terms
    FROM per_term GROUP BY ALL""")
def statistics_of_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a build's segments hold, stored once."""
    spec = _lines(spark, sf_dir, postings_block=100, partition_multiples=_MANY)
    path = store_statistics(spark, spec, build_index(spark, spec).postings_path)
    return spark.read.parquet(path).drop("sketch")


@query("merged_field_stats", f"""WITH {_STATISTICS_SQL}
    SELECT field, count(DISTINCT (shard, segment)) AS segments, CAST(sum(df) AS BIGINT) AS postings,
           max(df) AS max_segment_df, true AS terms_within_2_percent FROM per_term GROUP BY field""")
def merged_statistics_of_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index's fields from the statistics of its segments; distinct terms held against a
    count over all postings."""
    spec = _lines(spark, sf_dir, postings_block=100, partition_multiples=_MANY)
    result = build_index(spark, spec)
    merged = merged_field_stats(spark, [store_statistics(spark, spec, result.postings_path)])
    exact = field_stats(spark.read.parquet(result.postings_path)).select("field", F.col("terms").alias("exact"))
    close = F.abs(F.col("terms") - F.col("exact")) * 50 <= F.col("exact")
    return merged.join(exact, "field").select(
        "field", "segments", "postings", "max_segment_df", close.alias("terms_within_2_percent"))


def _after_deletes(spark: SparkSession, sf_dir: str) -> str:
    """Manifest path of a build of which two sets of ids, not disjoint, were deleted."""
    result = build_index(spark, _lines(spark, sf_dir), with_postings=False)
    ids = fx.table(spark, sf_dir, "lineitem").selectExpr("cast(l_orderkey as string) doc_id", "l_orderkey n")
    for divisor in (7, 11):
        delete_documents(spark, result.manifest_path, ids.where(F.col("n") % divisor == 0).select("doc_id"), block=10)
    return result.manifest_path


@query("documents_deleted", f"""WITH {_RANKED_SQL}
    SELECT id AS doc_id, doc_json, shard, segment FROM firsts WHERE l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0""")
def documents_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_published(spark, _after_deletes(spark, sf_dir)).select("doc_id", "doc_json", "shard", "segment")


@query("manifest_deleted", f"""WITH {_RANKED_SQL},
    counts AS (SELECT shard, segment, count(*) AS docs,
                 count(*) FILTER (WHERE l_orderkey % 7 = 0 OR l_orderkey % 11 = 0) AS deleted FROM firsts GROUP BY ALL)
    SELECT *, CAST(sum(docs) OVER (PARTITION BY shard) AS BIGINT) AS shard_docs,
           CAST(sum(deleted) OVER (PARTITION BY shard) AS BIGINT) AS shard_deleted, CAST(3 AS BIGINT) AS generation
    FROM counts""")
def manifest_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletions are a generation of their own; the documents stay where they are."""
    newest = latest_generation(read_manifest(spark, _after_deletes(spark, sf_dir)))
    return newest.select("shard", "segment", "docs", "deleted", "shard_docs", "shard_deleted", "generation")


@query("index_build_clashes", f"""WITH {_RANKED_SQL}
    SELECT id AS doc_id, concat('{{"_column_0":"', l_linestatus, '","_column_1":', l_suppkey, ',"a.b":"', l_returnflag,
               '","pri_key":"', id, '","refused":', l_partkey, ',"row":', l_linenumber, '}}') AS doc_json FROM firsts""")
def index_build_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns called like those that a build puts beside them, and like renamed ones."""
    rows = fx.table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) pri_key", "l_linenumber `row`", "l_partkey `refused`", "l_suppkey `_column_1`",
        "l_returnflag `a.b`", "l_linestatus `_column_0`")
    spec = _spec(spark, rows, "clashes", id_field="pri_key", order_by=("row", "refused", "_column_1", "a.b", "_column_0"))
    result = build_index(spark, spec, with_postings=False)
    return read_published(spark, result.manifest_path).select("doc_id", "doc_json")


@query("index_build_fields_by_partition", f"""WITH {fx.ORDERS_FIELDS_SQL}
    SELECT * FROM facts UNION ALL SELECT 'dt', 'string', true, 'dt'""")
def index_build_fields_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a second version, of whose three partitions the first has read two."""
    folder = shared_dir(spark, "partitioned")
    fx.src_orders(spark, sf_dir).withColumn("dt", F.col("status")).write.partitionBy("dt").parquet(folder)
    options = dict(table=folder, num_shards=fx.NUM_SHARDS, partition_multiples=SEGMENTS, id_field="pri_key",
                   order_by=("odate",), work_dir=shared_dir(spark, "builds"), facts_by="dt")
    build_index(spark, BuildSpec(index_name="o_20240116", where="dt <> 'P'", **options), with_postings=False)
    second = BuildSpec(index_name="o_20240117", **options)
    generation = build_index(spark, second, with_postings=False).generation
    return spark.read.parquet(f"{second.index_path}/fields/generation={generation}")


@query("index_build_bulk", f"""WITH {_RANKED_SQL},
    lines AS (SELECT *, strlen(concat('{{"create":{{"_id":"', id, '"}}}}', chr(10), doc_json)) AS size FROM firsts),
    sized AS (SELECT *, row_number() OVER w - 1 AS n, sum(size) OVER w - size AS before FROM lines
              WINDOW w AS (PARTITION BY shard, segment ORDER BY id ROWS UNBOUNDED PRECEDING))
    SELECT shard, segment, CAST(n // 100 + CAST(before AS BIGINT) // 9000 AS BIGINT) AS batch,
           count(*) AS actions, CAST(sum(size) + count(*) AS BIGINT) AS bytes FROM sized GROUP BY ALL""")
def index_build_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk requests that a build stores, cut by actions and bytes."""
    spec = _lines(spark, sf_dir, bulk=True, bulk_actions=100, bulk_bytes=9000)
    result = build_index(spark, spec, with_postings=False)
    return spark.read.parquet(result.bulk_path).select(
        "shard", "segment", "batch", "actions", F.octet_length("body").cast("bigint").alias("bytes"))


# ---- rows without ids, bad JSON, nothing, a failure, publishing --------------------------

def _orders(spark: SparkSession, sf_dir: str, **options) -> BuildSpec:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "case when o_orderkey % 3 <> 0 then cast(o_orderkey as string) end id", "o_orderstatus status",
        "o_orderpriority prio")
    return _spec(spark, rows, "orders", **{**dict(id_field="id", order_by=("status", "prio")), **options})


@query("index_build_nameless", """
    WITH docs AS (SELECT CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS id,
                    concat('{', CASE WHEN o_orderkey % 3 <> 0 THEN concat('"id":"', o_orderkey, '",') ELSE '' END,
                           '"prio":"', o_orderpriority, '","status":"', o_orderstatus, '"}') AS doc_json FROM orders)
    SELECT coalesce(id, concat(md5(doc_json), '-', row_number() OVER (PARTITION BY id, doc_json) - 1)) AS doc_id,
           doc_json FROM docs""")
def index_build_nameless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows has no id; equal ones among them are many."""
    result = build_index(spark, _orders(spark, sf_dir), with_postings=False)
    return read_published(spark, result.manifest_path).select("doc_id", "doc_json")


@query("index_build_bad_json", """
    SELECT CAST(event_id AS VARCHAR) AS doc_id, event_id % 5 = 0 AS refused,
           CASE WHEN event_id % 5 = 0 THEN substr(props, 1, length(props) - 1)
                ELSE json_extract_string(props, '$.k') END AS text FROM events""")
def index_build_bad_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text that is no JSON object goes to the rejects whole; the others become fields."""
    rows = fx.table(spark, sf_dir, "events").selectExpr(
        "event_id", "case when event_id % 5 = 0 then substr(props, 1, length(props) - 1) else props end props")
    result = build_index(spark, _spec(spark, rows, "events", id_field="event_id", json_source="props",
                                      order_by=("event_id",)), with_postings=False)
    kept = read_published(spark, result.manifest_path).select(
        "doc_id", F.lit(False).alias("refused"), F.get_json_object("doc_json", "$.k").alias("text"))
    return kept.unionByName(spark.read.parquet(result.rejects_path).select(
        "doc_id", F.lit(True).alias("refused"), F.get_json_object("row", "$.props").alias("text")))


@query("index_build_empty", """
    SELECT count(*) AS docs, CAST(1 AS BIGINT) AS generation FROM orders WHERE o_orderstatus = 'none'""")
def index_build_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicate that no row meets: a generation without documents is published."""
    result = build_index(spark, _orders(spark, sf_dir, where="status = 'none'"))
    return read_manifest(spark, result.manifest_path).select("docs", "generation")


@query("index_build_failed", """
    SELECT unnest(['id', 'prio', 'status']) AS field, 'string' AS type, count(*) AS docs FROM orders""")
def index_build_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second build that fails leaves mapping and documents of the first."""
    spec = _orders(spark, sf_dir)
    first: BuildResult = build_index(spark, spec, with_postings=False)
    overrides = fx.table(spark, sf_dir, "orders").selectExpr(
        "'status' index_name", "'long' data_type", "'20240116' dt").distinct()
    try:
        build_index(spark, spec, overrides=overrides, with_postings=False)
    except PySparkException:
        docs = read_published(spark, first.manifest_path).count()
        return mapping_fields(read_mapping(spark, first.mapping_path)).select(
            "field", "type", F.lit(docs).cast("bigint").alias("docs"))
    raise AssertionError("the second build did not fail")


@query("index_publish", """
    SELECT idx, status, CASE WHEN status = 'open' THEN 'orders_now' END AS alias, docs
    FROM (VALUES ('orders_20240115', 'closed'), ('orders_20240116', 'open')) v(idx, status),
         (SELECT count(*) AS docs FROM orders) n""")
def index_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days built and published: the first is gone, the second closed, the third open."""
    spec = _orders(spark, sf_dir, alias="orders_now")
    counts = {}
    for day in ("20240114", "20240115", "20240116"):
        today = BuildSpec(**{**spec.__dict__, "index_name": f"orders_{day}"})
        result = build_index(spark, today, with_postings=False)
        publish(spark, today, result, view=False)
        counts[today.index_name] = result.manifest_path
    aliases, versions = read_versions(spark, f"{spec.work_dir}/_versions")
    stored = None
    for idx, path in counts.items():
        one = read_manifest(spark, path).agg(F.sum("docs").alias("docs")).select(F.lit(idx).alias("idx"), "docs")
        stored = one if stored is None else stored.unionByName(one)
    return versions.join(stored, "idx").join(aliases, "idx", "left").select("idx", "status", "alias", "docs")


@query("index_publish_aliases", """
    SELECT * FROM (VALUES ('orders_20240116', 'orders_now'), ('orders_20240115', 'orders_old')) v(idx, alias)
    WHERE (SELECT count(*) FROM orders) > 0""")
def index_publish_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version that expires takes its other aliases along; those of a closed version stay."""
    spec = _orders(spark, sf_dir, alias="orders_now")
    for day, aliases in (("20240114", ("orders_now", "orders_first")), ("20240115", ("orders_now", "orders_old")),
                         ("20240116", ("orders_now",))):
        for alias in aliases:
            today = BuildSpec(**{**spec.__dict__, "index_name": f"orders_{day}", "alias": alias})
            if alias == aliases[0]:
                result = build_index(spark, today, with_postings=False)
            publish(spark, today, result, view=False)
    return read_versions(spark, f"{spec.work_dir}/_versions")[0].select("idx", "alias")
