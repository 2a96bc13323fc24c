"""Queries: ordinals, postings, statistics, segment manifests."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shardloom.operators.discovery import discover_fields
from shardloom.operators.documents import (
    build_documents, document_term_sets, document_terms, render_terms, with_doc_id,
)
from shardloom.operators.mapping import indexed_field_names, infer_mapping
from shardloom.operators.postings import (
    doc_ordinals, field_docs, field_stats, postings, term_stats,
)
from shardloom.operators.segments import (
    latest_generation, segment_manifest, shard_merge, shard_totals,
)
from shardloom.operators.sharding import with_segment, with_shard
from shardloom.session import shared_dir
from shardloom.sinks import commit_manifest, next_generation, read_manifest, write_sharded
from shardloom.spec import Rules
from shardloom.suite import fixtures as fx
from shardloom.suite.registry import query

BLOCK = 500


@query("doc_ordinals", f"""WITH {fx.placed_sql(fx.ORDER_IDS)}
    SELECT doc_id, shard, segment, row_number() OVER (PARTITION BY shard, segment ORDER BY doc_id) - 1 AS ord
    FROM placed""")
def ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_ordinals(fx.place(fx.order_ids(spark, sf_dir).select("doc_id")))


# Fields of the orders view that are indexed: plain ones and the tags map, not *_map, not *_ex.
_RULES = Rules(id_field="pri_key", deny=frozenset({"price"}), overrides={"custkey": "string", "flag": "integer"})

_NUMBERED_SQL = f"""{fx.ORDERS_LONG_SQL}, {fx.placed_sql(fx.ORDER_IDS)},
numbered AS (SELECT doc_id, shard, segment, row_number() OVER (PARTITION BY shard, segment ORDER BY doc_id) - 1 AS ord
             FROM placed),
blocks AS (SELECT shard, segment, field, term, CAST(ord // {BLOCK} AS BIGINT) AS block, ord
           FROM long JOIN numbered USING (doc_id)
           WHERE field IN ('pri_key', 'status', 'odate', 'prio', 'custkey', 'flag'))"""


def _order_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.src_orders(spark, sf_dir)
    indexed = indexed_field_names(infer_mapping(discover_fields(rows)))
    numbered = doc_ordinals(fx.place(with_doc_id(rows, _RULES)))
    return postings(render_terms(numbered, rows.schema, _RULES, indexed,
                                 ["shard", "segment", "ord"]), BLOCK)


@query("postings_build", f"""WITH {_NUMBERED_SQL}
    SELECT shard, segment, field, term, block, CAST(count(*) AS INTEGER) AS df,
           string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) AS ords
    FROM blocks GROUP BY shard, segment, field, term, block""")
def postings_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_postings(spark, sf_dir).withColumn(
        "ords", F.array_join(F.col("ords").cast("array<string>"), ","))


@query("postings_long_terms", f"""
    WITH {fx.placed_sql('SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents', 300)},
    numbered AS (SELECT *, row_number() OVER (PARTITION BY shard, segment ORDER BY doc_id) - 1 AS ord FROM placed),
    long AS (SELECT shard, segment, ord, 'lang' AS field, lang AS term FROM numbered
             UNION ALL SELECT shard, segment, ord, 'text', text FROM numbered WHERE text <> '')
    SELECT shard, segment, field, term, CAST(ord // 64 AS BIGINT) AS block, CAST(count(*) AS INTEGER) AS df,
           string_agg(CAST(ord AS VARCHAR), ',' ORDER BY ord) AS ords
    FROM long GROUP BY ALL""")
def postings_long_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts are single terms, stored as they are, however long."""
    rows = fx.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "text", "lang")
    rules = Rules(id_field="id")
    numbered = doc_ordinals(fx.place(with_doc_id(rows, rules), 300))
    terms = render_terms(numbered, rows.schema, rules, frozenset({"text", "lang"}),
                         ["shard", "segment", "ord"])
    return postings(terms, 64).withColumn(
        "ords", F.array_join(F.col("ords").cast("array<string>"), ","))


@query("field_stats", f"""WITH {_NUMBERED_SQL},
    per_term AS (SELECT field, term, count(*) AS df FROM blocks GROUP BY field, term)
    SELECT field, count(*) AS terms, CAST(sum(df) AS BIGINT) AS postings, max(df) AS max_df
    FROM per_term GROUP BY field""")
def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_stats(_order_postings(spark, sf_dir))


@query("term_stats", f"""WITH {fx.ORDERS_LONG_SQL}
    SELECT field, term, count(*) AS df FROM long WHERE field IN ('prio', 'odate', 'flag') GROUP BY ALL""")
def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_stats(document_term_sets(fx.src_orders(spark, sf_dir), _RULES, only={"prio", "odate", "flag"}))


@query("field_docs", f"""WITH {fx.ORDERS_LONG_SQL}
    SELECT field, count(*) AS docs FROM long WHERE field <> 'price' GROUP BY field""")
def docs_per_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_docs(document_terms(fx.src_orders(spark, sf_dir), _RULES).where("pos = 0"))


@query("doc_store", """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, md5(text) AS digest, n_chars FROM documents WHERE text <> ''""")
def doc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents keep whole texts, unindexed fields too; read back from the JSON."""
    rows = fx.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "n_chars", F.create_map(
            F.lit("text"), F.col("text"), F.lit("lang"), F.col("lang")).alias("body_ex"))
    stored = build_documents(rows, Rules(id_field="id")).select("doc_id", "doc_json")
    return stored.select("doc_id", F.from_json("doc_json", "lang string, text string, n_chars bigint").alias("d")) \
        .select("doc_id", "d.lang", F.md5("d.text").alias("digest"), "d.n_chars")


@query("segment_compact", f"""
    WITH {fx.placed_sql(fx.ORDER_IDS)}
    SELECT shard, segment, count(*) AS docs, CAST(1 AS BIGINT) AS files FROM placed GROUP BY ALL""")
def segment_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "compact")
    write_sharded(fx.together(fx.order_ids(spark, sf_dir)), path, ("doc_id", "o_orderstatus"))
    per_file = spark.read.parquet(path).groupBy(
        "shard", "segment", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("shard", "segment").agg(
        F.sum("n").alias("docs"), F.count(F.lit(1)).alias("files"))


_MERGED_SQL = f"""{fx.BUNDLES_SQL},
merged AS (SELECT *, concat('p_', segment) AS bundle,
             row_number() OVER (PARTITION BY shard ORDER BY concat('p_', segment)) - 1 AS position FROM bundles)"""

_NAME_SQL = "concat('_', lower(to_base(position, 36)))"


@query("shard_merge", f"WITH {_MERGED_SQL} SELECT *, position = 0 AS is_base FROM merged")
def merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_merge(fx.bundles(spark, sf_dir))


@query("segment_names", f"WITH {_MERGED_SQL} SELECT shard, segment, {_NAME_SQL} AS name FROM merged")
def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_manifest(fx.bundles(spark, sf_dir)).select("shard", "segment", "name")


_MANIFEST_SQL = f"""SELECT shard, segment, {_NAME_SQL} AS name, position, docs, deleted,
    CAST(sum(docs) OVER (PARTITION BY shard) AS BIGINT) AS shard_docs,
    CAST(sum(deleted) OVER (PARTITION BY shard) AS BIGINT) AS shard_deleted"""


@query("segment_manifest", f"WITH {_MERGED_SQL} {_MANIFEST_SQL}, CAST(1 AS BIGINT) AS generation FROM merged")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_manifest(fx.bundles(spark, sf_dir), 1)


@query("manifest_commit", f"""WITH {_MERGED_SQL} {_MANIFEST_SQL}, CAST(2 AS BIGINT) AS generation FROM merged""")
def manifest_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first list without the small bundles, then the whole one: readers get the newer."""
    path = shared_dir(spark, "manifest")
    found = fx.bundles(spark, sf_dir)
    for bundles in (found.where("segment > 0"), found):
        rows = segment_manifest(bundles, next_generation(spark, path)).withColumn("path", F.lit("docs"))
        commit_manifest(rows, path)
    return latest_generation(read_manifest(spark, path)).drop("path", "deletes", "refused")


@query("shard_empty", f"""
    WITH n AS (SELECT {fx.shard_sql('o_orderstatus', 9)} AS shard, count(*) AS docs,
                 count(DISTINCT CAST({fx.hash_sql('CAST(o_orderkey AS VARCHAR)', 9)} % 4 AS INTEGER)) AS segments
               FROM orders GROUP BY ALL)
    SELECT CAST(r.i AS INTEGER) AS shard, coalesce(segments, 0) AS segments, coalesce(docs, 0) AS docs,
           docs IS NULL AS skipped FROM range(9) r(i) LEFT JOIN n ON n.shard = r.i""")
def shard_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = with_shard(fx.order_ids(spark, sf_dir), 9, F.col("o_orderstatus"))
    found = with_segment(sharded, 4).groupBy("shard", "segment").agg(F.count(F.lit(1)).alias("docs"))
    return shard_totals(found, 9)
