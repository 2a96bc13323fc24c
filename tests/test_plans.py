"""Physical plans: what must and must not be in them."""
import pytest
from pyspark.sql import functions as F

from shardloom.operators.documents import document_term_sets, render_documents, with_doc_id
from shardloom.operators.postings import doc_ordinals, term_stats
from shardloom.operators.sharding import (
    bulk_batches, colocate, dedupe_first, dedupe_rejects, with_segment, with_shard,
)
from shardloom.sinks import write_sharded
from shardloom.session import shared_dir
from shardloom.sources import scan
from shardloom.spec import Rules
from shardloom.suite import QUERIES, fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, small):
    text = plan(scan(spark, f"{small}/orders.parquet", "o_orderstatus = 'F'", ["o_orderkey"]))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_first_of_an_id_is_cut_before_the_shuffle(spark, small):
    text = plan(dedupe_first(fx.src_lines(spark, small), fx.LINE_ORDER))
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_one_shuffle_from_rows_to_numbered_documents(spark, small):
    rows = fx.src_orders(spark, small)
    rules = Rules(id_field="pri_key")
    placed = colocate(with_segment(with_shard(with_doc_id(rows, rules), 3), 4), 4, 3)
    numbered = doc_ordinals(placed)
    docs = render_documents(numbered, rows.schema, rules, ["shard", "segment", "ord"]).select("doc_id", "doc_json", "ord")
    text = plan(docs)
    assert text.count("Exchange") == 1 and "shufflepartitionidpassthrough" in text


def test_shard_is_pruned_on_read(spark, small):
    path = shared_dir(spark, "pruned")
    placed = with_segment(with_shard(fx.order_ids(spark, small), 3), 4)
    write_sharded(colocate(placed, 4, 3), path, ("doc_id",))
    text = plan(spark.read.parquet(path).where("shard = 1"))
    assert "PartitionFilters: [isnotnull(shard" in text


WRITING = ("stream", "sink", "bundle_l", "scan_tsv", "index_")


# streams, sinks and builds run while the query is made; their plans are of the read-back
@pytest.mark.parametrize("name", sorted(n for n in QUERIES
                                        if not n.startswith(WRITING)))
def test_no_query_leaves_the_jvm_or_joins_without_a_key(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                 "MapInPandas", "FlatMapGroups", "Exchange SinglePartition, REPARTITION"):
        assert word not in text


def test_windows_are_partitioned(spark, small):
    for name, run in QUERIES.items():
        if name.startswith(WRITING):
            continue
        for part in plan(run(spark, small)).split("windowspecdefinition(")[1:]:
            assert "specifiedwindowframe" in part.split("ASC")[0] or "ASC" in part
            assert not part.startswith("specifiedwindowframe"), name


def test_a_hot_id_is_split_where_rejects_are_found(spark):
    rows = spark.range(200_000).selectExpr(
        "case when id % 2 = 0 then 'hot' else cast(id % 40000 as string) end doc_id", "id a", "repeat('x', 40) b")
    path = shared_dir(spark, "hot")
    rows.repartition(16).write.parquet(path)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = dedupe_rejects(spark.read.parquet(path), ["a"])
        assert found.count() == 200_000 - 1 - spark.read.parquet(path).where("doc_id <> 'hot'").select("doc_id").distinct().count()
        rows = found.collect()
        text = plan(found)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert rows and "skew=true" in text


def test_bulk_batches_and_term_counts_move_documents_once(spark, small):
    rows = fx.src_orders(spark, small)
    rules = Rules(id_field="pri_key")
    placed = colocate(with_segment(with_shard(with_doc_id(rows, rules), 3), 4), 4, 3)
    docs = render_documents(placed, rows.schema, rules, ["shard", "segment", "slot"])
    assert plan(bulk_batches(docs, 10, 1000)).count("Exchange") == 1
    assert plan(term_stats(document_term_sets(rows, rules))).count("Exchange") == 1
