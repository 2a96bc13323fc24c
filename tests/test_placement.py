"""Placement on skewed data, checked against brute force."""
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shardloom.operators.postings import doc_ordinals, postings
from shardloom.operators.sharding import (
    bulk_batches, colocate, dedupe_first, dedupe_rejects, partition_counts, rows_but_first, segment_plan,
    with_segment, with_shard,
)
from shardloom.sources.columns import row_hash


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one id, and a third of those are exact copies."""
    return spark.range(9000).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('k', id % 4000) end doc_id",
        "case when id % 9 = 0 then 7 else id % 501 end a", "case when id % 9 = 0 then 7 else id % 7 end b")


def brute_force(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["doc_id"]].append((r["a"], r["b"]))
    first = {k: min(v) for k, v in groups.items()}
    refused = Counter()
    for k, v in groups.items():
        for place in v:
            refused[(k, *place)] += 1
        refused[(k, *first[k])] -= 1
    return first, {k: n for k, n in refused.items() if n}


def test_first_and_rejects_with_a_hot_id(spark, skewed):
    first, refused = brute_force(skewed.collect())
    got = {r["doc_id"]: (r["a"], r["b"]) for r in dedupe_first(skewed, ["a", "b"]).collect()}
    assert got == first
    rejects = {tuple(r[c] for c in ("doc_id", "a", "b")): r["refused"]
               for r in dedupe_rejects(skewed, ["a", "b"]).collect()}
    assert rejects == refused
    assert len(got) + sum(rejects.values()) == skewed.count()


def test_rejects_with_null_order_values(spark):
    rows = spark.sql("select * from values ('a', null), ('a', 1), ('a', null), ('b', 2), (null, 1), (null, 1) t(doc_id, a)")
    assert [(r["doc_id"], r["a"]) for r in dedupe_first(rows, ["a"]).orderBy("doc_id").collect()] == [("a", None), ("b", 2)]
    assert sorted((r["a"] or 0, r["refused"]) for r in dedupe_rejects(rows, ["a"]).collect()) == [(0, 1), (1, 1)]


def test_rows_but_first_meet_in_no_join(skewed):
    first, refused = brute_force(skewed.collect())
    found = rows_but_first(skewed, dedupe_first(skewed, ["a", "b"]), ["doc_id", "a", "b"])
    assert {(r["doc_id"], r["a"], r["b"]): r["refused"] for r in found.collect()} == refused
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_row_hash_tells_nulls_apart(spark):
    rows = spark.sql("select * from values (null, 'x', 0D), ('x', null, 0D), ('x', null, -0D), ('x', null, null) t(a, b, c)")
    assert rows.select(row_hash(rows.schema).alias("h")).distinct().count() == 4


def test_a_segment_plan_is_broadcast_at_any_size(spark):
    docs = with_shard(spark.range(100).selectExpr("cast(id as string) doc_id"), 3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = with_segment(docs, segment_plan(docs, 10))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_segments_stay_near_the_target_in_a_hot_shard(spark):
    docs = spark.range(6000).selectExpr("cast(id as string) doc_id", "case when id % 3 = 0 then id else -1 end r")
    sharded = with_shard(docs, 5, F.col("r"))
    placed = with_segment(sharded, segment_plan(sharded, 500))
    sizes = partition_counts(placed).collect()
    assert sum(r["docs"] for r in sizes) == 6000
    assert max(r["docs"] for r in sizes) < 700
    assert max(Counter(r["shard"] for r in sizes).values()) >= 8


def test_every_document_is_in_one_shard(spark):
    docs = spark.range(3000).selectExpr("cast(id as string) doc_id")
    sharded = with_shard(docs, 7)
    assert sharded.count() == 3000 and sharded.where("shard < 0 or shard > 6 or shard is null").count() == 0
    again = with_shard(docs.repartition(5), 7)
    assert sharded.exceptAll(again).count() == 0


def test_colocate_with_uneven_segments(spark):
    docs = spark.range(2000).selectExpr("cast(id as string) doc_id", "cast(id % 3 as int) shard")
    counts = [1, 4, 2]
    placed = docs.withColumn("segment", F.expr("cast(cast(doc_id as int) % element_at(array(1, 4, 2), shard + 1) as int)"))
    together = colocate(placed, counts, 3)
    assert together.rdd.getNumPartitions() == 7
    tasks = together.withColumn("task", F.spark_partition_id()).groupBy("shard", "segment").agg(
        F.count_distinct("task").alias("n"), F.max("slot").alias("slot")).collect()
    assert {r["n"] for r in tasks} == {1} and sorted(r["slot"] for r in tasks) == list(range(7))
    with pytest.raises(ValueError):
        colocate(placed, [1, 2], 3)


def test_batches_keep_their_limits(spark):
    docs = spark.range(1000).selectExpr("cast(id as string) doc_id", "0 shard", "cast(id % 2 as int) segment",
                                        "repeat('x', cast(id % 50 as int)) body")
    found = bulk_batches(docs, 30, 400, body="body").collect()
    by_batch = defaultdict(list)
    for r in found:
        by_batch[(r["segment"], r["batch"])].append(r)
    assert sum(map(len, by_batch.values())) == 1000
    for rows in by_batch.values():
        assert len(rows) <= 30
        # a batch may pass the size mark by its last document only
        assert sum(len(r["body"]) for r in sorted(rows, key=lambda r: r["doc_id"])[:-1]) < 400


def test_hot_term_postings_are_bounded_and_complete(spark):
    docs = spark.range(5000).selectExpr("cast(id as string) doc_id", "0 shard", "cast(id % 2 as int) segment")
    numbered = doc_ordinals(docs)
    terms = numbered.selectExpr("shard", "segment", "ord", "'f' field", "explode(array('hot', 'hot', doc_id)) term")
    blocks = postings(terms, 100)
    assert blocks.agg(F.max(F.size("ords"))).first()[0] <= 100
    hot = blocks.where("term = 'hot'")
    assert hot.agg(F.sum("df")).first()[0] == 5000
    back = hot.select("shard", "segment", F.explode("ords").alias("ord"))
    assert back.join(numbered, ["shard", "segment", "ord"]).select("doc_id").distinct().count() == 5000


def test_scope_and_order_are_checked(spark, skewed):
    with pytest.raises(ValueError):
        dedupe_first(skewed, [])
    with pytest.raises(ValueError):
        dedupe_first(skewed, ["a"], scope="partition")
