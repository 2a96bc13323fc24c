"""Statistics that merge: exact where one segment has a field, close everywhere else."""
import pytest
from pyspark.sql import functions as F

from shardloom.operators.statistics import merged_statistics, segment_statistics
from shardloom.plans import build_index, merged_field_stats, store_statistics
from tests.test_build import lines_spec

BLOCKS = "shard int, segment int, field string, term string, block long, df int, ords array<long>"


def test_a_term_over_many_blocks_and_segments(spark):
    rows = [(0, 0, "f", "a", 0, 2, [0, 1]), (0, 0, "f", "a", 1, 3, [4, 5, 6]), (0, 0, "f", "b", 0, 1, [0]),
            (0, 1, "f", "a", 0, 4, [0, 1, 2, 3]), (1, 0, "g", "", 0, 1, [0])]
    parts = segment_statistics(spark.createDataFrame(rows, BLOCKS))
    assert {(r.shard, r.segment, r.field): (r.postings, r.max_df, r.terms) for r in parts.collect()} == {
        (0, 0, "f"): (6, 5, 2), (0, 1, "f"): (4, 4, 1), (1, 0, "g"): (1, 1, 1)}
    assert {r.field: r[1:] for r in merged_statistics(parts).collect()} == {"f": (2, 10, 5, 2), "g": (1, 1, 1, 1)}
    by_shard = merged_statistics(parts, ("shard", "field")).collect()
    assert {(r.shard, r.field): r.postings for r in by_shard} == {(0, "f"): 10, (1, "g"): 1}


def test_no_postings_no_rows(spark):
    assert merged_statistics(segment_statistics(spark.createDataFrame([], BLOCKS))).count() == 0


@pytest.mark.parametrize("shared", [0, 150_000, 300_000])
def test_distinct_terms_of_overlapping_segments(spark, shared):
    """Two segments of 300,000 terms each, ``shared`` of them in both."""
    ids = spark.range(300_000).select(F.explode(F.array(
        F.struct(F.lit(0).alias("segment"), "id"),
        F.struct(F.lit(1).alias("segment"), (F.col("id") + 300_000 - shared).alias("id")))).alias("r"))
    blocks = ids.selectExpr("0 shard", "r.segment", "'f' field", "concat('term ', r.id) term", "0L block", "1 df")
    row = merged_statistics(segment_statistics(blocks)).first()
    assert row.postings == 600_000 and abs(row.terms - (600_000 - shared)) <= 0.02 * (600_000 - shared)


def test_statistics_of_builds_are_read_without_postings(spark, small):
    spec = lines_spec(spark, small)
    paths = [store_statistics(spark, spec, build_index(spark, spec).postings_path) for _ in range(2)]
    merged = merged_field_stats(spark, paths)
    assert all("/statistics/" in f for f in merged.inputFiles())
    one = {r.field: r for r in merged_field_stats(spark, paths[:1]).collect()}
    two = {r.field: r for r in merged.collect()}
    assert one.keys() == two.keys() and all(two[f].postings == 2 * one[f].postings for f in one)
    assert all(two[f].terms == one[f].terms or abs(two[f].terms / one[f].terms - 1) < 0.02 for f in one)
