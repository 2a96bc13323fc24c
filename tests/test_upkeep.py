"""Deletions, merged postings, writers at the same time, counts in the manifest."""
from pyspark.sql import functions as F

from shardloom import BuildSpec, shared_dir
from shardloom.operators.postings import merged_postings
from shardloom.operators.segments import latest_generation
from shardloom.plans import build_index, cut_over, delete_documents, publish
from shardloom.sinks import claim_generation, read_manifest, read_published, refused_counts


def spec_of(spark, rows, **options):
    rows.createOrReplaceTempView("upkeep_rows")
    return BuildSpec(**{**dict(table="upkeep_rows", index_name="up_20240116", num_shards=2, partition_multiples=2,
                               work_dir=shared_dir(spark, "upkeep"), id_field="id", order_by=("v",)), **options})


def test_merged_postings_recut_blocks_that_start_anywhere(spark):
    segments = spark.createDataFrame([(0, 0, 1, 7), (0, 1, 0, 5), (1, 0, 0, 3)], "shard int, segment int, position long, docs long")
    lists = {(0, 0): {"a": range(7), "b": [6]}, (0, 1): {"a": [0, 4]}, (1, 0): {"a": [2]}}
    blocks = [(s, g, "f", t, o // 4, [x for x in ords if x // 4 == o // 4]) for (s, g), some in lists.items()
              for t, ords in some.items() for o in range(0, 8, 4) if any(x // 4 == o // 4 for x in ords)]
    got = merged_postings(spark.createDataFrame(blocks, "shard int, segment int, field string, term string, block long, ords array<long>"),
                          segments, 4).collect()
    whole = {(0, "a"): [0, 4, *range(5, 12)], (0, "b"): [11], (1, "a"): [2]}
    assert {(r.shard, r.term, r.block): (r.df, r.ords) for r in got} == {
        (s, t, b): (len(part), part) for (s, t), ords in whole.items() for b in range(3)
        if (part := [o for o in ords if o // 4 == b])}


def test_deletes(spark):
    rows = spark.range(200).selectExpr("cast(id as string) id", "id v")
    spec = spec_of(spark, rows, alias="upkeep_live")
    result = build_index(spark, spec, with_postings=False)
    ids = spark.createDataFrame([("5",), ("5",), ("70",), (None,), ("no such id",)], "doc_id string")
    assert delete_documents(spark, result.manifest_path, ids) == 2
    assert delete_documents(spark, result.manifest_path, ids.where("doc_id is null")) == 3  # nothing, but what was gone stays gone
    assert {r.doc_id for r in read_published(spark, result.manifest_path).collect()} == {str(i) for i in range(200)} - {"5", "70"}
    newest = latest_generation(read_manifest(spark, result.manifest_path))
    assert newest.agg(F.sum("docs"), F.sum("deleted")).first()[:] == (200, 2)
    assert publish(spark, spec, result).published
    assert spark.table("upkeep_live").columns == spark.read.parquet(result.docs_path).columns
    assert spark.table("upkeep_live").count() == 198
    none = spark.createDataFrame([], "idx string, alias string"), spark.createDataFrame([], "idx string, status string")
    for expected, published in ((200, False), (198, True)):
        assert cut_over(spark, spec.index_name, "upkeep_live", result.manifest_path, *none, expected_docs=expected, view=False).published == published
    spark.sql("drop view upkeep_live")


def test_two_builds_at_the_same_time_share_no_generation(spark, monkeypatch):
    """The second build starts and ends between the start and the commit of the first."""
    from shardloom.plans import build as plan
    spec, inner = spec_of(spark, spark.range(50).selectExpr("cast(id as string) id", "id v")), []
    write = plan.write_sharded

    def while_writing(docs, path):
        if not inner:
            inner.append(None)
            inner[0] = build_index(spark, spec, with_postings=False)
        write(docs, path)

    monkeypatch.setattr(plan, "write_sharded", while_writing)
    outer = build_index(spark, spec, with_postings=False)
    assert (outer.generation, inner[0].generation) == (1, 2) and outer.docs_path != inner[0].docs_path
    assert read_published(spark, outer.manifest_path).inputFiles()[0].split("generation=")[1][0] == "2"
    assert read_published(spark, outer.manifest_path).count() == 50
    assert [claim_generation(spark, outer.manifest_path) for _ in range(2)] == [3, 4]


def test_refused_rows_are_counted_and_keep_the_gate_shut(spark):
    rows = spark.range(60).selectExpr("cast(id % 50 as string) id", "id v")
    for keep in (True, False):
        spec = spec_of(spark, rows, alias="upkeep_gate", keep_rejects=keep)
        result = build_index(spark, spec, with_postings=False)
        assert [tuple(r) for r in refused_counts(read_manifest(spark, result.manifest_path)).collect()] == [(1, "repeated id", 10)]
        assert not publish(spark, spec, result, view=False, max_refused=9).published
        assert publish(spark, spec, result, view=False, max_refused=10).published
