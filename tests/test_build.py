"""Whole builds and cut-over, with the invariants a build has to keep."""
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shardloom import BuildSpec, shared_dir
from shardloom.plans import build_index, cut_over, publish
from shardloom.plans.cutover import shard_reports
from shardloom.operators.lifecycle import latest_state
from shardloom.sinks import read_ledger, read_manifest, read_published, read_versions
from shardloom.sources import read_delimited, read_mapping
from shardloom.suite import fixtures as fx

ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def smoke_source(spark):
    """Three tab-separated rows in a dated folder."""
    path = shared_dir(spark, "smoke")
    fx.put_file(spark, f"{path}/dt=20991231/rows.tsv", "\n".join(
        f"pk_00{n}\tvalue01_00{n}\tvalue02_00{n}" for n in (1, 2, 3)))
    read_delimited(spark, path, "pri_key string, value01 string, value02 string, dt string") \
        .createOrReplaceTempView("smoke_rows")
    deny = spark.sql("select 'no_such_field' name, 'test' theme, '20991231' dt")
    overrides = spark.sql("select * from values ('pri_key', 'string', '20991231'), ('value01', 'string', "
                          "'20991231'), ('value02', 'string', '20991231') t(index_name, data_type, dt)")
    return deny, overrides


def lines_spec(spark, small, **options):
    base = dict(table=f"{small}/lineitem.parquet", index_name="lines_20240116", num_shards=3,
                id_field="l_orderkey", order_by=ORDER, segment_docs=400, postings_block=64,
                work_dir=shared_dir(spark, "work"))
    return BuildSpec(**{**base, **options})


def test_smoke_case(spark):
    deny, overrides = smoke_source(spark)
    spec = BuildSpec(table="smoke_rows", index_name="smoke_20991231", num_shards=9, id_field="pri_key",
                     where="dt = '20991231'", input_columns=("pri_key", "value01", "value02"),
                     order_by=("value01",), work_dir=shared_dir(spark, "work"))
    result = build_index(spark, spec, deny, overrides)
    docs = {r["doc_id"]: json.loads(r["doc_json"]) for r in read_published(spark, result.manifest_path).collect()}
    assert docs == {f"pk_00{n}": {"pri_key": f"pk_00{n}", "value01": f"value01_00{n}", "value02": f"value02_00{n}"}
                    for n in (1, 2, 3)}
    mapping = json.loads(read_mapping(spark, result.mapping_path).first()["json"])
    assert mapping == {f: {"type": "string", "index": "not_analyzed"} for f in ("pri_key", "value01", "value02")}
    assert [r["state"] for r in latest_state(read_ledger(spark, spec.ledger_path)).collect()] == ["completed"]


def test_build_invariants(spark, small):
    spec = lines_spec(spark, small)
    result = build_index(spark, spec)
    source = spark.read.parquet(spec.table)
    docs = read_published(spark, result.manifest_path)
    rejects = spark.read.parquet(result.rejects_path)
    refused = rejects.agg(F.sum("refused")).first()[0]
    assert docs.count() + refused == source.count()
    assert docs.count() == docs.select("doc_id").distinct().count() == source.select("l_orderkey").distinct().count()
    manifest = read_manifest(spark, result.manifest_path)
    assert manifest.agg(F.sum("docs")).first()[0] == docs.count()
    assert len(result.segments) == 3 and sum(result.segments) > 3
    files = docs.select("shard", "segment", F.col("_metadata.file_path").alias("f")).distinct()
    assert files.count() == files.select("shard", "segment").distinct().count()
    # postings round-trip: ordinals lead back to the documents that have the term
    postings = spark.read.parquet(result.postings_path)
    assert postings.agg(F.max(F.size("ords"))).first()[0] <= 64
    from pyspark.sql import Window
    numbered = docs.withColumn("ord", F.row_number().over(
        Window.partitionBy("shard", "segment").orderBy("doc_id")) - 1)
    flags = postings.where("field = 'l_returnflag'").select("shard", "segment", "term", F.explode("ords").alias("ord"))
    joined = numbered.join(flags, ["shard", "segment", "ord"])
    assert joined.count() == docs.count()
    assert joined.where(F.get_json_object("doc_json", "$.l_returnflag") != F.col("term")).count() == 0


def test_second_run_gives_the_same_bytes_under_a_new_generation(spark, small):
    spec = lines_spec(spark, small)
    first = build_index(spark, spec, with_postings=False)
    second = build_index(spark, spec, with_postings=False)
    assert (first.generation, second.generation) == (1, 2)
    a, b = (spark.read.parquet(r.docs_path) for r in (first, second))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    cleaned = build_index(spark, BuildSpec(**{**spec.__dict__, "clean_first": True}), with_postings=False)
    assert cleaned.generation == 1 and read_manifest(spark, cleaned.manifest_path).select("path").distinct().count() == 1
    second = build_index(spark, spec, with_postings=False)
    assert read_published(spark, second.manifest_path).inputFiles()[0].split("generation=")[1][0] == "2"


def test_segment_scope_keeps_duplicates_of_other_segments(spark, small):
    spec = lines_spec(spark, small, dedupe="segment", routing="l_partkey")
    result = build_index(spark, spec)
    docs = read_published(spark, result.manifest_path)
    source = spark.read.parquet(spec.table).select("l_orderkey").distinct().count()
    assert docs.count() > source
    assert docs.count() == docs.select("shard", "segment", "doc_id").distinct().count()


def test_rows_without_id_get_one(spark, small):
    rows = spark.read.parquet(f"{small}/orders.parquet").selectExpr(
        "case when o_orderkey % 3 <> 0 then o_orderkey end id", "o_orderstatus status", "o_orderpriority prio")
    rows.createOrReplaceTempView("some_ids")
    for routing in (None, "prio"):
        spec = BuildSpec(table="some_ids", index_name="ids_20240116", id_field="id", order_by=("prio",),
                         segment_docs=200, routing=routing, work_dir=shared_dir(spark, "work"))
        result = build_index(spark, spec)
        docs = read_published(spark, result.manifest_path)
        assert docs.count() == docs.select("doc_id").distinct().count() == rows.count()
        assert docs.where("doc_id like '%-%'").count() == rows.where("id is null").count()
        postings = spark.read.parquet(result.postings_path).where("field = 'prio'")
        assert postings.agg(F.sum("df")).first()[0] == rows.count()


def test_table_without_id_field(spark, small):
    spec = BuildSpec(table=f"{small}/orders.parquet", index_name="anon_20240116", segment_docs=200,
                     input_columns=("o_orderstatus", "o_orderpriority"), work_dir=shared_dir(spark, "work"))
    result = build_index(spark, spec)
    docs = read_published(spark, result.manifest_path)
    assert docs.count() == docs.select("doc_id").distinct().count() == spark.read.parquet(spec.table).count()
    assert docs.select("doc_json").distinct().count() == 15


def test_rejected_casts_are_kept_apart(spark, small):
    rows = spark.read.parquet(f"{small}/orders.parquet").selectExpr(
        "cast(o_orderkey as string) id", "case when o_orderkey % 5 = 0 then 'bad' else '7' end num")
    rows.createOrReplaceTempView("bad_numbers")
    overrides = spark.sql("select 'num' index_name, 'long' data_type, '20240116' dt")
    spec = BuildSpec(table="bad_numbers", index_name="bad_20240116", id_field="id", order_by=("num",),
                     on_error="reject", work_dir=shared_dir(spark, "work"))
    result = build_index(spark, spec, overrides=overrides)
    bad = rows.where("num = 'bad'").count()
    assert spark.read.parquet(result.rejects_path).where("reason = 'cast'").count() == bad
    assert read_published(spark, result.manifest_path).count() == rows.count() - bad
    failing = BuildSpec(**{**spec.__dict__, "on_error": "fail", "work_dir": shared_dir(spark, "work")})
    with pytest.raises(PySparkException, match="field num"):
        build_index(spark, failing, overrides=overrides)
    assert read_manifest(spark, f"{failing.index_path}/manifest").count() == 0
    assert latest_state(read_ledger(spark, failing.ledger_path)).first()["state"] == "started"


def test_side_tables_and_json_source(spark, small):
    rows = spark.read.parquet(f"{small}/events.parquet").selectExpr("event_id", "event_type", "value", "props")
    rows.createOrReplaceTempView("json_rows")
    deny = spark.sql("select * from values ('event_type', 'test', '20240116'), ('value', 'other', '20240116'), "
                     "('k', 'test', '20240101') t(name, theme, dt)")
    overrides = spark.sql("select ' k ' index_name, ' integer' data_type, '20240116' dt")
    spec = BuildSpec(table="json_rows", index_name="json_20240116", id_field="event_id", json_source="props",
                     order_by=("event_id",), work_dir=shared_dir(spark, "work"))
    result = build_index(spark, spec, deny, overrides)
    mapping = json.loads(read_mapping(spark, result.mapping_path).first()["json"])
    # a denied field stays in the mapping and leaves the documents
    assert mapping == {"event_id": {"type": "long"}, "event_type": {"type": "string", "index": "not_analyzed"},
                       "k": {"type": "integer"}, "value": {"type": "double"}}
    docs = read_published(spark, result.manifest_path)
    fields = docs.select(F.explode(F.json_object_keys("doc_json"))).distinct()
    assert sorted(r[0] for r in fields.collect()) == ["event_id", "k", "value"]
    assert docs.where(F.get_json_object("doc_json", "$.k").cast("int").isNull()).count() == 0


def test_cut_over(spark, small):
    results = {}
    work = shared_dir(spark, "work")
    for day in ("20240114", "20240115", "20240116"):
        spec = lines_spec(spark, small, index_name=f"lines_{day}", work_dir=work)
        results[spec.index_name] = build_index(spark, spec, with_postings=False)
    versions = spark.sql("select * from values ('lines_20240114', 'closed'), ('lines_20240115', 'open'), "
                         "('lines_20240116', 'open'), ('other_20240114', 'open') t(idx, status)")
    aliases = spark.sql("select * from values ('lines_20240115', 'lines'), ('other_20240114', 'other') t(idx, alias)")
    new = results["lines_20240116"]
    done = cut_over(spark, "lines_20240116", "lines_live", new.manifest_path,
                    aliases.replace("lines", "lines_live", "alias"), versions, settings={"refresh": "1's"},
                    work_dir=work)
    assert done.published
    assert read_manifest(spark, results["lines_20240114"].manifest_path).count() == 0
    assert read_published(spark, results["lines_20240115"].manifest_path).count() > 0
    assert sorted(tuple(r) for r in done.aliases.collect()) == [
        ("lines_20240116", "lines_live"), ("other_20240114", "other")]
    assert {tuple(r) for r in done.versions.collect()} == {
        ("lines_20240115", "closed"), ("lines_20240116", "open"), ("other_20240114", "open")}
    assert [r["idx"] for r in done.closed.collect()] == ["lines_20240115"]
    assert [r["idx"] for r in done.expired.collect()] == ["lines_20240114"]
    assert spark.table("lines_live").count() == read_published(spark, new.manifest_path).count()
    properties = {r["key"]: r["value"] for r in spark.sql("show tblproperties lines_live").collect()}
    assert properties["refresh"] == "1's"


def test_gate_blocks_a_damaged_version(spark, small):
    spec = lines_spec(spark, small)
    result = build_index(spark, spec, with_postings=False)
    versions = spark.sql("select 'lines_20240115' idx, 'open' status")
    aliases = spark.sql("select 'lines_20240115' idx, 'lines' alias")
    wrong = cut_over(spark, spec.index_name, "lines", result.manifest_path, aliases, versions,
                     expected_docs=1, view=False)
    # damage: documents of one segment written a second time
    docs = spark.read.parquet(result.docs_path).where("shard = 0 and segment = 0")
    docs.drop("shard", "segment").write.mode("append").parquet(f"{result.docs_path}/shard=0/segment=0")
    broken = cut_over(spark, spec.index_name, "lines", result.manifest_path, aliases, versions, view=False)
    missing = cut_over(spark, "lines_20240117", "lines", f"{spec.index_path}/nowhere", aliases, versions, view=False)
    for outcome in (wrong, broken, missing):
        assert not outcome.published
        assert [tuple(r) for r in outcome.aliases.collect()] == [("lines_20240115", "lines")]
        assert [tuple(r) for r in outcome.versions.collect()] == [("lines_20240115", "open")]


def test_spec_checks():
    with pytest.raises(ValueError):
        BuildSpec(table="t", index_name="a_20240101", work_dir="w", id_field="id")
    with pytest.raises(ValueError):
        BuildSpec(table="t", index_name="a_20240101", work_dir="w", num_shards=0)
    with pytest.raises(ValueError):
        BuildSpec(table="t", index_name="a_20240101", work_dir="w", dedupe="some")


def test_work_dir_is_required():
    with pytest.raises(ValueError, match="work_dir"):
        BuildSpec(table="t", index_name="a_20240101", id_field="id", order_by=("x",))


def test_nothing_to_build(spark, small):
    """An empty selection is published as a generation of no documents."""
    spec = lines_spec(spark, small, where="l_orderkey < 0")
    result = build_index(spark, spec)
    manifest = read_manifest(spark, result.manifest_path).collect()
    assert [(r["docs"], r["generation"]) for r in manifest] == [(0, 1)]
    assert read_published(spark, result.manifest_path).count() == 0
    reports = shard_reports(spark, spec.index_name, result.manifest_path).collect()
    assert [r["err"] for r in reports] == [None]


def test_failed_build_keeps_the_mapping(spark, small):
    spec = lines_spec(spark, small)
    first = build_index(spark, spec, with_postings=False)
    before = read_mapping(spark, first.mapping_path).collect()
    overrides = spark.sql("select 'l_returnflag' index_name, 'long' data_type, '20240116' dt")
    with pytest.raises(PySparkException):
        build_index(spark, spec, overrides=overrides, with_postings=False)
    assert read_mapping(spark, first.mapping_path).collect() == before
    assert {r["generation"] for r in read_manifest(spark, first.manifest_path).collect()} == {1}


@pytest.mark.parametrize("name", ["shard", "Segment", "slot", "doc_id", "_rank", "a.b", "_malformed"])
def test_any_column_name(spark, small, name):
    """A column called like one of placement's own, or with a dot, is a field like others."""
    spark.read.parquet(f"{small}/lineitem.parquet").withColumn(name, F.col("l_linenumber") * 100) \
        .createOrReplaceTempView("clash")
    result = build_index(spark, lines_spec(spark, small, table="clash", order_by=(name, *ORDER)))
    docs = [json.loads(r["doc_json"]) for r in read_published(spark, result.manifest_path).collect()]
    assert docs and all(d[name] == 100 * d["l_linenumber"] for d in docs)
    postings = spark.read.parquet(result.postings_path).where(F.col("field") == name)
    assert postings.agg(F.sum("df")).first()[0] == len(docs)
    assert name in json.loads(read_mapping(spark, result.mapping_path).first()["json"])


def test_malformed_json_is_refused_with_its_text(spark, small):
    rows = spark.read.parquet(f"{small}/events.parquet").selectExpr(
        "event_id", "case event_id % 5 when 0 then substr(props, 1, length(props) - 1) when 1 then '' "
                    "when 2 then '[1, 2]' else props end as `pro.ps`")
    rows.createOrReplaceTempView("broken_json")
    spec = BuildSpec(table="broken_json", index_name="broken_20240116", id_field="event_id", json_source="pro.ps",
                     order_by=("event_id",), work_dir=shared_dir(spark, "work"))
    result = build_index(spark, spec)
    refused = spark.read.parquet(result.rejects_path).collect()
    bad = {str(r["event_id"]): r["pro.ps"] for r in rows.where("event_id % 5 in (0, 2)").collect()}
    assert {r["doc_id"]: json.loads(r["row"])["pro.ps"] for r in refused} == bad
    assert {r["reason"] for r in refused} == {"malformed json"}
    docs = read_published(spark, result.manifest_path)
    assert docs.count() + len(refused) == rows.count()
    assert docs.where("doc_json like '%\"k\"%'").count() == rows.where("event_id % 5 in (3, 4)").count()


def test_rejects_keep_the_row_and_ties_are_settled(spark, small):
    spec = lines_spec(spark, small, order_by=("l_returnflag",))
    results = [build_index(spark, spec, with_postings=False) for _ in range(2)]
    a, b = (read_published(spark, r.manifest_path) for r in results)
    assert a.exceptAll(b).isEmpty()
    stored = {r["doc_json"] for r in a.collect()}
    rows = [json.loads(r["row"]) for r in spark.read.parquet(results[0].rejects_path).collect()]
    assert rows and all(set(r) >= {"l_orderkey", "l_partkey", "l_quantity"} for r in rows)
    source = spark.read.parquet(spec.table).count()
    assert len(stored) + spark.read.parquet(results[0].rejects_path).agg(F.sum("refused")).first()[0] == source


def test_more_fields_than_ten_thousand(spark):
    spark.range(10_500).selectExpr("cast(id as string) id", "map(concat('k', id), 'v') as many") \
        .createOrReplaceTempView("many_fields")
    spec = BuildSpec(table="many_fields", index_name="many_20240116", id_field="id", order_by=("id",),
                     work_dir=shared_dir(spark, "work"))
    result = build_index(spark, spec)
    assert len(json.loads(read_mapping(spark, result.mapping_path).first()["json"])) == 10_501
    assert spark.read.parquet(result.postings_path).select("field").distinct().count() == 10_501


def test_bulk_bodies_of_a_build(spark, small):
    result = build_index(spark, lines_spec(spark, small, bulk=True, bulk_actions=7, bulk_bytes=900), with_postings=False)
    bodies = spark.read.parquet(result.bulk_path).collect()
    assert all(r["actions"] <= 7 for r in bodies)
    lines = [line for r in bodies for line in r["body"].splitlines()]
    ids = [json.loads(line)["create"]["_id"] for line in lines[::2]]
    docs = {r["doc_id"]: r["doc_json"] for r in read_published(spark, result.manifest_path).collect()}
    assert dict(zip(ids, lines[1::2])) == docs and len(ids) == len(docs)
    assert all(len(r["body"]) - len(r["body"].splitlines()[-1]) - len(r["body"].splitlines()[-2]) - 3 <= 900 for r in bodies)


def test_publish_stores_aliases_and_versions(spark, small):
    work = shared_dir(spark, "work")
    for day in ("20240114", "20240115", "20240116"):
        spec = lines_spec(spark, small, index_name=f"lines_{day}", work_dir=work, alias="lines_now",
                          final_settings={"refresh": "1s"})
        result = build_index(spark, spec, with_postings=False)
        assert publish(spark, spec, result).published
    aliases, versions = read_versions(spark, f"{work}/_versions")
    assert [tuple(r) for r in aliases.collect()] == [("lines_20240116", "lines_now")]
    assert {tuple(r) for r in versions.collect()} == {("lines_20240115", "closed"), ("lines_20240116", "open")}
    assert spark.table("lines_now").count() == read_published(spark, result.manifest_path).count()
    assert read_manifest(spark, f"{work}/lines_20240114/manifest").count() == 0


def test_manifest_is_one_file(spark, small):
    result = build_index(spark, lines_spec(spark, small), with_postings=False)
    assert len(read_manifest(spark, result.manifest_path).inputFiles()) == 1
