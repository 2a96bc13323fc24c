"""Discovery, mapping rules and side tables on literal rows."""
import json

import pytest
from pyspark.errors import PySparkException

from shardloom.operators.discovery import discover_fields
from shardloom.operators.mapping import (
    explicit_fields, indexed_field_names, infer_mapping, mapping_json, mapping_summary,
    resolve_conflicts,
)
from shardloom.session import shared_dir
from shardloom.sources import (
    completed_bundles, deny_list, list_bundles, list_files, load_rules, read_delimited, scan,
    type_overrides,
)
from shardloom.spec import Rules
from shardloom.suite import fixtures as fx


def mapping(spark, sql, **options):
    rows = spark.sql(f"select {sql}")
    return json.loads(mapping_json(infer_mapping(discover_fields(rows), **options)).first()["json"])


def test_rules(spark):
    got = mapping(spark, "1 i, 1L l, cast(1 as decimal(5,2)) d, array(1) a, 'x' s, date'2024-01-01' day, "
                         "map('K$', 'v') x_map, map('H&', 1) y_ex, map('T', date'2024-01-01') tags")
    assert got == {
        "i": {"type": "integer"}, "l": {"type": "long"}, "d": {"type": "double"},
        "a": {"type": "string", "index": "not_analyzed"}, "s": {"type": "string", "index": "not_analyzed"},
        "day": {"type": "date", "format": "yyyyMMdd"}, "x_map-k-": {"type": "string", "index": "no"},
        "h-": {"type": "integer", "index": "no"}, "t": {"type": "date", "format": "yyyyMMdd"}}


def test_passed_through_names(spark):
    sql = "cast(1 as smallint) s, cast(1 as tinyint) t, timestamp'2024-01-01 00:00:00' ts, struct(1 as a) st, true b"
    assert {f: p["type"] for f, p in mapping(spark, sql).items()} == {
        "s": "smallint", "t": "tinyint", "ts": "timestamp", "st": "struct<a:int>", "b": "boolean"}
    strict = mapping(spark, sql, compat=False)
    assert {f: p["type"] for f, p in strict.items()} == {
        "s": "short", "t": "byte", "ts": "date", "st": "string", "b": "boolean"}
    assert "format" not in strict["ts"]


def test_empty_table_keeps_its_plain_fields(spark):
    rows = spark.sql("select 1 a, map('k', 'v') m").where("a > 1")
    assert [r["field"] for r in discover_fields(rows).collect()] == ["a"]


def test_plain_beats_map_in_a_conflict(spark):
    rows = spark.sql("select 'x' v, map('V', 1) m, map('w', 1L) n, map('w', 'a') o")
    got = {r["field"]: (r["src_type"], r["conflict"]) for r in resolve_conflicts(discover_fields(rows)).collect()}
    assert got == {"v": ("string", True), "w": ("bigint", True)}


def test_explicit_mapping_and_summary(spark):
    rows = spark.sql("select 1 a, 'x' b, map('k', 'v') c_map")
    explicit = explicit_fields(spark, '{"a": {"type": "short"}, "c_map-k": {"index": "not_analyzed"}}')
    result = infer_mapping(discover_fields(rows), explicit=explicit)
    assert indexed_field_names(result) == {"a", "b", "c_map-k"}
    assert tuple(mapping_summary(result).first()) == (3, 3)
    assert json.loads(mapping_json(result).first()["json"])["a"] == {"type": "short"}


def test_any_number_of_fields(spark):
    fields = spark.range(10_050).selectExpr("concat('k', id) field", "'string' src_type", "true is_plain", "'c' src_col")
    assert len(json.loads(mapping_json(infer_mapping(fields)).first()["json"])) == 10_050
    assert len(indexed_field_names(infer_mapping(fields))) == 10_050


def test_side_tables(spark):
    overrides = spark.sql("select * from values (' a ', ' long', '20240101'), ('a', 'long ', '20240101'), "
                          "('b', 'x', '20240102') t(index_name, data_type, dt)")
    assert [tuple(r) for r in type_overrides(overrides, "20240101").collect()] == [("a", "long")]
    clash = overrides.unionAll(spark.sql("select 'a', 'string', '20240101'"))
    with pytest.raises(PySparkException, match="two override types for field a"):
        type_overrides(clash, "20240101").collect()
    deny = spark.sql("select * from values ('n', 'test', '20240101'), ('n', 'test', '20240101'), "
                     "('m', 'other', '20240101') t(name, theme, dt)")
    names = deny_list(deny, "test", "20240101")
    assert [r["name"] for r in names.collect()] == ["n"]
    # a snapshot that is no number is just a text that matches nothing
    assert deny_list(deny, "test", "x").count() == 0
    fields = spark.sql("select 'other_field' field")
    assert load_rules(Rules(), names, fields=fields).deny == frozenset()
    assert load_rules(Rules(), names).deny == {"n"}


def test_scan_without_predicate_and_bad_listing(spark, small):
    path = f"{small}/orders.parquet"
    assert scan(spark, path).count() == scan(spark, path, "").count() == spark.read.parquet(path).count()
    missing = shared_dir(spark, "missing")
    assert list_bundles(spark, missing).count() == list_files(spark, missing).count() == 0


def test_listing_skips_unfinished_and_empty(spark):
    folder = shared_dir(spark, "listing")
    for name, text in (("p0_0.zip", "x"), ("p1_0.zip_tmp", "x"), ("p2_0.zip", "")):
        fx.put_file(spark, f"{folder}/0/{name}", text)
    names = [r["path"].rsplit("/", 1)[-1] for r in completed_bundles(list_bundles(spark, folder)).collect()]
    assert names == ["p0_0.zip"]
    assert list_files(spark, folder).count() == 3


def test_delimited_text_keeps_quotes_and_empties(spark):
    path = shared_dir(spark, "tsv")
    fx.put_file(spark, f"{path}/dt=20240101/a.tsv", 'a\t"q"x\t\nb\t\\N\tz')
    got = read_delimited(spark, path, "k string, v string, w string, dt string").orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", '"q"x', "", "20240101"), ("b", None, "z", "20240101")]
