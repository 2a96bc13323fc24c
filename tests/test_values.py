"""Value rules on literal rows with their edge values."""
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shardloom import Rules
from shardloom.operators.documents import (
    build_documents, cast_failures, document_terms, generated_ids, with_doc_id,
)


def doc(spark, sql, **rules):
    rows = build_documents(spark.sql(f"select {sql}"), Rules(**rules)).collect()
    return json.loads(rows[0]["doc_json"])


def terms(spark, sql, **rules):
    found = document_terms(spark.sql(f"select {sql}"), Rules(**rules)).collect()
    out = {}
    for r in sorted(found, key=lambda r: r["pos"]):
        out.setdefault(r["field"], []).append(r["term"])
    return out


@pytest.mark.parametrize("value, want", [
    ("cast(null as string)", None), ("''", None), ("'NULL'", None), ("'null'", None),
    ("' '", " "), ("' null'", " null"), ("'[a, b]'", ["a", "b"]), ("'[]'", [""]), ("'['", "["),
    ("'[a'", "[a"), ("'[,]'", []), ("'[a,,b,]'", ["a", "", "b"]), ("'[[x] ]'", ["x"]),
    ("array(1, 2)", ["1", "2"]), ("array(array(1, 2), array(3))", ["1", "2", "3"]),
    ("array(array(1), null)", ["1", "null"]), ("cast(array() as array<string>)", [""]),
    ("array('a b', 'c,d', 'e)')", ["ab", "c", "d", "e"]), ("array(null, 'x')", ["null", "x"]),
    ("array(struct(1 as a, 'x' as b))", ["[1", "x]"]),
    ("struct(1 as a, 'x y' as b)", ["1", "xy"]), ("struct(1 as a, cast(null as string) as b)", ["1", "null"]),
    ("struct(1 as a, array('p', 'q') as b)", ["1", "WrappedArray(p", "q)"]),
    ("date'2024-02-03'", "20240203"), ("cast(1.50 as decimal(10,2))", 1.5), ("7", 7), ("true", True),
    ("cast(null as array<int>)", None), ("cast(null as struct<a:int>)", None), ("cast(null as date)", None),
    ("timestamp'2024-02-03 04:05:06.789'", "2024-02-03T04:05:06.789"), ("cast('ab' as binary)", "YWI="),
])
def test_plain_value(spark, value, want):
    got = doc(spark, f"'k' id, {value} v", id_field="id")
    assert got == ({"id": "k"} if want is None else {"id": "k", "v": want})


@pytest.mark.parametrize("value", [
    "'[a, b]'", "''", "'null'", "array('a b')", "date'2024-02-03'", "cast(2.5 as decimal(5,1))",
    "struct(1 as a)", "7", "' '"])
def test_map_values_follow_the_plain_rules(spark, value):
    plain = doc(spark, f"{value} v")
    assert doc(spark, f"map('V', {value}) tags") == plain


@pytest.mark.parametrize("value, target, want", [
    ("'12'", "long", 12), ("12", "long", 12), ("'12'", "integer", 12), ("2.9D", "integer", 2),
    ("-2.9D", "integer", -2), ("1e300D", "integer", 2**31 - 1), ("12L", "integer", 12),
    ("'1.5'", "double", 1.5), ("3", "double", 3.0), ("12", "string", "12"), ("true", "string", "true"),
    ("cast(1.50 as decimal(5,2))", "string", "1.50"), ("cast(1.50 as decimal(5,2))", "double", 1.5),
    ("'x'", "date", "x"), ("'[1, 2]'", "long", ["1", "2"]), ("array(1)", "long", ["1"]),
    ("date'2024-02-03'", "long", "20240203"), ("'null'", "string", None), ("'5'", "LONG", "5"),
])
def test_override(spark, value, target, want):
    expected = {} if want is None else {"v": want}
    assert doc(spark, f"{value} v", overrides={"v": target}) == expected
    assert doc(spark, f"map('v', {value}) tags", overrides={"v": target}) == expected


@pytest.mark.parametrize("value, target", [
    ("'abc'", "long"), ("'2.0'", "long"), ("2.0D", "long"), ("''", "long"), ("'x'", "integer"),
    ("3000000000L", "integer"), ("true", "integer"), ("'x'", "double")])
def test_bad_override_fails_or_is_reported(spark, value, target):
    for sql in (f"{value} v", f"map('v', {value}) tags"):
        with pytest.raises(PySparkException, match="field v: value does not fit"):
            doc(spark, sql, overrides={"v": target})
        rules = Rules(overrides={"v": target}, on_error="reject")
        rows = spark.sql(f"select {sql}")
        assert rows.select(cast_failures(rows, rules).alias("f")).first()["f"] == ["v"]
        assert doc(spark, sql, overrides={"v": target}, on_error="reject") == {}


def test_field_names_and_denylist(spark):
    sql = "1 A, map('Prio$', 'x', 'CUST&k', 'y') Attrs_map, map('Hint', 'z') extra_ex"
    assert doc(spark, sql) == {"A": 1, "attrs_map-prio-": "x", "attrs_map-cust-k": "y", "hint": "z"}
    assert doc(spark, sql, deny=frozenset({"A", "attrs_map-prio-", "Hint"})) == {
        "attrs_map-cust-k": "y", "hint": "z"}


def test_later_field_wins_unless_empty(spark):
    assert doc(spark, "'a' v, map('V', 'b') t") == {"v": "b"}
    assert doc(spark, "'a' v, map('V', 'null') t") == {"v": "a"}
    assert doc(spark, "map('V', 'b') t, 'a' v") == {"v": "a"}
    assert doc(spark, "map('a&', '1', 'a$', '2') t") == {"a-": "2"}
    assert doc(spark, "'a' v, cast(null as map<string,string>) t") == {"v": "a"}


def test_id_follows_the_document(spark):
    def of(sql, **rules):
        return with_doc_id(spark.sql(f"select {sql}"), Rules(id_field="id", **rules)).first()["doc_id"]

    assert of("5 id") == "5"
    assert of("'a' id, map('ID', 'b') t") == "b"
    assert of("'a' id, map('ID', 'null') t") == "a"
    assert of("'null' id") is None
    assert of("'a' id", deny=frozenset({"id"})) is None
    assert of("'a' other") is None
    assert of("array('x', 'y') id") == "x,y"


def test_generated_ids_are_stable_and_unique(spark):
    rows = spark.range(1000).selectExpr("cast(null as string) id", "id % 3 v")
    docs = build_documents(rows, Rules(id_field="id"))
    first = sorted(r[0] for r in generated_ids(docs, block=7).select("doc_id").collect())
    assert len(set(first)) == 1000
    again = generated_ids(docs.repartition(5), block=64)
    assert sorted(r[0] for r in again.select("doc_id").collect()) == first


def test_typed_arrays_keep_elements(spark):
    assert doc(spark, "array('a b', null, 'c,d') v", arrays="typed") == {"v": ["a b", "c,d"]}


def test_long_form_positions(spark):
    assert terms(spark, "'k' id, array('a', 'b') v, map('x', '[1, 2]') m", id_field="id") == {
        "id": ["k"], "v": ["a", "b"], "x": ["1", "2"]}


def test_denied_columns_are_not_read(spark, small):
    rows = spark.read.parquet(f"{small}/orders.parquet")
    docs = build_documents(rows, Rules(id_field="o_orderkey", deny=frozenset({"o_custkey", "o_totalprice"})))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema:")[1]
    assert "o_orderkey" in schema and "o_custkey" not in schema and "o_totalprice" not in schema
    only_id = with_doc_id(rows, Rules(id_field="o_orderkey")).select("doc_id")
    assert "ReadSchema: struct<o_orderkey:bigint>" in only_id._jdf.queryExecution().executedPlan().toString()
    assert only_id.where(F.col("doc_id").isNull()).count() == 0
