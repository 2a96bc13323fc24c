"""Queries: document build and its value rules, compared in long form."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shardloom.operators.discovery import discover_fields
from shardloom.operators.documents import (
    build_documents, cast_failures, document_terms, generated_ids, render_fields, with_doc_id,
)
from shardloom.sources import deny_list, load_rules, type_overrides
from shardloom.spec import Rules
from shardloom.suite import fixtures as fx
from shardloom.suite.registry import query

_LONG = ("doc_id", "field", "pos", "term")


def _plain_term(term: Column, field: Column) -> Column:
    """Double text to fixed-point text, so engines need not agree on how doubles print."""
    fixed = F.col("term").cast("double").cast("decimal(15,2)").cast("string")
    return F.when(field == "price", fixed).otherwise(term)


def split_sql(text: str) -> str:
    """Comma split that drops trailing empties, in SQL."""
    return (f"CASE WHEN regexp_full_match({text}, ',+') THEN CAST([] AS VARCHAR[]) "
            f"ELSE string_split(rtrim({text}, ','), ',') END")


def long_sql(rows: str) -> str:
    """(doc_id, field, pos, term) of rows (doc_id, field, terms list)."""
    return (f"SELECT doc_id, field, CAST(generate_subscripts(terms, 1) - 1 AS INTEGER) AS pos, "
            f"unnest(terms) AS term FROM ({rows}) t")


@query("doc_build", f"""WITH {fx.ORDERS_LONG_SQL}
    SELECT doc_id, field, CAST(0 AS INTEGER) AS pos, term FROM long
    WHERE field NOT IN ('status', 'attrs_map-prio-')""")
def doc_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = document_terms(fx.src_orders(spark, sf_dir), fx.ORDERS_RULES)
    return terms.select("doc_id", "field", "pos", _plain_term(F.col("term"), F.col("field")).alias("term"))


@query("doc_json", """
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id,
           concat('{"custkey":', o_custkey, ',"odate":"', strftime(o_orderdate, '%Y%m%d'),
                  '","pri_key":"', o_orderkey, '","prio":"', o_orderpriority, '"}') AS doc_json
    FROM orders""")
def doc_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.src_orders(spark, sf_dir).select("pri_key", "prio", "odate", "custkey")
    return build_documents(rows, Rules(id_field="pri_key")).select("doc_id", "doc_json")


@query("doc_map_flatten", f"""WITH {fx.ORDERS_LONG_SQL}
    SELECT doc_id, field, term FROM long
    WHERE field = 'hint' OR field = 'flag' OR field LIKE '%\\_map-%' ESCAPE '\\'""")
def doc_map_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.src_orders(spark, sf_dir).select("pri_key", "attrs_map", "extra_ex", "tags", "dyn_map")
    return document_terms(rows, Rules(id_field="pri_key")).where("field <> 'pri_key'") \
        .select("doc_id", "field", "term")


@query("doc_field_name", """
    SELECT replace(replace(lower(concat('Brand&Size_map-', p_brand, '$', p_type)), '&', '-'), '$', '-') AS field,
           count(*) AS docs FROM part GROUP BY 1
    UNION ALL SELECT replace(replace(lower(concat(p_brand, '&', p_size)), '&', '-'), '$', '-'), count(*)
    FROM part GROUP BY 1""")
def doc_field_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "part").selectExpr(
        "map(concat(p_brand, '$', p_type), p_name) `Brand&Size_map`",
        "map(concat(p_brand, '&', p_size), p_name) Sizes")
    return document_terms(rows, Rules()).groupBy("field").agg(F.count(F.lit(1)).alias("docs"))


@query("doc_denylist", f"""WITH {fx.ORDERS_LONG_SQL}, {fx.DENY_SQL}
    SELECT field, count(*) AS docs FROM long
    WHERE field NOT IN (SELECT name FROM deny) AND field <> 'status' GROUP BY field""")
def doc_denylist(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.src_orders(spark, sf_dir)
    rules = load_rules(Rules(id_field="pri_key", deny=frozenset({"status"})),
                       deny=deny_list(fx.deny_table(spark, sf_dir), "test", fx.SNAPSHOT),
                       fields=discover_fields(rows))
    return document_terms(rows, rules).groupBy("field").agg(F.count(F.lit(1)).alias("docs"))


_EMPTY = ("case {k} % 6 when 0 then 'null' when 1 then '' when 2 then ' ' when 3 then 'NULL'"
          " when 4 then cast(null as {text}) else o_orderpriority end")


@query("doc_drop_empty", f"""
    WITH v AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, {_EMPTY.format(k='o_orderkey', text='varchar')} AS note FROM orders),
    f AS (SELECT doc_id, 'note' AS field, note AS term FROM v UNION ALL SELECT doc_id, 'tag', note FROM v)
    SELECT * FROM f WHERE term IS NOT NULL AND term <> '' AND lower(term) <> 'null'""")
def doc_drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) id", f"{_EMPTY.format(k='o_orderkey', text='string')} note") \
        .selectExpr("id", "note", "map('tag', note) tags")
    return document_terms(rows, Rules(id_field="id")).where("field <> 'id'") \
        .select("doc_id", "field", "term")


@query("doc_array", f"""
    WITH v AS (SELECT CAST(vec_id AS VARCHAR) AS doc_id, label FROM embeddings),
    t AS (SELECT doc_id, 'pair' AS field, concat(label, ',', label * 2) AS t FROM v
          UNION ALL SELECT doc_id, 'nested', concat(label, ',', label + 1, ',null') FROM v
          UNION ALL SELECT doc_id, 'empty', '' FROM v WHERE label % 2 = 0
          UNION ALL SELECT doc_id, 'hole', concat('null,', label) FROM v
          UNION ALL SELECT doc_id, 'text', concat('a', label, ',b(c,,x') FROM v
          UNION ALL SELECT doc_id, 'tail', concat(label, ',,') FROM v
          UNION ALL SELECT doc_id, 'commas', ',,' FROM v
          UNION ALL SELECT doc_id, 'list', concat('k', label, ',', label) FROM v)
    {long_sql(f"SELECT doc_id, field, {split_sql('t')} AS terms FROM t")}""")
def doc_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "embeddings").selectExpr(
        "cast(vec_id as string) id", "array(label, label * 2) pair",
        "array(array(label, label + 1), cast(null as array<int>)) nested",
        "case when label % 2 = 0 then cast(array() as array<int>) end empty",
        "array(null, cast(label as string)) hole",
        "array(concat('a ', label), 'b(c', ',x)') text",
        "array(cast(label as string), '', '') tail", "array(',', '') commas",
        "map('list', array(concat('k ', label), cast(label as string))) lists")
    return document_terms(rows, Rules(id_field="id")).where("field <> 'id'").select(*_LONG)


_LINES_TEXT = "replace(replace(replace(text, 'WrappedArray(', ''), ')', ''), ' ', '')"


@query("doc_array_lines", f"""
    WITH v AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id,
                 {split_sql(f"replace({_LINES_TEXT}, chr(10), ',')")} AS terms FROM documents)
    SELECT doc_id, CAST(len(terms) AS INTEGER) AS terms, md5(array_to_string(terms, '|')) AS digest FROM v""")
def doc_array_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of whole texts as an array column."""
    rows = fx.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.split("text", "\n").alias("lines"))
    rules = Rules(id_field="id")
    fields = render_fields(with_doc_id(rows, rules), rows.schema, rules, only={"lines"})
    return fields.select("doc_id", F.size("terms").alias("terms"),
                         F.md5(F.array_join("terms", "|")).alias("digest"))


@query("doc_array_typed", """
    WITH v AS (SELECT CAST(vec_id AS VARCHAR) AS doc_id, label FROM embeddings),
    t AS (SELECT doc_id, 'text' AS field, [concat('a ', label), 'b(c', ',x)'] AS terms FROM v
          UNION ALL SELECT doc_id, 'nested', [CAST(label AS VARCHAR), CAST(label + 1 AS VARCHAR)] FROM v)
    """ + long_sql("SELECT * FROM t"))
def doc_array_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "embeddings").selectExpr(
        "cast(vec_id as string) id", "array(concat('a ', label), null, 'b(c', ',x)') text",
        "array(array(label), cast(null as array<int>), array(label + 1)) nested")
    return document_terms(rows, Rules(id_field="id", arrays="typed")).where("field <> 'id'").select(*_LONG)


@query("doc_bracket_string", f"""
    WITH v AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders),
    t AS (SELECT doc_id, CASE WHEN k % 5 = 0 THEN [''] WHEN k % 5 = 1 THEN [concat('[', s, ', ', p)]
                 WHEN k % 5 = 2 THEN CAST([] AS VARCHAR[])
                 ELSE {split_sql("replace(concat(s, ',', p, ','), ' ', '')")} END AS terms FROM v)
    {long_sql("SELECT doc_id, 'code' AS field, terms FROM t UNION ALL SELECT doc_id, 'tag', terms FROM t")}""")
def doc_bracket_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) id",
        "case when o_orderkey % 5 = 0 then '[]' when o_orderkey % 5 = 1 then"
        " concat('[', o_orderstatus, ', ', o_orderpriority) when o_orderkey % 5 = 2 then '[,, ]'"
        " else concat('[', o_orderstatus, ', ', o_orderpriority, ',]') end code") \
        .selectExpr("id", "code", "map('tag', code) tags")
    return document_terms(rows, Rules(id_field="id")).where("field <> 'id'").select(*_LONG)


@query("doc_struct", f"""
    WITH v AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders),
    t AS (SELECT doc_id, concat(k, ',', CASE WHEN k % 4 = 0 THEN 'null' ELSE s END, ',', replace(p, ' ', '')) AS t FROM v WHERE k % 3 <> 0)
    {long_sql(f"SELECT doc_id, 'pair' AS field, {split_sql('t')} AS terms FROM t")}""")
def doc_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) id",
        "case when o_orderkey % 3 <> 0 then struct(o_orderkey as k,"
        " case when o_orderkey % 4 <> 0 then o_orderstatus end as s, struct(o_orderpriority as p) as q) end pair")
    return document_terms(rows, Rules(id_field="id")).where("field <> 'id'").select(*_LONG)


@query("doc_date", """
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'odate' AS field, strftime(o_orderdate, '%Y%m%d') AS term FROM orders
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'due', strftime(o_orderdate + INTERVAL 7 DAY, '%Y%m%d') FROM orders""")
def doc_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) id", "cast(o_orderdate as date) odate",
        "map('due', date_add(cast(o_orderdate as date), 7)) dates")
    # an override of a date field comes too late to change its value
    return document_terms(rows, Rules(id_field="id", overrides={"odate": "long", "due": "string"})) \
        .where("field <> 'id'").select("doc_id", "field", "term")


def _typed(docs: DataFrame, field: str) -> DataFrame:
    value = F.try_variant_get("doc", f"$.{field}", "variant")
    return docs.select("doc_id", F.schema_of_variant(value).alias("kind"),
                       F.try_variant_get("doc", f"$.{field}", "string").alias("value"))


@query("doc_cast_long", """
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'BIGINT' AS kind, CAST(o_custkey * 100000 AS VARCHAR) AS value FROM orders""")
def doc_cast_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) id", "map('big', cast(o_custkey * 100000 as string)) tags")
    return _typed(build_documents(rows, Rules(id_field="id", overrides={"big": "long"})), "big")


@query("doc_cast_integer", """
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'BIGINT' AS kind,
           CAST(CAST(trunc(-o_totalprice) AS INTEGER) AS VARCHAR) AS value FROM orders""")
def doc_cast_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) id", "-o_totalprice cut")
    return _typed(build_documents(rows, Rules(id_field="id", overrides={"cut": "integer"})), "cut")


@query("doc_cast_double", """
    SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, l_linenumber AS line, 'DOUBLE' AS kind,
           CAST(l_extendedprice AS DECIMAL(15,2)) AS value FROM lineitem""")
def doc_cast_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) id", "l_linenumber line",
        "cast(cast(l_extendedprice as decimal(15,2)) as string) price")
    docs = build_documents(rows, Rules(id_field="id", overrides={"price": "double"}), keep=["line"])
    value = F.try_variant_get("doc", "$.price", "variant")
    return docs.select("doc_id", "line", F.schema_of_variant(value).alias("kind"),
                       F.try_variant_get("doc", "$.price", "double").cast("decimal(15,2)").alias("value"))


@query("doc_cast_string", """
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'STRING' AS kind, CAST(o_custkey AS VARCHAR) AS value FROM orders
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'STRING', o_orderpriority FROM orders""")
def doc_cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.src_orders(spark, sf_dir).select("pri_key", "custkey", "prio")
    docs = build_documents(rows, Rules(id_field="pri_key", overrides={"custkey": "string", "prio": "date"}))
    return _typed(docs, "custkey").unionByName(_typed(docs, "prio"))


@query("doc_decimal", """
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'DOUBLE' AS kind, CAST(o_totalprice AS DECIMAL(15,2)) AS value FROM orders""")
def doc_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = build_documents(fx.src_orders(spark, sf_dir).select("pri_key", "price"), Rules(id_field="pri_key"))
    value = F.try_variant_get("doc", "$.price", "variant")
    return docs.select("doc_id", F.schema_of_variant(value).alias("kind"),
                       F.try_variant_get("doc", "$.price", "double").cast("decimal(15,2)").alias("value"))


@query("doc_value_rules", f"""
    WITH v AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderkey AS k, o_custkey AS c, o_orderdate AS d FROM orders),
    t AS (SELECT doc_id, 'list' AS field, [CAST(c AS VARCHAR)] AS terms FROM v
          UNION ALL SELECT doc_id, 'code', CASE WHEN k % 2 = 0 THEN [CAST(c AS VARCHAR), 'x'] ELSE [CAST(c AS VARCHAR)] END FROM v
          UNION ALL SELECT doc_id, 'day', [strftime(d, '%Y%m%d')] FROM v
          UNION ALL SELECT doc_id, 'amount', [concat(c, '.50')] FROM v
          UNION ALL SELECT doc_id, 'plain', [CAST(c AS VARCHAR)] FROM v)
    {long_sql("SELECT * FROM t")}""")
def doc_value_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) id", "array(o_custkey) list",
        "case when o_orderkey % 2 = 0 then concat('[', o_custkey, ', x]') else cast(o_custkey as string) end code",
        "cast(o_orderdate as date) day", "cast(o_custkey + 0.5 as decimal(15,2)) amount", "o_custkey plain")
    rules = Rules(id_field="id", overrides={"list": "long", "code": "long", "day": "long", "amount": "string"})
    return document_terms(rows, rules).where("field <> 'id'").select(*_LONG)


@query("doc_cast_reject", """
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id,
           CASE WHEN o_orderkey % 4 = 0 THEN 'code' ELSE 'code,num' END AS fields
    FROM orders WHERE o_orderkey % 2 = 0""")
def doc_cast_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) id",
        "case when o_orderkey % 2 = 0 then o_orderpriority else cast(o_orderkey as string) end code",
        "map('num', case when o_orderkey % 4 = 2 then '2.0' else '2' end) tags")
    rules = Rules(id_field="id", overrides={"code": "long", "num": "long"}, on_error="reject")
    bad = with_doc_id(rows, rules).withColumn("bad", cast_failures(rows, rules))
    return bad.where("size(bad) > 0").select("doc_id", F.array_join("bad", ",").alias("fields"))


@query("doc_collision", """
    SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 'status' AS field,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus WHEN o_orderkey % 3 = 0 THEN 'late'
                ELSE o_orderpriority END AS term FROM orders""")
def doc_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) id", "o_orderstatus status",
        "map('STATUS', case when o_orderkey % 2 = 0 then 'null' else o_orderpriority end) tags",
        "case when o_orderkey % 3 = 0 and o_orderkey % 2 = 1 then map('Status', 'late') end more")
    return document_terms(rows, Rules(id_field="id")).where("field <> 'id'").select("doc_id", "field", "term")


@query("doc_id", """
    SELECT CAST(o_orderkey AS VARCHAR) AS k,
           CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR)
                WHEN o_orderkey % 3 = 1 THEN concat('m', o_orderkey) END AS doc_id FROM orders""")
def doc_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) k", "case when o_orderkey % 3 = 0 then o_custkey end id",
        "case when o_orderkey % 3 = 1 then map('ID', concat('m', o_orderkey)) end tags")
    return with_doc_id(rows, Rules(id_field="id")).select("k", "doc_id")


@query("doc_id_generated", """
    WITH d AS (SELECT concat('{"prio":"', o_orderpriority, '","status":"', o_orderstatus, '"}') AS doc_json FROM orders)
    SELECT concat(md5(doc_json), '-', row_number() OVER (PARTITION BY doc_json) - 1) AS doc_id, doc_json FROM d""")
def doc_id_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.src_orders(spark, sf_dir).select("status", "prio")
    docs = build_documents(rows, Rules(id_field="status_id"))
    return generated_ids(docs, block=100).select("doc_id", "doc_json")
