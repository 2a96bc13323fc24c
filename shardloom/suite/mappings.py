"""Queries: field discovery and mapping inference."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shardloom.operators.discovery import (
    discover_fields, map_fields, plain_coverage,
)
from shardloom.operators.mapping import (
    explicit_fields, field_budget, infer_mapping, mapping_json, mapping_summary, resolve_conflicts,
)
from shardloom.sources import type_overrides
from shardloom.suite import fixtures as fx
from shardloom.suite.registry import query

# The SQL twin of the mapping rules over ``facts`` and ``overrides``.
_MAPPING_SQL = f"""{fx.ORDERS_FIELDS_SQL}, {fx.OVERRIDE_SQL},
typed AS (SELECT field, is_plain, src_col,
            coalesce(o.type, CASE WHEN src_type = 'bigint' THEN 'long' WHEN src_type = 'int' THEN 'integer'
              WHEN src_type LIKE 'array%' THEN 'string' WHEN src_type LIKE 'decimal%' THEN 'double'
              ELSE src_type END) AS type,
            is_plain OR NOT (suffix(src_col, '_map') OR suffix(src_col, '_ex')) AS indexable
          FROM facts LEFT JOIN overrides o USING (field)),
mapping AS (SELECT field, type, indexable,
              CASE WHEN NOT indexable THEN 'no' WHEN lower(type) = 'string' THEN 'not_analyzed' END AS index,
              CASE WHEN lower(type) = 'date' THEN 'yyyyMMdd' END AS format FROM typed)"""

_ENTRY_SQL = """concat('"', field, '":{"type":"', type, '"',
    CASE WHEN index IS NULL THEN '' ELSE concat(',"index":"', index, '"') END,
    CASE WHEN format IS NULL THEN '' ELSE concat(',"format":"', format, '"') END, '}')"""


def _mapping(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    overrides = type_overrides(fx.override_table(spark, sf_dir), fx.SNAPSHOT)
    return infer_mapping(discover_fields(fx.src_orders(spark, sf_dir)), overrides, **options)


@query("fields_plain", """
    SELECT 'pri_key' AS field, 'string' AS src_type, true AS is_plain, 'pri_key' AS src_col, count(o_orderkey) AS docs FROM orders
    UNION ALL SELECT 'status', 'string', true, 'status', count(o_orderstatus) FROM orders
    UNION ALL SELECT 'price', 'decimal(15,2)', true, 'price', count(o_totalprice) FROM orders
    UNION ALL SELECT 'odate', 'date', true, 'odate', count(o_orderdate) FROM orders
    UNION ALL SELECT 'prio', 'string', true, 'prio', count(o_orderpriority) FROM orders
    UNION ALL SELECT 'custkey', 'bigint', true, 'custkey', count(o_custkey) FROM orders""")
def fields_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_coverage(fx.src_orders(spark, sf_dir))


@query("fields_map", f"WITH {fx.ORDERS_FIELDS_SQL} SELECT * FROM facts WHERE NOT is_plain")
def fields_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_fields(fx.src_orders(spark, sf_dir))


@query("fields_distinct", f"WITH {fx.ORDERS_FIELDS_SQL} SELECT * FROM facts")
def fields_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover_fields(fx.src_orders(spark, sf_dir))


@query("fields_per_column", f"""WITH {fx.ORDERS_FIELDS_SQL}
    SELECT src_col, count(DISTINCT field) AS fields FROM facts GROUP BY src_col""")
def fields_per_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_budget(discover_fields(fx.src_orders(spark, sf_dir)))


def _typed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey big", "l_linenumber num", "cast(l_tax as decimal(10,2)) dec", "l_discount dbl",
        "cast(l_discount as float) flt", "l_linenumber > 3 flag", "cast(l_linenumber as smallint) small",
        "cast(l_linenumber as tinyint) tiny", "l_shipdate stamp", "cast(l_shipdate as date) day",
        "array(l_linenumber) nums", "named_struct('a', l_linenumber, 'b', l_returnflag) pair",
        "map(concat(l_returnflag, '$', l_linestatus), l_partkey) big_map",
        "map(l_linestatus, cast(l_tax as decimal(10,2))) dec_map",
        "map(l_returnflag, array(l_linestatus)) list_map")


@query("mapping_types", """
    WITH facts AS (
      SELECT DISTINCT 'big' AS field, 'long' AS type FROM lineitem UNION SELECT 'num', 'integer' FROM lineitem
      UNION SELECT 'dec', 'double' FROM lineitem UNION SELECT 'dbl', 'double' FROM lineitem
      UNION SELECT 'flt', 'float' FROM lineitem UNION SELECT 'flag', 'boolean' FROM lineitem
      UNION SELECT 'small', 'smallint' FROM lineitem UNION SELECT 'tiny', 'tinyint' FROM lineitem
      UNION SELECT 'stamp', 'timestamp_ntz' FROM lineitem UNION SELECT 'day', 'date' FROM lineitem
      UNION SELECT 'nums', 'string' FROM lineitem UNION SELECT 'pair', 'struct<a:int,b:string>' FROM lineitem
      UNION SELECT concat('big_map-', lower(l_returnflag), '-', lower(l_linestatus)), 'long' FROM lineitem
      UNION SELECT concat('dec_map-', lower(l_linestatus)), 'double' FROM lineitem
      UNION SELECT concat('list_map-', lower(l_returnflag)), 'string' FROM lineitem)
    SELECT * FROM facts""")
def mapping_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer_mapping(discover_fields(_typed_lines(spark, sf_dir))).select("field", "type")


@query("mapping_override", f"WITH {_MAPPING_SQL} SELECT field, type FROM mapping")
def mapping_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapping(spark, sf_dir).select("field", "type")


@query("mapping_indexable", f"WITH {_MAPPING_SQL} SELECT field, indexable FROM mapping")
def mapping_indexable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapping(spark, sf_dir).select("field", "indexable")


@query("mapping_index_attr", f"WITH {_MAPPING_SQL} SELECT field, index FROM mapping")
def mapping_index_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapping(spark, sf_dir).select("field", "index")


@query("mapping_date_format", f"WITH {_MAPPING_SQL} SELECT field, format FROM mapping")
def mapping_date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapping(spark, sf_dir).select("field", "format")


@query("mapping_summary", f"""WITH {_MAPPING_SQL}
    SELECT count(*) FILTER (indexable) AS indexed_fields, count(*) AS all_fields FROM mapping""")
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping_summary(_mapping(spark, sf_dir))


@query("mapping_json", f"""WITH {_MAPPING_SQL}
    SELECT concat('{{', string_agg({_ENTRY_SQL}, ',' ORDER BY field), '}}') AS json FROM mapping""")
def as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping_json(_mapping(spark, sf_dir))


@query("mapping_root", f"""WITH {_MAPPING_SQL}
    SELECT concat('{{"properties":{{', string_agg({_ENTRY_SQL}, ',' ORDER BY field),
                  '}},"_all":{{"enabled":false}}}}') AS json FROM mapping""")
def mapping_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping_json(_mapping(spark, sf_dir), wrap=True)


_EXPLICIT = '{"prio":{"type":"keyword"},"status":{"index":"no"},"added":{"type":"date","format":"yyyy"}}'


@query("mapping_explicit", f"""WITH {_MAPPING_SQL}
    SELECT field, CASE WHEN field = 'prio' THEN 'keyword' ELSE type END AS type,
           CASE WHEN field = 'status' THEN 'no' ELSE index END AS index, format,
           field <> 'status' AND indexable AS indexable FROM mapping
    UNION ALL SELECT 'added', 'date', NULL, 'yyyy', true""")
def mapping_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapping(spark, sf_dir, explicit=explicit_fields(spark, _EXPLICIT))


@query("mapping_index_lists", f"""WITH {_MAPPING_SQL}
    SELECT field, type, format, field IN ('prio', 'attrs_map-prio-', 'price') OR src_col IN ('dyn_map', 'odate') AS indexable,
           CASE WHEN NOT (field IN ('prio', 'attrs_map-prio-', 'price') OR src_col IN ('dyn_map', 'odate')) THEN 'no'
                WHEN lower(type) = 'string' THEN 'not_analyzed' END AS index
    FROM mapping JOIN (SELECT DISTINCT field, src_col FROM facts) USING (field)""")
def mapping_index_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapping(spark, sf_dir, index_fields=["prio", "attrs_map-prio-", "price"],
                    index_source_columns=["dyn_map", "odate"])


@query("mapping_conflicts", """
    WITH facts AS (
      SELECT DISTINCT lower(o_orderpriority) AS field, 'string' AS src_type, false AS is_plain, 'texts' AS src_col FROM orders
      UNION SELECT lower(o_orderpriority), 'bigint', false, 'numbers' FROM orders WHERE o_orderpriority < '4'
      UNION SELECT lower(o_orderstatus), 'bigint', false, 'numbers' FROM orders WHERE o_orderpriority >= '4'
      UNION SELECT 'f', 'string', true, 'f' FROM orders),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY NOT is_plain, src_type, src_col) AS rn,
                 min(src_type) OVER (PARTITION BY field) <> max(src_type) OVER (PARTITION BY field) AS conflict
               FROM facts)
    SELECT field, src_type, is_plain, src_col, conflict FROM ranked WHERE rn = 1""")
def mapping_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "orders").selectExpr(
        "o_orderstatus f", "map(o_orderpriority, o_orderstatus) texts",
        "map(case when o_orderpriority < '4' then o_orderpriority else o_orderstatus end, o_custkey) numbers")
    return resolve_conflicts(discover_fields(rows))
