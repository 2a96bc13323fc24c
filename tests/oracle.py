"""Run a registered query and its SQL twin side by side and compare the rows."""
from __future__ import annotations

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


# fixed values: Spark type names and what DuckDB calls the same type
SAME_TYPE = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
             "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
             "timestamp": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT",
             "tinyint": "TINYINT"}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    expected = con.sql(sql)
    columns = sorted(df.columns)
    if columns != sorted(expected.columns):
        return [f"columns {columns} != {sorted(expected.columns)}"]
    found = []
    types = dict(zip(expected.columns, map(str, expected.types)))
    for field in df.schema.fields:
        spark_type = field.dataType.simpleString()
        want = SAME_TYPE.get(spark_type, spark_type.upper())
        if want != types[field.name].upper():
            found.append(f"type of {field.name}: {spark_type} != {types[field.name]}")
    left = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    right = sorted(expected.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall(),
                   key=repr)
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    if not right:
        found.append("the SQL gives no rows")
    extra = set(left) - set(right)
    missing = set(right) - set(left)
    if extra or missing or left != right:
        found.append(f"only Spark {sorted(extra, key=repr)[:3]}, only SQL {sorted(missing, key=repr)[:3]}")
    return found
