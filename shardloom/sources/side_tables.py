"""Field denylist and type overrides: small dated tables that steer a build."""
from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from shardloom.spec import Rules


def deny_list(df: DataFrame, theme: str, dt: str) -> DataFrame:
    """Distinct denied field names of one theme and snapshot date."""
    return df.where((F.col("theme") == theme) & (F.col("dt").cast("string") == dt)) \
        .select("name").where(F.col("name").isNotNull()).distinct()


def type_overrides(df: DataFrame, dt: str, order_by: Column | None = None) -> DataFrame:
    """One (field, type) per field of a snapshot date, both trimmed.

    With ``order_by`` the last row of a field wins.  Without it the table has no last
    row, so two different types for one field are an error.
    """
    rows = df.where(F.col("dt").cast("string") == dt).select(
        F.trim("index_name").alias("field"), F.trim("data_type").alias("type"),
        (F.lit(0) if order_by is None else order_by).alias("seq"))
    if order_by is not None:
        return rows.groupBy("field").agg(F.max_by("type", F.struct("seq", "type")).alias("type"))
    both = rows.groupBy("field").agg(F.min("type").alias("low"), F.max("type").alias("high"))
    message = F.concat(F.lit("two override types for field "), F.col("field"))
    return both.select("field", F.when(F.col("low") == F.col("high"), F.col("low"))
                       .otherwise(F.raise_error(message).cast("string")).alias("type"))


def load_rules(base: Rules, deny: DataFrame | None = None, overrides: DataFrame | None = None,
               fields: DataFrame | None = None) -> Rules:
    """Rules with the given denylist and overrides.

    Only names that are fields of this index matter.  With ``fields`` the side tables are
    cut to those by a semi join, so their own size does not count: what comes back is at
    most a row per field of the index that is denied or overridden.
    """
    names, types = base.deny, dict(base.overrides)
    if deny is not None:
        wanted = deny if fields is None else deny.join(
            fields.select(F.col("field").alias("name")), "name", "left_semi")
        names = names | {r["name"] for r in wanted.collect()}
    if overrides is not None:
        wanted = overrides if fields is None else overrides.join(
            fields.select("field"), "field", "left_semi")
        types.update({r["field"]: r["type"] for r in wanted.collect()})
    return replace(base, deny=frozenset(names), overrides=types)
