"""Build states and version lifecycle as operators over small tables.

Inputs are state records, shard reports, alias rows and version rows.  None of them is
assumed tiny: every step is a join or an aggregate that combines on the map side.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shardloom.functions.names import retention_name

DELETED = "deleted"


def latest_state(ledger: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """Newest state of each index; an index whose record was deleted is gone."""
    newest = F.max_by("state", F.struct(*order_by, "state"))
    return ledger.groupBy("idx").agg(newest.alias("state")).where(F.col("state") != DELETED)


def completed(names: DataFrame, ledger: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """Whether each named index is completed; one without a record is not."""
    return names.join(latest_state(ledger, order_by), "idx", "left").select(
        "idx", F.coalesce(F.lower("state") == "completed", F.lit(False)).alias("completed"))


def pending(listed: DataFrame, processed: DataFrame, key: str = "path") -> DataFrame:
    return listed.join(processed, key, "left_anti")


def build_barrier(expected: DataFrame, done: DataFrame, group: str, unit: str) -> DataFrame:
    """Per build: expected units, units still open, and whether the build may go on."""
    open_units = expected.join(done, [group, unit], "left_anti")
    left = open_units.groupBy(group).agg(F.count(F.lit(1)).alias("left"))
    every = expected.groupBy(group).agg(F.count(F.lit(1)).alias("expected"))
    return every.join(left, group, "left").select(
        group, "expected", F.coalesce("left", F.lit(0)).alias("left"),
        (F.coalesce("left", F.lit(0)) == 0).alias("released"))


def health_gate(names: DataFrame, shards: DataFrame, num_shards: int | None = None) -> DataFrame:
    """Whether each index exists, has no shard error, and (if given) has all its shards."""
    good = F.bool_and(F.col("err").isNull())
    if num_shards is not None:
        good = good & (F.count_distinct("shard") == num_shards)
    report = shards.groupBy("idx").agg(good.alias("good"))
    return names.join(report, "idx", "left").select(
        "idx", F.coalesce("good", F.lit(False)).alias("healthy"))


def reconciled(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Expected against stored document counts per index."""
    return expected.join(stored, "idx", "left").select(
        "idx", (F.col("expected_docs") == F.coalesce("stored_docs", F.lit(0))).alias("complete"))


def alias_swap(aliases: DataFrame, targets: DataFrame) -> DataFrame:
    """Alias rows (idx, alias) after each target alias moves to its new version.

    All aliases of a version are looked at, not just its first.
    """
    others = aliases.join(targets.select("alias"), "alias", "left_anti").select("idx", "alias")
    return others.unionByName(targets.select("idx", "alias"))


def alias_losers(aliases: DataFrame, targets: DataFrame) -> DataFrame:
    """Versions that held a moved alias, without the new one: these get closed."""
    new = targets.select("alias", F.col("idx").alias("new_idx"))
    return aliases.join(new, "alias").where(F.col("idx") != F.col("new_idx")) \
        .select("idx").distinct()


def version_close(versions: DataFrame, losers: DataFrame) -> DataFrame:
    """Version table with the losers' status set to closed."""
    lost = losers.select("idx", F.lit(True).alias("_lost"))
    return versions.join(lost, "idx", "left").withColumn(
        "status", F.when(F.col("_lost"), F.lit("closed")).otherwise(F.col("status"))).drop("_lost")


def expired_names(new_versions: DataFrame, days: int = -2, sep: str = "_") -> DataFrame:
    """The version each new one pushes out."""
    return new_versions.select(retention_name(F.col("idx"), days, sep).alias("idx")).distinct()


def version_expire(versions: DataFrame, new_versions: DataFrame, days: int = -2) -> DataFrame:
    """Version table without the pushed-out ones; names that do not exist change nothing."""
    return versions.join(expired_names(new_versions, days), "idx", "left_anti")


def version_create(names: DataFrame, num_shards: int) -> DataFrame:
    """Start row of a version: shard count, no copies, no refresh while loading."""
    return names.select(
        "idx", F.lit("open").alias("status"), F.lit(num_shards).alias("num_shards"),
        F.lit(0).alias("replicas"), F.lit(-1).alias("refresh_interval"))


def final_properties(versions: DataFrame, gate: DataFrame, settings: Column) -> DataFrame:
    """Settings (a map column) laid over each healthy version's own; others stay as they are."""
    return versions.join(gate, "idx", "left").withColumn(
        "settings", F.when(F.coalesce("healthy", F.lit(False)),
                           F.map_concat(F.col("settings"), settings))
        .otherwise(F.col("settings"))).drop("healthy")


def shards_by_holder(assigned: DataFrame, live: DataFrame) -> DataFrame:
    """Shard list of each live holder; a list is at most as long as the index has shards."""
    return assigned.join(live, "holder", "left_semi").groupBy("idx", "holder").agg(
        F.sort_array(F.collect_set("shard")).alias("shards"))
