"""Publishing a finished version: gate, alias, close, expire.

Version and alias tables are stored as a new Parquet generation before the view moves, and
the expired folder is deleted last.  The alias itself is a SQL view over the published
documents.  If the gate is shut, nothing changes.
"""
from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from shardloom.operators import lifecycle
from shardloom.operators.segments import latest_generation
from shardloom.plans.build import BuildResult
from shardloom.sinks.files import delete_path, one_path, read_manifest, read_versions, refused_counts, write_versions
from shardloom.spec import BuildSpec


@dataclass(frozen=True)
class CutoverResult:
    published: bool
    aliases: DataFrame
    versions: DataFrame
    closed: DataFrame
    expired: DataFrame


def shard_reports(spark: SparkSession, idx: str, manifest_path: str) -> DataFrame:
    """(idx, shard, err): a shard whose stored rows differ from its manifest has an error.

    Counting by partition folder needs no column, so this reads file footers only.
    """
    newest = latest_generation(read_manifest(spark, manifest_path))
    paths = [r["path"] for r in newest.select("path").distinct().collect()]
    listed = newest.groupBy("shard").agg(F.sum("docs").alias("docs"))
    if not paths:
        return listed.select(F.lit(idx).alias("idx"), "shard", F.lit(None).cast("string").alias("err"))
    stored = spark.read.parquet(*paths).groupBy("shard").agg(F.count(F.lit(1)).alias("stored"))
    differs = F.col("docs") != F.coalesce("stored", F.lit(0))
    return listed.join(stored, "shard", "left").select(
        F.lit(idx).alias("idx"), "shard", F.when(differs, F.concat(
            F.lit("manifest "), F.col("docs"), F.lit(" stored "), F.coalesce("stored", F.lit(0))))
        .alias("err"))


def cut_over(spark: SparkSession, idx: str, alias: str, manifest_path: str,
             aliases: DataFrame, versions: DataFrame, retention_days: int = -2,
             expected_docs: int | None = None,
             settings: Mapping[str, str] | None = None, view: bool = True,
             work_dir: str | None = None, max_refused: int | None = None) -> CutoverResult:
    """Move ``alias`` to version ``idx`` if it is healthy; close and expire older versions.

    The gate also stays shut if the documents that are not deleted differ from
    ``expected_docs``, or if the build refused more than ``max_refused`` rows; both numbers
    are read from the manifest.  Every alias of the expired version goes with it.

    With ``work_dir`` the new tables are stored in its ``_versions`` folder, and the folder
    of the expired version is removed.
    """
    one = spark.range(1).select(F.lit(idx).alias("idx"), F.lit(alias).alias("alias"))
    gate = lifecycle.health_gate(one.select("idx"), shard_reports(spark, idx, manifest_path))
    healthy = gate.first()["healthy"]
    newest = latest_generation(read_manifest(spark, manifest_path))
    if healthy and expected_docs is not None:
        healthy = newest.agg(F.sum(F.col("docs") - F.col("deleted")).alias("n")).first()["n"] == expected_docs
    if healthy and max_refused is not None:
        healthy = (refused_counts(newest).agg(F.sum("refused").alias("n")).first()["n"] or 0) <= max_refused
    if not healthy:
        none = one.select("idx").where(F.lit(False))
        return CutoverResult(False, aliases, versions, none, none)

    losers = lifecycle.alias_losers(aliases, one)
    moved = lifecycle.alias_swap(aliases, one)
    closed = lifecycle.version_close(versions, losers)
    gone = versions.join(lifecycle.expired_names(one, retention_days), "idx", "left_semi") \
        .select("idx").collect()  # one version at most: the name is made from ``idx``
    expired = spark.createDataFrame(gone, "idx string")
    left = lifecycle.version_expire(closed, one, retention_days)
    lost = moved.join(expired, "idx", "left_semi").select("alias").collect()  # aliases of one version
    moved = moved.join(expired, "idx", "left_anti").select("idx", "alias")
    if work_dir:
        state = versions_path(work_dir)
        write_versions(moved, left, state)
        moved, left = read_versions(spark, state)
    if view:
        publish_view(spark, alias, one_path(newest), settings, one_path(newest, "deletes"))
        for row in lost:
            spark.sql(f"DROP VIEW IF EXISTS {view_name(row['alias'])}")
    if work_dir:
        for row in gone:
            delete_path(spark, f"{work_dir.rstrip('/')}/{row['idx']}")
    return CutoverResult(True, moved, left, losers, expired)


def versions_path(work_dir: str) -> str:
    return f"{work_dir.rstrip('/')}/_versions"


def publish(spark: SparkSession, spec: BuildSpec, result: BuildResult, retention_days: int = -2,
            view: bool = True, max_refused: int | None = None) -> CutoverResult:
    """Cut over to a build, with the alias and final settings its spec names and the alias
    and version tables stored in its work folder."""
    if not spec.alias:
        raise ValueError("the spec names no alias")
    aliases, versions = read_versions(spark, versions_path(spec.work_dir))
    new = spark.range(1).select(F.lit(spec.index_name).alias("idx"), F.lit("open").alias("status"))
    versions = versions.join(new.select("idx"), "idx", "left_anti").select("idx", "status").unionByName(new)
    return cut_over(spark, spec.index_name, spec.alias, result.manifest_path, aliases, versions,
                    retention_days, settings=spec.final_settings, view=view, work_dir=spec.work_dir,
                    max_refused=max_refused)


def view_name(alias: str) -> str:
    return "`" + alias.replace("`", "``") + "`"


def publish_view(spark: SparkSession, alias: str, docs_path: str,
                 settings: Mapping[str, str] | None = None, deletes_path: str | None = None) -> None:
    """The alias as a catalog view, without deleted documents, with the final settings as its properties."""
    name, docs = view_name(alias), "parquet." + view_name(docs_path)
    shown = f"SELECT * FROM {docs}"
    if deletes_path:
        shown = (f"SELECT * EXCEPT (ord) FROM (SELECT *, _metadata.row_index AS ord FROM {docs}) d LEFT ANTI JOIN "
                 f"(SELECT shard, segment, explode(ords) AS ord FROM parquet.{view_name(deletes_path)}) x "
                 "ON d.shard = x.shard AND d.segment = x.segment AND d.ord = x.ord")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {shown}")
    for key, value in (settings or {}).items():
        quoted = [str(x).replace("\\", "\\\\").replace("'", "\\'") for x in (key, value)]
        spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ('{quoted[0]}' = '{quoted[1]}')")
