"""Discovery per partition: each is read once, again when it has changed, and results equal a full pass."""
import pytest
from pyspark.sql import functions as F

from shardloom import BuildSpec, shared_dir
from shardloom.operators.discovery import discover_fields
from shardloom.plans import build_index
from shardloom.plans.build import source_rows
from shardloom.plans.facts import incremental_fields


def land(spark, folder, dt, keys, mode="append", kind="int"):
    rows = spark.createDataFrame([(f"{dt}-{i}", {k: i}) for i, k in enumerate(keys)], f"id string, m_map map<string,{kind}>")
    rows.coalesce(1).write.mode(mode).parquet(f"{folder}/dt={dt}")


def spec_of(spark, folder, **options):
    return BuildSpec(**{**dict(table=folder, index_name="f_20240116", num_shards=2, id_field="id", order_by=("id",),
                               work_dir=shared_dir(spark, "facts"), facts_by="dt"), **options})


def fields_of(spark, spec):
    """Names of the map fields, and the partitions read; held against a full pass."""
    source = source_rows(spark, spec)
    found, read = incremental_fields(spark, spec, source, source_rows)
    rows = sorted(map(tuple, found.collect()))
    assert rows == sorted(map(tuple, discover_fields(source).collect()))
    return {r[0] for r in rows if not r[2]}, sorted(read, key=str)


def test_partitions_are_read_once_and_again_when_changed(spark):
    folder = shared_dir(spark, "source")
    land(spark, folder, "20240115", ["a", "b"])
    land(spark, folder, "20240116", ["b", "c"])
    spec = spec_of(spark, folder)
    assert fields_of(spark, spec) == ({"m_map-a", "m_map-b", "m_map-c"}, ["20240115", "20240116"])
    assert fields_of(spark, spec)[1] == []
    land(spark, folder, "20240117", ["d"])
    assert fields_of(spark, spec) == ({f"m_map-{k}" for k in "abcd"}, ["20240117"])
    land(spark, folder, "20240115", ["e"])  # one more file
    assert fields_of(spark, spec) == ({f"m_map-{k}" for k in "abcde"}, ["20240115"])
    land(spark, folder, "20240116", ["f"], mode="overwrite")  # c is gone
    assert fields_of(spark, spec) == ({f"m_map-{k}" for k in "abdef"}, ["20240116"])


def test_a_predicate_selects_partitions(spark):
    folder = shared_dir(spark, "source")
    for dt, keys in (("20240115", "a"), ("20240116", "b"), ("__HIVE_DEFAULT_PARTITION__", "n")):
        land(spark, folder, dt, keys)
    spec = spec_of(spark, folder, where="dt >= '20240116'")
    assert fields_of(spark, spec) == ({"m_map-b"}, ["20240116"])
    everything = spec_of(spark, folder, work_dir=spec.work_dir, index_name="f_20240117")
    assert fields_of(spark, everything) == ({"m_map-a", "m_map-b", "m_map-n"}, ["20240115", None])
    assert fields_of(spark, spec) == ({"m_map-b"}, [])
    assert fields_of(spark, spec_of(spark, folder, where="dt = '1'"))[0] == set()
    with pytest.raises(ValueError, match="may only ask for 'dt'"):
        fields_of(spark, spec_of(spark, folder, where="dt >= '20240116' and id = 'x'"))


def test_the_scan_is_pruned_to_unseen_partitions(spark):
    folder = shared_dir(spark, "source")
    land(spark, folder, "20240115", ["a"])
    spec = spec_of(spark, folder)
    build_index(spark, spec, with_postings=False)
    land(spark, folder, "20240116", ["b"])
    seen = []

    def watched(session, wanted):
        rows = source_rows(session, wanted)
        seen.append(rows)
        return rows

    found, read = incremental_fields(spark, spec, source_rows(spark, spec), watched)
    assert read == ["20240116"] and len(seen) == 1
    pruned = seen[0].where(F.col("dt").cast("string").isin(read))
    plan = pruned.select("m_map")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "as string) = 20240116)]" in plan


def test_another_type_of_a_map_starts_anew(spark):
    folder = shared_dir(spark, "source")
    land(spark, folder, "20240115", ["a"])
    spec = spec_of(spark, folder)
    fields_of(spark, spec)
    land(spark, folder, "20240115", ["a"], mode="overwrite", kind="bigint")
    assert fields_of(spark, spec) == ({"m_map-a"}, ["20240115"])


def test_columns_without_the_partition_column(spark):
    folder = shared_dir(spark, "source")
    land(spark, folder, "20240115", ["a"])
    spec = spec_of(spark, folder, input_columns=("id", "m_map"))
    assert fields_of(spark, spec) == ({"m_map-a"}, ["20240115"])
