"""Placement of documents in shards and segments, first-row-wins, micro-batches."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shardloom.functions.hashing import segment_of, shard_of
from shardloom.session import stored


def with_shard(docs: DataFrame, num_shards: int, routing: Column | None = None) -> DataFrame:
    """Shard by hash of the routing value, or of the id where routing is absent."""
    key = F.col("doc_id") if routing is None else F.coalesce(routing.cast("string"), F.col("doc_id"))
    return docs.withColumn("shard", shard_of(key, num_shards))


def segment_plan(sharded: DataFrame, target_docs: int) -> DataFrame:
    """(shard, docs, segments): as many segments as keep each near ``target_docs``.

    One partial aggregate to a row per shard.  A shard that routing makes hot simply gets
    more segments, so no segment, task or file grows with the skew.
    """
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("docs")).select(
        "shard", "docs",
        F.greatest(F.ceil(F.col("docs") / target_docs), F.lit(1)).cast("int").alias("segments"))


def planned_segments(sharded: DataFrame, target_docs: int, num_shards: int) -> list[int]:
    """The segment plan as a count per shard: one small job, at most one row per shard."""
    rows = segment_plan(sharded, target_docs).collect()
    found = {r["shard"]: r["segments"] for r in rows}
    return [found.get(shard, 1) for shard in range(num_shards)]


def with_segment(sharded: DataFrame, segments: int | Sequence[int] | DataFrame) -> DataFrame:
    """Segment number of every document.

    ``segments`` is one count for all shards, a count per shard (a literal lookup), or a
    ``segment_plan`` that is still to be computed (a join of one row per shard).
    """
    if isinstance(segments, int):
        return sharded.withColumn("segment", segment_of(F.col("doc_id"), segments))
    if not isinstance(segments, DataFrame):
        per_shard = F.element_at(F.array(*map(F.lit, segments)), F.col("shard") + 1)
        return sharded.withColumn("segment", segment_of(F.col("doc_id"), per_shard))
    plan = segments.select("shard", "segments")
    # every shard is in the plan; a left join just spares a null test that would hash twice.
    # A row per shard is broadcast at any size: a shuffle by shard would be a task per shard.
    return sharded.join(F.broadcast(plan), "shard", "left").withColumn(
        "segment", segment_of(F.col("doc_id"), F.col("segments"))).drop("segments")


def colocate(placed: DataFrame, segments: Sequence[int] | int, num_shards: int) -> DataFrame:
    """One task per (shard, segment): numbered tasks, so no two segments collide in one.

    Adds ``slot``, the number of the segment over all shards.  Later windows and groups
    that include ``slot`` need no further shuffle.
    """
    counts = [segments] * num_shards if isinstance(segments, int) else list(segments)
    if len(counts) != num_shards:
        raise ValueError("one segment count per shard is needed")
    first, total = [], 0
    for n in counts:
        first.append(total)
        total += n
    if isinstance(segments, int):
        slot = F.col("shard") * F.lit(segments) + F.col("segment")
    else:
        slot = F.element_at(F.array(*map(F.lit, first)), F.col("shard") + 1) + F.col("segment")
    return placed.withColumn("slot", slot.cast("int")).repartitionById(total, F.col("slot"))


def partition_counts(placed: DataFrame) -> DataFrame:
    return placed.groupBy("shard", "segment").agg(F.count(F.lit(1)).alias("docs"))


def nonempty_shards(placed: DataFrame, num_shards: int) -> DataFrame:
    """Every shard number with its document count and whether it gets a bundle."""
    found = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("docs"))
    every = placed.sparkSession.range(num_shards).select(F.col("id").cast("int").alias("shard"))
    return every.join(found, "shard", "left").select(
        "shard", F.coalesce("docs", F.lit(0)).alias("docs"),
        (F.coalesce("docs", F.lit(0)) > 0).alias("bundled"))


def scope_keys(scope: str) -> list[str]:
    if scope == "global":
        return ["doc_id"]
    if scope == "segment":
        return ["shard", "segment", "doc_id"]
    raise ValueError(f"scope must be 'global' or 'segment', not {scope!r}")


def dedupe_first(docs: DataFrame, order_by: Sequence[str | Column],
                 scope: str = "global") -> DataFrame:
    """The first row of every id in ``scope``, for the rows that have an id.

    Rows without one are never duplicates of each other: ``generated_ids`` names them.  The rank filter lets Spark keep only each task's best row per id *before* the shuffle
    (``WindowGroupLimit``), so an id holding a third of all rows shuffles a row per task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if not order:
        raise ValueError("the first row of an id needs order columns")
    window = Window.partitionBy(*scope_keys(scope)).orderBy(*order)
    return docs.where(F.col("doc_id").isNotNull()) \
        .withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedupe_rejects(docs: DataFrame, order_by: Sequence[str], scope: str = "global",
                   row: Column | None = None) -> DataFrame:
    """Refused rows: (*scope, *order_by, refused), equal rows counted together.

    The ids that repeat and their first rows are a partial aggregate over the id and the
    order columns, stored; the raw rows then meet it in a join that drops all other ids and
    whose row side adaptive execution can split where an id is hot.  Equal rows are counted
    last, by one struct of all columns, so that the split rows need not lie together by id.
    ``row`` is a text of the whole row to keep beside each.
    """
    keys = scope_keys(scope)
    place = F.struct(*order_by)
    named = docs.where(F.col("doc_id").isNotNull())
    repeated = stored(
        named.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
        .where("_n > 1").select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_first"), "repeated")
    found = named.join(repeated, [F.col(k) == F.col(f"_of_{k}") for k in keys]).select(
        F.struct(*keys, *order_by).alias("_alike"), place.eqNullSafe(F.col("_first")).alias("_best"),
        (F.lit(None).cast("string") if row is None else row).alias("row"))
    counted = found.groupBy("_alike", "_best").agg(F.count(F.lit(1)).alias("_copies"), F.min("row").alias("row"))
    refused = F.col("_copies") - F.col("_best").cast("int")
    return counted.select("_alike.*", refused.alias("refused"), *(() if row is None else ("row",))) \
        .where("refused > 0")


def rows_but_first(rows: DataFrame, firsts: DataFrame, alike: Sequence[str]) -> DataFrame:
    """(*alike, refused): ``rows`` without one copy of each row of ``firsts``, equal rows
    counted together.

    Firsts count against the rows, so there is no join, and rows move once, by all of
    ``alike``: the rows of a hot id go to as many tasks as they differ.
    """
    both = rows.select(*alike, F.lit(1).cast("bigint").alias("_n")).unionAll(
        firsts.select(*alike, F.lit(-1).cast("bigint").alias("_n")))
    return both.groupBy(*alike).agg(F.sum("_n").alias("refused")).where("refused > 0")


def bulk_batches(placed: DataFrame, max_actions: int, max_bytes: int,
                 body: str = "doc_json") -> DataFrame:
    """Micro-batch number of every document inside its segment, in id order.

    A new batch starts when the action count or the byte count passes a multiple of its
    limit.  Ids are unique and segments are sized by plan, so each window is bounded.
    Documents that ``colocate`` has put together (``slot``) are not moved again.
    """
    window = Window.partitionBy(*_together(placed)).orderBy("doc_id")
    size = F.octet_length(body).cast("bigint")
    before = F.sum(size).over(window.rowsBetween(Window.unboundedPreceding, 0)) - size
    by_count = F.floor((F.row_number().over(window) - 1) / max_actions)
    by_size = F.floor(before / max_bytes)
    return placed.withColumn("batch", (by_count + by_size).cast("bigint"))


def _together(placed: DataFrame) -> list[str]:
    return ["slot"] if "slot" in placed.columns else ["shard", "segment"]


def bulk_bodies(placed: DataFrame, max_actions: int, max_bytes: int, line: str = "line") -> DataFrame:
    """(shard, segment, batch, actions, body): the lines of each micro-batch as one request.

    A body has at most ``max_actions`` lines and, but for its last line, at most
    ``max_bytes`` bytes.
    """
    keys = list(dict.fromkeys([*_together(placed), "shard", "segment", "batch"]))
    lines = F.array_sort(F.collect_list(F.struct("doc_id", F.col(line).alias("line"))))
    found = bulk_batches(placed, max_actions, max_bytes, line).groupBy(*keys).agg(lines.alias("lines"))
    body = F.concat(F.array_join(F.col("lines.line"), "\n"), F.lit("\n"))
    return found.select("shard", "segment", "batch", F.size("lines").cast("bigint").alias("actions"), body.alias("body"))
