"""Exact dedup by a heavy-hitter split, in DataFrame operations only.

Misra-Gries counters (``freqItems``) name every digest above ``support`` of all rows.  The
candidates number at most ``1 / support``; their true counts and winners are then taken
over all rows, and this small table is broadcast, so that the copies of a hot text are
settled where they are read.  Only the other digests are shuffled, and no group among them
holds more than ``support`` of the rows.

Defined cases: a null text is the empty text; a null ``doc_id`` is smaller than any other;
of rows that share text and ``doc_id`` exactly one stays; an empty table gives no rows;
other columns, whatever their names, are not looked at.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import stored

SUPPORT = 0.001


def _digest(text: str = "text"):
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)


def _frequent(digests: DataFrame, support: float) -> DataFrame:
    """At most ``1 / support`` digests, among them all that more rows than that share have."""
    found = digests.stat.freqItems(["digest"], support)
    return found.select(F.explode("digest_freqItems").alias("digest"))


def copy_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per document: the id that stays for its text, the size of its group, and
    whether this is the row that stays (the one with the largest ``doc_id``)."""
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest"),
                              F.monotonically_increasing_id().alias("row")), "digests")
    last = F.max(F.struct("doc_id", "row"))
    winners = stored(rows.join(F.broadcast(_frequent(rows, support)), "digest")
                     .groupBy("digest").agg(last.alias("last"), F.count("*").alias("group_size")), "winners")
    hot = rows.join(F.broadcast(winners), "digest")
    same = Window.partitionBy("digest")
    cold = (rows.join(F.broadcast(winners), "digest", "left_anti")
            .withColumn("last", last.over(same)).withColumn("group_size", F.count("*").over(same)))
    return hot.unionByName(cold).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("last.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``docs`` with one row of each text, the one with the largest ``doc_id``.

    Copies of hot texts go while the table is read; the others by a rank per digest, which
    Spark cuts to one row per task and digest before the shuffle.  Ties of ``doc_id`` are
    settled by a hash of the whole row; rows that are alike in all columns are one row.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                       _digest().alias("digest"))
    digests = rows.select("digest", "id")
    winners = stored(digests.join(F.broadcast(_frequent(digests, support)), "digest")
                     .groupBy("digest").agg(F.max("id").alias("last")), "winners")
    left = (rows.join(F.broadcast(winners), "digest", "left")
            .filter("last is null or id is not distinct from last"))
    first = Window.partitionBy("digest").orderBy(F.col("id").desc_nulls_last(), F.xxhash64(F.to_json("row")))
    return left.withColumn("rank", F.row_number().over(first)).filter("rank = 1").select("row.*")


def dedup_query(spark, sf_dir):
    """op5: the copy groups of all ``documents``."""
    from shardloom.llm.common import table
    return copy_groups(table(spark, sf_dir, "documents"))


DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
