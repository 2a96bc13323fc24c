"""Exact-term index of placed documents: ordinals, posting blocks, statistics."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def doc_ordinals(placed: DataFrame) -> DataFrame:
    """Number of each document inside its segment, in id order, from 0.

    Uses ``slot`` where documents are already together per segment: no shuffle then.
    """
    keys = ["slot"] if "slot" in placed.columns else ["shard", "segment"]
    window = Window.partitionBy(*keys).orderBy("doc_id")
    return placed.withColumn("ord", (F.row_number().over(window) - 1).cast("bigint"))


def postings(terms: DataFrame, block: int) -> DataFrame:
    """(shard, segment, field, term, block, df, ords) from (shard, segment, ord, field, term).

    Each list holds the ordinals of one block of ``block`` documents, so a term that every
    document has becomes many bounded rows.  A document counts once per term.
    """
    keys = ["slot"] if "slot" in terms.columns else []
    keyed = terms.select(*keys, "shard", "segment", "field", "term",
                         F.floor(F.col("ord") / block).cast("bigint").alias("block"), "ord")
    grouped = keyed.groupBy(*keys, "shard", "segment", "field", "term", "block").agg(
        F.sort_array(F.collect_set("ord")).alias("ords"))
    return grouped.select("shard", "segment", "field", "term", "block",
                          F.size("ords").alias("df"), "ords")


def segment_bases(segments: DataFrame) -> DataFrame:
    """(shard, segment, base): the ordinal in the shard of each segment's first document, a
    prefix sum over the segments in manifest order; a row per segment."""
    earlier = Window.partitionBy("shard").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return segments.select("shard", "segment", F.coalesce(F.sum("docs").over(earlier), F.lit(0)).alias("base"))


def merged_postings(blocks: DataFrame, segments: DataFrame, block: int) -> DataFrame:
    """(shard, field, term, block, df, ords): a shard's postings from those of its segments.

    Ordinals are moved up by the size of the segments before and cut anew at multiples of
    ``block``; whole lists travel, never single postings, and no document is read.  A list
    of the result has at most ``block`` ordinals, whatever the number of segments.
    """
    moved = blocks.join(segment_bases(segments), ["shard", "segment"]).select(
        "shard", "field", "term", F.transform("ords", lambda o: o + F.col("base")).alias("ords"))
    number = (F.element_at("ords", 1) / block).cast("bigint"), (F.element_at("ords", -1) / block).cast("bigint")
    cut = moved.select("shard", "field", "term", "ords", F.explode(F.sequence(*number)).alias("block")).select(
        "shard", "field", "term", "block",
        F.filter("ords", lambda o: (o >= F.col("block") * block) & (o < (F.col("block") + 1) * block)).alias("ords"))
    whole = cut.where("size(ords) > 0").groupBy("shard", "field", "term", "block").agg(
        F.sort_array(F.flatten(F.collect_list("ords"))).alias("ords"))
    return whole.select("shard", "field", "term", "block", F.size("ords").alias("df"), "ords")


def term_stats(terms: DataFrame) -> DataFrame:
    """(field, term, df): documents per term, from ``document_term_sets``.

    A document has a term once there, so a plain count does, which combines on the map side.
    """
    return terms.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def field_stats(posting_blocks: DataFrame) -> DataFrame:
    """(field, terms, postings, max_df) from posting blocks.

    Blocks are first summed per term, then per field; both steps combine on the map side,
    so a field that all documents have is no hot group.
    """
    per_term = posting_blocks.groupBy("field", "term").agg(F.sum("df").alias("df"))
    return per_term.groupBy("field").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("df").alias("postings"),
        F.max("df").alias("max_df"))


def field_docs(entries: DataFrame) -> DataFrame:
    """(field, docs): documents that have the field, from one row per (document, field)."""
    return entries.groupBy("field").agg(F.count(F.lit(1)).alias("docs"))
