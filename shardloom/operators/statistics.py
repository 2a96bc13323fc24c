"""Field statistics that merge: exact counts and sketches of terms, per segment.

A segment's statistics are made once, from its postings.  Those of any set of segments, of a
shard, an index or several indexes follow from them alone: document and posting counts add
up, and the distinct terms are the union of sketches, whose size is fixed.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# 2^16 registers: distinct terms within 2 % far beyond three standard errors (0.4 %); up to
# 64 KB a field and segment, and less where a field has few terms
SKETCH_BITS = 16


def segment_statistics(blocks: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """(shard, segment, field, postings, max_df, terms, sketch) from posting blocks.

    ``terms`` and ``max_df`` are exact for the segment.  Blocks are summed per term first;
    both steps combine on the map side.
    """
    keys = ["shard", "segment", "field"]
    per_term = blocks.groupBy(*keys, "term").agg(F.sum("df").cast("bigint").alias("df"))
    return per_term.groupBy(*keys).agg(
        F.sum("df").alias("postings"), F.max("df").alias("max_df"), F.count(F.lit(1)).alias("terms"),
        F.hll_sketch_agg("term", bits).alias("sketch"))


def merged_statistics(statistics: DataFrame, keys: tuple[str, ...] = ("field",)) -> DataFrame:
    """(*keys, segments, postings, max_segment_df, terms) of all segments in ``statistics``.

    ``postings`` is exact.  ``terms`` is the estimate of the united sketches, held between
    what is certain: at least the terms of the richest segment, at most those of all segments
    together; so it is exact where one segment has the field.  ``max_segment_df`` is the
    largest number of documents that a term has in one segment.
    """
    found = statistics.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("segments"), F.sum("postings").alias("postings"),
        F.max("max_df").alias("max_segment_df"), F.max("terms").alias("_least"), F.sum("terms").alias("_most"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("_about"))
    terms = F.greatest("_least", F.least("_about", "_most"))
    return found.select(*keys, "segments", "postings", "max_segment_df", terms.alias("terms"))
