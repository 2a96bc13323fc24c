"""Placement hashes: stateless, the same in every SQL engine and on every retry."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _hex_bucket(value: Column, start: int, buckets: int | Column) -> Column:
    number = F.conv(F.substring(F.md5(value), start, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def shard_of(routing: Column, num_shards: int | Column) -> Column:
    return _hex_bucket(routing.cast("string"), 1, num_shards)


def segment_of(doc_id: Column, segments: int | Column) -> Column:
    # other hash digits than the shard, so segments stay even inside one shard
    return _hex_bucket(doc_id.cast("string"), 9, segments)
