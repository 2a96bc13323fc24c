"""Helpers shared by the training-data operators: inputs, stored tables, components."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.session import prepare, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def modest_batches(spark: SparkSession) -> None:
    """Texts are long: a batch for Python holds at most a thousand."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, whatever else the table holds; a null text is empty."""
    modest_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again.

    Cuts the lineage, survives lost executors, and gives later joins plain scans, whose
    exchanges adaptive execution can split when a key is hot.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class BitMap:
    """A set of 64-bit hashes as a bit map of fixed size, for use inside tasks.

    It may hold more than was put in, never less, so an exact step has to follow.  At most
    ``bits / 64`` rows come to the driver, whatever the table holds.
    """

    def __init__(self, hashes: DataFrame, bits: int = 1 << 26):
        self.last = np.uint64(bits - 1)
        both = F.array(*[F.shiftrightunsigned("hash", by).bitwiseAND(F.lit(bits - 1)) for by in (0, 32)])
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(64)).cast("int"))
        found = (hashes.select(F.explode(both).alias("bit")).groupBy(F.shiftright("bit", 6).alias("at"))
                 .agg(F.bit_or(bit).alias("set")).toPandas())
        packed = np.zeros(bits >> 6, np.uint64)
        packed[found["at"].to_numpy(np.int64)] = found["set"].to_numpy(np.int64).view(np.uint64)
        self.shared = hashes.sparkSession.sparkContext.broadcast(packed)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        packed, out = self.shared.value, np.ones(len(hashes), bool)
        for by in (0, 32):
            bit = (hashes >> np.uint64(by)) & self.last
            out &= (packed[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def fold(doc_id: str, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus``."""
    return F.crc32(F.col(doc_id).cast("string")) % modulus


def group_starts(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """The first row of each group of rows that are sorted by ``keys``."""
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for key in keys:
        column = rows[key].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of sorted rows cut so that no group lies in two of them."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        cut = int(group_starts(rows, keys)[-1])
        if cut:
            yield rows.iloc[:cut]
        rest = rows.iloc[cut:]
    if rest is not None:
        yield rest


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that the edges ``a, b`` reach from each node.

    Each round merges every node with the first of itself and its neighbours, by id at first
    and then by a hash of the round, and keeps the distinct edges between what is left: a
    quarter of the nodes at least goes on average, so the rounds grow with the logarithm of
    the nodes and together join few more rows than there are edges.  Every round is stored:
    joins then read plain tables, and a node with very many edges can be split.
    """
    links = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links, steps = stored(links.distinct(), "edges"), []
    while not links.isEmpty():
        def place(name, turn=len(steps)):
            return F.struct((F.xxhash64(name, F.lit(turn)) if turn else F.lit(0)).alias("hash"), F.col(name).alias("node"))
        both = links.union(links.select("b", "a"))
        step = both.groupBy("a").agg(F.min(place("b")).alias("first")).select(
            F.col("a").alias("node"), F.least("first", place("a"))["node"].alias("root"))
        steps.append(step := stored(step, "labels"))
        low, high = (step.select(F.col("node").alias(x), F.col("root").alias(y)) for x, y in (("a", "low"), ("b", "high")))
        moved = links.join(low, "a").join(high, "b").filter("low <> high")
        links = stored(moved.select(F.least("low", "high").alias("a"), F.greatest("low", "high").alias("b")).distinct(), "edges")
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = steps.pop()
    while steps:
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = stored(steps.pop().join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "labels")
    least = stored(labels.groupBy("root").agg(F.min("node").alias("least")), "least")
    return labels.join(least, "root").select("node", F.col("least").alias("root"))
