"""SimHash near-dedup with bit-sliced comparison.

Fingerprints are cut into six pieces; two that differ in at most three bits agree in three
of them, so the twenty choices of three pieces (about 32 bits each) bring every link into
some block, and a block stays small at any number of documents.  A block is compared as
vertical bit planes: 64 fingerprints to a machine word, distances kept in carry-save
counters, words abandoned once all 64 distances exceed the radius.  Only a spanning tree
of a block's links is given out; blocks of a few fingerprints are compared many at a time,
64 pairs to a word.  A block over ``BLOCK`` fingerprints is cut into chunks,
and each pair of chunks is a block of its own.

Defined cases: a null or blank text has fingerprint zero and links like any other; equal
fingerprints are one node; a null ``doc_id`` is ignored when the smallest id is chosen; an
empty table gives no rows; other columns are not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import components, group_starts, stored, table, texts, whole_groups
from shardloom.llm.tokens import forget

RADIUS, WORDS, SEED, BLOCK, LITTLE = 3, 3, 42, 4096, 12
PIECES = (11, 11, 11, 11, 10, 10)
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, words: int = WORDS) -> int:
    """The majority of each bit over the hashes of all word shingles, repeats included."""
    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = min(words, len(found))
    spans = zip(starts[:len(found) - n + 1].tolist(), ends[n - 1:].tolist())
    hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 15):
        some = hashes[part:part + (1 << 15)]
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, print``: the fingerprint as a signed long; a column ``digest`` is kept."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in batch["text"]], np.uint64)
            yield batch.drop(columns="text").assign(print=prints.view(np.int64))
    kept = [f"{name} {kind}" for name, kind in docs.dtypes if name != "text"]
    return docs.mapInPandas(run, ", ".join([*kept, "print long"]))


def near(prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Packed matrix: bit j of row i says that fingerprints i and j differ in at most
    ``radius`` (below four) bits."""
    n = len(prints)
    width = -(-n // 64)
    bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.zeros((64, width * 64), np.uint8)
    planes[:, :n] = bits.T
    planes = np.packbits(planes, axis=1, bitorder="little").view(np.uint64)
    spare = np.zeros(width * 64, np.uint8)
    spare[n:] = 1
    spare = np.packbits(spare, bitorder="little").view(np.uint64)
    out = np.zeros((n, width), np.uint64)
    for first in range(0, n, 64):
        asked = bits[first:first + 64].astype(np.uint64) * ONES
        live = np.arange(width)
        low, high = np.zeros((2, len(asked), width), np.uint64)
        over = np.repeat(spare[None, :], len(asked), 0)
        for plane in range(64):
            bit = planes[plane, live][None, :] ^ asked[:, plane, None]
            carry = low & bit
            low ^= bit
            over |= high & carry
            high ^= carry
            if plane % 8 == 7:
                stay = (over != ONES).any(0)
                if not stay.all():
                    live, low, high, over = live[stay], low[:, stay], high[:, stay], over[:, stay]
                    if not len(live):
                        break
        if radius < 3:
            for value in range(radius + 1, 4):
                over |= (low if value & 1 else ~low) & (high if value & 2 else ~high)
        out[first:first + 64, live] = ~over
    return out


def near_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs differ in at most three bits, 64 pairs to a machine word."""
    n = len(a)
    bits = np.zeros((64, -(-n // 64) * 64), np.uint8)
    bits[:, :n] = np.unpackbits((a ^ b).view(np.uint8).reshape(-1, 8), axis=1).T
    planes = np.packbits(bits, axis=1).view(np.uint64)
    low, high, over = np.zeros((3, planes.shape[1]), np.uint64)
    for bit in planes:
        carry = low & bit
        low ^= bit
        over |= high & carry
        high ^= carry
    return np.unpackbits((~over).view(np.uint8))[:n].astype(bool)


def spanning(prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning tree of the links among the fingerprints, as two arrays of places."""
    return tree(near(prints, radius), len(prints))


def tree(links: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning tree of the links that a packed matrix of ``n`` rows gives."""
    fresh = np.packbits(np.pad(np.ones(n, np.uint8), (0, -n % 64)), bitorder="little").view(np.uint64)
    left, right = [], []
    done = np.zeros(n, bool)
    for root in range(n):
        if done[root]:
            continue
        reached = np.array([root])
        while len(reached):
            done[reached] = True
            fresh[reached >> 6] = np.packbits(
                np.pad(~done, (0, -n % 64)).reshape(-1, 64)[reached >> 6], axis=1, bitorder="little").view(np.uint64)[:, 0]
            found = np.bitwise_or.reduce(links[reached], axis=0) & fresh
            reached = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little")[:n])
            left.append(np.full(len(reached), root))
            right.append(reached)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def _masks() -> list[int]:
    shifts = np.concatenate(([0], np.cumsum(PIECES)))
    pieces = [((1 << size) - 1) << int(at) for size, at in zip(PIECES, shifts)]
    chosen = [sum(pieces[i] for i in some) for some in combinations(range(len(PIECES)), len(PIECES) - RADIUS)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in chosen]


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that join all fingerprints of the column ``print`` which chains of
    links join; the fingerprints must be distinct."""
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("print").bitwiseAND(F.lit(mask)).alias("key"))
                     for i, mask in enumerate(_masks())])
    rows = prints.select("print", F.explode(keys).alias("k")).select("print", "k.choice", "k.key")
    sizes = stored(rows.groupBy("choice", "key").agg(F.count("*").alias("size")).filter("size > 1"), "blocks")
    chunks = F.ceil(F.col("size") / block)
    own = F.pmod(F.xxhash64("print"), chunks)
    met = (rows.join(sizes, ["choice", "key"])
           .select("print", "choice", "key", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("other"))
           .select("print", "choice", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")))
    by = ["choice", "key", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, by):
            prints = rows["print"].to_numpy(np.int64)
            starts = group_starts(rows, by)
            sizes = np.diff(np.append(starts, len(rows)))
            owner = np.repeat(np.arange(len(starts)), sizes)
            little = sizes[owner] <= LITTLE
            for step in range(1, LITTLE):  # pairs of little blocks, many blocks at a time
                a = np.flatnonzero(little[:-step] & (owner[:-step] == owner[step:]))
                a = a[near_pairs(prints[a].view(np.uint64), prints[a + step].view(np.uint64))]
                yield pd.DataFrame({"a": prints[a], "b": prints[a + step]})
            for start, size in zip(starts[sizes > LITTLE], sizes[sizes > LITTLE]):
                block = prints[start:start + size]
                a, b = spanning(block.view(np.uint64))
                yield pd.DataFrame({"a": block[a], "b": block[b]})

    # as many tasks as the session says: the rows are few for the work they make
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.repartition(tasks, *by).sortWithinPartitions(*by).mapInPandas(run, "a long, b long")


def _roots(prints: DataFrame, block: int) -> DataFrame:
    """``print, first, root``: each fingerprint, its smallest id and one that names its component."""
    nodes = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("print"), block))
    placed = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root"))
    return stored(placed, "placed")


def near_groups(docs: DataFrame, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """One row per document: its fingerprint and the smallest id that links reach."""
    prints = stored(fingerprints(texts(docs), words), "prints")
    placed = _roots(prints, block)
    least = stored(placed.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = stored(placed.join(least, "root").select("print", "component_id"), "named")
    return prints.join(named, "print").select("doc_id", "print", "component_id")


def drop_near_copies(docs: DataFrame, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest ``doc_id``.

    A row is known by ``doc_id`` and its text's digest, so ids may repeat or be null; a
    component without any id keeps the row with the smallest digest.  Of rows equal in both
    one stays.  Texts are moved once, by this key.
    """
    held = texts(docs).withColumn("digest", F.md5("text"))
    prints = stored(fingerprints(held, words), "prints")
    return one_of_each(docs, prints.join(_roots(prints, block).select("print", "root"), "print"))


def one_of_each(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """``docs`` with one row of each ``root`` of ``placed``, whose ``doc_id, digest`` name a
    row: smallest id first, rows without id last, then the smallest digest."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("best")
    kept = stored(placed.groupBy("root").agg(best)
                  .select(F.coalesce("best.doc_id", F.lit(0)).alias("id"), "best.none", "best.digest"), "kept")
    key = ["id", "none", "digest"]
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                       F.col("doc_id").cast("long").isNull().alias("none"),
                       F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("digest"))
    first = Window.partitionBy(*key).orderBy(F.xxhash64(F.to_json("row")))
    named = rows.join(kept, key, "left_semi").withColumn("rank", F.row_number().over(first)).filter("rank = 1")
    return named.select("row.*")


def simhash_query(spark, sf_dir):
    """op8: fingerprints and components of all ``documents``."""
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
