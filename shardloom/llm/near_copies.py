"""Near copies of a five-word Jaccard of 0.8 or more: the near-dedup stage of the pipeline.

Texts are sets of hashed five-word shingles (fewer words: the whole sequence); texts with
equal sets are one node.  A node has a SimHash of 256 bits over its set, of which two sets of
Jaccard 0.8 differ in 39 on average with a standard deviation of 6; no choice of equal pieces
finds such pairs, so blocks are keys of ``ROWS`` minima of the set under ``BANDS`` seeds: a
link shares one with a probability of 1 - (1 - 0.8 ** ROWS) ** BANDS, which is 0.99999.  A
block is compared as vertical bit planes: seven planes at a time go through carry-save adders
into seven counters for 64 fingerprints a machine word, and words are abandoned once all 64
distances exceed ``RADIUS``.  Only a spanning tree of a block's links is given out, from its
smallest ids, so that the blocks of a group give the same links.  What
these links join is then compared by the exact Jaccard of the sets: a breadth-first walk
tests each node reached against the nodes not reached yet, so a tight group costs one pass.
Blocks and groups over ``BLOCK`` rows or ``CHUNK`` shingles are cut into chunks, each pair of
chunks being a block of its own, so no task holds an unbounded group; a block of two chunks
gives only links between what either chunk links by itself.

Defined cases: null, empty and blank texts have one and the same set and are near copies of
each other; a very long text is one set of 8 bytes a shingle and is never cut; texts that
differ in case of A-Z or white space alone are near copies; ``doc_id`` may repeat or be null;
an empty table gives no rows; other columns are kept and not looked at.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import BitMap, components, group_starts, stored, texts, whole_groups
from shardloom.llm.simhash import LITTLE, ONES, SEED, one_of_each, tree

WORDS, SIMILARITY = 5, (4, 5)  # shingles of five words; a Jaccard of 4/5
BITS, RADIUS, ROWS, BANDS = 256, 72, 5, 30
BLOCK, CHUNK, NODE = 4096, 1 << 20, 256  # fingerprints a block; shingles a chunk, of which a node counts NODE more
_draw = np.random.default_rng(SEED)
FACTORS, TERMS = _draw.integers(0, 1 << 64, (2, ROWS * BANDS, 1), np.uint64)
FACTORS |= np.uint64(1)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of all word shingles in ascending order."""
    found = text.encode("utf-8", "replace").lower().split()
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), SEED)], np.uint64)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[:len(found) - words + 1].tolist(), ends[words - 1:].tolist())
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans), np.uint64,
                                 len(found) - words + 1))


def mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(31))


def marks(some: np.ndarray) -> tuple[bytes, list[int]]:
    """The fingerprint of a set, majorities of ``BITS`` bits, and its block keys."""
    counts = np.zeros(BITS, np.int64)
    least = np.full(ROWS * BANDS, ONES)
    seeds = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for part in range(0, len(some), 2048):
        piece = some[part:part + 2048]
        words = mixed(piece[:, None] + seeds)
        counts += np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        least = np.minimum(least, (FACTORS * piece + TERMS).min(1))
    bits = np.packbits((2 * counts > len(some)).astype(np.uint8), bitorder="little").tobytes()
    bands = least.reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), number) for number, band in enumerate(bands)]
    return bits, np.array(keys, np.uint64).view(np.int64).tolist()


def planes(prints: np.ndarray) -> np.ndarray:
    """``BITS`` bit planes of fingerprints of bytes, padded to whole words."""
    bits = np.zeros((BITS, -(-len(prints) // 64) * 64), np.uint8)
    bits[:, :len(prints)] = np.unpackbits(prints, axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _add(a, b, c):
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def far(vertical: np.ndarray, asked: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """``over[i, w]``: which of the 64 fingerprints of word w differ in more than ``radius``
    (below 128) bits from the one whose bits, as whole words, are ``asked[:, i]``."""
    shape = (asked.shape[1], vertical.shape[1])
    over = np.zeros(shape, np.uint64)
    live, seen = np.arange(shape[1]), np.zeros(shape, np.uint64)
    start = 127 - radius  # a counter passes 127 once the distance exceeds the radius
    counters = [np.full(shape, ONES if start >> k & 1 else 0, np.uint64) for k in range(7)]
    for first in range(0, BITS, 7):
        seven = vertical[first:first + 7, live][:, None, :] ^ asked[first:first + 7, :, None]
        p = [*seven, *[np.zeros_like(seen)] * (7 - len(seven))]
        one, carry_a = _add(*p[:3])
        two, carry_b = _add(*p[3:6])
        low, carry_c = _add(one, two, p[6])
        middle, high = _add(carry_a, carry_b, carry_c)
        carry = np.zeros_like(low)
        for k, bit in enumerate((low, middle, high)):
            counters[k], carry = _add(counters[k], bit, carry)
        for k in range(3, 7):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        seen |= carry
        if first // 7 % 4 == 3:
            stay = (seen != ONES).any(0)
            if not stay.all():
                over[:, live[~stay]] = ONES
                live, seen, counters = live[stay], seen[:, stay], [c[:, stay] for c in counters]
                if not len(live):
                    return over
    over[:, live] = seen
    return over


def near(prints: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Packed matrix: bit j of row i says that fingerprints i and j are within the radius."""
    n, vertical = len(prints), planes(prints)
    spare = np.packbits(np.arange(vertical.shape[1] * 64) >= n, bitorder="little").view(np.uint64)
    whole = np.unpackbits(prints, axis=1, bitorder="little").T.astype(np.uint64) * ONES
    return np.concatenate([~(far(vertical, whole[:, at:at + 64], radius) | spare) for at in range(0, n, 64)])


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Which of the pairs are within the radius, 64 pairs to a machine word."""
    over = far(planes(a ^ b), np.zeros((BITS, 1), np.uint64), radius)
    return ~np.unpackbits(over[0].view(np.uint8), bitorder="little")[:len(a)].astype(bool)


def as_rows(prints: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(prints), np.uint8).reshape(-1, BITS // 8)


def same_groups(sets: list[np.ndarray], prints: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning tree of the links among the sets: a Jaccard of at least ``SIMILARITY``."""
    up, down = SIMILARITY
    size = np.array([len(s) for s in sets])
    close = near(prints) if len(sets) > LITTLE else np.full((len(sets), 1), ONES)
    unreached = np.ones(len(sets), bool)
    left, right = [], []
    for root in range(len(sets)):
        waiting = [root] if unreached[root] else []
        unreached[root] = False
        while waiting:
            at = waiting.pop()
            row = np.unpackbits(close[at].view(np.uint8), bitorder="little")[:len(sets)].astype(bool)
            fits = (np.minimum(size, size[at]) * down >= np.maximum(size, size[at]) * up)
            asked = np.flatnonzero(row & unreached & fits)
            if not len(asked):
                continue
            words = np.concatenate([sets[i] for i in asked])
            place = np.minimum(np.searchsorted(sets[at], words), size[at] - 1)
            starts = np.concatenate(([0], np.cumsum(size[asked])[:-1]))
            common = np.add.reduceat((sets[at][place] == words).astype(np.int64), starts)
            found = asked[common * down >= (size[at] + size[asked] - common) * up]
            unreached[found] = False
            waiting += found.tolist()
            left += [at] * len(found)
            right += found.tolist()
    return left, right


def across(find, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trees that ``find`` gives of the places of a block; in a block of two chunks (``own``)
    only links between the trees of either chunk, which the chunk's own block gives."""
    def heads(at):
        of = np.arange(len(at))
        left, right = found = tuple(np.asarray(x, np.int64) for x in find(at))
        for a, b in zip(left.tolist(), right.tolist()):
            of[b] = of[a]
        return at[of], found

    whole, found = heads(np.arange(len(own)))
    if (own == own[0]).all():
        return found
    alone = np.unique(np.concatenate([heads(np.flatnonzero(own == chunk))[0] for chunk in np.unique(own)]))
    alone = alone[whole[alone] != alone]
    return whole[alone], alone


def _chunked(rows: DataFrame, by: list[str], chunks) -> DataFrame:
    """``rows`` once for each pair of chunks that the own chunk is part of."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))
    return (rows.withColumn("own", F.pmod(F.xxhash64("id"), chunks)).withColumn("other", other)
            .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
            .repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by, "low", "high")
            .sortWithinPartitions(*by, "low", "high", "id"))


def candidates(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that join all of ``id, print, keys`` which share a key and lie within
    the radius, or chains of such."""
    rows = nodes.select("id", F.explode("keys").alias("key"))
    sizes = stored(rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "near-keys")
    met = rows.join(sizes, "key").join(nodes.select("id", "print"), "id")
    by = ["key", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, by):
            prints, ids, own = as_rows(rows["print"]), rows["id"].to_numpy(np.int64), rows["own"].to_numpy()
            starts = group_starts(rows, by)
            sizes = np.diff(np.append(starts, len(rows)))
            owner = np.repeat(np.arange(len(starts)), sizes)
            little = sizes[owner] <= LITTLE
            for step in range(1, LITTLE):  # pairs of little blocks, many blocks at a time
                a = np.flatnonzero(little[:-step] & (owner[:-step] == owner[step:]))
                if len(a):
                    a = a[near_pairs(prints[a], prints[a + step])]
                    yield pd.DataFrame({"a": ids[a], "b": ids[a + step]})
            for start, size in zip(starts[sizes > LITTLE], sizes[sizes > LITTLE]):
                block = prints[start:start + size]
                a, b = across(lambda at: tree(near(block[at]), len(at)), own[start:start + size])
                yield pd.DataFrame({"a": ids[start + a], "b": ids[start + b]})

    shape = _chunked(met, ["key"], F.ceil(F.col("size") / block)).select("id", "print", "own", *by)
    return shape.mapInPandas(run, "a long, b long")


def near_copy_roots(docs: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, digest, root`` of every row: rows whose texts chains of near copies join
    have the same ``root``; ``digest`` is the MD5 of the text."""
    held = texts(docs).select("doc_id", F.md5("text").alias("digest"), F.xxhash64("text").alias("hash"), "text")

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                some = shingles(text)
                rows.append((hashlib.md5(some.tobytes()).hexdigest(), len(some), *marks(some)))
            new = pd.DataFrame(rows, columns=["node", "size", "print", "keys"], index=batch.index)
            yield pd.concat([batch.drop(columns="text"), new], axis=1)

    known = "doc_id long, digest string, hash long"
    marked = stored(held.mapInPandas(mark, known + ", node string, size long, print binary, keys array<long>"), "near-marks")
    nodes = stored(marked.groupBy("node").agg(F.min_by(F.struct("hash", "size", "print", "keys"), "hash").alias("of"))
                   .select(F.monotonically_increasing_id().alias("id"), "node", "of.*"), "near-nodes")
    joined = components(candidates(nodes, block)).withColumnRenamed("node", "id").withColumnRenamed("root", "group")
    asked = stored(nodes.select("id", "hash", "node", "size", "print").join(joined, "id"), "near-asked")
    wanted = BitMap(asked.select("hash"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[wanted.has(batch["hash"].to_numpy(np.int64).view(np.uint64))]
            if not len(batch):  # columns of empty lists would be numbers
                continue
            sets = [shingles(text) for text in batch["text"]]
            yield pd.DataFrame({"hash": batch["hash"], "node": [hashlib.md5(s.tobytes()).hexdigest() for s in sets],
                                "shingles": [s.tobytes() for s in sets]})

    sets = held.select("hash", "text").mapInPandas(cut, "hash long, node string, shingles binary")
    weights = asked.groupBy("group").agg(F.sum(F.col("size") + NODE).alias("weight"))
    full = stored(sets.join(asked, ["hash", "node"]).groupBy("id", "group", "print")
                  .agg(F.first("shingles").alias("shingles")).join(weights, "group"), "near-sets")
    by = ["group", "low", "high"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, by):
            starts = group_starts(rows, by)
            for start, stop in zip(starts, np.append(starts[1:], len(rows))):
                some = rows.iloc[start:stop]
                ids = some["id"].to_numpy(np.int64)
                sets, prints = [np.frombuffer(s, np.uint64) for s in some["shingles"]], as_rows(some["print"])
                a, b = across(lambda at: same_groups([sets[i] for i in at], prints[at]), some["own"].to_numpy())
                yield pd.DataFrame({"a": ids[a], "b": ids[b]}, dtype=np.int64)

    pairs = _chunked(full, ["group"], F.ceil(F.col("weight") / chunk)).select("id", "print", "shingles", "own", *by)
    roots = components(pairs.mapInPandas(compare, "a long, b long")).withColumnRenamed("node", "id")
    named = nodes.select("id", "node").join(roots, "id", "left").select("node", F.coalesce("root", "id").alias("root"))
    return marked.select("doc_id", "digest", "node").join(named, "node").select("doc_id", "digest", "root")


def drop_near(docs: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with one row of each group of near copies, the one with the smallest ``doc_id``
    (rows without one last, then the smallest digest of the text)."""
    return one_of_each(docs, near_copy_roots(docs, block, chunk))
