"""Packing into windows by non-negative least squares over shallow length combinations.

Documents are cut only where they exceed the window: whole windows first, then one rest.
The histogram of the rests has at most ``WINDOW - 1`` lengths whatever the number of
documents, so it alone is planned on the driver: all pairs and triples of present lengths
that fill a window exactly (and near-fills for lengths without an exact one) are columns
of a non-negative least-squares problem whose right side is the histogram.  Its solution is
rounded by running sums: each column gets the whole numbers that the sum of all columns up
to it passes, so that many small shares of alike columns add up to a repeat here and there
and none is lost.  What is left of the histogram is packed greedily, largest first, a
pattern as often as it goes.  The plan has at most a row per length of a column, a number
that the window bounds.  A rest finds its
place from its rank among the rests of its length; ranks are counted in salted parts, so
that a length which very many documents share is spread over tasks.

Defined cases: a null or empty text is the single end id; rows that share ``doc_id`` are
packed as separate documents; a null ``doc_id`` is kept as null; an empty table gives no
rows; other columns are not looked at.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import stored, table, texts
from shardloom.llm.tokens import MOST, SMALL, encoder, release, slices, tokenizer_path

WINDOW, END = 2048, 1
PART = 512  # ranks are counted in parts of about so many pieces of one length
SHAPE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, piece long"


def pieces(docs: DataFrame, window: int = WINDOW, path: str | None = None, most: int = MOST) -> DataFrame:
    """Each document's ids in pieces of at most ``window``: full ones, then the rest."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            found, names = batch["text"].tolist(), batch["doc_id"].tolist()
            for a, b in slices(found, SMALL):
                rows = []
                for name, raw in zip(names[a:b], encoder(path, True, most).encode(found[a:b])):
                    raw += end
                    view, total = memoryview(raw), len(raw) // 4
                    rows += [(name, at, min(window, total - at), zlib.crc32(view[4 * at:4 * (at + window)]), total)
                             for at in range(0, total, window)]
                yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).astype(
                    {"doc_id": "Int64"})
                release()

    shape = SHAPE.removesuffix(", piece long")
    return texts(docs).mapInPandas(run, shape).withColumn("piece", F.monotonically_increasing_id())


def fills(lengths: np.ndarray, window: int) -> np.ndarray:
    """Combinations of two or three of the lengths (0: none) that fill the window exactly;
    for a length in no such pair or triple, the best pair."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    small = lengths[2 * lengths <= window]
    pairs = small[have[window - small]]
    found = [np.stack([window - pairs, pairs, np.zeros_like(pairs)], 1)]
    for c in lengths[3 * lengths <= window]:
        b = lengths[(lengths >= c) & (2 * lengths <= window - c)]
        b = b[have[window - c - b]]
        found.append(np.stack([window - c - b, b, np.full_like(b, c)], 1))
    found = np.concatenate(found)
    used = np.zeros(window + 1, bool)
    used[found.ravel()] = True
    alone = lengths[~used[lengths]]
    place = np.searchsorted(lengths, window - alone, "right") - 1
    fit = place >= 0
    near = np.stack([alone[fit], lengths[place[fit]], np.zeros_like(alone[fit])], 1)
    return np.concatenate([found, near])


def solve(columns: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts ``x >= 0`` with least squared ``A x - counts``, by accelerated
    projected gradients; ``A`` is kept as the lengths of each column."""
    size = len(counts)

    def times(x):
        out = np.zeros(size)
        for k in range(columns.shape[1]):
            out += np.bincount(columns[:, k], x, size)
        out[0] = 0
        return out

    def turned(y):
        y = y.copy()
        y[0] = 0
        return y[columns].sum(1)

    if not len(columns):
        return np.zeros(0)
    v = np.ones(len(columns))
    for _ in range(20):  # largest eigenvalue of A'A
        v = turned(times(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(columns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - turned(times(y) - counts) / (1.02 * norm))
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y, x = new + (last - 1) / t * (new - x), new
    return x


def rounded(columns: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """Whole repeats with the sum of ``repeats``, in order of the columns' lengths, so that
    what one column loses goes to one that is like it."""
    order = np.lexsort(columns.T[::-1])
    whole = np.zeros(len(columns), np.int64)
    whole[order] = np.diff(np.floor(np.cumsum(repeats[order]) + 1e-6), prepend=0)
    return whole


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Rows ``length, first, count, sequence, offset``: the pieces of that length with
    ranks from ``first`` on lie at ``offset`` of the sequences from ``sequence`` on."""
    counts = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    lengths = np.flatnonzero(counts)
    columns = fills(lengths, window)
    repeats = solve(columns, counts.astype(float))
    left, taken = counts.copy(), np.zeros(window + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def put(pattern: list[int], times: int) -> None:
        nonlocal sequence
        offset = 0
        for length in pattern:
            rows.append((length, int(taken[length]), times, sequence, offset))
            taken[length] += times
            left[length] -= times
            offset += length
        sequence += times

    def most(pattern: list[int]) -> int:
        return min(int(left[length]) // pattern.count(length) for length in set(pattern))

    whole = rounded(columns, repeats)
    for i in np.flatnonzero(whole):
        pattern = [int(c) for c in columns[i] if c]
        if times := min(int(whole[i]), most(pattern)):
            put(pattern, times)
    while left.any():
        pattern, room = [], window
        spare = left.copy()
        while room and (fit := np.flatnonzero(spare[:room + 1])).size:
            length = int(fit[-1])
            if pattern and len(fit) > 1:  # an exact pair for the room is better than the largest
                pair = fit[(fit <= room - fit) & (spare[np.maximum(room - fit, 0)] > 0)]
                if spare[room] == 0 and len(pair) and (2 * pair[-1] != room or spare[pair[-1]] > 1):
                    length = room - int(pair[-1])
            pattern.append(length)
            spare[length] -= 1
            room -= length
        put(pattern, most(pattern))
    return rows


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None, most: int = MOST) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece; a
    worker remembers the ids of ``most`` pieces of words, which bounds its memory."""
    cut = stored(pieces(docs, window, path, most), "pieces")
    whole = cut.filter(F.col("length") == window).select(
        "*", (2 * F.col("piece") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rests = cut.filter(F.col("length") < window)
    histogram = {r["length"]: r["count"] for r in rests.groupBy("length").count().collect()}
    placed = plan(histogram, window)
    spark = docs.sparkSession
    shares = spark.createDataFrame([(k, -(-n // PART)) for k, n in histogram.items()], "length long, parts long")
    parted = rests.join(F.broadcast(shares), "length").withColumn("part", F.pmod(F.xxhash64("piece"), F.col("parts")))
    parts = parted.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(parts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "bases")
    inside = Window.partitionBy("length", "part").orderBy("piece")
    ranked = (parted.withColumn("rank", F.row_number().over(inside) - 1).join(bases, ["length", "part"])
              .select(*[c.split()[0] for c in SHAPE.split(", ")], (F.col("rank") + F.col("base")).alias("rank")))
    ordered = np.array(sorted(placed), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(ordered)  # bounded by the window

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = shared.value
        keys = rows[:, 0] << 48 | rows[:, 1]
        for batch in batches:
            rank = batch["rank"].to_numpy()
            at = np.searchsorted(keys, batch["length"].to_numpy() << 48 | rank, "right") - 1
            yield batch.drop(columns="rank").assign(
                sequence_id=2 * (rows[at, 3] + rank - rows[at, 1]), offset=rows[at, 4])

    fitted = ranked.mapInPandas(run, SHAPE + ", sequence_id long, offset long")
    return whole.unionByName(fitted).drop("piece")


def packing_query(spark, sf_dir):
    """op3: all ``documents`` packed into sequences of at most 2048 ids."""
    return pack(table(spark, sf_dir, "documents"))
