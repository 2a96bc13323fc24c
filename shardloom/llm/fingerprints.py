"""Document fingerprints from prefix polynomial hashes.

A text's prefix array of a polynomial in its code points gives the hash of any span by two
lookups, so span equality is one comparison and the longest common extension of two places
a binary search over it.  The fingerprint keeps, for each of ``SLOTS`` slots, the smallest
hash of the spans of ``SPAN`` code points that fall into the slot; an empty slot repeats the
nearest slot before it.  The share of equal slots estimates the overlap of two span sets
(Jaccard), from which the likeness, the common share of the two texts, follows.  The edited
text shares the first half of the prefix array of its document.

Defined cases: a null text is empty; texts under ``SPAN`` code points have one span, the
whole text; two empty texts have likeness 1, an empty and another text 0; rows that share a
``doc_id`` are neighbours in the order of their text's hash; rows without ``doc_id`` come
first; the next of the last document is the first, so a single document is its own next; an
empty table gives no rows; other columns are not looked at.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import stored, table, texts

SLOTS, SPAN = 64, 12
MODULUS = (1 << 31) - 1  # a prime; products of two residues fit 64 bits
BASES = (1_000_003, 998_244_353)
BUCKETS = 4  # of the ordered documents, for each shuffle partition


class Prefixes:
    """Prefix arrays of one text under two bases."""

    powers: list[np.ndarray] = [np.ones(1, np.uint64) for _ in BASES]

    def __init__(self, points: np.ndarray, head: "Prefixes | None" = None, shared: int = 0):
        """``points``: code points; the first ``shared`` are those of ``head``."""
        self.points = points
        n = len(points)
        if len(Prefixes.powers[0]) <= n:
            Prefixes.powers = [_powers(base, max(2 * n, 1 << 16)) for base in BASES]
        tail = points[shared:].astype(np.uint64) + np.uint64(1)
        self.sums = []
        for k, power in enumerate(Prefixes.powers):
            terms = tail * power[shared:n] % np.uint64(MODULUS)
            before = head.sums[k][:shared + 1] if head is not None else np.zeros(1, np.uint64)
            # a sum of 2**32 residues still fits 64 bits; kept unreduced
            self.sums.append(np.concatenate((before, before[-1] + np.cumsum(terms, dtype=np.uint64))))

    def span(self, start, length):
        """Hash of ``length`` code points from ``start`` on (arrays or numbers), comparable
        between texts that have at most ``len(powers)`` code points."""
        out = np.uint64(0)
        for k, (sums, power) in enumerate(zip(self.sums, Prefixes.powers)):
            inside = (sums[np.add(start, length)] - sums[start]) % np.uint64(MODULUS)
            shift = power[len(power) - 1 - np.asarray(start)]
            out = out << np.uint64(31) | inside * shift % np.uint64(MODULUS)
        return out

    def spans(self, length: int) -> np.ndarray:
        n = len(self.points) - length + 1
        out = np.zeros(n, np.uint64)
        for sums, power in zip(self.sums, Prefixes.powers):
            inside = (sums[length:] - sums[:n]) % np.uint64(MODULUS)
            out = out << np.uint64(31) | inside * power[::-1][:n] % np.uint64(MODULUS)
        return out


def _powers(base: int, size: int) -> np.ndarray:
    out = np.ones(size + 1, np.uint64)
    done, step = 1, base
    while done <= size:  # doubling: the next run is the run so far times base**done
        more = min(done, size + 1 - done)
        out[done:done + more] = out[:more] * np.uint64(step) % np.uint64(MODULUS)
        step = step * step % MODULUS
        done += more
    return out


def equal(a: Prefixes, i: int, b: Prefixes, j: int, length: int) -> bool:
    """Whether two spans of the texts are equal."""
    return bool(a.span(i, length) == b.span(j, length))


def extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """The longest common extension from place ``i`` of one text and ``j`` of the other."""
    low, high = 0, min(len(a.points) - i, len(b.points) - j)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if equal(a, i, b, j, middle) else (low, middle - 1)
    return low


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _absolute(prefixes: Prefixes) -> np.ndarray:
    """Span hashes that do not depend on the place of the span or on the power table."""
    n = len(prefixes.points)
    if not n:
        return np.zeros(0, np.uint64)
    length = min(SPAN, n)
    out = np.zeros(n - length + 1, np.uint64)
    for k, (sums, base) in enumerate(zip(prefixes.sums, BASES)):
        inside = (sums[length:] - sums[:n - length + 1]) % np.uint64(MODULUS)
        back = _inverse_powers(k, n)[:n - length + 1]
        out = out << np.uint64(31) | inside * back % np.uint64(MODULUS)
    return out


_inverses: dict[int, np.ndarray] = {}


def _inverse_powers(k: int, n: int) -> np.ndarray:
    if k not in _inverses or len(_inverses[k]) < n:
        _inverses[k] = _powers(pow(BASES[k], -1, MODULUS), max(2 * n, 1 << 16))
    return _inverses[k]


def sketch(hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """The smallest hash of each slot; empty slots repeat the nearest one before, around."""
    out = np.full(slots, np.iinfo(np.uint64).max, np.uint64)
    if len(hashes):
        mixed = _mixed(hashes)
        slot = (mixed >> np.uint64(58)).astype(np.int64) * slots >> 6
        low = mixed & np.uint64((1 << 58) - 1)
        order = np.argsort(mixed)  # by slot, and by hash inside it
        first = np.append(True, np.diff(slot[order]) != 0)
        out[slot[order][first]] = low[order][first]
        full = np.flatnonzero(out != np.iinfo(np.uint64).max)
        nearest = full[np.searchsorted(full, np.arange(slots), "right") - 1]
        out = out[nearest]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated common share of two texts, from the share of equal slots."""
    same = float(np.mean(a == b))
    return 2 * same / (1 + same)


def _name(slots: np.ndarray) -> str:
    return "".join(f"{int(x) & 0xFFFFFFFF:08x}" for x in slots)


def with_next(docs: DataFrame) -> DataFrame:
    """Documents in buckets by id, each bucket with the first document of the next one.

    Bucket borders are quantiles of the ids, so a bucket holds about as many documents as
    any other; the first document of a bucket is read a second time as the last of the
    bucket before.  ``bucket, copy, doc_id, tie, text``, to be read in this order.
    """
    rows = texts(docs).withColumn("tie", F.xxhash64("text"))
    spark = docs.sparkSession
    many = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.percentile_approx("doc_id", [i / many for i in range(1, many)], 20 * many)).first()[0]
    borders = sorted(set(found or []))
    bucket = F.lit(0)
    if borders:
        edges = F.array(*[F.lit(b).cast("long") for b in borders])
        bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(
            F.size(F.filter(edges, lambda b: b <= F.col("doc_id"))))
    heads = (rows.select("doc_id", "tie", bucket.alias("bucket")).groupBy("bucket")
             .agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "tie")).alias("head")).collect())
    if not heads:
        return rows.select(F.lit(0).alias("bucket"), F.lit(False).alias("copy"), "doc_id", "tie", "text", F.lit(False).alias("only"))
    heads = sorted((r["bucket"], r["head"]["doc_id"], r["head"]["tie"]) for r in heads)  # a row per bucket
    back = spark.createDataFrame(
        [(here[1], here[2], heads[i - 1][0]) for i, here in enumerate(heads)], "id long, tie long, before int")
    placed = rows.withColumn("bucket", bucket)
    copies = (rows.join(F.broadcast(back.withColumnRenamed("tie", "other")),
                        F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("other")))
              .select(F.col("before").alias("bucket"), F.lit(True).alias("copy"), "doc_id", "tie", "text"))
    return placed.select("bucket", F.lit(False).alias("copy"), "doc_id", "tie", "text").unionByName(copies)


SHAPE = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double, shared_start long")


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is the start of
    the next document, and their likeness; ``shared_start``: the code points with which
    the text and the next one begin alike."""
    def points(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, out = None, []
        for batch in batches:
            for bucket, copy, name, text in zip(batch["bucket"], batch["copy"], batch["doc_id"], batch["text"]):
                if held is not None and held[0] == bucket and not held[4]:
                    out.append(_row(held, text, points))
                    held = (bucket, name, text, out[-1][1], copy)
                    out[-1] = out[-1][0]
                else:
                    held = (bucket, name, text, None, copy)
                if len(out) >= 200:
                    yield pd.DataFrame(out, columns=[c.split()[0] for c in SHAPE.split(", ")]).astype({"doc_id": "Int64"})
                    out = []
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SHAPE.split(", ")]).astype({"doc_id": "Int64"})

    by = ["bucket", "copy", "doc_id", "tie"]
    return with_next(docs).repartition("bucket").sortWithinPartitions(*by).select(*by, "text").mapInPandas(run, SHAPE)


def _row(held, following: str, points):
    """The result row of a document, and what the next one can use again."""
    _, name, text, known, _ = held
    here, slots = known if known is not None else _sketched(text, points)
    after, next_slots = _sketched(following, points)
    half = len(text) // 2
    edited = text[:len(text) - half] + following[:half]
    changed = Prefixes(points(edited), here, len(text) - half)
    edited_slots = sketch(_absolute(changed))
    common = extension(here, 0, after, 0)
    row = (None if pd.isna(name) else int(name), len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(),
           _name(slots), _name(edited_slots), likeness(slots, edited_slots), likeness(slots, next_slots), common)
    return row, (after, next_slots)


def _sketched(text: str, points):
    prefixes = Prefixes(points(text))
    return prefixes, sketch(_absolute(prefixes))


def fingerprint_query(spark, sf_dir):
    """op7: fingerprints of all ``documents``."""
    return compare(table(spark, sf_dir, "documents"))
