"""Dedup of repeated passages by sparse suffix arrays.

Suffixes are retained only at minimiser positions: of every ``SPAN`` following ``GRAM``-word
prefixes the one with the smallest hash.  Any passage of ``LENGTH = GRAM + SPAN - 1`` words
contains such a position, and equal passages contain the same one.  A first pass counts the
prefixes; those that occur again go into a bit map of fixed size, and the second pass keeps
only suffixes in it.  These are sorted by their prefix, and around each the match is extended
to the left and right: the passages of ``LENGTH`` words that hold the position are compared
with those of the suffixes sorted beside it, each through prefix hashes of the text.
Comparing two adjacent suffixes only would lose a match where a third with a longer right
side stands between them, so all that share a prefix are compared.  A prefix of more than
``GROUP`` suffixes is spread over tasks by passage, with the counts combined before they
move; both ways give the same rows.  Texts are not moved until they are cut.

Hashes are polynomials over the XXH64 of whole words, so runs of ``LENGTH`` words have equal
hashes only if the words' own 64-bit hashes collide.

A passage that occurs more than once is repeated; its first occurrence is the one with the
smallest (doc_id, place), and the words of every other occurrence are marked.

Defined cases: words are separated by ASCII white space and compared byte by byte; a null
text is empty; texts under ``LENGTH`` words have no passages; very long texts are read
whole; rows that share ``doc_id`` and text are one document; a null ``doc_id`` comes before
all others (it stands as the smallest long inside); an empty table gives no rows; other
columns are not looked at.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import BitMap, modest_batches, stored, table, whole_groups
from shardloom.llm.tokens import forget

LENGTH, GRAM = 50, 16
SPAN = LENGTH - GRAM + 1
GROUP = 20_000  # suffixes with one prefix that a task compares by itself: some 15 MB of hashes
NOBODY = -1 << 63  # stands for a null doc_id
BASE = 0x9E3779B97F4A7C15  # odd, so powers have inverses modulo 2**64
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
KEYS = ["doc_id", "print"]
PLACE = np.uint64((1 << 31) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """Prefix hashes over the words of a text: the hash of any run of words in one step."""

    powers = np.ones(1, np.uint64)
    backs = np.ones(1, np.uint64)

    def __init__(self, text: str):
        words = text.encode("utf-8", "replace").split()
        self.words = n = len(words)
        if len(Hashed.powers) <= n:
            size = max(n + 1, 1 << 16)
            Hashed.powers = np.cumprod(np.append(np.uint64(1), np.full(size, BASE, np.uint64)))
            inverse = np.uint64(pow(BASE, -1, 1 << 64))
            Hashed.backs = np.cumprod(np.append(np.uint64(1), np.full(size, inverse, np.uint64)))
        line = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
        self.prefix = np.append(np.uint64(0), np.cumsum(line * Hashed.powers[:n], dtype=np.uint64))

    def runs(self, length: int) -> np.ndarray:
        """The hash of every run of ``length`` words, by first word."""
        if self.words < length:
            return np.zeros(0, np.uint64)
        n = self.words - length + 1
        return _mixed((self.prefix[length:] - self.prefix[:n]) * Hashed.backs[:n])


def _slide(x: np.ndarray, size: int, least) -> np.ndarray:
    """``least`` over every ``size`` neighbours, by doubling."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x = least(x[:-step], x[step:])
        done += step
    return x


def retained(grams: np.ndarray, span: int = SPAN) -> np.ndarray:
    """For every ``span`` following grams the place of the leftmost smallest one."""
    if len(grams) < span:
        return np.zeros(0, np.int64)
    place = np.arange(len(grams), dtype=np.uint64)
    ranked = grams & ~PLACE | place  # ties of the upper bits go to the left, in every text alike
    return (_slide(ranked, span, np.minimum) & PLACE).astype(np.int64)


def repeated_grams(docs: DataFrame) -> DataFrame:
    """``hash``: the prefixes that more than one retained suffix has, counted in tasks first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for batch in batches:
            some = [np.zeros(0, np.uint64)]
            for text in batch["text"]:
                grams = Hashed(text).runs(GRAM)
                some.append(grams[np.unique(retained(grams))])
            found, n = np.unique(np.concatenate(some), return_counts=True)
            yield pd.DataFrame({"hash": found.view(np.int64), "n": n})
    counted = _keyed(docs).select("text").mapInPandas(run, "hash long, n long")
    return counted.groupBy("hash").agg(F.sum("n").alias("n")).filter("n > 1").select("hash")


def _joined(run):
    """Fewer, larger frames for Arrow."""
    def wrapped(batches):
        held, size = [], 0
        for frame in run(batches):
            held.append(frame)
            size += len(frame)
            if size >= 20_000:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)
    return wrapped


def _id(doc_id: str = "doc_id"):
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NOBODY))


def _keyed(docs: DataFrame) -> DataFrame:
    modest_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(_id().alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text"))


def passages(docs: DataFrame) -> DataFrame:
    """``gram, doc_id, print, first, hashes``: for each retained suffix that may have a
    neighbour the hashes of the passages whose position it is; the first begins at ``first``.
    Rows that share ``doc_id`` and text give the same rows again."""
    wanted = BitMap(stored(repeated_grams(docs), "grams"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, print_, text in zip(batch["doc_id"], batch["print"], batch["text"]):
                hashed = Hashed(text)
                grams = hashed.runs(GRAM)
                at = retained(grams)
                if not len(at):
                    continue
                begins = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                ends = np.append(begins[1:], len(at))
                keep = wanted.has(grams[at[begins]])
                if not keep.any():
                    continue
                whole = hashed.runs(LENGTH).view(np.int64)
                yield pd.DataFrame({
                    "gram": grams[at[begins[keep]]].view(np.int64), "doc_id": name, "print": print_,
                    "first": begins[keep].astype(np.int32),
                    "hashes": [whole[a:b] for a, b in zip(begins[keep], ends[keep])]})

    return _keyed(docs).mapInPandas(_joined(run), "gram long, doc_id long, print long, first int, hashes array<long>")


MARKED = "doc_id long, print long, first int, last int, original boolean"


def _runs(name: np.ndarray, print_: np.ndarray, place: np.ndarray, original: np.ndarray) -> pd.DataFrame:
    """Neighbouring marked passages of a document as runs of words."""
    if not len(place):  # of the types the others have: a frame of floats would round the hashes beside it
        return pd.DataFrame({c.split()[0]: np.zeros(0, bool if "boolean" in c else np.int64) for c in MARKED.split(", ")})
    order = np.lexsort((place, original, print_, name))
    name, print_, place, original = name[order], print_[order], place[order], original[order]
    new = np.append(True, (np.diff(name) != 0) | (np.diff(print_) != 0) | (np.diff(original.astype(int)) != 0) | (np.diff(place) > 1))
    at = np.flatnonzero(new)
    to = np.append(at[1:], len(place)) - 1
    return pd.DataFrame({"doc_id": name[at], "print": print_[at], "first": place[at],
                         "last": place[to] + LENGTH, "original": original[at]})


def matches(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``doc_id, print, first, last, original``: runs of words ``[first, last)`` of repeated
    passages; ``original`` where they are first occurrences."""
    rows = stored(passages(docs), "passages")
    sizes = stored(rows.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > group), "sizes").select("gram")
    small, large = rows.join(sizes, "gram", "left_anti"), rows.join(sizes, "gram", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in whole_groups(batches, ["gram"]):
            lengths = batch["hashes"].map(len).to_numpy()
            name, print_ = (np.repeat(batch[k].to_numpy(np.int64), lengths) for k in KEYS)
            begin = np.cumsum(lengths) - lengths
            place = np.repeat(batch["first"].to_numpy(np.int64) - begin, lengths) + np.arange(lengths.sum())
            hashes = np.concatenate(batch["hashes"].to_list())
            order = np.lexsort((place, print_, name, hashes))  # neighbours in hash order are equal passages
            hashes, name, print_, place = hashes[order], name[order], print_[order], place[order]
            once = np.append(True, (np.diff(place) != 0) | (print_[1:] != print_[:-1]) | (name[1:] != name[:-1]) | (hashes[1:] != hashes[:-1]))
            hashes, name, print_, place = hashes[once], name[once], print_[once], place[once]
            head = np.append(True, hashes[1:] != hashes[:-1])
            again = ~head | np.append(~head[1:], False)
            if again.any():
                yield _runs(name[again], print_[again], place[again], head[again])

    small = small.repartition("gram").sortWithinPartitions("gram").mapInPandas(_joined(run), MARKED)
    single = large.select(*KEYS, F.posexplode("hashes").alias("step", "hash"), "first").select(
        *KEYS, "hash", (F.col("first") + F.col("step")).alias("place"))
    at = F.struct("doc_id", "print", "place")
    least = stored(single.groupBy("hash").agg(F.min(at).alias("least"), F.max(at).alias("most"))
                   .filter("least <> most").drop("most"), "hot")
    hot = single.join(least, "hash").select(
        *KEYS, "place", (F.struct("doc_id", "print", "place") == F.col("least")).alias("original"))

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield _runs(*(batch[k].to_numpy() for k in (*KEYS, "place", "original")))

    return small.unionByName(hot.mapInPandas(close, MARKED))


def spans(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``doc_id, print, first, last, original``: maximal runs of repeated words, one row for
    each run of first occurrences and of later ones."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = ["doc_id", "print", "original"]
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            keys = rows[by].to_numpy(np.int64)
            new = np.append(True, (keys[1:] != keys[:-1]).any(1))
            owner = np.cumsum(new)
            first, last = rows["first"].to_numpy(np.int64), rows["last"].to_numpy(np.int64)
            shift = owner * (1 << 40)  # a later owner's runs are beyond all earlier ones
            reach = np.maximum.accumulate(last + shift)
            new[1:] |= (first + shift)[1:] > reach[:-1]
            at = np.flatnonzero(new)
            to = np.append(at[1:], len(rows)) - 1
            out = rows.iloc[at].assign(last=(reach - shift)[to].astype(np.int32))
            yield out.iloc[:-1]
            held = out.iloc[-1:]
        if held is not None:
            yield held

    by = ["doc_id", "print", "original", "first"]
    return matches(docs, group).repartition("doc_id", "print").sortWithinPartitions(*by).mapInPandas(run, MARKED)


def without(text: str, spans_: list[tuple[int, int]]) -> str:
    """The text without the words ``[first, last)`` of the spans and the white space after each."""
    raw = text.encode("utf-8", "replace")
    at = [m.span() for m in WORD.finditer(raw)]
    out, end = [], 0
    for first, last in sorted(spans_):
        begin = at[first][0]
        if begin > end:
            out.append(raw[end:begin])
        end = max(end, at[last][0] if last < len(at) else len(raw))
    out.append(raw[end:])
    return b"".join(out).decode("utf-8")


def drop_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``docs`` without the later occurrences of repeated passages; ``n_chars`` follows the
    text, and a document of which no word is left goes."""
    later = stored(spans(docs, group).filter("not original").groupBy(*KEYS)
                   .agg(F.collect_list(F.struct("first", "last")).alias("cut")), "cuts")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), _id().alias("doc_id"), F.xxhash64(text).alias("print"))

    @F.pandas_udf("string")
    def cut_out(column: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([without(t, [(c["first"], c["last"]) for c in some]) for t, some in zip(column, cuts)], dtype=object)

    met = rows.join(later.hint("merge"), KEYS, "left")  # the same way at every size
    same = met.filter("cut is null").select("row.*")
    new = met.filter("cut is not null").withColumn("left", cut_out("row.text", "cut")).filter(F.length(F.trim("left")) > 0)
    changed = F.col("row").withField("text", F.col("left"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withField("n_chars", F.length("left").cast(kind))
    return same.unionByName(new.select(changed.alias("row")).select("row.*"))


def repeats_query(spark, sf_dir):
    """op9: the repeated passages of all ``documents``, first and later occurrences."""
    found = spans(table(spark, sf_dir, "documents"))
    return found.select(F.when(F.col("doc_id") != NOBODY, F.col("doc_id")).alias("doc_id"), F.col("first").cast("long").alias("first_word"),
                        F.col("last").cast("long").alias("end_word"), "original")
