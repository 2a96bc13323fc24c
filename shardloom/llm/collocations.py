"""Phrase collocations by best-first branch and bound over prefixes.

A phrase that starts with word ``w`` scores at most ``1000 n / f(w)``: its first cut has
``l = f(w)``, and no phrase occurs more often than its rest.  So the frequent words of a
language are a frontier ordered by an admissible bound.  Each round expands the best part
of it, words of up to ``STEP`` times the count of those before, to phrases of 2, 3, 4 and 5
words; a prefix that occurs fewer than ``LEAST`` times is not grown.  The ``TOP``-th best
surviving score of each language cuts the frontier: once no word left has a bound of at
least that score (so that ties are settled too), the language is done.  Counts of the rests
that the frontier has not reached are taken in one more pass.

The texts are read twice: to count words, and to store their runs of frequent words, which
every later pass reads.  Words that are not frequent and prefixes that are not being grown
are passed over by a bit map of fixed size (``BITS``), whatever the vocabulary; it can only
let too much through, and joins with the exact tables follow.  Counts are combined over
a million words or more in a task before they are shuffled.  A candidate lies inside a
longer one of equal count exactly if all its occurrences have the same left neighbour or
the same right neighbour, so neighbours are counted (as 64-bit hashes) with the phrase, and
nothing longer has to be expanded to see that it goes.

Defined cases: a null text is empty, a null language is ``und``; rows repeated count again;
a very long text is read whole; ties are ordered by count, then by the phrase's bytes; an
empty table gives no rows; other columns, ``doc_id`` included, are not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import modest_batches, stored, table

LEAST, TOP, LONGEST, STEP = 100, 2000, 5, 64
BITS = 1 << 24
CHARS = 8_000_000  # characters after which a task gives out its counts
BREAK = 0
FOLDED = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
COUNTED = "lang string, phrase string, a long, left_min long, left_max long, right_min long, right_max long"


def _encoded(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The different words, and the texts as their places from 1; 0 parts the pieces.

    Words are found on the bytes of all texts at once and numbered by Arrow's dictionary.
    """
    line = "\n".join(texts).encode("utf-8", "replace").lower().translate(FOLDED)
    raw = np.frombuffer(line, np.uint8)
    ends = raw == 10
    gap = ends | (raw == 32)
    edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
    first, last = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    if not len(first):
        return [], np.zeros(1, np.int32)
    offsets = np.append(0, np.cumsum(last - first))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~gap])])
    found = words.dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(ends), first)
    before = np.cumsum(np.append(True, piece[1:] != piece[:-1]))  # breaks before each word
    coded = np.zeros(len(first) + int(before[-1]) + 1, np.int32)
    coded[np.arange(len(first)) + before] = found.indices.to_numpy() + 1
    return [w.decode("utf-8", "replace") for w in found.dictionary.to_pylist()], coded


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, list[str], np.ndarray]]:
    """Encoded texts of one language, many words at a time."""
    held, size = {}, 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= CHARS:
                yield from ((lang, *_encoded(some)) for lang, some in held.items())
                held, size = {}, 0
    yield from ((lang, *_encoded(some)) for lang, some in held.items())


def _hashes(words: list[str]) -> np.ndarray:
    """The hash of each word by its place."""
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) for w in ["", *words]), np.uint64, len(words) + 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def _grown(start: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of its prefix and its last word."""
    return _mixed(start * np.uint64(0x9E3779B97F4A7C15) + word)


def _origin(lang: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(lang.encode("utf-8", "replace"), 1)], np.uint64)


def _phrase_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = np.zeros(len(batch), np.uint64)
        for i, (lang, phrase) in enumerate(zip(batch["lang"], batch["phrase"])):
            done = _origin(lang)
            for word in phrase.split(" "):
                done = _grown(done, np.array([xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))], np.uint64))
            out[i] = done[0]
        yield pd.DataFrame({"hash": out.view(np.int64)})


class BitMap:
    """A set of phrases as a bit map of fixed size; it may hold more than was put in."""

    def __init__(self, phrases: DataFrame):
        modest_batches(phrases.sparkSession)
        rows = phrases.select("lang", "phrase").mapInPandas(_phrase_hashes, "hash long")
        both = F.array(F.col("hash").bitwiseAND(F.lit(BITS - 1)), F.shiftrightunsigned("hash", 40).bitwiseAND(F.lit(BITS - 1)))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(64)).cast("int"))
        found = (rows.select(F.explode(both).alias("bit")).groupBy(F.shiftright("bit", 6).alias("at"))
                 .agg(F.bit_or(bit).alias("set")).toPandas())  # at most BITS / 64 rows
        bits = np.zeros(BITS >> 6, np.uint64)
        bits[found["at"].to_numpy(np.int64)] = found["set"].to_numpy(np.int64).view(np.uint64)
        self.shared = phrases.sparkSession.sparkContext.broadcast(np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        bits, last = self.shared.value, np.uint64(BITS - 1)
        return bits[hashes & last] & bits[(hashes >> np.uint64(40)) & last]

    def __getstate__(self):
        return {"shared": self.shared}


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    return order, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(key) else np.zeros(0, np.int64)


def _counts(lang: str, words: list[str], hashes: np.ndarray, coded: np.ndarray, at: np.ndarray, size: int) -> pd.DataFrame:
    """The phrases of ``size`` words that begin ``at``, with their number and neighbours."""
    key = coded[at].astype(np.int64)
    for k in range(1, size):
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key << 32 | coded[at + k]
    order, starts = _groups(key)
    at = at[order]
    first = at[starts]
    parts = [[words[i - 1] for i in coded[first + k]] for k in range(size)]
    out = {"lang": lang, "phrase": list(map(" ".join, zip(*parts))), "a": np.diff(np.append(starts, len(at)))}
    for side, beside in (("left", coded[at - 1]), ("right", coded[at + size])):
        seen = hashes[beside].view(np.int64)
        out[f"{side}_min"] = np.minimum.reduceat(np.where(beside == BREAK, LOW, seen), starts)
        out[f"{side}_max"] = np.maximum.reduceat(np.where(beside == BREAK, HIGH, seen), starts)
    return pd.DataFrame(out)


def frequent_runs(corpus: DataFrame, frequent: BitMap) -> DataFrame:
    """``lang, words, coded``: the texts with nothing left but runs of frequent words; rare
    words end a run like the end of a piece, and words that stand alone are left out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, words, coded in _chunks(batches):
            good = frequent.has(_grown(_origin(lang), _hashes(words)))
            good[BREAK] = False
            fresh = np.where(good, np.cumsum(good), BREAK).astype(np.int32)[coded]
            held = fresh != BREAK
            beside = np.append(False, held[:-1]) | np.append(held[1:], False)
            held &= beside
            after = np.append(False, held[:-1])
            fresh[~held] = BREAK
            fresh = np.append(np.int32(BREAK), fresh[held | after])
            yield pd.DataFrame({"lang": [lang], "words": [[w for w, g in zip(words, good[1:]) if g]],
                                "coded": [np.append(fresh, np.int32(BREAK)).tobytes()]})
    return corpus.mapInPandas(run, "lang string, words array<string>, coded binary")


def _passed(runs: DataFrame, sizes: range, wanted: BitMap, whole: bool) -> DataFrame:
    """Counts of the phrases of ``sizes`` words whose prefix is wanted; or, if ``whole``,
    that are wanted themselves."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, words, raw in zip(batch["lang"], batch["words"], batch["coded"]):
                coded, words = np.frombuffer(raw, np.int32), list(words)
                hashes = _hashes(words)
                at = np.flatnonzero(coded)
                done = _grown(_origin(lang), hashes)[coded[at]]
                for size in range(2, sizes.stop):
                    if size in sizes and not whole:
                        keep = wanted.has(done)
                        at, done = at[keep], done[keep]
                    added = coded[at + size - 1]
                    keep = added != BREAK
                    at, done = at[keep], _grown(done[keep], hashes[added[keep]])
                    if size in sizes:
                        some = at[wanted.has(done)] if whole else at
                        if len(some):
                            yield _counts(lang, words, hashes, coded, some, size)

    found = runs.mapInPandas(run, COUNTED).groupBy("lang", "phrase")
    ends = [F.min(f"{side}_min").alias(f"{side}_min") for side in ("left", "right")]
    ends += [F.max(f"{side}_max").alias(f"{side}_max") for side in ("left", "right")]
    return found.agg(F.sum("a").alias("a"), *ends)


def word_counts(corpus: DataFrame) -> DataFrame:
    """``lang, phrase, a``: the number of each word, and of all under the empty phrase."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for lang, words, coded in _chunks(batches):
            number = np.bincount(coded, minlength=1)
            number[BREAK] = 0
            yield pd.DataFrame({"lang": lang, "phrase": ["", *words], "a": np.append(number.sum(), number[1:])})
    return corpus.mapInPandas(run, "lang string, phrase string, a long").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def _counted(runs: DataFrame, sizes: range, wanted: DataFrame, whole: bool, least: int) -> DataFrame:
    """The stored counts of ``_passed`` of at least ``least``."""
    conf = runs.sparkSession.conf
    rows = _passed(runs, sizes, BitMap(wanted), whole).filter(F.col("a") >= least)
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # a row holds very many words
    rows = stored(rows, "counted")
    modest_batches(runs.sparkSession)
    return rows


def _score(a: str, n: str, left: str, right: str) -> Column:
    """``floor(1000 a n / (l r))`` in whole numbers of up to 38 digits."""
    a, n, left, right = (f"cast({x} as decimal(19,0))" for x in (a, n, left, right))
    return F.expr(f"(cast(1000 as decimal(4,0)) * {a} * {n}) div ({left} * {right})")


def _grow(runs: DataFrame, tier: DataFrame, least: int, longest: int) -> list[DataFrame]:
    """Levels of phrases from the words of ``tier``: counts, neighbours and ``ls``, the
    counts of the proper prefixes."""
    level = tier.select("lang", "phrase", "a", F.array().cast("array<long>").alias("ls"))
    levels = []
    for size in range(2, longest + 1):
        if level.isEmpty():
            break
        counts = _counted(runs, range(size, size + 1), level, False, least)
        before = level.select("lang", F.col("phrase").alias("prefix"), F.concat("ls", F.array("a")).alias("ls"))
        split = F.split("phrase", " ")
        level = stored(counts.withColumn("prefix", F.array_join(F.slice(split, 1, size - 1), " "))
                       .join(before, ["lang", "prefix"]).drop("prefix"), "level")
        levels.append(level)
    return levels


def _surviving(level: DataFrame, longest: int) -> DataFrame:
    """Phrases that no longer one of equal count holds."""
    held = (F.col("left_min") == F.col("left_max")) | (F.col("right_min") == F.col("right_max"))
    return level.filter((F.size("ls") == longest - 1) | ~held).select("lang", "phrase", "a", "ls")


def _best(rows: DataFrame, top: int) -> DataFrame:
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(first).cast("long")).filter(F.col("rank") <= top)


def _limits(best: DataFrame, top: int) -> DataFrame:
    return best.filter(F.col("rank") == top).select("lang", F.col("score").alias("limit"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, step: int = STEP) -> DataFrame:
    """The ``top`` best phrases of each language."""
    modest_batches(docs.sparkSession)
    corpus = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = stored(word_counts(corpus).filter((F.col("a") >= least) | (F.col("phrase") == "")), "words")
    total = counts.filter("phrase = ''").select("lang", F.col("a").alias("n"))
    words = stored(counts.filter("phrase <> ''").join(total, "lang").withColumn("bound", F.expr("1000 * n div a")), "frontier")
    runs = stored(frequent_runs(corpus, BitMap(words)), "runs")
    known = words.select("lang", "phrase", "a")
    shape = "lang string, phrase string, a long, l long, r long, n long, score long, rank long"
    best = docs.sparkSession.createDataFrame([], shape)
    reached = least
    while True:
        ahead = words.filter(F.col("a") >= reached).join(_limits(best, top), "lang", "left").filter("limit is null or bound >= limit")
        if ahead.isEmpty():
            return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        tier = stored(ahead.filter(F.col("a") < reached * step).select("lang", "phrase", "a"), "tier")
        reached *= step
        levels = _grow(runs, tier, least, longest)
        if levels:
            for level in levels:
                known = known.unionByName(level.select("lang", "phrase", "a"))
            best = _scored(runs, levels, known, total, words, best, least, top, longest)


def _scored(runs, levels, known, total, words, best, least, top, longest) -> DataFrame:
    """``best`` with the phrases of a round; only those that can still enter are scored."""
    found = _surviving(levels[0], longest)
    for level in levels[1:]:
        found = found.unionByName(_surviving(level, longest))
    split = F.split("phrase", " ")
    last = words.select("lang", F.col("phrase").alias("last"), F.col("a").alias("f"))
    found = (found.withColumn("last", F.element_at(split, -1)).join(last, ["lang", "last"]).join(total, "lang")
             .withColumn("score", _score("a", "n", "element_at(ls, -1)", "f"))  # of the last cut: none scores higher
             .select("lang", "phrase", "a", "ls", "n", "score", F.col("f").alias("r")))
    found = stored(found, "found")
    pairs = found.filter(F.size("ls") == 1).select("lang", "phrase", "a", F.element_at("ls", 1).alias("l"), "r", "n", "score")
    shape = [c for c in best.columns if c != "rank"]
    best = stored(_best(best.select(*shape).unionByName(pairs.select(*shape)), top), "best")
    longer = stored(found.filter(F.size("ls") > 1).join(_limits(best, top), "lang", "left")
                    .filter("limit is null or score >= limit").select("lang", "phrase", "a", "ls", "n"), "longer")
    if longer.isEmpty():
        return best
    cut = F.transform("ls", lambda left, i: F.struct((i + 1).alias("k"), left.alias("l"), F.array_join(
        F.slice(split, i + 2, F.size("ls") + 1), " ").alias("rest")))
    cuts = stored(longer.select("lang", "phrase", "a", "n", F.explode(cut).alias("c")).select("lang", "phrase", "a", "n", "c.*"), "cuts")
    missing = stored(cuts.select("lang", F.col("rest").alias("phrase")).distinct().join(known, ["lang", "phrase"], "left_anti"), "rests")
    if not missing.isEmpty():
        counted = _counted(runs, range(2, longest), missing, True, least).select("lang", "phrase", "a")
        known = known.unionByName(counted.join(missing, ["lang", "phrase"], "left_semi"))
    rests = known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    lowest = F.min(F.struct(_score("a", "n", "l", "r").alias("score"), "k", "l", "r")).alias("cut")
    scored = (cuts.join(rests, ["lang", "rest"]).groupBy("lang", "phrase", "a", "n").agg(lowest)
              .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    return stored(_best(best.select(*shape).unionByName(scored.select(*shape)), top), "best")


def collocation_query(spark, sf_dir):
    """op11: the best phrases of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


COLLOCATION_SQL = f"""
WITH pieces AS (SELECT row_number() OVER () AS p, lang, piece FROM (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)),
places AS (SELECT p, lang, words, unnest(range(1, len(words) + 1)) AS i FROM (SELECT p, lang,
    list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces)),
totals AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
grams AS (SELECT lang, k, words[i:i + k - 1] AS g FROM places, range(1, {LONGEST + 1}) sizes(k) WHERE i + k - 1 <= len(words)),
counts AS (SELECT lang, k, g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
cuts AS (SELECT c.lang, c.g, c.k AS size, c.a, j AS k, l.a AS l, r.a AS r, n, (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
    FROM counts c JOIN totals USING (lang), range(1, {LONGEST}) cut(j)
    JOIN counts l ON l.lang = c.lang AND l.g = c.g[1:j] JOIN counts r ON r.lang = c.lang AND r.g = c.g[j + 1:]
    WHERE j < c.k),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
held AS (SELECT DISTINCT s.lang, s.g FROM counts s JOIN counts w ON w.lang = s.lang AND w.k > s.k AND 100 * w.a >= 100 * s.a
    AND (w.g[1:s.k] = s.g OR w.g[2:s.k + 1] = s.g OR w.g[3:s.k + 2] = s.g OR w.g[4:s.k + 3] = s.g)),
ranked AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM lowest ANTI JOIN held USING (lang, g))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked QUALIFY rank <= {TOP}
"""
