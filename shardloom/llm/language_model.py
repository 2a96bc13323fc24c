"""LM scoring by a log-bilinear model trained in numpy with noise-contrastive estimation.

Outputs of the model are ``FREQUENT`` frequent words, the end of a text, and ``ENDINGS``
classes that hold all other words by their last two bytes.  From the ``CONTEXT`` words
before a place the model predicts by a sum of weighted embeddings; one batched matrix
product and a normalised exponential give the log-probability of the output, and a word of
a class then has its smoothed share of the class.  Together this is a distribution over
all words and, in each class, one unseen word.

The counts of all training words are taken over all training texts by a shuffle.  Weights
are learnt in one pass over all training texts, encoded with a byte per token, each part of
the table from a common start; the parts' weights are averaged by their numbers of words, for
``ROUNDS`` rounds.
The most frequent ``KNOWN`` words' counts go to every task (a fixed bound); the counts of
the other words meet their occurrences in a join.

Defined cases: a null text is empty and has one token, the end; a null ``doc_id`` belongs to
the training part; without training texts every count is zero; rows that share ``doc_id``
are scored apart; an empty table gives no rows; other columns are not looked at.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import fold, stored, table, texts

FREQUENT, ENDINGS, KNOWN = 127, 64, 100_000
SIZE, CONTEXT, NOISE, BATCH, ROUNDS, RATE, SEED = 16, 4, 48, 2048, 1, 0.15, 11
CACHE = 600_000  # words that a worker remembers before it starts anew
END = b""  # no word is empty


def words_of(text: str) -> list[bytes]:
    """The tokens: words with A-Z in lower case, then the end."""
    return [*text.encode("utf-8", "replace").lower().split(), END]


def word_hash(word: bytes) -> int:
    """64 bits that stand for the word in shuffles."""
    value = xxhash.xxh64_intdigest(word, 1)
    return value - (1 << 64) if value >> 63 else value


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


def counts(docs: DataFrame) -> DataFrame:
    """``hash, ending, n``: counts over the rows whose ``held_out`` is false."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[bytes, int] = {}
        for batch in batches:
            for text in batch["text"]:
                for word in words_of(text):
                    found[word] = found.get(word, 0) + 1
                if len(found) > CACHE:
                    yield frame(found)
                    found = {}
        if found:
            yield frame(found)

    def frame(found: dict[bytes, int]) -> pd.DataFrame:
        return pd.DataFrame({"hash": list(map(word_hash, found)), "ending": list(map(ending, found)),
                             "n": list(found.values())})

    rows = docs.filter("not held_out").select("text").mapInPandas(run, "hash long, ending int, n long")
    return rows.groupBy("hash", "ending").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The bounded part of the counts that every task has."""

    def __init__(self, tokens: int, words: int, known: list[tuple[int, int]], sums: dict[int, tuple[int, int]]):
        """``known``: hashes and counts, most frequent first; ``sums``: per ending the
        number of tokens and of words."""
        self.tokens, self.words = tokens, words
        end = word_hash(END)
        top = [h for h, _ in known if h != end][:FREQUENT]
        self.output = {h: i for i, h in enumerate([end, *top])}
        self.known = dict(known)
        self.outputs = FREQUENT + 1 + ENDINGS
        self.sums = sums

    def finish(self, endings: dict[int, int]) -> "Vocabulary":
        """Take the words with an output of their own out of the classes."""
        inside = np.zeros(ENDINGS)
        kinds = np.zeros(ENDINGS)
        for k, (n, v) in self.sums.items():
            inside[k], kinds[k] = n, v
        for h in self.output:
            if h in self.known:
                inside[endings[h]] -= self.known[h]
                kinds[endings[h]] -= 1
        self.below = np.log10(inside + 0.5 * (kinds + 1))
        self.unigram = np.full(self.outputs, 0.5)
        for h, i in self.output.items():
            self.unigram[i] += self.known.get(h, 0)
        self.unigram[FREQUENT + 1:] += inside
        self.unigram /= self.unigram.sum()
        return self


class Reader:
    """Words as places in arrays of what is known about them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.output, self.hashes = np.zeros((2, 1024), np.int64)
        self.count = np.zeros(1024)

    def _learn(self, words: list[bytes]) -> None:
        v, start = self.vocabulary, len(self.place)
        self.place.update(zip(words, range(start, start + len(words))))
        while len(self.count) < len(self.place):
            self.output, self.hashes, self.count = (np.concatenate((x, x)) for x in (self.output, self.hashes, self.count))
        for i, word in enumerate(words, start):
            h = word_hash(word)
            own = v.output.get(h)
            self.output[i] = FREQUENT + 1 + ending(word) if own is None else own
            self.hashes[i], self.count[i] = h, v.known.get(h, -1)

    def read(self, texts_: list[str]):
        """For all tokens: output, hash, count (-1 where it is not among the known); and the
        number of tokens of each text."""
        if len(self.place) > CACHE:
            self._clear()
        words, sizes = [], []
        for text in texts_:
            found = words_of(text)
            sizes.append(len(found))
            words += found
        self._learn(list(set(words).difference(self.place)))
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        return (self.output[at], self.hashes[at], self.count[at]), np.array(sizes, np.int64)


def contexts(output: np.ndarray, sizes: np.ndarray, blank: int) -> np.ndarray:
    """The ``CONTEXT`` outputs before each token of its text, nearest first."""
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(output))
    out = np.empty((len(output), CONTEXT), np.int64)
    for k in range(CONTEXT):
        before = place - k - 1
        out[:, k] = np.where(before >= starts, output[np.maximum(before, 0)], blank)
    return out


def _sums(places: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The sums of the rows that have the same place."""
    order = np.argsort(places, kind="stable")
    sorted_ = places[order]
    starts = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    out[sorted_[starts]] = np.add.reduceat(rows[order], starts)
    return out


class LogBilinear:
    """Embeddings of contexts ``e`` and of outputs ``q``, weights of places ``c``, biases ``b``."""

    def __init__(self, unigram: np.ndarray):
        draw = np.random.default_rng(SEED)
        m = len(unigram)
        self.e = draw.standard_normal((m + 1, SIZE)) * 0.1
        self.q = draw.standard_normal((m, SIZE)) * 0.1
        self.c = np.ones((CONTEXT, SIZE)) / CONTEXT
        self.b = np.log(unigram)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.e, self.q, self.c, self.b)])

    def load(self, values: np.ndarray) -> "LogBilinear":
        at = 0
        for name in "eqcb":
            shape = getattr(self, name).shape
            size = int(np.prod(shape))
            setattr(self, name, values[at:at + size].reshape(shape))
            at += size
        return self

    def log_probabilities(self, before: np.ndarray, outputs: np.ndarray, rows: int = 4096) -> np.ndarray:
        """Normalised natural log-probabilities of the outputs, by batched matrix products."""
        e, c = self.e.astype(np.float32), self.c.astype(np.float32)
        q, b = np.ascontiguousarray(self.q.T, np.float32), self.b.astype(np.float32)
        moved = [e * c[k] for k in range(CONTEXT)]
        longest = sum(np.sqrt((m.astype(float) ** 2).sum(1)).max() for m in moved)
        # no sum can overflow: no need to move the largest to zero
        safe = longest * np.sqrt((self.q ** 2).sum(1)).max() + np.abs(self.b).max() < 60
        out = np.empty(len(outputs))
        for at in range(0, len(outputs), rows):
            some = before[at:at + rows]
            r = moved[0][some[:, 0]]
            for k in range(1, CONTEXT):
                r = r + moved[k][some[:, k]]
            s = r @ q
            s += b
            if not safe:
                s -= s.max(1, keepdims=True)
            chosen = s[np.arange(len(s)), outputs[at:at + rows]].astype(float)
            np.exp(s, out=s)
            out[at:at + rows] = chosen - np.log(s.sum(1).astype(float))
        return out

    def learn(self, before: np.ndarray, outputs: np.ndarray, unigram: np.ndarray, draw, squares: list[np.ndarray]) -> None:
        """One pass of noise-contrastive estimation; noise is shared inside a batch."""
        m = len(unigram)
        log_noise = np.log(NOISE * unigram).astype(np.float32)
        steps = np.cumsum(unigram)
        before, outputs = before.T.astype(np.int16), outputs.astype(np.int16)  # small numbers sort fast
        for at in range(0, len(outputs), BATCH):
            some, right = np.ascontiguousarray(before[:, at:at + BATCH]), outputs[at:at + BATCH]
            n = len(right)
            wrong = np.minimum(np.searchsorted(steps, draw.random(NOISE)), m - 1).astype(np.int16)
            q, b = self.q.astype(np.float32), self.b.astype(np.float32) - log_noise
            moved = (self.e * self.c[:, None, :]).astype(np.float32)
            r = moved[0][some[0]]
            for k in range(1, CONTEXT):
                r += moved[k][some[k]]
            q_right, q_wrong = q[right], q[wrong]
            good = np.einsum("ij,ij->i", r, q_right) + b[right]
            bad = r @ q_wrong.T + b[wrong]
            g_good = 1 / (1 + np.exp(-np.clip(good, -30, 30))) - 1
            g_bad = 1 / (1 + np.exp(-np.clip(bad, -30, 30)))
            dr = g_good[:, None] * q_right + g_bad @ q_wrong
            dq = _sums(np.concatenate((right, wrong)), np.concatenate((g_good[:, None] * r, g_bad.T @ r)), m)
            db = np.bincount(right, g_good, m) + np.bincount(wrong, g_bad.sum(0), m)
            seen = np.stack([_sums(some[k], dr, m + 1) for k in range(CONTEXT)])
            dc = (seen * self.e).sum(1)
            de = (seen * self.c[:, None, :]).sum(0)
            for value, gradient, square in zip((self.e, self.q, self.c, self.b), (de, dq, dc, db), squares):
                gradient = gradient / n
                square += gradient * gradient
                value -= RATE * gradient / (np.sqrt(square) + 1e-4)


def vocabulary(counted: DataFrame) -> Vocabulary:
    """The bounded part of the counts: totals, the ``KNOWN`` most frequent words, and the
    sums of each ending."""
    per = counted.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    step = F.floor(F.log2("n") * 16)  # of the counts; the steps are few whatever the counts
    least, room = 10 ** 6, KNOWN
    for row in sorted(counted.groupBy(step.alias("step")).agg(F.count("*").alias("v")).collect(), reverse=True):
        room -= row["v"]
        if room < 0:
            break
        least = row["step"]
    top = counted.filter(step >= least).select("hash", "n", "ending").toPandas().sort_values(
        ["n", "hash"], ascending=[False, True])  # at most KNOWN rows
    sums = {r["ending"]: (r["n"], r["v"]) for r in per}
    found = Vocabulary(sum(n for n, _ in sums.values()), sum(v for _, v in sums.values()),
                       list(zip(top["hash"].tolist(), top["n"].tolist())), sums)
    return found.finish(dict(zip(top["hash"].tolist(), top["ending"].tolist())))


def encoded(docs: DataFrame, shared) -> DataFrame:
    """``row, doc_id, held_out`` and what the counts tell of every text, read once.

    ``outputs``: a byte per token; ``n_known`` and ``logs``: number of known words and the
    sum of log10(count + 0.5) over the words every task knows; ``inner``: the sum of the
    log shares of classes without counts of the others, whose hashes are ``far_hash``."""
    @F.pandas_udf("outputs binary, n_tokens long, n_known long, logs double, inner double, "
                  "far_hash array<long>, far_n array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader, below = Reader(shared.value), shared.value.below

        def some(texts_: list[str]) -> pd.DataFrame:
            (output, hashes, count), sizes = reader.read(texts_)
            starts = np.cumsum(sizes) - sizes
            here = count >= 0
            logs = np.where(here, np.log10(np.maximum(count, 0) + 0.5), 0.0)
            inner = np.where(output > FREQUENT, logs - below[np.maximum(output - FREQUENT - 1, 0)], 0.0)
            add = lambda x: np.add.reduceat(x, starts)
            line, away = output.astype(np.uint8).tobytes(), ~here
            far = [np.unique(hashes[a:a + n][away[a:a + n]], return_counts=True) for a, n in zip(starts, sizes)]
            return pd.DataFrame({
                "outputs": [line[a:a + n] for a, n in zip(starts.tolist(), sizes.tolist())], "n_tokens": sizes,
                "n_known": add((count > 0).astype(np.int64)), "logs": add(logs), "inner": add(inner),
                "far_hash": [h for h, _ in far], "far_n": [n for _, n in far]})

        for batch in batches:
            found = batch.tolist()
            yield pd.concat([some(found[at:at + 64]) for at in range(0, len(found), 64)], ignore_index=True)

    rows = docs.select("doc_id", "held_out", run("text").alias("e")).select("doc_id", "held_out", "e.*")
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "encoded")


def _outputs(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens' outputs, and the number of tokens of each text."""
    return np.frombuffer(b"".join(lines), np.uint8).astype(np.int64), np.fromiter(map(len, lines), np.int64, len(lines))


def fit(rows: DataFrame, shared) -> LogBilinear:
    """Average the weights that the parts of the encoded training texts learn from a common start."""
    model = LogBilinear(shared.value.unigram)
    parts = rows.filter("not held_out").select("outputs")
    for turn in range(ROUNDS):
        start = rows.sparkSession.sparkContext.broadcast(model.flat())

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = LogBilinear(shared.value.unigram).load(start.value.copy())
            squares = [np.full_like(x, 1e-6) for x in (own.e, own.q, own.c, own.b)]
            draw, total = np.random.default_rng(SEED + turn), 0
            for batch in batches:
                for at in range(0, len(batch), 64):
                    output, sizes = _outputs(batch["outputs"].iloc[at:at + 64].tolist())
                    order = draw.permutation(len(output))
                    before = contexts(output, sizes, len(shared.value.unigram))
                    own.learn(before[order], output[order], shared.value.unigram, draw, squares)
                    total += len(output)
            if total:
                values = own.flat()
                yield pd.DataFrame({"place": np.arange(len(values)), "sum": values * total, "n": float(total)})

        found = (parts.mapInPandas(run, "place long, sum double, n double")
                 .groupBy("place").agg((F.sum("sum") / F.sum("n")).alias("value")).orderBy("place").collect())
        if not found:
            break
        model.load(np.array([r["value"] for r in found]))
    return model


def scored(docs: DataFrame) -> DataFrame:
    """One row per document of ``doc_id, held_out, text``: sizes, base score and model score."""
    spark = docs.sparkSession
    counted = stored(counts(docs), "counts")
    v = vocabulary(counted)
    shared = spark.sparkContext.broadcast(v)
    rows = encoded(docs, shared)
    model = spark.sparkContext.broadcast(fit(rows, shared))

    @F.pandas_udf("double")
    def steps(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        blank = len(shared.value.unigram)

        def some(lines: list[bytes]) -> np.ndarray:
            output, sizes = _outputs(lines)
            found = model.value.log_probabilities(contexts(output, sizes, blank), output) / math.log(10)
            return np.add.reduceat(found, np.cumsum(sizes) - sizes)

        for batch in batches:
            lines = batch.tolist()
            yield pd.Series(np.concatenate([some(lines[at:at + 64]) for at in range(0, len(lines), 64)]))

    far = rows.select("row", F.explode(F.arrays_zip("far_hash", "far_n")).alias("f")).select(
        "row", F.col("f.far_hash").alias("hash"), F.col("f.far_n").alias("times"))
    # a word that is in no training text has no count
    met = far.join(counted.select("hash", "n"), "hash", "left")
    sums = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("far_logs"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("far_known"))
    zero = F.lit(0.0)
    below = math.log10(v.tokens + 0.5 * (v.words + 1))
    named = stored(rows.drop("far_hash", "far_n").withColumn("steps", steps("outputs")).drop("outputs"), "scored")
    return named.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("far_logs", zero) - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        (F.col("steps") + F.col("inner") + F.coalesce("far_logs", zero)).alias("score"))


def score_table(docs: DataFrame, modulus: int = 5, held: int = 1) -> DataFrame:
    """Scores of all texts by a model of those whose id's crc32 modulo ``modulus`` is not ``held``."""
    return scored(texts(docs).withColumn("held_out", F.coalesce(fold("doc_id", modulus) == held, F.lit(False))))


def language_model_query(spark, sf_dir):
    """op10: scores of all ``documents``."""
    return score_table(table(spark, sf_dir, "documents"))
