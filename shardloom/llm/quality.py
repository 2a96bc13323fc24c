"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``WORDS`` words.  Each passage is described by the
shares of character classes and of their neighbour pairs, and by how much it repeats
itself; an encoder layer, gated attention and the output layer are learnt together from
the labels of whole documents.  The score of a document is that of the attention-weighted
mean of all its encoded passages.

The fit takes at most ``SAMPLE`` labelled documents, those with the smallest hash of their
id, one row of each id (the smallest text), and of these, in that order, all that fit in
``BYTES`` of text; these two bounds are parameters.  It reads them whole, as scoring does.
Scoring reads every passage of every text and needs no shuffle: the weights have a fixed
size.  Label, language, source and id are no inputs.

Defined cases: a null text is empty and counts as one passage without words; labels that
are null, or of unknown documents, are left out; several labels of one document count with
their mean; without labels of both kinds every score is the share of label 1 (0.5 without
any label); repeated rows get equal scores; an empty table gives no rows; other columns are
not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import fold, modest_batches, table, texts
from shardloom.llm.tokens import SMALL, forget, release, slices

WORDS, SAMPLE, BYTES = 64, 6000, 1 << 26
HIDDEN, GATES, STEPS, BATCH, RATE, DECAY, SEED = 24, 12, 900, 128, 0.01, 1e-4, 7
THRESHOLD = 0.7

CLASSES = 12
BYTE_CLASS = np.full(256, 11, np.int64)  # other symbols
BYTE_CLASS[ord("a"):ord("z") + 1] = 0
BYTE_CLASS[ord("A"):ord("Z") + 1] = 1
BYTE_CLASS[ord("0"):ord("9") + 1] = 2
BYTE_CLASS[128:] = 3
for _number, _symbols in enumerate((" ", ".", ",", "!?", "|", "'\"-", ":;()"), 4):
    for _symbol in _symbols:
        BYTE_CLASS[ord(_symbol)] = _number
FEATURES = CLASSES + CLASSES * CLASSES + 4


def passages(text: str, words: int = WORDS) -> list[list[bytes]]:
    found = text.encode("utf-8", "replace").split()
    return [found[i:i + words] for i in range(0, len(found), words)] or [[]]


def features(parts: list[list[bytes]]) -> np.ndarray:
    """A row of features for each passage."""
    lines = [b" ".join(p) for p in parts]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    classes = BYTE_CLASS[np.frombuffer(b"".join(lines), np.uint8)]
    owner = np.repeat(np.arange(len(lines)), sizes)
    single = np.bincount(owner * CLASSES + classes, minlength=len(lines) * CLASSES)
    inside = owner[1:] == owner[:-1]
    pairs = (owner[1:] * CLASSES + classes[1:]) * CLASSES + classes[:-1]
    double = np.bincount(pairs[inside], minlength=len(lines) * CLASSES * CLASSES)
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    unique = np.fromiter((len(set(p)) for p in parts), np.int64, len(parts))
    twice = np.fromiter((sum(map(bytes.__eq__, p, p[1:])) for p in parts), np.int64, len(parts))
    some = np.maximum(counts, 1)
    rest = np.stack([unique / some, twice / some, sizes / some / 10, counts / WORDS], 1)
    shares = np.concatenate([single.reshape(len(lines), -1), double.reshape(len(lines), -1)], 1)
    return np.concatenate([np.sqrt(shares / np.maximum(sizes, 1)[:, None]), rest], 1).astype(np.float32)


@dataclass
class Model:
    """Weights of encoder (w, b), gated attention (v, u, a) and output (c, d)."""

    shift: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of bags; ``starts`` has the first row of each."""
        if self.constant is not None:
            return np.full(len(starts), self.constant)
        return 1 / (1 + np.exp(-forward(self.weights, (x - self.shift) / self.scale, starts)[0].astype(float)))


def forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray):
    sizes = np.diff(np.append(starts, len(x)))
    h = np.tanh(x @ w["w"] + w["b"])
    t, s = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
    e = (t * s) @ w["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    alpha = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(alpha[:, None] * h, starts, axis=0)
    return z @ w["c"] + w["d"], (sizes, h, t, s, alpha, z)


def gradients(w, x, starts, y) -> dict[str, np.ndarray]:
    """Of the mean log loss over the bags."""
    out, (sizes, h, t, s, alpha, z) = forward(w, x, starts)
    g = (1 / (1 + np.exp(-out)) - y) / len(y)
    dz = np.repeat(g[:, None] * w["c"], sizes, axis=0)
    da = (dz * h).sum(1)
    de = alpha * (da - np.repeat(np.add.reduceat(alpha * da, starts), sizes))
    dt, ds = de[:, None] * w["a"] * s * (1 - t * t), de[:, None] * w["a"] * t * s * (1 - s)
    dh = (alpha[:, None] * dz + dt @ w["v"].T + ds @ w["u"].T) * (1 - h * h)
    return {"w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ ds,
            "a": (t * s).T @ de, "c": z.T @ g, "d": g.sum()}


def train(bags: list[np.ndarray], labels: np.ndarray, steps: int = STEPS) -> Model:
    """Adam over batches of documents; the order of the bags settles the result."""
    if not len(bags) or labels.min() == labels.max():
        share = float(labels.mean()) if len(bags) else 0.5
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {}, share)
    everything = np.concatenate(bags)
    shift, scale = everything.mean(0), everything.std(0) + 0.02
    bags = [((b - shift) / scale).astype(np.float32) for b in bags]
    draw = np.random.default_rng(SEED)

    def start(*shape):
        return (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    w = {"w": start(FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "v": start(HIDDEN, GATES),
         "u": start(HIDDEN, GATES), "a": start(GATES), "c": start(HIDDEN), "d": np.float32(0)}
    mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        chosen = draw.integers(0, len(bags), min(BATCH, 4 * len(bags)))
        sizes = [len(bags[i]) for i in chosen]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        grads = gradients(w, np.concatenate([bags[i] for i in chosen]), starts, labels[chosen])
        rate = RATE * (1 - step / (steps + 1))
        for k, g in grads.items():
            g = g + DECAY * w[k]
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g * g
            move = mean[k] / (1 - 0.9 ** step) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
            w[k] = (w[k] - rate * move).astype(np.float32)
    return Model(shift, scale, w)


def fitting(sizes: list[int], most: int) -> list[bool]:
    """Which of the texts, in order, have room beside those taken before them."""
    taken, left = [], most
    for size in sizes:
        taken.append(size <= left)
        left -= size * taken[-1]
    return taken


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = BYTES) -> Model:
    """Learn from labelled documents outside the held-out quarter.

    At most ``sample`` bags of together ``most`` bytes of text reach the driver, however
    often an id is repeated.
    """
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
              .filter("doc_id is not null and quality is not null").filter(fold("doc_id", 4) != 2)
              .groupBy("doc_id").agg(F.avg("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))  # bounded, so it may be broadcast
    found = texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("quality").alias("quality"))
    sizes = found.select("doc_id", F.octet_length("text").alias("size"), F.xxhash64("doc_id").alias("place")).collect()
    sizes.sort(key=lambda r: (r["place"], r["doc_id"]))
    ids = [(r["doc_id"],) for r, fits in zip(sizes, fitting([r["size"] for r in sizes], most)) if fits]
    found = found.join(F.broadcast(docs.sparkSession.createDataFrame(ids, "doc_id long")), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for batch in batches:
            for name, text, label in zip(batch["doc_id"], batch["text"], batch["quality"]):
                bag = np.concatenate([features(some) for some in _runs(passages(text))])
                yield pd.DataFrame({"doc_id": [name], "label": [label], "bag": [bag.tobytes()]})
        release()

    rows = found.mapInPandas(run, "doc_id long, label double, bag binary").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in rows]
    return train(bags, np.array([r["label"] for r in rows]))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every document, beside the row itself as ``row``."""
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        forget()
        found, out = [t or "" for t in column], []
        for a, b in slices(found, SMALL):
            bags = [passages(t) for t in found[a:b]]
            starts = np.concatenate(([0], np.cumsum([len(p) for p in bags])[:-1])).astype(int)
            x = np.concatenate([features(some) for some in _runs([p for bag in bags for p in bag])])
            out.append(shared.value.score(x, starts))
            release()
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.select(F.struct("*").alias("row"), score(F.col("text").cast("string")).alias("score"))


def _runs(parts: list, most: int = 1024):
    for i in range(0, len(parts), most):
        yield parts[i:i + most]


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that the classifier rejects."""
    return scores(docs, fit(docs, labels)).filter(F.col("score") >= threshold).select("row.*")


def quality_query(spark, sf_dir):
    """op1: quality scores of all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scores(docs, model).select(
        "row.doc_id", F.coalesce(fold("row.doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
