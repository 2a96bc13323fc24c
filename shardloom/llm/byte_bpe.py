"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Decoding turns the vocabulary's printable characters back into bytes, joins them, and only
then reads UTF-8, so characters that are split over several ids come back whole.  The byte
lengths of the ids also give each id's place in the text in bytes and, by the byte-to-
character map, in characters.

Defined cases: a null text is empty and has no ids; special tokens in a text are ordinary
text; lone surrogates cannot occur in a Spark string; an empty table gives no rows; other
columns are not looked at; repeated rows give repeated results.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from shardloom.llm.common import table, texts
from shardloom.llm.tokens import encoder, slices, tokenizer_path


def byte_characters() -> dict[str, int]:
    """The printable character of each byte: printable Latin-1 stands for itself, the other
    bytes take the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def id_bytes(path: str) -> list[bytes]:
    """The bytes of every id of the vocabulary file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    bytes_of, out = byte_characters(), {}
    for word, number in content["model"]["vocab"].items():
        out[number] = bytes(bytes_of[c] for c in word) if all(c in bytes_of for c in word) else word.encode()
    for token in content.get("added_tokens", []):
        out[token["id"]] = token["content"].encode()
    return [out.get(i, b"") for i in range(max(out) + 1)]


def decode(ids: np.ndarray, path: str) -> bytes:
    return b"".join(map(id_bytes(path).__getitem__, ids.tolist()))


def offsets(ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one character of each id; an id that holds part of a character
    covers that character."""
    parts = list(map(id_bytes(path).__getitem__, ids.tolist()))
    ends = np.cumsum([0, *map(len, parts)])
    raw = np.frombuffer(b"".join(parts), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
    if not len(raw):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return (character[np.minimum(ends[:-1], len(raw) - 1)].astype(np.int32),
            (character[np.maximum(ends[1:] - 1, 0)] + 1).astype(np.int32))


def encode_table(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, starts, ends``: ids and the characters that each covers."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in slices(found := batch["text"].tolist()):
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in encoder(path, False).encode(found[a:b])]
                spans = [offsets(x, path) for x in ids]
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b].to_numpy(), "ids": ids,
                                    "starts": [s for s, _ in spans], "ends": [e for _, e in spans]})
    return texts(docs).mapInPandas(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode_table(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; bytes that are no UTF-8 become U+FFFD."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [
                decode(np.asarray(x if x is not None else [], np.int64), path).decode("utf-8", "replace")
                for x in batch["ids"]]})
    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document the number of ids, a digest of the ids and one of what they decode to."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = id_bytes(path)
        decimal = [b"%d" % i for i in range(len(known))]
        for batch in batches:
            found = batch["text"].tolist()
            for a, b in slices(found):
                counts, names, backs = [], [], []
                for raw in encoder(path, False).encode(found[a:b]):
                    ids = np.frombuffer(raw, "<u4").tolist()
                    counts.append(len(ids))
                    names.append(hashlib.sha256(b" ".join(map(decimal.__getitem__, ids))).hexdigest())
                    backs.append(hashlib.sha256(b"".join(map(known.__getitem__, ids))).hexdigest())
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b].to_numpy(), "n_tokens": counts,
                                    "ids_sha256": names, "decoded_sha256": backs})
    return texts(docs).mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_query(spark, sf_dir):
    """op6: digests of ids and decoded bytes of all ``documents``."""
    return digests(table(spark, sf_dir, "documents"))
