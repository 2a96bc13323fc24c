"""Byte-level BPE ids of whole texts through the tokenizers library, with a cache of words."""
from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

JSON = "byte_bpe_50k.json"
MOST = 800_000  # pieces that a worker remembers: some 200 MB
WHITE = r"\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LETTERS = r"A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ωЀ-ҁҊ-ӿ"  # some letters; a piece that is not cut is as right
TAIL = rf"([{LETTERS}])([.,;:!?|*$&%#]+)(\n|$)"
FEED = rf"([^{WHITE}])\n([^{WHITE}])"
CUT = "\0"
SPACE = "\u0120"  # fixed value: how the vocabulary writes a space
RUN = 256  # words encoded by one call
SMALL = 1 << 20  # characters at once in the pipeline, whose workers share an executor with idle ones
SPECIAL = "<|endoftext|>"  # fixed value: the vocabulary's only special token


class Encoder:
    """Encodes texts as bytes of little-endian unsigned 32-bit ids.

    Where every space of a text is followed by a character that is no white space, each
    space begins a match of the splitting pattern, so the text's ids are those of its
    pieces between spaces, one after the other; a text without this form goes to the library
    whole.  Pieces are cut further, where a letter ends a match before marks and where a line
    feed between other characters is a match of its own.  Arrow cuts the texts and puts the ids
    together; the ids of a part come from the library once and are then remembered.
    ``most`` bounds the memory, not the result: the cache starts anew beyond it.
    """

    def __init__(self, path: str, special: bool, most: int = MOST):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.special, self.most = special, most
        self.begins = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.begins[number] = token.startswith(SPACE)
        self.known: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that begin with a space, many in one call: none holds another space, so
        a token that begins with one begins the next word."""
        out = []
        for i in range(0, len(words), RUN):
            run = words[i:i + RUN]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(run)], add_special_tokens=False)[0].ids, "<u4")
            starts = 4 * np.flatnonzero(self.begins[ids])
            if len(starts) != len(run):
                out += self._whole(run)
                continue
            raw, bounds = ids.tobytes(), [*starts.tolist(), 4 * len(ids)]
            out += [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        return out

    def _parts(self, parts: list[str]) -> list[bytes]:
        """The ids of distinct parts, remembered or from the library."""
        found = list(map(self.known.get, parts))
        new = [i for i, x in enumerate(found) if x is None]
        for own, encoded in ((True, self._words), (False, self._whole)):
            places = [i for i in new if (parts[i][:1] == " ") is own]
            names = [parts[i] for i in places]
            raw = encoded(names)
            self.known.update(zip(names, raw))
            for i, x in zip(places, raw):
                found[i] = x
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        if len(self.known) > self.most:
            self.known = {}
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds, words = split.offsets.to_numpy(), split.flatten()
        after = np.ones(len(words), bool)
        after[bounds[:-1]] = False
        heads = words.take(pa.array(bounds[:-1])).to_numpy(zero_copy_only=False)
        first = dict(zip(some := list(set(heads)), self._parts(some)))
        bounds = bounds - np.arange(len(bounds))  # of the words that follow a space
        rest = words.filter(pa.array(after)).dictionary_encode()
        names, places = rest.dictionary, rest.indices
        odd = pc.or_(pc.match_substring_regex(names, f"^([{WHITE}]|$)"), pc.match_substring(names, CUT))
        cut = pc.replace_substring_regex(names, TAIL, rf"\1{CUT}\2\3")
        cut = pc.replace_substring_regex(cut, FEED, f"\\1{CUT}\n{CUT}\\2")
        space, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        cut = pc.split_pattern(pc.binary_join_element_wise(space, cut, none), CUT)
        parts = cut.flatten().dictionary_encode()
        ids = pa.array(self._parts(parts.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        ends, raw = _joined(ids.take(parts.indices))
        ends = np.ascontiguousarray(ends[cut.offsets.to_numpy()])
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(names), [None, pa.py_buffer(ends), raw])
        ends, raw = _joined(ids.take(places))
        ends, raw = ends[bounds].tolist(), memoryview(raw)
        odd = np.concatenate(([0], np.cumsum(odd.take(places).to_numpy(zero_copy_only=False))))[bounds]
        out = []
        for text, head, a, b, whole in zip(texts, heads, ends, ends[1:], (odd[1:] > odd[:-1]).tolist()):
            if whole or (self.special and SPECIAL in text):
                out += self._whole([text])
            else:
                out.append(first[head] + raw[a:b])
        return out


def _joined(entries: pa.LargeBinaryArray) -> tuple[np.ndarray, pa.Buffer]:
    """Where each of the entries begins, with the end, and their bytes one after the other."""
    offsets, raw = entries.buffers()[1:]
    return np.frombuffer(offsets, np.int64)[entries.offset:entries.offset + len(entries) + 1], raw or pa.py_buffer(b"")


@lru_cache(maxsize=2)
def encoder(path: str, special: bool, most: int = MOST) -> Encoder:
    """One encoder per worker process, kept between tasks."""
    return Encoder(path, special, most)


def release() -> None:
    """Give back what Arrow holds for later arrays: an executor has more workers than tasks, and
    an idle one keeps it."""
    pa.default_memory_pool().release_unused()


def forget() -> None:
    """Drop the encoders of this worker process, which now serves another operator."""
    encoder.cache_clear()
    release()


def tokenizer_path(name: str = JSON) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def slices(texts: list[str], most: int = 1 << 22):
    """The texts in runs of at least one text and about ``most`` characters."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
