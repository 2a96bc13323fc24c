"""Token ids, packing and fingerprints against plain versions."""
import base64
import hashlib
import zlib

import numpy as np
import pytest

from shardloom.llm import byte_bpe, fingerprints, packing
from shardloom.llm.tokens import Encoder, tokenizer_path
from tests.llm.conftest import frame, prose

ODD = ["", " ", "a  b", "x \n y", "it's  don't\n\n'll", "a b  c", "é.,!? 12a ..a <|endoftext|> b", "\ta b ", "a. 's b",
       "'s.'s a", "ab.'s c", "a\xa0 b", "a  b", "x\x1cy z", "word, word. word!?", "漢字 🙂🙂 𝔘", " lead", "trail ", "a\r\n b"]


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers as P
    import tiktoken
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("special", [True, False])
def test_encoder_is_the_library(special, odd_rows):
    texts = ODD + [t or "" for _, t in odd_rows] + ODD
    ours = Encoder(tokenizer_path(), special, most=50)
    for text, raw in zip(texts, [x for t in texts for x in ours.encode([t])]):
        assert np.frombuffer(raw, "<u4").tolist() == ours.tokenizer.encode(text, add_special_tokens=False).ids


def test_digests_and_round_trip(spark, odd, odd_rows, plain, none):
    found = {(r.doc_id, r.decoded_sha256): r for r in byte_bpe.digests(odd).collect()}
    for i, text in odd_rows:
        ids = plain.encode_ordinary(text or "")
        row = found[i, hashlib.sha256((text or "").encode()).hexdigest()]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    encoded = byte_bpe.encode_table(odd)
    back = sorted((str(r.doc_id), r.text) for r in byte_bpe.decode_table(encoded).collect())
    assert back == sorted((str(i), t or "") for i, t in odd_rows)
    for row in encoded.collect():
        text = next(t or "" for i, t in odd_rows if i == row.doc_id and len(plain.encode_ordinary(t or "")) == len(row.ids))
        covered = [text[a:b] for a, b in zip(row.starts, row.ends)]
        assert set("".join(covered)) == set(text)
        for number, part in zip(row.ids, covered):
            assert plain.decode_single_token_bytes(number) in part.encode()
    assert byte_bpe.digests(none).count() == byte_bpe.encode_table(none).count() == 0


def test_pack(spark, odd, odd_rows, none):
    rows = packing.pack(odd).collect()
    ours = Encoder(tokenizer_path(), True)
    docs = {}
    for i, text in odd_rows:
        docs.setdefault(i, []).append(ours.encode([text or ""])[0] + np.array([packing.END], "<u4").tobytes())
    for r in rows:
        assert any(zlib.crc32(raw[4 * r.start:4 * (r.start + r.length)]) == r.ids_crc32 and len(raw) == 4 * r.doc_tokens
                   for raw in docs[r.doc_id])
    assert sum(r.length for r in rows) == sum(len(x) // 4 for some in docs.values() for x in some)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("seed,n", [(0, 1), (1, 40), (2, 5000), (3, 200_000)])
def test_plan_holds_every_piece_once(seed, n):
    draw = np.random.default_rng(seed)
    lengths = np.minimum(1 + draw.geometric(1 / 300, n), 2047)
    lengths[: n // 3] = 700  # a third of the pieces share one length
    values, counts = np.unique(lengths, return_counts=True)
    histogram = dict(zip(values.tolist(), counts.tolist()))
    rows = packing.plan(histogram)
    seen, ends = {}, {}
    for length, first, times, sequence, offset in rows:
        seen.setdefault(length, []).append((first, times))
        for s in (sequence, sequence + times - 1):
            ends.setdefault(s, []).append((offset, length))
    for length, parts in seen.items():
        at = 0
        for first, times in sorted(parts):
            assert first == at
            at += times
        assert at == histogram[length]
    for parts in ends.values():
        parts = sorted(set(parts))
        assert all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:])) and sum(parts[-1]) <= 2048
    used = sum(k * v for k, v in histogram.items())
    sequences = max(sequence + times for _, _, times, sequence, _ in rows)
    assert n < 1000 or used / (2048 * sequences) > 0.99


@pytest.mark.parametrize("special", [True, False])
def test_words_encoded_together_equal_texts_encoded_alone(special):
    """Words with line ends, marks, odd white space and the special token between others."""
    draw = np.random.default_rng(11)
    parts = ["a", "Bc", "été", "日本", "🙂", "\n", "\r\n", "\t", "'s", "...", "12", "\u00a0", "\u2003", "\u0120", "<|endoftext|>",
             "<|endof", "text|>", "-", "_", "\x00", "\u0301"]
    texts = [" ".join("".join(draw.choice(parts, draw.integers(0, 5))) for _ in range(draw.integers(1, 40)))
             for _ in range(600)]
    one = Encoder(tokenizer_path(), special)
    want = [np.array(e.ids, "<u4").tobytes() for e in one.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [raw for i in range(0, 600, 50) for raw in one.encode(texts[i:i + 50])] == want


def test_rounding_keeps_the_sum_and_uses_the_histogram():
    """Small shares of many columns become whole repeats: a third of the pieces lie in columns."""
    draw = np.random.default_rng(5)
    lengths = np.minimum(1 + draw.geometric(1 / 400, 50_000), 2047)
    counts = np.bincount(lengths, minlength=2049)
    columns = packing.fills(np.flatnonzero(counts), 2048)
    repeats = packing.solve(columns, counts.astype(float))
    whole = packing.rounded(columns, repeats)
    assert abs(whole.sum() - repeats.sum()) <= 1 and (whole >= 0).all() and np.floor(repeats).sum() < whole.sum() / 2
    left = counts.copy()
    for column, times in zip(columns[whole > 0], whole[whole > 0]):
        pattern = [c for c in column if c]
        times = min(times, min(left[c] // pattern.count(c) for c in pattern))
        for c in pattern:
            left[c] -= times
    assert (left >= 0).all() and left.sum() < 0.7 * len(lengths)
    assert packing.rounded(np.zeros((0, 3), int), np.zeros(0)).shape == (0,)


def test_solve_reaches_an_exact_fit():
    columns = np.array([[1448, 600, 0], [1024, 1024, 0], [700, 700, 648]])
    counts = np.zeros(2049)
    counts[[1448, 600, 1024, 700, 648]] = [30, 30, 80, 50, 25]
    assert np.allclose(packing.solve(columns, counts, 2000), [30, 40, 25], atol=0.1)


def likeness_rows(spark, rows):
    return {(r.doc_id, r.n_chars): r for r in fingerprints.compare(frame(spark, rows).repartition(3)).collect()}


def test_fingerprints_follow_the_rule(spark, odd_rows):
    rows = [(i, t) for i, t in odd_rows if i not in (None, 15)]
    found = fingerprints.compare(frame(spark, rows).repartition(3)).collect()
    assert len(found) == len(rows)
    order = sorted(rows)
    by_id = {r.doc_id: r for r in found}
    for (i, text), (j, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        row = by_id[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        if text == following:
            assert row.near_next == 1 and row.fingerprint == by_id[j].fingerprint
            assert row.edited_fingerprint == row.fingerprint or text != edited
        if edited == text:
            assert row.near_edited == 1 and row.edited_fingerprint == row.fingerprint
        common = next((k for k, (a, b) in enumerate(zip(text, following)) if a != b), min(len(text), len(following)))
        assert row.shared_start == common
    assert by_id[9].near_edited > 0.3 and by_id[9].near_next < by_id[9].near_edited


def test_fingerprints_of_repeated_ids_and_nulls(spark, odd, odd_rows, none):
    found = fingerprints.compare(odd)
    assert found.count() == len(odd_rows)
    assert fingerprints.compare(none).count() == 0
    lone = fingerprints.compare(frame(spark, [(5, "abcdef")])).collect()
    assert lone[0].near_next == 1 and lone[0].edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_spans_and_extensions():
    texts = [prose(1, 50), "xx" + prose(1, 50), prose(2, 50)]
    a, b, c = (fingerprints.Prefixes(np.frombuffer(t.encode("utf-32-le"), np.uint32)) for t in texts)
    assert fingerprints.equal(a, 0, b, 2, 40) and not fingerprints.equal(a, 0, b, 1, 40)
    assert fingerprints.extension(a, 0, b, 2) == len(texts[0])
    for i in range(0, 60, 7):
        for j in range(0, 60, 11):
            want = next((k for k, (x, y) in enumerate(zip(texts[0][i:], texts[2][j:])) if x != y), None)
            assert want is None or fingerprints.extension(a, i, c, j) == want


def test_parts_of_words_are_asked_once():
    """Words before marks and line feeds come to the library once, not once per combination."""
    words = prose(5, 30).split()
    texts = ["x " + " ".join(f"{a}{mark}\n{b.title()}{end}" for b in words for mark, end in (("", "!"), (".", ""), ("&&&", "?!")))
             for a in words]
    texts += ["x a\n\nb c!!\nd e\n", "x a\0b.", "x a.\n", "x it's! don't.", "x a\t\nb", "x a\x1c\nb c\xa0\nd", "x \ta", "x a\nb\nc\nd",
              "x x1! 1. ..", "x é́! a\u2028\nb", "", " ", "x", "x  y", "ǅ! ʰ! a\x85\nb", "x 漢字! ひ. ٣! Ω! ы..\nы"]
    encoder = Encoder(tokenizer_path(), False)
    asked, library = 0, encoder.tokenizer

    class Counted:
        def encode_batch_fast(self, some, **options):
            nonlocal asked
            asked += sum(map(len, some))
            return library.encode_batch_fast(some, **options)

    encoder.tokenizer = Counted()
    found = encoder.encode(texts[:30])
    assert asked < 2_000 < sum(map(len, texts[:30])) / 20
    found += encoder.encode(texts[30:])
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]
