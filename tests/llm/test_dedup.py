"""Exact, SimHash and passage dedup against plain versions of the same rules."""
import hashlib
import random

import numpy as np
import pytest
import xxhash

from shardloom.llm import exact_dedup, simhash, suffixes
from tests.llm.conftest import frame, prose

LENGTH = suffixes.LENGTH


def test_copy_groups(odd, odd_rows):
    found = exact_dedup.copy_groups(odd, support=0.1).collect()
    assert len(found) == len(odd_rows)
    texts = [(i, t or "") for i, t in odd_rows]
    for row in found:
        same = [i for i, t in texts if hashlib.sha256(t.encode()).hexdigest() == row.text_sha256]
        assert row.group_size == len(same)
        assert row.keep_id == max((i for i in same if i is not None), default=None)
    for digest in {r.text_sha256 for r in found}:
        assert sum(r.kept for r in found if r.text_sha256 == digest) == 1


def test_drop_copies_keeps_the_largest_id(spark, odd, odd_rows):
    kept = exact_dedup.drop_copies(odd, support=0.1)
    assert kept.columns == odd.columns
    found = {r.text or "": r.doc_id for r in kept.collect()}
    assert len(found) == kept.count() == len({t or "" for _, t in odd_rows})
    assert found[prose(1, 80)] == 8 and found[""] == 2 and found[prose(8, 60)] == 15


def test_hot_text_is_settled_apart_from_the_others(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 50}") for i in range(600)]
    docs = frame(spark, rows)
    found = exact_dedup.copy_groups(docs, support=0.05).collect()
    assert {(r.keep_id, r.group_size) for r in found if r.doc_id % 3 == 0} == {(597, 200)}
    assert sum(r.kept for r in found) == len({t for _, t in rows}) == exact_dedup.drop_copies(docs, 0.05).count()


def test_empty_tables(none):
    assert exact_dedup.copy_groups(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0
    assert simhash.near_groups(none).count() == 0
    assert simhash.drop_near_copies(none).count() == 0
    assert suffixes.spans(none).count() == 0
    assert suffixes.drop_repeats(none).count() == 0


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in "".join("\n" if c in " \t\n\x0b\x0c\r" else c for c in words).split("\n") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                root[top(a)] = top(b)
    return {n: top(n) for n in nodes}


def test_fingerprints_and_spark_hash(spark, odd_rows):
    for _, text in odd_rows:
        if text is None or len(text) < 5000:
            assert simhash.fingerprint(text or "") == plain_fingerprint(text or "")


def test_near_groups_against_all_pairs(spark):
    draw = random.Random(5)
    rows = []
    for i in range(60):
        words = prose(i % 12, 200).split()
        for _ in range(i // 12):
            words[draw.randrange(200)] = "edit%d" % draw.randrange(9)
        rows.append((i * 7 % 60, " ".join(words)))
    rows += [(100, None), (101, "  ")]
    found = {r.doc_id: r for r in simhash.near_groups(frame(spark, rows)).collect()}
    prints = {i: simhash.fingerprint(t or "") for i, t in rows}
    roots = plain_components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    for i in prints:
        assert found[i].print & (1 << 64) - 1 == prints[i]
        assert found[i].component_id == min(j for j in prints if roots[j] == roots[i])
    kept = {r.doc_id for r in simhash.drop_near_copies(frame(spark, rows)).collect()}
    assert kept == {r.component_id for r in found.values()}


def test_near_copies_with_shared_and_missing_ids(spark):
    a, b, c, d = (prose(700 + i, 120) for i in range(4))
    rows = [(7, a), (7, b), (7, b), (8, b), (None, c), (None, c + " "), (None, d), (3, d)]
    for _ in range(2):
        kept = [(r.doc_id, r.text.strip()) for r in simhash.drop_near_copies(frame(spark, rows).repartition(3)).collect()]
        assert sorted(kept, key=repr) == sorted([(7, a), (7, b), (None, c), (3, d)], key=repr)
        rows.reverse()


@pytest.mark.parametrize("n", [2, 13, 64, 65, 200])
def test_bit_slices_against_plain_distances(n):
    draw = np.random.default_rng(n)
    base = draw.integers(0, 1 << 63, 4, dtype=np.uint64)
    prints = np.array([base[i % 4] ^ np.uint64(sum(1 << int(b) for b in set(draw.integers(0, 64, i % 6)))) for i in range(n)])
    distance = np.array([[(int(a) ^ int(b)).bit_count() for b in prints] for a in prints])
    got = np.unpackbits(simhash.near(prints).view(np.uint8), axis=1, bitorder="little")[:, :n]
    assert (got == (distance <= 3)).all()
    assert (simhash.near_pairs(prints, prints[::-1]) == (distance[np.arange(n), np.arange(n)[::-1]] <= 3)).all()
    a, b = simhash.spanning(prints)
    root = plain_components(list(range(n)), lambda i, j: distance[i, j] <= 3)
    assert len(a) == n - len(set(root.values())) and all(root[i] == root[j] for i, j in zip(a, b))


@pytest.mark.parametrize("block", [20, 4096])
def test_hot_block_is_cut_into_chunks(spark, block):
    center = 0x0123456789ABCDEF
    prints = sorted({center ^ 1 << a ^ 1 << b for a in range(14) for b in range(a)} | {center, 5})
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    from shardloom.llm.common import components
    found = {r.node: r.root for r in components(simhash.links(df, block)).collect()}
    assert set(found) == set(prints) - {5} and len(set(found.values())) == 1


def test_components_of_a_long_chain(spark):
    from shardloom.llm.common import components
    order = list(range(60))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame([*zip(order, order[1:]), (100, 101), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(60)}, 100: 100, 101: 100}


def plain_marks(rows):
    """Of each document the words in repeated passages that are first and that are not."""
    texts = {i: (t or "").encode("utf-8", "replace").split() for i, t in rows if i is not None}
    where = {}
    for i in sorted(texts):
        for p in range(len(texts[i]) - LENGTH + 1):
            where.setdefault(b" ".join(texts[i][p:p + LENGTH]), []).append((i, p))
    marks = {}
    for places in where.values():
        if len(places) > 1:
            for k, (i, p) in enumerate(sorted(places)):
                marks.setdefault((i, k == 0), set()).update(range(p, p + LENGTH))
    return texts, marks


def spans_as_marks(found):
    marks = {}
    for r in found:
        marks.setdefault((r.doc_id, r.original), set()).update(range(r.first, r.last))
    return marks


@pytest.mark.parametrize("group", [3, suffixes.GROUP])
def test_repeated_passages_against_all_passages(spark, odd_rows, group):
    rows = [(i, t) for i, t in odd_rows if i not in (12, 13)]
    draw = random.Random(9)
    for i in range(40):  # passages of many lengths, shared whole or in part
        start = draw.randrange(300)
        shared = prose(1000 + i % 3, 400).split()[start:start + draw.randrange(30, 100)]
        rows.append((200 + i, prose(500 + i, draw.randrange(40)) + " " + " ".join(shared) + "\n" + prose(600 + i, draw.randrange(40))))
    docs = frame(spark, rows).repartition(4)
    texts, marks = plain_marks({r: None for r in rows})
    found = suffixes.spans(docs, group).collect()
    assert spans_as_marks(found) == marks
    kept = {r.doc_id: r for r in suffixes.drop_repeats(docs, group).collect() if r.doc_id is not None}
    for i, words in texts.items():
        left = [w for k, w in enumerate(words) if k not in marks.get((i, False), ())]
        changed = (i, False) in marks
        if changed and not left:
            assert i not in kept
        else:
            assert (kept[i].text or "").encode("utf-8", "replace").split() == left
            if changed:
                assert kept[i].n_chars == len(kept[i].text)
            else:
                assert (i, kept[i].text) in rows


def test_longest_texts(spark):
    long = prose(7, 30_000)
    found = suffixes.spans(frame(spark, [(12, long), (13, long)])).collect()
    assert {(r.doc_id, r.first, r.last, r.original) for r in found} == {(12, 0, 30_000, True), (13, 0, 30_000, False)}


def test_passages_in_rows_without_id(spark):
    passage = prose(77, 60)
    rows = [(None, prose(1, 10) + " " + passage), (3, passage + " " + prose(2, 10)), (None, prose(1, 10) + " " + passage)]
    found = {(r.doc_id, r.first, r.last, r.original) for r in suffixes.spans(frame(spark, rows)).collect()}
    assert found == {(suffixes.NOBODY, 10, 70, True), (3, 0, 60, False)}
    assert sorted(len(r.text.split()) for r in suffixes.drop_repeats(frame(spark, rows)).collect()) == [10, 70, 70]


def test_words_whose_letters_follow_a_pattern_are_told_apart(spark):
    """Two words of 1,024 letters whose polynomials over the letters are equal modulo 2**64."""
    signs = [bin(i).count("1") % 2 for i in range(1024)]
    one, other = ("".join("ab"[s ^ flip] for s in signs) for flip in (0, 1))
    left, right = prose(5, 49), prose(6, 49)
    rows = [(1, f"{left} {one} {right}"), (2, f"{left} {other} {right}")]
    assert suffixes.spans(frame(spark, rows)).count() == 0
