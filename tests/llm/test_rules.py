"""Quality rules and the prefix trie against plain versions and their SQL."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import math
import re

import pytest

from shardloom.llm import prefix_trie, rules
from tests.llm.conftest import frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in twice for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def plain_buckets(text, buckets):
    codes = [zlib.crc32(w.encode()) for w in WORD.findall(text or "")]
    return [c % buckets for c in codes] + [(31 * a + b) % buckets for a, b in zip(codes, codes[1:])]


def labels_of(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int")


def test_rules_agree_with_the_plain_version(spark, odd, odd_rows):
    odd_rows = odd_rows + [(40, "a b c a b c a b # c\nx\n\nx\n x\nx"), (41, "w " * 60), (42, prose(1, 90)), (43, prose(50, 90))]
    marks = [(6, 1), (9, 1), (12, 1), (41, 0), (42, 1), (42, 0), (None, 1), (15, 1), (15, 1)]
    trusted = {6, 9, 12, 15}
    buckets = 64
    raw, target = Counter(), Counter()
    for i, text in odd_rows:
        found = plain_buckets(text, buckets)
        raw.update(found)
        if i in trusted:
            target.update(found)
    weights = [round(1e6 * (math.log((target[b] + 1) / (target.total() + buckets)) - math.log((raw[b] + 1) / (raw.total() + buckets))))
               for b in range(buckets)]
    expected = []
    for i, text in odd_rows:
        base, found = plain_base(text), plain_buckets(text, buckets)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        ratio = sum(weights[b] for b in found)
        expected.append((i, *base, failed, not failed and ratio >= -20_000 * len(found), len(found), ratio))
    got = rules.judge(frame(spark, odd_rows).repartition(3), labels_of(spark, marks), buckets, -20_000).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_rules_without_trusted_rows_or_rows(spark, odd, none):
    found = rules.judge(odd, labels_of(spark, []), 64).collect()
    assert all(r.kept == (not r.base_failed) and r.log_ratio == 0 for r in found)
    assert rules.judge(none, labels_of(spark, [(1, 1)]), 64).count() == 0


def test_rules_use_no_python(spark, odd, none):
    plan = rules.judge(odd, labels_of(spark, [(6, 1)]), 64)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, number, role, text in rows:
        if conv is None:
            continue
        role, text = role or "", text or ""
        digest = hashlib.sha256((hashlib.sha256(role.encode()).hexdigest() + hashlib.sha256(text.encode()).hexdigest()).encode()).hexdigest()
        turns[conv].append((number is not None, number or 0, digest, role, text))
    turns = {c: [t[3:] for t in sorted(some)] for c, some in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(turns.get(c - c % 100, [])[:h] + own[h:])
    members, children, ends = defaultdict(list), Counter(), defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = Counter(), Counter()
    for path, some in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(some) - 1) * (len(path[-1][1]) if path else 0)
    return sorted((min(some), len(path), min(members[path[:-1]]) if path else None, len(some), children[path], leaves[path], saved[path],
                   hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()) for path, some in members.items())


def talk(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "k") for r in rows],
                                 "conv_id long, turn long, role string, text string, key string, place long, band string")


@pytest.mark.parametrize("height, chunk", [(3, 2), (16, 4096)])
def test_trie_agrees_with_the_plain_version(spark, monkeypatch, height, chunk):
    monkeypatch.setattr(prefix_trie, "PART", 4)
    draw = random.Random(height)
    rows = []
    for c in [*range(0, 30), *range(100, 115), *range(205, 210), *range(-103, -95), 1000, 10**12]:
        for n in range(draw.choice([1, 2, 3, 5, 7])):
            rows.append((c, draw.choice([n, n, n, None, 3]), draw.choice(["user", "user", None]), draw.choice(["a", "bé", None, "", "ccc"])))
    for c in (300, 301, 302):  # long ones that part late
        rows += [(c, n, "user", f"turn {n}" if n < 20 else f"turn {n} {c}") for n in range(25)]
    rows += [(None, 1, "user", "nobody"), (5, 0, "user", "a"), (5, 0, "user", "a"), (7, 9, "user", "x" * 100_000)]
    got = prefix_trie.trie(talk(spark, rows).repartition(5), height, chunk).collect()
    assert sorted(map(tuple, got)) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(talk(spark, [])).count() == 0
    assert prefix_trie.trie(talk(spark, [(None, 1, "user", "x")])).count() == 0


def test_one_conversation_longer_than_a_part(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART", 64)
    rows = [(1, n, "user", str(n % 7)) for n in range(200)]
    assert sorted(map(tuple, prefix_trie.trie(talk(spark, rows)).collect())) == plain_trie(rows)
