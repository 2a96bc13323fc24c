"""Collocations against a count of all phrases."""
import random
import re
from collections import Counter, defaultdict

import pytest

from shardloom.llm import collocations

SHAPE = "lang string, text string, doc_id long, phrase string, a string, n long, score string, words string"


def table(spark, rows):
    return spark.createDataFrame([(lang, text, 1, "p", "a", 1, "s", "w") for lang, text in rows], SHAPE)


def plain(rows, least, top, longest=5):
    counts, out = defaultdict(Counter), []
    for lang, text in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        frequent = {g: c for g, c in f.items() if c >= least}
        held = set()
        for g, c in frequent.items():
            for k in range(2, len(g)):
                held |= {g[i:i + k] for i in range(len(g) - k + 1) if f[g[i:i + k]] <= c}
        found = []
        for g, a in frequent.items():
            if len(g) > 1 and g not in held:
                score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.fixture(scope="module")
def talk():
    draw = random.Random(4)
    words = ["The", "of", "a", "naïve", "漢字", "x\x1cy", "New", "York", "city", "big", "apple", "é"]
    rows = []
    for lang in ("en", "fr", None, "und"):
        for _ in range(40):
            text = []
            for _ in range(draw.randint(0, 40)):
                text.append(draw.choice(["new york city hall", "the big apple of a", "of the"] + words * 2))
                text.append(draw.choice([" ", " ", " ", "\t ", ". ", ",", "\n", ";\r", "!?"]))
            rows.append((lang, "".join(text)))
    return rows + [("en", None), ("en", ""), ("fr", " \t\n.,"), ("es", "one"), ("en", "go on " * 3000)]


@pytest.mark.parametrize("least, top, step, chars", [(4, 6, 2, 900), (3, 2000, 64, 10**7)])
def test_collocations_agree_with_a_count_of_all(spark, monkeypatch, talk, least, top, step, chars):
    monkeypatch.setattr(collocations, "CHARS", chars)
    got = collocations.collocations(table(spark, talk).repartition(3), least, top, 5, step).collect()
    assert sorted(map(tuple, got)) == plain(talk, least, top)


def test_nothing_to_find(spark):
    assert collocations.collocations(table(spark, []), 2).count() == 0
    assert collocations.collocations(table(spark, [("en", "a b"), (None, None)]), 2).count() == 0


def test_scores_pass_64_bits(spark):
    big = 9_000_000_000_000_000
    row = spark.createDataFrame([(big, 3 * big, big + 1, 7)], "a long, n long, l long, r long")
    assert row.select(collocations._score("a", "n", "l", "r").alias("s")).first().s == 1000 * big * 3 * big // ((big + 1) * 7)
