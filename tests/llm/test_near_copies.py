"""The near-dedup stage against the Jaccard of all pairs."""
import random
from collections import defaultdict

import numpy as np
import pytest

from shardloom.llm import near_copies
from tests.llm.conftest import frame, prose
from tests.llm.test_dedup import plain_components

SF = "/root/testdata/sf0.1"


def plain_shingles(text):
    words = (text or "").encode("utf-8", "replace").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def linked(a, b):
    both = len(a & b)
    return 5 * both >= 4 * (len(a) + len(b) - both)


def edited(draw, words, times):
    words = list(words)
    for _ in range(times):
        words[draw.randrange(len(words))] = f"edit{draw.randrange(99)}"
    return " ".join(words)


@pytest.mark.parametrize("n", [2, 63, 65, 150])
@pytest.mark.parametrize("radius", [0, 40, 72, 126])
def test_bit_planes_against_plain_distances(n, radius):
    draw = np.random.default_rng(n)
    prints = draw.integers(0, 256, (n, 32), np.uint8)
    prints[::3] = prints[0] ^ (draw.integers(0, 256, (len(prints[::3]), 32), np.uint8) & draw.integers(0, 256, (1, 32), np.uint8))
    distance = np.array([[np.unpackbits(a ^ b).sum() for b in prints] for a in prints])
    got = np.unpackbits(near_copies.near(prints, radius).view(np.uint8), axis=1, bitorder="little")
    assert (got[:, :n] == (distance <= radius)).all() and not got[:, n:].any()
    assert (near_copies.near_pairs(prints, prints[::-1], radius) == (distance[np.arange(n), np.arange(n)[::-1]] <= radius)).all()


@pytest.mark.parametrize("block,chunk", [(near_copies.BLOCK, near_copies.CHUNK), (5, 3000)])
def test_groups_against_all_pairs(spark, block, chunk):
    draw = random.Random(3)
    rows = [(i * 11 % 150, edited(draw, prose(i % 9, 200 + i % 9).split(), i // 9 % 5)) for i in range(150)]
    rows += [(200, None), (201, "  "), (202, ""), (203, "One two"), (204, "one  TWO"), (205, "one two three four five six"),
             (206, prose(3, 20_000)), (207, edited(draw, prose(3, 20_000).split(), 200)), (208, prose(4, 20_000))]
    sets = {i: plain_shingles(t) for i, t in rows}
    want = plain_components(list(sets), lambda a, b: linked(sets[a], sets[b]))
    found = {r.doc_id: r.root for r in near_copies.near_copy_roots(frame(spark, rows).repartition(3), block, chunk).collect()}
    assert len(found) == len(rows)
    ours, theirs = defaultdict(set), defaultdict(set)
    for i in sets:
        ours[found[i]].add(i)
        theirs[want[i]].add(i)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))
    kept = near_copies.drop_near(frame(spark, rows), block, chunk)
    assert kept.columns == frame(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(g) for g in theirs.values())


def test_shared_and_missing_ids(spark, odd, none):
    a, b, c, d = (prose(700 + i, 120) for i in range(4))
    rows = [(7, a), (7, b), (7, b), (8, b), (None, c), (None, c + " "), (None, d), (3, d)]
    for _ in range(2):
        kept = [(r.doc_id, r.text.strip()) for r in near_copies.drop_near(frame(spark, rows).repartition(3)).collect()]
        assert sorted(kept, key=repr) == sorted([(7, a), (7, b), (None, c), (3, d)], key=repr)
        rows.reverse()
    assert near_copies.drop_near(none).count() == 0 < near_copies.drop_near(odd).count()


def test_batches_without_any_candidate(spark):
    rows = [(i, prose(900 + i, 60)) for i in range(12)] + [(12, prose(900, 60) + " more")]
    docs = frame(spark, rows).repartitionByRange(6, "doc_id")
    assert sorted(r.doc_id for r in near_copies.drop_near(docs).collect()) == list(range(12))


def test_recall_on_the_given_documents(spark):
    """All links between different texts, found by an index of shingles."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets, seen, where = {}, set(), defaultdict(list)
    for row in docs.select("doc_id", "text").collect():
        if row.text not in seen:
            seen.add(row.text)
            sets[row.doc_id] = plain_shingles(row.text)
            for s in sets[row.doc_id]:
                where[s].append(row.doc_id)
    root = {r.doc_id: r.root for r in near_copies.near_copy_roots(docs).collect()}
    links = right = 0
    for a in sets:
        for b in {b for s in sets[a] for b in where[s]} - {a}:
            if linked(sets[a], sets[b]):
                links += 1
                right += root[a] == root[b]
    print(f"{right} of {links} links")
    assert links and right >= 0.99 * links


def test_components_keep_each_link_about_once(spark, monkeypatch):
    """Rounds do not multiply the rows that are joined: the links shrink with what is merged."""
    from shardloom.llm import common

    sizes = []

    def counted(df, purpose, real=common.stored):
        out = real(df, purpose)
        if purpose == "edges":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(common, "stored", counted)
    links = [(a, b) for a in range(20) for b in range(20, 220)] + [(i, i + 1) for i in range(500, 520)]
    found = common.components(spark.createDataFrame(links + [(b, a) for a, b in links], "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {**dict.fromkeys(range(220), 0), **dict.fromkeys(range(500, 521), 500)}
    assert sum(sizes) < 1.2 * len(links), sizes


def test_blocks_of_two_chunks_give_links_between_them_only():
    draw = np.random.default_rng(4)
    base = draw.integers(0, 256, (9, 32), np.uint8)
    prints = base[draw.integers(0, 9, 300)] ^ (1 << draw.integers(0, 8, (300, 32))).astype(np.uint8)
    own = draw.integers(0, 2, 300)
    prints[own == 0] = np.where((draw.random(300) < 0.5)[own == 0, None], prints[own == 0], base[0])

    def find(at):
        return near_copies.tree(near_copies.near(prints[at]), len(at))

    whole = plain_components(list(range(300)), lambda a, b: int(np.unpackbits(prints[a] ^ prints[b]).sum()) <= 72)
    links = [x for chunk in (0, 1) for at in [np.flatnonzero(own == chunk)] for x in zip(*(at[y].tolist() for y in find(at)))]
    between = list(zip(*(y.tolist() for y in near_copies.across(find, own))))
    given = set(links + between)
    assert len(between) < 20
    found = plain_components(list(range(300)), lambda a, b: (a, b) in given or (b, a) in given)
    assert len(set(zip(found.values(), whole.values()))) == len(set(found.values())) == len(set(whole.values())) < 300
