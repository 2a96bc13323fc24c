"""Classifier, language model, page text, licences and the pipeline."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shardloom.llm import language_model, licences, pages, quality
from shardloom.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import frame, prose
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.01"


def held(i, modulus, value):
    return zlib.crc32(str(i).encode()) % modulus == value


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, small, name):
    assert differences(QUERIES[name](spark, small), connect(small), ORACLE[name]) == []


def test_quality_on_held_out_labels(spark):
    scores = QUERIES["op1_quality_attention"](spark, SF)
    rows = scores.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = [r.predicted == r.quality for r in rows]
    assert len(rows) > 60 and np.mean(right) > 0.95
    for r in rows[:50]:
        assert held(r.doc_id, 4, 2) and r.predicted == int(r.score >= 0.7)


def test_quality_odd_tables(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(6, 1, 0), (9, 0, 0), (6, 1, 1), (None, 1, 0), (999, 0, 0), (11, None, 0), (14, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    kept = quality.keep_good(odd, labels, threshold=0.0)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)
    assert quality.keep_good(none, labels).count() == 0
    nothing = quality.scores(odd, quality.fit(odd, labels.filter("false"))).collect()
    assert {r.score for r in nothing} == {0.5}


def test_quality_scores_by_brute_force(spark):
    """Every document's score, a document and a passage at a time, from the model's weights."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit(docs, labels)
    found = quality.scores(docs, model).select("row.text", "score").collect()
    assert len(found) == docs.count() and model.constant is None
    w = {k: np.asarray(v, float) for k, v in model.weights.items()}
    for r in found:
        words, hidden, worth = (r.text or "").encode().split(), [], []
        for i in range(0, max(len(words), 1), quality.WORDS):
            x = (quality.features([words[i:i + quality.WORDS]])[0] - model.shift) / model.scale
            h = np.tanh(x @ w["w"] + w["b"])
            gate = 1 / (1 + np.exp(-(h @ w["u"])))
            hidden.append(h)
            worth.append(math.exp(float((np.tanh(h @ w["v"]) * gate) @ w["a"])))
        z = sum(a * h for a, h in zip(worth, hidden)) / sum(worth)
        assert r.score == pytest.approx(1 / (1 + math.exp(-float(z @ w["c"] + w["d"]))), abs=1e-3)


def test_quality_fit_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    """An id on very many rows is one bag; long texts are read whole or, without room, left out."""
    docs = spark.range(20_000).selectExpr("case when id < 19990 then 1L else id end doc_id",
                                          "concat('text ', id) text").unionByName(
        spark.createDataFrame([(20_000, "word " * 10_000)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1)] + [(i, i % 2) for i in range(19_990, 20_001)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda bags, y: seen.append([len(b) for b in bags]) or quality.Model(
        np.zeros(quality.FEATURES), np.ones(quality.FEATURES), {}, 0.5))
    learnt = [i for i in [1, *range(19_990, 20_001)] if not held(i, 4, 2)]
    assert 20_000 in learnt
    quality.fit(docs, labels)
    quality.fit(docs, labels, most=1_000)
    quality.fit(docs, labels, sample=3)
    assert [len(s) for s in seen] == [len(learnt), len(learnt) - 1, 3]
    assert max(seen[0]) == -(-10_000 // quality.WORDS) and max(seen[1]) == 1


def test_texts_that_fit():
    assert quality.fitting([5, 9, 4, 1, 1], 10) == [True, False, True, True, False]
    assert quality.fitting([], 10) == [] and quality.fitting([0, 0], 0) == [True, True]


def test_attention_gradients():
    draw = np.random.default_rng(0)
    w = {"w": draw.standard_normal((5, 4)), "b": draw.standard_normal(4), "v": draw.standard_normal((4, 3)),
         "u": draw.standard_normal((4, 3)), "a": draw.standard_normal(3), "c": draw.standard_normal(4), "d": np.float64(0.3)}
    x, starts, y = draw.standard_normal((7, 5)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])

    def loss():
        out = quality.forward(w, x, starts)[0]
        return np.mean(np.log1p(np.exp(out)) - y * out)
    for name, g in quality.gradients(w, x, starts, y).items():
        if name == "d":
            continue
        flat = w[name].reshape(-1)
        for i in range(flat.size):
            keep = flat[i]
            flat[i] = keep + 1e-6
            up = loss()
            flat[i] = keep - 1e-6
            down = loss()
            flat[i] = keep
            assert abs((up - down) / 2e-6 - np.asarray(g).reshape(-1)[i]) < 1e-6


def plain_words(text):
    return (text or "").encode("utf-8", "replace").lower().split() + [b""]


def check_scores(rows, texts):
    counts = Counter(w for i, t in texts for w in plain_words(t) if i is None or not held(i, 5, 1))
    n, v = sum(counts.values()), len(counts)
    known = {}
    for i, t in texts:
        words = plain_words(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        known.setdefault(i, []).append((len(words), sum(counts[w] > 0 for w in words), base))
    for r in rows:
        assert r.train_tokens == n
        assert any((r.n_tokens, r.n_known) == (a, b) and abs(r.base_score - c) < 1e-6 * max(1, abs(c)) for a, b, c in known[r.doc_id])
        assert math.isfinite(r.score) and r.score <= 0


def test_language_model_odd_tables(spark, odd, odd_rows, none):
    rows = language_model.score_table(odd).collect()
    assert len(rows) == len(odd_rows)
    check_scores(rows, odd_rows)
    assert language_model.score_table(none).count() == 0
    lone = language_model.score_table(frame(spark, [(i, "a b") for i in range(50) if held(i, 5, 1)])).collect()
    assert {(r.train_tokens, r.n_known, r.n_tokens) for r in lone} == {(0, 0, 3)}


def test_language_model_beats_the_base(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(language_model, "KNOWN", 300)  # most words then come by the join
    rows = language_model.score_table(docs).collect()
    check_scores(rows, [(r.doc_id, r.text) for r in docs.collect()])
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > 0.98 * sum(r.base_score for r in out)


def test_model_is_normalised():
    unigram = np.random.default_rng(1).dirichlet(np.ones(30))
    model = language_model.LogBilinear(unigram)
    before = np.random.default_rng(2).integers(0, 31, (5, language_model.CONTEXT))
    total = sum(np.exp(model.log_probabilities(before, np.full(5, k))) for k in range(30))
    assert np.allclose(total, 1, atol=1e-5)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div>%s<aside><p>Side words of a bar</p></aside>
<div id="comments"><p>First reader says a lot of things here</p></div><form><label>Mail</label></form>
<footer>&copy; Somebody</footer></body></html>"""
BODY = """<h1>Head&amp;line</h1><p>First   words &lt;of&gt; the
text with <b>bold</b> parts.<p>Second &#233;&#x1F642; part<br>goes on.</p><div class="ad">Buy now</div>
<ul><li>one item</li><li>two items</li></ul><script>x()</script><p>Last part of the whole long text.</p>"""
WANT = ("Head&line\n\nFirst words <of> the text with bold parts.\n\nSecond é🙂 part goes on.\n\none item\n\ntwo items\n\n"
        "Last part of the whole long text.")


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main>", "<div id='content'>%s</div>"])
def test_page_text(spark, around):
    rows = spark.read.parquet(f"{SF}/pages.parquet").limit(100).collect()
    weights = pages.learn([r.html for r in rows])
    assert weights["word"] > 0 and all(v < 0 for k, v in weights.items() if k != "word")
    assert pages.main_text(PAGE % (around % BODY), weights) == WANT


def test_page_weights_are_counted_in_tasks(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    copies = rows.unionByName(rows.filter("page_id % 3 = 0")).repartition(5)
    assert pages.fit(copies) == pages.learn([r.html for r in rows.collect()])
    few = pages.fit(copies, sample=10)
    assert few["word"] == 1.0 and len(few) > 1 and few == pages.fit(rows.repartition(3), sample=10)
    assert pages.fit(rows.filter("false")) == pages.START_WEIGHTS


@pytest.mark.parametrize("wrapper", [
    "class='page has-sidebar'", "class='no-sidebar'", 'class="with-nav"', "id=search-result", "title='the hidden city'",
    "class='w-4 hidden md:block'", "data-x='a hidden b'", "class=sidebar"])
@pytest.mark.parametrize("around", ["<article>%s</article>", "<div id='content'>%s</div>"])
def test_wrapped_page_keeps_its_text(wrapper, around):
    body = "<div class='page' " + wrapper + ">" if "class" not in wrapper else "<div " + wrapper + ">"
    assert pages.main_text(PAGE % (body + around % BODY + "</div>"), pages.START_WEIGHTS) == WANT


def test_parts_that_are_still_left_out():
    for attributes in ("hidden", "hidden=''", "class='x sidebar'", "class='site-footer'", "id=cookie_banner", "style='display: none'"):
        page = f"<div {attributes}>left out words</div>" + BODY
        assert "left out" not in pages.main_text(page, pages.START_WEIGHTS)
    assert pages.main_text("<form class=search><div class=widget><p>" + "all words of a page " * 9, pages.START_WEIGHTS)
    assert pages.main_text("<nav><p>Home and other places of a page</nav>", pages.START_WEIGHTS) == ""
    comments = "<div id=comments>" + "readers say much more " * 30 + "</div>"
    assert pages.main_text("<article><p>Short article of a few words</article>" + comments, pages.START_WEIGHTS) == "Short article of a few words"


def test_borders_of_the_run_stand(spark):
    weights = pages.learn([r.html for r in spark.read.parquet(f"{SF}/pages.parquet").limit(100).collect()])
    second = "<section><h2>Second part</h2><p>" + "words of the second part " * 4 + "</section>"
    found = pages.main_text(PAGE % ("<article>" + BODY + "</article>" + second), weights)
    assert found == WANT + "\n\nSecond part\n\n" + " ".join(["words of the second part"] * 4)
    menu = "<div><ul>" + "<li><a href='/x'>Item</a></li>" * 9 + "</ul></div>"  # without any mark
    assert pages.main_text(menu + "<div>" + BODY + "</div>" + menu, weights) == WANT
    long = "<p>" + "many words that stand around " * 3 + "<a href='/x'>one link</a> and go on</p>"
    assert pages.main_text("<div>" + long * 5 + "</div>", weights).count("go on") == 5


def test_given_pages_give_their_article(spark):
    import re
    from html import unescape
    for r in QUERIES["op4_page_text"](spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        want = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1|ul|li|div)>", article)]
        assert r.text == "\n\n".join(b for b in want if b) and r.n_chars == len(r.text)


def test_page_odd_tables(spark):
    odd = spark.createDataFrame(
        [(1, "u", None, "x"), (2, None, "", "x"), (None, "v", "no tags at all", "x"), (3, "w", "<p>a<p>b</i></div><", "x"),
         (3, "w", "<p>a<p>b</i></div><", "x"), (4, "z", "<script>never ends", "x"), (5, "y", "<p>" * 3000 + "deep", "x"),
         (6, "y", "<div>" + "long words " * 20000, "x")], "page_id long, url string, html string, text string")
    found = {(r.page_id, r.url): r for r in pages.extract(odd).collect()}
    assert [found[k].text for k in ((1, "u"), (2, None), (None, "v"), (3, "w"), (4, "z"), (5, "y"))] == [
        "", "", "no tags at all", "a\n\nb\n\n<", "", "deep"]
    assert found[6, "y"].n_chars == 20000 * 11 - 1
    assert pages.extract(odd).count() == 8 and pages.extract(odd.filter("false")).count() == 0


def plain_licences(rows, limit=licences.LIMIT):
    texts = [t or "" for _, _, t in rows]
    vocabulary = {t for _, s in licences.STATEMENTS for t in licences.terms(s)}
    df = Counter(t for text in texts for t in set(licences.terms(text)) & vocabulary)
    idf, vectors = licences.weigh(df, len(texts))
    out = []
    for text in texts:
        best = None
        for line in text.split("\n"):
            raw = {t: n * idf.get(t, idf[None]) for t, n in Counter(licences.terms(line)).items()}
            norm = math.sqrt(sum(w * w for w in raw.values()))
            for name, vector in vectors:
                cosine = norm and round(sum(w * vector.get(t, 0) for t, w in raw.items()) / norm, 9)
                if cosine >= limit and (best is None or (-cosine, name) < best):
                    best = (-cosine, name)
        out.append(best)
    return out


def test_licences_against_all_lines(spark, odd_rows):
    rows = [(i, f"a/{i}", t) for i, t in odd_rows if i not in (12, 13, 15) and i is not None]
    rows += [(100, "a/b/LICENSE", "Released under the MIT License.\nmore"), (101, "a/COPYING", "Licensed under CC BY-NC 4.0."),
             (102, "a/b/c/d.txt", "nothing"), (103, "a/x/y.txt", None), (104, None, "free"), (105, "top.txt", "words"),
             (106, "a/b/e.txt", "This work is licensed under the GNU General Public License, version 3."),
             (107, "a/b/f.txt", "the license of this work is general and public"), (108, "ab/c.txt", "z")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, path string, text string, file string, licence string")
    found = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert len(found) == len(rows)
    for (i, path, _), best in zip(rows, plain_licences(rows)):
        row = found[i]
        if best:
            assert (row.origin, row.licence, row.licence_path) == ("own", best[1], path) and abs(row.similarity + best[0]) < 1e-8
        else:
            folders = [] if path is None else ["/".join(path.split("/")[:k]) for k in range(path.count("/"), 0, -1)]
            want = next(({"a/b": "MIT", "a": "CC-BY-NC-4.0"}[f] for f in folders if f in ("a", "a/b")), None)
            assert row.licence == want and row.origin == (want and "inherited")
    assert found[102].licence_path == "a/b/LICENSE" and found[103].licence_path == "a/COPYING"
    assert licences.scan(docs.filter("false")).count() == 0


def test_licence_files_and_wrapped_headers(spark):
    bodies = dict(licences.TEXTS)
    notice = [s for n, s in licences.STATEMENTS if n == "GPL-3.0" and "free software" in s][0]
    wrapped = "# Copyright 2020 Somebody\n#\n# " + notice.replace("modify it", "modify it\n# ").replace("as published", "as\n# published")
    rows = [(1, "p/LICENSE", "Copyright (c) 2020 Some Body\n\n" + bodies["MIT"]), (2, "q/COPYING", bodies["GPL-3.0"]),
            (3, "r/LICENSE", bodies["BSD-3-Clause"]), (4, "s/x.py", wrapped + "\n#\nimport x\n"),
            (5, "s/y.go", "// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.\n"),
            (6, "s/z.c", "// SPDX-License-Identifier: MIT\nint x;"), (7, "p/a.py", "code"), (8, "LICENSE", bodies["Apache-2.0"]),
            (9, "z/deep/b.py", "code"), (10, "top.py", "code"), (11, "q/LICENSE", bodies["MPL-2.0"])]
    rows += [(100 + i, None, "plain text %d of no licence" % i) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    found = {r.doc_id: (r.licence, r.origin) for r in licences.scan(docs).collect()}
    want = ["MIT", "GPL-3.0", "BSD-3-Clause", "GPL-3.0", "BSD-3-Clause", "MIT", "MIT", "Apache-2.0", "Apache-2.0", "Apache-2.0", "MPL-2.0"]
    assert found == {i + 1: (w, "inherited" if i + 1 in (7, 9, 10) else "own") for i, w in enumerate(want)} | {
        100 + i: (None, None) for i in range(30)}


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, before, SF), name)
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
        sizes.append(after.count())
        before = after
    assert docs.count() > sizes[0] > sizes[1] >= sizes[2] >= sizes[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}


def test_pipeline_on_odd_and_empty_tables(spark, odd, none, tmp_path):
    spark.createDataFrame([(6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for table in (odd, none):
        before = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = corpus_pipeline.stored(stage(spark, before, str(tmp_path)), name)
            assert before.columns == table.columns
        corpus_pipeline.STAGES[-1][1](spark, before, str(tmp_path)).count()
    assert prose(1, 3)
