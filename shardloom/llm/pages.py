"""Main text of web pages by a maximum-scoring run of tokens.

A page is read as a row of words and tags.  Words score positive and tags negative, each
kind of tag with a weight learnt from labelled pages: the log odds of standing inside the
main part, with a word's as the unit, held between ``LEAST`` and ``TAG`` so that a few links
or lists do not cut a text.  One linear scan finds the contiguous run with the largest sum,
and its borders stand: a part that the page marks as main only enters the score.  Inside
the run, parts that are never main text (scripts, forms, navigation, notices, comments of
readers ...) are left out, and the rest becomes blocks.

Labelled pages are those that mark their main part themselves (``article`` or ``main``);
the fit reads at most ``SAMPLE`` of them, those with the smallest hash of their url and id,
and counts their words and tags inside tasks.
Extraction reads every page whole, one at a time, without a shuffle.

Defined cases: null or empty html gives an empty text; html without any words gives an
empty text; unclosed and wrongly nested tags are closed where HTML closes them; without a
labelled page the weights are the built-in ones; a null ``page_id`` or ``url`` is kept;
repeated rows give repeated results; an empty table gives no rows; other columns are not
looked at.
"""
from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import modest_batches, table

SAMPLE = 2000

# fixed values: the elements of HTML by what they do to text
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "select")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
NEVER = ("nav", "aside", "form", "footer", "dialog", "menu", "head", "button", "fieldset", "audio", "video", "canvas")
BLOCKS = ("address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt",
          "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main",
          "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
          *NEVER)
# an opening tag that ends an open element of the kinds after it
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
# class, id or role that marks a part as no main text: a whole name, or one made of such names only
ASIDE = ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
         "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer",
         "gdpr", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo",
         "promoted", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "social",
         "sponsor", "sponsored", "subscribe", "toolbar", "widget", "masthead", "pagination", "pager", "signup",
         "login", "copyright", "disclaimer", "alert", "ad-container", "ad-slot", "comment-list", "comments-area",
         "main-menu", "main-nav", "nav-menu", "related-articles", "related-posts", "search-box", "search-form",
         "share-buttons", "site-footer", "site-nav", "social-links")

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
PART = re.compile(r"[a-z]+")

# kinds that hold no main text even where they hold most of the words
MENUS = ("nav", "aside", "footer", "menu", "head")

START_WEIGHTS = {"word": 1.0}
TAG, LEAST, UNMARKED = -0.2, -1.0, 0.5


class Reader:
    """The pieces of a page: ``(kind, name, text, out, inside)`` in page order.

    ``kind`` is ``text`` or ``tag``; ``out`` says that the piece stands in a part that is
    never main text; ``inside`` that it stands in a part the page marks as main.

    A part that would be left out stays if it holds ``article`` or ``main``, or, on a page
    without these elsewhere and apart from menus, most of the page's words.
    """

    def __init__(self, page: str):
        self.pieces: list[tuple[str, str, str, bool, bool]] = []
        self.open: list[tuple[str, bool, list]] = []  # with the spans that end with the element
        self.aside: list[list] = []  # name, first piece, piece after the last, outer before inner
        self.marks: list[list] = []
        at = 0
        while (found := TOKEN.search(page, at)) is not None:
            self._text(page[at:found.start()])
            at = found.end()
            name = (found[2] or "").lower()
            if not name:
                continue
            if found[1]:
                self._close(name)
            else:
                at = self._begin(name, found[3] or "", page, at)
        self._text(page[at:])
        self._cut(0)
        self._leave_out()

    def _leave_out(self) -> None:
        """Mark the pieces of the parts that have to go."""
        words = [0, *accumulate(len(p[2].split()) for p in self.pieces)]
        marks = [first for _, first, end in self.marks if words[end] > words[first]]
        done = 0
        for name, first, end in self.aside:
            if first < done:
                continue  # stands in one that goes
            held = bisect_left(marks, end) - bisect_left(marks, first)
            most = name not in MENUS and held == len(marks) and 2 * (words[end] - words[first]) > words[-1]
            if name == "head" or not (held or most):
                self.pieces[first:end] = [(a, b, c, True, e) for a, b, c, _, e in self.pieces[first:end]]
                done = end

    def _cut(self, i: int) -> None:
        for _, _, spans in self.open[i:]:
            for span in spans:
                span[2] = len(self.pieces)
        del self.open[i:]

    def _inside(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    def _text(self, raw: str) -> None:
        if raw:
            self.pieces.append(("text", "", unescape(raw) if "&" in raw else raw, False, self._inside()))

    def _tag(self, name: str) -> None:
        self.pieces.append(("tag", name, "", False, self._inside()))

    def _begin(self, name: str, attributes: str, page: str, at: int) -> int:
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            self._tag(name)
            return end.end() if end else len(page)
        if name in BLOCKS:
            self._leave("p", BLOCKS)
        if name in CLOSES:
            for kind in CLOSES[name]:
                self._leave(kind, ("ul", "ol", "dl", "table"))
        inside = self._inside()
        if name not in VOID:
            spans = []
            if name in NEVER or (name == "header" and not inside) or _aside(name, attributes):
                self.aside.append([name, len(self.pieces), 0])
                spans.append(self.aside[-1])
            if name in ("article", "main"):
                self.marks.append([name, len(self.pieces), 0])
                spans.append(self.marks[-1])
            self.open.append((name, inside or name in ("article", "main"), spans))
        self._tag(name)
        return at

    def _leave(self, name: str, until: tuple[str, ...]) -> None:
        """Close an open ``name`` unless one of ``until`` stands above it."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                self._cut(i)
                return
            if self.open[i][0] in until:
                return

    def _close(self, name: str) -> None:
        if name in VOID:
            if name == "br":
                self._tag(name)
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                self._tag(name)
                self._cut(i)
                return
        self._tag(name)


def _aside(name: str, attributes: str) -> bool:
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for found in ATTRIBUTE.finditer(attributes):
        key, value = found[1].lower(), (found[2] or found[3] or found[4] or "").lower()
        if key in ("class", "id", "role") and any(map(_names_aside, value.split())):
            return True
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _names_aside(name: str) -> bool:
    """A whole name of the list, or one whose parts are all names of it."""
    if name in ASIDE:
        return True
    parts = PART.findall(name)
    return "".join(parts) == re.sub(r"[-_0-9]+", "", name) and bool(parts) and all(part in ASIDE for part in parts)


def counts(page: str) -> tuple[Counter, Counter]:
    """Words (as ``word``) and tags of a page inside its main part, and outside it."""
    inside, outside = Counter(), Counter()
    for piece in Reader(page).pieces:
        into = inside if piece[4] and not piece[3] else outside
        if piece[0] == "text":
            into["word"] += len(piece[2].split())
        else:
            into[piece[1]] += 1
    return inside, outside


def learn(pages: list[str]) -> dict[str, float]:
    """Weights from pages that mark their main part."""
    inside, outside = Counter(), Counter()
    for page in pages:
        for total, found in zip((inside, outside), counts(page)):
            total.update(found)
    return weights_of(inside, outside)


def weights_of(inside: Counter, outside: Counter) -> dict[str, float]:
    """Weights from the counts of such pages: log odds of standing inside the main part."""
    if not inside["word"]:
        return dict(START_WEIGHTS)
    total_in, total_out = sum(inside.values()), sum(outside.values())

    def odds(name: str) -> float:
        return math.log((inside[name] + 1) / (total_in + 1)) - math.log((outside[name] + 1) / (total_out + 1))

    names = sorted((inside.keys() | outside.keys()) - {"word"})
    # a word is the unit; no tag gains, and none costs more than LEAST
    return {"word": 1.0} | {n: max(LEAST, min(TAG, odds(n) / max(odds("word"), 1.0))) for n in names}


def region(pieces: list, weights: dict[str, float]) -> tuple[int, int]:
    """The run of pieces with the largest sum, by one scan.

    Parts left out neither gain nor cost: they do not cut a text in two.  Where a page marks
    a main part, tags inside it cost nothing and words outside it gain ``UNMARKED``.
    """
    best, best_from, best_to, total, start = 0.0, 0, 0, 0.0, 0
    word = weights["word"]
    marked = any(p[4] and not p[3] and p[2].strip() for p in pieces)
    for i, piece in enumerate(pieces):
        if piece[3]:
            gain = 0.0
        elif piece[0] == "text":
            gain = (UNMARKED if marked and not piece[4] else word) * len(piece[2].split())
        else:
            gain = 0.0 if piece[4] else weights.get(piece[1], TAG)
        if total <= 0:
            total, start = 0.0, i
        total += gain
        if total > best:
            best, best_from, best_to = total, start, i + 1
    return best_from, best_to


def main_text(page: str, weights: dict[str, float]) -> str:
    pieces = Reader(page).pieces
    begin, end = region(pieces, weights)
    blocks, line = [], []

    def flush() -> None:
        joined = " ".join("".join(line).split())
        if joined:
            blocks.append(joined)
        line.clear()

    for piece in pieces[begin:end]:
        if piece[0] == "tag":
            if piece[1] in BLOCKS or (piece[3] and piece[1] in RAW):
                flush()
            elif piece[1] == "br":
                line.append(" ")
        elif not piece[3]:
            line.append(piece[2])
    flush()
    return "\n\n".join(blocks)


def fit(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights from at most ``sample`` pages; only hashes and counts of tags reach the driver.

    The pages of one hash, such as copies of a row, count as one page, the smallest html.
    """
    html = F.col("html").cast("string")
    rows = (pages.select(html.alias("html"), F.xxhash64(F.col("url").cast("string"), F.col("page_id").cast("long")).alias("place"))
            .filter(F.col("html").rlike("(?i)<(article|main)[\\s>]")))
    places = rows.select("place").distinct().orderBy("place").limit(sample)  # bounded, so it may be broadcast
    chosen = rows.join(F.broadcast(places), "place").groupBy("place").agg(F.min("html").alias("html")).select("html")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in batch["html"]:
                for total, found in zip((inside, outside), counts(page)):
                    total.update(found)
        names = sorted(inside.keys() | outside.keys())
        yield pd.DataFrame({"name": names, "inside": [inside[n] for n in names], "outside": [outside[n] for n in names]})

    found = (chosen.mapInPandas(run, "name string, inside long, outside long")
             .groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect())
    return weights_of(Counter({r["name"]: r["inside"] for r in found}), Counter({r["name"]: r["outside"] for r in found}))


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every page."""
    modest_batches(pages.sparkSession)
    weights = fit(pages) if weights is None else weights

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, weights) if h else "" for h in column], dtype=object)

    found = pages.select("page_id", "url", text(F.col("html").cast("string")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def pages_query(spark, sf_dir):
    """op4: the main text of all ``pages``."""
    return extract(table(spark, sf_dir, "pages"))
