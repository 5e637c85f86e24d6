"""Main text of web pages by gradient-boosted trees over DOM-node features.

Every block element of a page is a node with features: subtree density, words of its attributes and
of those above, depth, place, siblings, links and punctuation. Boosted trees give each node the
log-odds that it is main text. Hierarchical decoding then chooses the set of nodes with the highest
weighted sum in which no node is kept below a dropped one: a subtree goes if keeping its best part
scores less than nothing, so ancestors and descendants never contradict each other.

The trees are fitted on TRAINING_PAGES generated pages, whose main text is known by construction
and whose layouts vary (semantic elements, or plain divisions named by attributes). They are fitted
once per Python process, from a fixed seed; nothing is fitted on the pages to extract.

Defined cases: null, empty and blank html have empty text; text outside any element is judged with
its surroundings; unclosed and stray tags are repaired as browsers do for blocks; an article whose
element is truncated ends with the page; rows that repeat are extracted one by one; an empty table
gives an empty result; further columns have no influence; pages of any length are read whole.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, fit
from .common import pick, small_batches, texts
from .dom import Page

TRAINING_PAGES = 900
#: How much a node's opinion on its whole subtree counts, against that on its own text.
SUBTREE = 0.25


class Author:
    """Writes labelled pages: what is wrapped in main() is main text."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)
        self.semantic = self.r.random() < 0.6
        syllables = "ba ce do fi gu la me ni po ra se ti vu wa ze lo an er in on".split()
        self.vocabulary = ["".join(self.r.choices(syllables, k=self.r.choice((1, 1, 2, 2, 3)))) for _ in range(300)]

    def words(self, low: int, high: int) -> str:
        return " ".join(self.r.choices(self.vocabulary, k=self.r.randint(low, high)))

    def prose(self, sentences: int) -> str:
        out = []
        for _ in range(sentences):
            s = self.words(3, 18)
            if self.r.random() < 0.6:
                s = s.replace(" ", ", ", 1)
            out.append(s.capitalize() + self.r.choice("..?!"))
        return " ".join(out)

    def named(self, tag: str, names: list[str], inside: str, anonymous: float = 0.0) -> str:
        r = self.r
        if self.semantic and r.random() < 0.8:
            attribute = f' class="{r.choice(names)}"' if r.random() < 0.4 else ""
            return f"<{tag}{attribute}>{inside}</{tag}>"
        if r.random() < anonymous:
            return f"<div>{inside}</div>"
        return f'<div {r.choice(("class", "id"))}="{r.choice(("", "site-", "c_", "main "))if r.random() < 0.3 else ""}{r.choice(names)}">{inside}</div>'

    def links(self, n: int) -> str:
        r = self.r
        items = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(n)]
        if r.random() < 0.8:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return r.choice((" | ", " ", "<br>")).join(items)

    def boilerplate(self, kind: str) -> str:
        r = self.r
        if kind == "nav":
            return self.named("nav", ["nav", "menu", "navbar", "breadcrumbs", "toolbar"], self.links(r.randint(3, 12)), 0.2)
        if kind == "header":
            return self.named("header", ["header", "masthead", "banner"], f"<div>{self.words(1, 5)}</div>" + (self.links(r.randint(0, 5)) if r.random() < 0.5 else ""))
        if kind == "footer":
            return self.named("footer", ["footer", "copyright", "contentinfo"], self.r.choice(("&copy; ", "")) + self.prose(r.randint(1, 3)) + (self.links(r.randint(1, 6)) if r.random() < 0.5 else ""))
        if kind == "aside":
            inside = "".join(r.choice((f"<h3>{self.words(1, 4)}</h3>", f"<p>{self.prose(r.randint(1, 4))}</p>", self.links(r.randint(2, 8)))) for _ in range(r.randint(1, 4)))
            return self.named("aside", ["sidebar", "widget", "related", "trending", "promo"], inside)
        if kind == "ad":
            return f'<div class="{r.choice(("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad"))}">{r.choice((self.prose(r.randint(1, 4)), f"<p>{self.prose(r.randint(1, 3))}</p>"))}</div>'
        if kind == "notice":
            return self.named("div", ["cookie", "cookie-notice", "consent", "notice", "gdpr", "alert", "privacy"], f"<p>{self.prose(r.randint(1, 4))}</p>" + ("<button>ok</button>" if r.random() < 0.5 else ""))
        if kind == "form":
            return f'<form class="{r.choice(("newsletter", "search", "login", "subscribe", "form", "contact"))}">' + (f"<p>{self.prose(r.randint(1, 2))}</p>" if r.random() < 0.6 else "") + f'<label>{self.words(1, 3)}</label><input name="a"><button>go</button></form>'
        if kind == "comments":
            names, one = ["comments", "discussion", "responses", "commentlist", "replies"], ["comment", "reply", "comment-body"]
            inside = f"<h3>{self.words(1, 3)}</h3>" + "".join(f'<{(t := r.choice(("div", "article", "li")))} class="{r.choice(one)}"><p>{self.prose(r.randint(1, 6))}</p></{t}>' for _ in range(r.randint(1, 6)))
            return self.named("section", names, inside)
        return f'<div class="{r.choice(("share", "social", "sharing", "tags"))}">{self.links(r.randint(2, 5))}</div>'

    def blocks(self, n: int) -> list[str]:
        r, out = self.r, []
        for _ in range(n):
            kind = r.random()
            close = r.random() < 0.8
            if kind < 0.7:
                words = self.prose(r.choice((1, 1, 2, 3, 5, 8, 12))) if r.random() < 0.8 else self.words(1, 4)
                if r.random() < 0.2:
                    words = words.replace(" ", ' <a href="/x">', 1).replace(",", "</a>,", 1) if "," in words else words
                if r.random() < 0.2:
                    words = "<b>" + words + "<br>"
                out.append(f"<p>{words}" + ("</p>" if close else ""))
            elif kind < 0.78:
                out.append(f"<h{(k := r.randint(2, 4))}>{self.words(1, 6)}</h{k}>")
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li>{self.prose(1) if r.random() < 0.7 else self.words(1, 5)}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif kind < 0.91:
                out.append(f"<blockquote><p>{self.prose(r.randint(1, 3))}</p></blockquote>")
            elif kind < 0.94:
                out.append(f"<pre>{self.words(5, 30)}</pre>")
            elif kind < 0.97:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.words(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>")
            else:
                out.append(f"<figure><figcaption>{self.prose(1)}</figcaption></figure>")
        return out

    def page(self) -> tuple[str, set[str]]:
        """The page, with the texts of its main runs marked by a leading and trailing \\x01."""
        r = self.r
        body = self.blocks(r.choice((0, 0, 1, 2, 4, 8, 14, 25)))
        if r.random() < 0.8 or not body:
            body.insert(0, f"<h1>{self.words(1, 14)}</h1>")
        if r.random() < 0.3:
            body.insert(1, f"<p><b>{self.words(1, 30)}<br>")
        marked = ["\x01" + b for b in body]
        for kind in r.choices(("ad", "share", "form", "aside", "notice"), k=r.choice((0, 0, 0, 1, 2))):
            marked.insert(r.randint(1, len(marked)), "\x02" + self.boilerplate(kind))
        inside = "".join(marked)
        main = self.named("article", ["article", "content", "post", "entry", "story", "main-content", "articleBody"], inside, 0.25) if r.random() < 0.95 else inside
        if r.random() < 0.3:
            main = self.named("main", ["main", "page", "content", "columns"], main + ("\x02" + self.boilerplate("comments") if r.random() < 0.5 else ""), 0.3)
        before = ["\x02" + self.boilerplate(k) for k in ("notice", "header", "nav", "ad") if r.random() < 0.55]
        after = ["\x02" + self.boilerplate(k) for k in ("share", "comments", "aside", "ad", "form", "nav", "footer", "notice") if r.random() < 0.35]
        if r.random() < 0.3:
            r.shuffle(before)
        if r.random() < 0.15:  # a page of main text alone
            before, after, main = [], [], r.choice((main, inside, f"<main>{inside}</main>"))
        whole = "".join(before) + main + "".join(after)
        if r.random() < 0.3:
            whole = f'<div {r.choice(("class", "id"))}="{r.choice(("wrapper", "page", "container", "site"))}">{whole}</div>'
        tail = "</body></html>" if r.random() < 0.9 else ""
        return f'<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title><style>p{{}}</style></head><body>{whole}{tail}'


def labelled(source: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of a page in which \\x01 starts main and \\x02 other text.

    Marks stand before a block's tag, so as runs of their own they say what the text after them is."""
    plain = Page(source.replace("\x01", "").replace("\x02", ""))
    kinds: list[bool] = []
    marked = Page(source.replace("\x01", "<hr>\x01<hr>").replace("\x02", "<hr>\x02<hr>"))
    now = False
    for _, text in marked.runs:
        if text in ("\x01", "\x02"):
            now = text == "\x01"
        else:
            kinds.append(now)
    if len(kinds) != len(plain.runs):
        return np.empty((0, 0)), np.empty(0)
    share = [[0, 0] for _ in plain.tag]
    for (node, text), kind in zip(plain.runs, kinds, strict=True):
        share[node][kind] += len(text)
    for v in range(len(share) - 1, 0, -1):
        for k in (0, 1):
            share[plain.parent[v]][k] += share[v][k]
    keep = [v for v in range(1, len(share)) if sum(share[v])]
    features = np.array(plain.features(), dtype=float)
    return features[keep], np.array([share[v][1] > share[v][0] for v in keep], dtype=float)


@lru_cache(maxsize=2)
def trained(pages: int = TRAINING_PAGES) -> Boosted:
    parts = [labelled(Author(seed).page()) for seed in range(pages)]
    parts = [p for p in parts if len(p[1])]
    return fit(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def decode(page: Page, score: np.ndarray) -> str:
    """Text of the nodes with the highest sum of weighted scores in which no kept node has a
    dropped ancestor; the root is always kept."""
    own, chars = page.weights()
    n = len(page.tag)
    value = [float(score[v]) * (own[v] + SUBTREE * chars[v]) for v in range(n)]
    value[0] = 0.0
    for v in range(n - 1, 0, -1):
        if value[v] > 0:
            value[page.parent[v]] += value[v]
    kept = [True] * n
    for v in range(1, n):
        kept[v] = kept[page.parent[v]] and (value[v] > 0 or page.tag[v] == "body")
    loose = {v for v in range(n) if page.tag[v] in ("html", "body")}
    return " ".join(text for node, text in page.runs if kept[node] and not (node in loose and score[node] < 0))


def main_texts(sources: list[str], model: Boosted) -> list[str]:
    pages = [Page(s) for s in sources]
    features = [p.features() for p in pages]
    score = model(np.array([row for f in features for row in f], dtype=float))
    out, at = [], 0
    for page, f in zip(pages, features, strict=True):
        out.append(decode(page, score[at : at + len(f)]))
        at += len(f)
    return out


EXTRACTED = "page_id long, url string, text string, n_chars long"


def _each(model: Boosted) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = [(t or b"").decode() for t in texts(batch, "html")]
            found = [t for i in range(0, len(sources), 100) for t in main_texts(sources[i : i + 100], model)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return each


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for each row of pages."""
    small_batches(pages.sparkSession)
    rows = pick(pages, id_col, url_col, html_col).toDF("page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    return rows.mapInArrow(_each(trained()), EXTRACTED)
