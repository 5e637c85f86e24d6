"""A block-level tree of a web page: nodes with features, and runs of text."""

from __future__ import annotations

import html
import math
import re

# HTML's inline and void elements, elements whose content is not text to read, and
# the start tags that end an open paragraph.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr img picture source input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video select textarea button datalist head title noembed noframes".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dd dt td th tr".split())
#: An open one of the first is ended by the start of one of its kin, unless one of the last is in between.
KIN = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"})}
SCOPE = frozenset("table td th html body article section div main aside nav footer header form blockquote ul ol dl".split())

# Words of class, id and role attributes that speak for or against main text.
GOOD = frozenset("article articlebody body content entry main page post story text hentry prose blog columns maincontent postcontent".split())
BAD = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent contact cookie cookies copyright disqus disclaimer dropdown foot footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup privacy promo promoted promotion recommended related reply replies respond search share sharing shop sidebar signup skip skyscraper social sponsor sponsored subscribe subscription tags teaser toc toolbar tools tracking trending widget discussion responses alert toast complementary contentinfo".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

TAGS = ("article main", "section div", "nav menu", "header", "footer", "aside", "form fieldset", "ul ol dl", "li dd dt", "p", "h1 h2 h3 h4 h5 h6", "table tbody thead tr td th", "pre blockquote figure figcaption", "body html")
_KIND = {t: i for i, names in enumerate(TAGS) for t in names.split()}

FEATURES = (
    "tag", "depth", "good", "bad", "good_above", "bad_above", "nav_above", "own_chars", "chars", "link_share", "chars_per_node", "chars_share",
    "place", "siblings", "sibling_no", "like_siblings", "stops_per_char", "commas_per_char", "paragraphs", "items", "parent_link_share", "parent_paragraphs",
    "before_chars", "after_chars", "longest_run", "inputs", "article_above", "words_per_run",
)


class Page:
    """Nodes are block elements in page order; runs are (node, text) in page order."""

    __slots__ = ("bad", "form", "good", "link", "parent", "runs", "tag")

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.good, self.bad, self.link, self.form = ["html"], [-1], [0], [0], [0], [0]
        self.runs: list[tuple[int, str]] = []
        stack, names, links, raw = [0], ["html"], 0, []
        at, end, search = 0, len(source), _TOKEN.search

        def flush() -> None:
            if raw:
                text = " ".join("".join(raw).split())
                raw.clear()
                if text:
                    self.runs.append((stack[-1], text))

        def leave(k: int) -> None:
            del stack[k:], names[k:]

        while at < end:
            m = search(source, at)
            piece = source[at : m.start() if m else end]
            if piece:
                raw.append(html.unescape(piece) if "&" in piece else piece)
                if links:
                    self.link[stack[-1]] += len(piece)
            if not m:
                break
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            tag, closing = name.lower(), m[1] or m[4]
            if tag in INLINE:
                if tag == "a":
                    links = 0 if closing else 1
                elif tag == "input" or tag == "label":
                    self.form[stack[-1]] += 1
                continue
            if closing:
                if tag == "br":
                    flush()
                elif tag in names:
                    flush()
                    k = len(names) - 1 - names[::-1].index(tag)
                    if k:
                        leave(k)
                    links = 0
                elif tag == "p":
                    flush()
                continue
            if tag in RAW or tag in SILENT:
                # its content is no text of the page: go on behind its end tag
                if tag in RAW or tag in ("svg", "math", "template", "object", "canvas", "audio", "video", "select", "button", "datalist"):
                    close = re.compile(rf"</{tag}\s*>", re.I).search(source, at) if not m[0].endswith("/>") else None
                    if close:
                        at = close.end()
                    elif tag in RAW and not m[0].endswith("/>"):
                        at = end
                if tag in ("select", "textarea", "button"):
                    self.form[stack[-1]] += 1
                continue
            flush()
            if tag in VOID:
                continue
            if tag in ("html", "body") and tag in names:
                continue
            if tag in ENDS_P:
                for k in range(len(names) - 1, 0, -1):
                    if names[k] == "p":
                        leave(k)
                        break
                    if names[k] in SCOPE:
                        break
            if tag in KIN:
                kin, bound = KIN[tag]
                for k in range(len(names) - 1, 0, -1):
                    if names[k] in bound:
                        break
                    if names[k] in kin:
                        leave(k)
                        if tag != "tr" or names[-1] not in ("tr", "td", "th"):
                            break
            good = bad = 0
            attributes = m[3] or m[6]
            if attributes:
                for n in _NAMES.findall(attributes):
                    for word in set(_WORD.findall(_CAMEL.sub(" ", n[0] or n[1] or n[2]).lower())):
                        good += word in GOOD
                        bad += word in BAD
            self.tag.append(tag)
            self.parent.append(stack[-1])
            self.good.append(good)
            self.bad.append(bad)
            self.link.append(0)
            self.form.append(0)
            stack.append(len(self.tag) - 1)
            names.append(tag)
            links = 0
        flush()

    def features(self) -> list[tuple[float, ...]]:
        n, parent, tag = len(self.tag), self.parent, self.tag
        own, runs, longest, stops, commas, words = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        start, end_at, at = [-1] * n, [0] * n, 0
        for node, text in self.runs:
            size = len(text)
            own[node] += size
            runs[node] += 1
            longest[node] = max(longest[node], size)
            stops[node] += text.count(". ") + text.endswith((".", "!", "?"))
            commas[node] += text.count(",")
            words[node] += text.count(" ") + 1
            if start[node] < 0:
                start[node] = at
            at += size
            end_at[node] = at
        total = max(1, at)
        chars, link, nodes, paragraphs, items, inputs = own[:], self.link[:], [1] * n, [0] * n, [0] * n, self.form[:]
        children: list[list[int]] = [[] for _ in range(n)]
        for v in range(n - 1, 0, -1):
            p = parent[v]
            chars[p] += chars[v]
            link[p] += link[v]
            nodes[p] += nodes[v]
            runs[p] += runs[v]
            words[p] += words[v]
            stops[p] += stops[v]
            commas[p] += commas[v]
            inputs[p] += inputs[v]
            longest[p] = max(longest[p], longest[v])
            paragraphs[p] += paragraphs[v] + (tag[v] == "p")
            items[p] += items[v] + (tag[v] == "li")
            if start[v] >= 0 and (start[p] < 0 or start[v] < start[p]):
                start[p] = start[v]
            children[p].append(v)
        depth, good_above, bad_above, nav_above, article_above = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        number, alike, before, after = [0] * n, [0] * n, [0] * n, [0] * n
        for p in range(n):
            kids = children[p][::-1]
            counts: dict[str, int] = {}
            for v in kids:
                counts[tag[v]] = counts.get(tag[v], 0) + 1
            for k, v in enumerate(kids):
                depth[v] = depth[p] + 1
                good_above[v] = good_above[p] + self.good[p]
                bad_above[v] = bad_above[p] + self.bad[p]
                nav_above[v] = nav_above[p] or tag[p] in ("nav", "header", "footer", "aside", "form", "menu")
                article_above[v] = article_above[p] or tag[p] in ("article", "main")
                number[v], alike[v] = k, counts[tag[v]]
                before[v] = chars[kids[k - 1]] if k else 0
                after[v] = chars[kids[k + 1]] if k + 1 < len(kids) else 0
        log = math.log1p
        return [
            (
                _KIND.get(tag[v], -1), depth[v], self.good[v], self.bad[v], good_above[v], bad_above[v], nav_above[v], log(own[v]), log(chars[v]),
                link[v] / (chars[v] + 1), chars[v] / nodes[v], chars[v] / total, max(start[v], 0) / total, len(children[parent[v]]) if v else 1, number[v], alike[v],
                stops[v] / (chars[v] + 1), commas[v] / (chars[v] + 1), log(paragraphs[v]), log(items[v]), link[parent[v]] / (chars[parent[v]] + 1) if v else 0.0,
                log(paragraphs[parent[v]]) if v else 0.0, log(before[v]), log(after[v]), log(longest[v]), inputs[v], article_above[v], words[v] / (runs[v] + 1),
            )
            for v in range(n)
        ]

    def weights(self) -> tuple[list[int], list[int]]:
        """Characters of own and of all text of each node."""
        own = [0] * len(self.tag)
        for node, text in self.runs:
            own[node] += len(text)
        chars = own[:]
        for v in range(len(self.tag) - 1, 0, -1):
            chars[self.parent[v]] += chars[v]
        return own, chars
