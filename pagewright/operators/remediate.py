"""Document fixes: sequential within a document, parallel across documents.

Each finding is fixed at its own element, in the order of findings, since later fixes see earlier
ones (landmarks build on each other). An element's number in the page as it was is a handle that
stays valid while the tree is rewritten: it leads to the node wherever a fix has moved it, or tells
that one has removed it. Each finding gets an outcome: remediated (with no change if an earlier fix
has settled it), failed, or skipped, if there is no fix for its kind or the element is none that the
kind is about. Texts that a model would write come from an injected provider; the default one is
deterministic.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions.colour import COLOUR
from pagewright.operators.findings import numbered
from pagewright.operators.optional_rules import DECORATIVE_NAMES, SMALL
from pagewright.operators.rules import GENERIC_ALTS, GENERIC_LINKS, ICON_CLASSES, NEW_WINDOW, READER_CLASSES, SKIPPED_INPUTS, TEXT_TAGS, URL_TEXT
from pagewright.sources.html_tree import VOID, Comment, Node, TreeBuilder
from pagewright.sources.tables import written

Provider = Callable[[str, str], str]
RAW = ("script", "style")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
CONTROLS = ("input", "select", "textarea")


def stub_provider(purpose: str, context: str) -> str:
    """Stands in for a model: a plain phrase made of the context."""
    words = " ".join(context.split()[:8])
    return {"alt": f"Figure: {words}" if words else "Figure", "link": words or "Link"}.get(purpose, words)


class _End(str):
    """An end tag on its way out."""

    __slots__ = ()

    def __new__(cls, tag: str) -> _End:
        return super().__new__(cls, f"</{tag}>")


class Document:
    def __init__(self, source: str) -> None:
        builder = TreeBuilder(comments=True)
        builder.feed(source)
        self.root, self.nodes = builder.root, builder.nodes
        self.gone: set[int] = set()
        self._tags: dict[str, list[int]] | None = None
        self.doctype = (re.match(r"\s*<!doctype[^>]*>", source, re.I) or [""])[0]

    def all(self, *tags: str, under: Node | None = None) -> list[Node]:
        out, stack = [], [under or self.root]
        while stack:
            node = stack.pop()
            if node is not (under or self.root) and (not tags or node.tag in tags):
                out.append(node)
            stack += [k for k in reversed(node.kids) if isinstance(k, Node)]
        return out

    def first(self, *tags: str, under: Node | None = None) -> Node | None:
        return next(iter(self.all(*tags, under=under)), None)

    def text(self, node: Node) -> str:
        out: list[str] = []
        stack: list[Node | Comment | str] = [*reversed(node.kids)]
        while stack:
            k = stack.pop()
            if isinstance(k, str):
                out.append(k)
            elif isinstance(k, Node) and k.tag not in RAW:
                stack += reversed(k.kids)
        return " ".join("".join(out).split())

    def make(self, tag: str, text: str = "", **attrs: str) -> Node:
        node = Node(-1, tag, {k.rstrip("_").replace("_", "-"): v for k, v in attrs.items()}, None, 0)
        if text:
            node.kids.append(text)
        return node

    def insert(self, parent: Node, at: int, node: Node) -> None:
        node.parent = parent
        parent.kids.insert(at, node)

    def wrap(self, parent: Node, kids: list[Node | Comment | str], wrapper: Node) -> None:
        """Puts these children of parent, in their order, into wrapper, at the place of the first."""
        moved = {id(k) for k in kids}
        at = next((i for i, k in enumerate(parent.kids) if id(k) in moved), len(parent.kids))
        parent.kids = [k for k in parent.kids if id(k) not in moved]
        for k in kids:
            if isinstance(k, Node):
                k.parent = wrapper
            wrapper.kids.append(k)
        self.insert(parent, at, wrapper)

    def remove(self, node: Node) -> None:
        node.parent.kids = [k for k in node.parent.kids if k is not node]
        self.gone.update(id(n) for n in (node, *self.all(under=node)))

    def place(self, node: Node) -> int:
        return next(i for i, k in enumerate(node.parent.kids) if k is node)

    def node(self, ord_: int | None) -> Node | None:
        """The element of this number in the page as it was; None if it has been removed."""
        found = self.nodes[ord_] if ord_ is not None and 0 <= ord_ < len(self.nodes) else None
        return found if found is not None and id(found) not in self.gone else None

    def around(self, node: Node, *tags: str) -> Node | None:
        up = node.parent
        while up is not None and up.tag not in tags:
            up = up.parent
        return up

    def _numbers(self, tag: str) -> list[int]:
        if self._tags is None:
            self._tags = {}
            for n in self.nodes:
                self._tags.setdefault(n.tag, []).append(n.ord)
        return self._tags.get(tag, [])

    def nearest(self, node: Node, tags: Iterable[str], after: bool = False) -> Iterator[Node]:
        """The elements of these tags before (or after) a node of the page as it was, nearest first."""
        numbers = sorted(k for t in tags for k in self._numbers(t))
        at = bisect_left(numbers, node.ord)
        found = (k for k in numbers[at:] if k > node.ord) if after else reversed(numbers[:at])
        return (n for n in map(self.node, found) if n is not None)

    def body(self) -> Node:
        return self.first("body") or self.first("html") or self.root

    def written(self) -> str:
        return self.doctype + self.markup(self.root.kids)

    def markup(self, kids: list[Node | Comment | str]) -> str:
        out: list[str] = []
        stack: list[tuple[Node | Comment | str, bool]] = [(k, False) for k in reversed(kids)]  # with: raw text
        while stack:
            k, raw = stack.pop()
            if isinstance(k, str):
                out.append(k if raw else entities.escape(k, quote=False))
            elif isinstance(k, Comment):
                out.append(f"<!--{k.data}-->")
            else:
                out.append(f"<{k.tag}" + "".join(f' {name}="{entities.escape(v)}"' for name, v in k.attrs.items()) + ">")
                if k.tag not in VOID:
                    stack.append((_End(k.tag), True))
                    stack += [(x, k.tag in RAW) for x in reversed(k.kids)]
        return "".join(out)


class Result(NamedTuple):
    outcome: str
    note: str
    changes: int


def done(note: str) -> Result:
    return Result("remediated", note, 1)


def fine(note: str) -> Result:
    return Result("remediated", note, 0)


def failed(note: str) -> Result:
    return Result("failed", note, 0)


def skipped(note: str) -> Result:
    return Result("skipped", note, 0)


Handler = Callable[[Document, Node, Provider], Result]

#: By kind of finding: the fix of one element, and the tags of the elements that it is for (none: the
#: fix is for the document, whatever the element).
HANDLERS: dict[str, tuple[Handler, tuple[str, ...]]] = {}


def handles(*kinds: str, tags: str | tuple[str, ...] = ()) -> Callable[[Handler], Handler]:
    def add(f: Handler) -> Handler:
        for k in kinds:
            HANDLERS[k] = f, (tags,) if isinstance(tags, str) else tags
        return f

    return add


def headings(d: Document) -> list[Node]:
    return d.all(*HEADINGS)


@handles("missing-title", "empty-title", "generic-title")
def title(d: Document, node: Node, ask: Provider) -> Result:
    h1 = d.first("h1")
    meta = next((m for m in d.all("meta") if m.attrs.get("name") == "description"), None)
    text = (d.text(h1) if h1 else "") or (meta.attrs.get("content", "")[:60] if meta else "") or "Untitled Document"
    name = d.first("title")
    if name is None:
        head = d.first("head")
        if head is None:
            head = d.make("head")
            d.insert(d.first("html") or d.root, 0, head)
        name = d.make("title")
        d.insert(head, 0, name)
    name.kids = [text]
    return done(f"title set to {text}")


@handles("missing-document-language", "invalid-document-language")
def language(d: Document, node: Node, ask: Provider) -> Result:
    html = d.first("html")
    if html is None:
        return failed("no html element")
    html.attrs["lang"] = "en"
    return done("lang set to en")


@handles("no-h1")
def missing_h1(d: Document, node: Node, ask: Provider) -> Result:
    if d.first("h1"):
        return fine("an h1 is there")
    name = d.first("title")
    place = d.first("header") or next((n for n in d.all() if "header" in n.attrs.get("class", "")), None) or d.first("main") or d.body()
    d.insert(place, 0, d.make("h1", (d.text(name) if name else "") or "Document Title"))
    return done("h1 added")


@handles("no-headings")
def missing_headings(d: Document, node: Node, ask: Provider) -> Result:
    if headings(d):
        return fine("headings are there")
    short = [p for p in d.all("p") if 0 < len(d.text(p)) < 100 and d.first("b", "strong", under=p)]
    short += [n for n in d.all("div") if re.search("title|heading", n.attrs.get("class", "")) and 0 < len(d.text(n)) < 100]
    for k, found in enumerate(short[:6]):
        found.tag = "h1" if k == 0 else "h2"
    return done(f"{len(short[:6])} headings made") if short else missing_h1(d, node, ask)


@handles("skipped-heading-level", tags=HEADINGS)
def skipped_level(d: Document, node: Node, ask: Provider) -> Result:
    """Headings of the levels that the page lacks above this one, before it."""
    there = {int(h.tag[1]) for h in headings(d)}
    level = int(node.tag[1]) if node.tag in HEADINGS else 0
    lacking = [k for k in range(max((k for k in there if k < level), default=level), level) if k not in there]
    if not lacking:
        return fine("no level is skipped")
    before = next((h for h in d.nearest(node, HEADINGS) if h.tag in HEADINGS), None)
    for k in lacking:
        d.insert(node.parent, d.place(node), d.make(f"h{k}", f"{d.text(before) if before else 'Section'} - {d.text(node)}"))
    return done(f"{len(lacking)} headings added")


@handles("empty-heading", tags=HEADINGS)
def empty_heading(d: Document, node: Node, ask: Provider) -> Result:
    if d.text(node):
        return fine("it has a text")
    words = next((w for w in (d.text(p).split() for p in d.nearest(node, ("p",), after=True)) if w), [])
    node.kids = [" ".join(words[:5]) or "Section"]
    return done(f"text set to {node.kids[0]}")


def _has(d: Document, tag: str, role: str) -> Node | None:
    return next((n for n in d.all() if n.tag == tag or n.attrs.get("role") == role), None)


@handles("missing-main-landmark")
def main(d: Document, node: Node, ask: Provider) -> Result:
    if _has(d, "main", "main"):
        return fine("a main landmark is there")
    body = d.body()
    kids = [k for k in body.kids if not (isinstance(k, Node) and k.tag in ("header", "nav", "footer", "script"))]
    d.wrap(body, kids, d.make("main", id="main-content"))
    return done("main landmark added")


@handles("missing-navigation-landmark")
def navigation(d: Document, node: Node, ask: Provider) -> Result:
    if _has(d, "nav", "navigation"):
        return fine("a navigation landmark is there")
    lists = [u for u in d.all("ul", "ol") if len(d.all("a", under=u)) >= 2 and u.parent]
    if lists:
        d.wrap(lists[0].parent, [lists[0]], d.make("nav", aria_label="Main navigation"))
    else:
        d.insert(d.body(), 0, d.make("nav", aria_label="Main navigation"))
    return done("navigation landmark added")


@handles("missing-header-landmark")
def header(d: Document, node: Node, ask: Provider) -> Result:
    if _has(d, "header", "banner"):
        return fine("a header landmark is there")
    body = d.body()
    made = d.make("header", role="banner")
    h1 = d.first("h1")
    if h1 and h1.parent is body:
        d.wrap(body, [h1], made)
    else:
        d.insert(body, 0, made)
    return done("header landmark added")


@handles("missing-footer-landmark")
def footer(d: Document, node: Node, ask: Provider) -> Result:
    if _has(d, "footer", "contentinfo"):
        return fine("a footer landmark is there")
    d.insert(d.body(), len(d.body().kids), d.make("footer", role="contentinfo"))
    return done("footer landmark added")


@handles("missing-skip-link")
def skip_link(d: Document, node: Node, ask: Provider) -> Result:
    main(d, node, ask)
    target = _has(d, "main", "main")
    target.attrs.setdefault("id", "main-content")
    d.insert(d.body(), 0, d.make("a", "Skip to main content", href=f"#{target.attrs['id']}", class_="skip-link"))
    return done("skip link added")


def _file_words(img: Node) -> str:
    return re.sub(r"[-_]+", " ", re.sub(r"\.\w+$", "", img.attrs.get("src", "").rpartition("/")[2]))


def _number(value: str | None) -> int | None:
    return int(value) if value is not None and re.fullmatch(r"\s*\d+\s*", value) else None


def decorative(img: Node) -> bool:
    """By role, by size, or by the name of its source."""
    width, height = (_number(img.attrs.get(k)) for k in ("width", "height"))
    small = width is not None and height is not None and width < SMALL and height < SMALL
    return img.attrs.get("role") == "presentation" or img.attrs.get("aria-hidden") == "true" or small or any(w in img.attrs.get("src", "") for w in DECORATIVE_NAMES)


@handles("missing-alt-text", "empty-alt-text", "generic-alt-text", tags="img")
def alt(d: Document, node: Node, ask: Provider) -> Result:
    """An empty alt text of a decorative image is confirmed by a role; all others get a text."""
    now = node.attrs.get("alt")
    if now is not None and not now.strip() and decorative(node):
        if node.attrs.get("role") == "presentation":
            return fine("it is marked as decorative")
        node.attrs["role"] = "presentation"
        return done("marked as decorative")
    if now is None or not now.strip() or now.strip().lower() in GENERIC_ALTS:
        node.attrs["alt"] = ask("alt", _file_words(node))
        return done(f"alt set to {node.attrs['alt']}")
    return fine("it has an alt text")


def _caption(d: Document, img: Node | None, place: Node, made_attr: str = "data-generated-alt") -> str:
    """A caption: a substantial alt text, else the next paragraph if it is one (it goes), else title,
    words of the file name, an extractor's alt text, or the heading before."""
    attrs = img.attrs if img else {}
    if len(attrs.get("alt", "")) > 10:
        return attrs["alt"]
    p = next(d.nearest(img or place, ("p",), after=True), None)
    told = d.text(p) if p is not None else ""
    if re.match(r"Figure|Fig\.", told) and not d.first("img", "figure", "table", under=p):
        d.remove(p)
        return told
    if attrs.get("title"):
        return attrs["title"]
    name = attrs.get("src", "").split("/")[-1].split(".")[0]
    if len(name) > 5 and not name.isdigit() and (words := re.findall("[A-Za-z]+", name)):
        return " ".join(w.capitalize() for w in words)
    if attrs.get(made_attr):
        return attrs[made_attr]
    return next((t for t in (d.text(h) for h in d.nearest(img or place, HEADINGS)) if t), "")


def _put_caption(d: Document, figure: Node, text: str) -> None:
    """A numbered caption stands before the image, any other after it."""
    first = re.match(r"(?:Figure|Fig\.)\s+\d+", text, re.I)
    d.insert(figure, 0 if first else len(figure.kids), d.make("figcaption", text))


@handles("missing-figure-caption", "empty-figure-caption", "missing-figcaption", tags="figure")
def figure(d: Document, node: Node, ask: Provider) -> Result:
    caption, img = d.first("figcaption", under=node), d.first("img", under=node)
    if caption is not None and d.text(caption):
        return fine("it has a caption")
    text = _caption(d, img, node) or ask("alt", "")
    if caption is None:
        _put_caption(d, node, text)
    else:
        caption.kids = [text]
    return done(f"caption set to {text}")


@handles("improper-figure-structure", tags="img")
def figure_around(d: Document, node: Node, ask: Provider) -> Result:
    """An image gets a figure around it, in its place, which takes its id and has its caption as a name."""
    if d.around(node, "figure") is not None:
        return fine("it is in a figure")
    box = d.make("figure", role="group", class_="content-figure")
    if node.attrs.get("id"):
        box.attrs["id"] = node.attrs.pop("id")
    text = _caption(d, node, node)
    d.wrap(node.parent, [node], box)
    if text:
        box.attrs["aria-label"] = text
        _put_caption(d, box, text)
    return done(f"figure added, captioned {text}" if text else "figure added without a caption")


@handles("empty-link-text", "generic-link-text", "url-as-link-text", tags="a")
def links(d: Document, node: Node, ask: Provider) -> Result:
    text, href = d.text(node), node.attrs.get("href", "")
    img = d.first("img", under=node)
    if (not text and img is not None and img.attrs.get("alt")) or re.fullmatch("#+", href):
        return fine("it has a name, or leads nowhere")
    if text and text.lower() not in GENERIC_LINKS and not re.search(URL_TEXT, text):
        return fine("it has a text that tells")
    site = re.match(r"https?://(?:www\.)?([^/]+)", href)
    # a site's name is kept off the forms that count as an address
    told = re.sub(r"\.(com|org|net|edu|gov|io)$", "", site[1]).replace(".", " ") if site else ""
    told = told or ask("link", re.sub(r"[/#?=&._-]+", " ", href).strip() or _around(d, node))
    name = f"Link to {told}" if told.lower() not in GENERIC_LINKS else f"Link to the page {told}"
    if not text and img is not None:
        img.attrs["alt"] = name
    else:
        node.kids = [name]
    return done(f"text set to {name}")


def _around(d: Document, node: Node) -> str:
    """The first words of the element around a node that has any."""
    up = node.parent
    while up is not None and not d.text(up):
        up = up.parent
    return " ".join(d.text(up).split()[:8]) if up is not None else ""


def warns(d: Document, node: Node) -> bool:
    """Whether a link tells of its new window: by text, aria-label, title, a text for readers, an icon."""
    def told(text: str) -> bool:
        return any(w in text.lower() for w in NEW_WINDOW)

    if told(d.text(node)) or told(node.attrs.get("aria-label", "")) or told(node.attrs.get("title", "")):
        return True
    return any(n.tag == "i" and any(c in n.attrs.get("class", "") for c in ICON_CLASSES) or n.tag in ("span", "div") and any(c in n.attrs.get("class", "") for c in READER_CLASSES) and told(d.text(n)) for n in d.all(under=node))


@handles("new-window-link-no-warning", tags="a")
def new_window(d: Document, node: Node, ask: Provider) -> Result:
    if node.attrs.get("target") != "_blank" and "external" not in node.attrs.get("rel", "").split():
        return skipped("it opens no new window")
    if warns(d, node):
        return fine("it warns")
    node.kids.append(" (opens in new window)")
    return done("warning added")


def _rows(d: Document, table: Node) -> list[Node]:
    return d.all("tr", under=table)


def layout_table(d: Document, table: Node) -> bool:
    """As the table rules tell it: by role, by class, or by having neither headers nor caption and one
    row or one column."""
    if table.attrs.get("role") == "presentation" or re.search("layout|grid|non-data", " ".join(table.attrs.get("class", "").split()).lower()):
        return True
    if d.first("th", under=table) or d.first("caption", under=table):
        return False
    rows = _rows(d, table)
    return len(rows) <= 1 or len(d.all("td", "th", under=rows[0])) <= 1


def _data_table(f: Handler) -> Handler:
    """Leaves layout tables alone."""
    def run(d: Document, node: Node, ask: Provider) -> Result:
        table = node if node.tag == "table" else d.around(node, "table")
        if table is None or layout_table(d, table):
            return skipped("no data table")
        return f(d, node, ask)

    return run


@handles("table-missing-headers", "missing-table-headers", tags="table")
@_data_table
def table_headers(d: Document, node: Node, ask: Provider) -> Result:
    if d.first("th", under=node):
        return fine("it has headers")
    cells = d.all("td", under=_rows(d, node)[0])
    for c in cells:
        c.tag, c.attrs["scope"] = "th", "col"
    return done(f"{len(cells)} cells made headers") if cells else failed("its first row has no cells")


def _scope(row: Node, row_no: int, cell_no: int) -> str:
    in_head = row.parent is not None and row.parent.tag == "thead"
    return "col" if in_head or row_no == 0 or cell_no else "row"


@handles("table-missing-scope", "missing-header-scope", tags="th")
@_data_table
def header_scope(d: Document, node: Node, ask: Provider) -> Result:
    """The scope of one header: where it stands in its row and table says which."""
    if "scope" in node.attrs:
        return fine("it has a scope")
    row, table = d.around(node, "tr"), d.around(node, "table")
    if row is None or d.around(row, "table") is not table:
        return failed("it is in no row of its table")
    first_row = d.first("tr", under=table) is row
    first_cell = d.first("td", "th", under=row) is node
    node.attrs["scope"] = _scope(row, 0 if first_row else 1, 0 if first_cell else 1)
    return done(f"scope set to {node.attrs['scope']}")


@handles("table-irregular-headers", tags="table")
@_data_table
def table_scopes(d: Document, node: Node, ask: Provider) -> Result:
    n = 0
    for i, row in enumerate(_rows(d, node)):
        for j, cell in enumerate(d.all("td", "th", under=row)):
            if cell.tag == "th" and "scope" not in cell.attrs:
                cell.attrs["scope"] = _scope(row, i, j)
                n += 1
    return done(f"scope of {n} headers set") if n else failed("its headers have scopes")


@handles("table-missing-caption", "missing-table-caption", tags="table")
@_data_table
def table_caption(d: Document, node: Node, ask: Provider) -> Result:
    if d.first("caption", under=node):
        return fine("it has a caption")
    before = next((t for t in (d.text(h) for h in d.nearest(node, HEADINGS)) if t), "")
    d.insert(node, 0, d.make("caption", before or "Table data"))
    return done("caption added")


@handles("table-missing-thead", tags="table")
@_data_table
def table_head(d: Document, node: Node, ask: Provider) -> Result:
    if d.first("thead", under=node):
        return fine("it has a head")
    row = d.first("tr", under=node)
    if row is None or not d.first("th", under=row):
        return failed("its first row has no headers")
    part = row.parent
    head = d.make("thead")
    if part is node:
        d.wrap(node, [row], head)
    else:  # the row leaves its body, before which the head stands
        part.kids = [k for k in part.kids if k is not row]
        row.parent, head.kids = head, [row]
        d.insert(part.parent, d.place(part), head)
    return done("head added")


@handles("table-missing-tbody", tags="table")
@_data_table
def table_body(d: Document, node: Node, ask: Provider) -> Result:
    if d.first("tbody", under=node):
        return fine("it has a body")
    direct = [k for k in node.kids if isinstance(k, Node) and k.tag == "tr"]
    if direct and len(direct) > 1 and not d.first("thead", under=node) and d.first("th", under=direct[0]):
        direct = direct[1:]  # the headers' row is for the head
    if not direct:
        return failed("it has no rows of its own")
    d.wrap(node, direct, d.make("tbody"))
    return done("body added")


@handles("table-missing-headers-id", "complex-table-no-ids", tags="table")
@_data_table
def table_ids(d: Document, node: Node, ask: Provider) -> Result:
    n, told = 0, 0
    heads: dict[int, str] = {}
    taken = {x.attrs["id"] for x in d.all() if x.attrs.get("id")}
    for row in _rows(d, node):
        for j, cell in enumerate(d.all("td", "th", under=row)):
            if cell.tag == "th":
                if not cell.attrs.get("id"):
                    slug = re.sub("[^a-z0-9]", "-", d.text(cell).lower()[:20])
                    slug = f"th-{slug}" if slug[:1].isalpha() else f"header-{n}"
                    cell.attrs["id"] = slug if slug not in taken else next(x for k in range(len(taken) + 1) if (x := f"{slug}-{k}") not in taken)
                    taken.add(cell.attrs["id"])
                heads[j] = cell.attrs["id"]
                n += 1
            elif j in heads:
                cell.attrs.setdefault("headers", heads[j])
                told += 1
    return done(f"{n} headers and {told} cells tied") if n else failed("it has no headers")


def _control_name(c: Node) -> str:
    return c.attrs.get("placeholder") or c.attrs.get("name", "").replace("_", " ").title() or c.attrs.get("type", "text").title()


def named(d: Document, control: Node) -> bool:
    """As the label rule tells it: by a label around it or for it, aria-label, title, or the text of an
    element that aria-labelledby names."""
    if d.around(control, "label") is not None or control.attrs.get("aria-label", "").strip() or control.attrs.get("title", "").strip():
        return True
    id_, by = control.attrs.get("id"), control.attrs.get("aria-labelledby", "").split()
    return any((id_ and n.tag == "label" and n.attrs.get("for") == id_) or (n.attrs.get("id") in by and d.text(n)) for n in d.all()) if id_ or by else False


@handles("form-control-missing-label", "missing-form-label", tags=CONTROLS)
def form_label(d: Document, node: Node, ask: Provider) -> Result:
    if node.attrs.get("type", "").lower() in SKIPPED_INPUTS and node.tag == "input":
        return skipped("it needs no label")
    if named(d, node):
        return fine("it has a name")
    text = _control_name(node)
    d.insert(node.parent, d.place(node), d.make("label", text, for_=node.attrs.setdefault("id", f"control-{node.ord}")))
    return done(f"label {text} added")


@handles("form-label-empty", tags="label")
def empty_label(d: Document, node: Node, ask: Provider) -> Result:
    """The label of a control is called as the control is."""
    if d.text(node):
        return fine("it has a text")
    target = d.first(*CONTROLS, under=node)
    if target is None and node.attrs.get("for"):
        target = next((n for n in d.all(*CONTROLS) if n.attrs.get("id") == node.attrs["for"]), None)
    if target is None:
        return failed("it is for no control")
    node.kids.insert(0, _control_name(target))
    return done(f"text set to {node.kids[0]}")


@handles("form-required-field-missing-aria", "form-required-field-not-indicated", "missing-aria-required", tags=CONTROLS)
def form_required(d: Document, node: Node, ask: Provider) -> Result:
    if "required" not in node.attrs and node.attrs.get("aria-required") != "true":
        return skipped("it is not required")
    node.attrs["aria-required"] = "true"
    for label in d.all("label"):
        if node.attrs.get("id") and label.attrs.get("for") == node.attrs["id"] and not re.search(r"\*|required", d.text(label).lower()):
            label.kids.append(" *")
    return done("marked as required")


@handles("form-fieldset-missing-legend", tags="fieldset")
def fieldset(d: Document, node: Node, ask: Provider) -> Result:
    legend = d.first("legend", under=node)
    if legend is not None and d.text(legend):
        return fine("it has a legend")
    if legend is None:
        legend = d.make("legend")
        d.insert(node, 0, legend)
    legend.kids = ["Form group"]
    return done("legend added")


def _legend(d: Document, controls: list[Node]) -> str:
    """What the labels of these controls begin with, if that is more than three characters. It keeps its
    case, as it is shown."""
    labels = {n.attrs["for"]: d.text(n) for n in reversed(d.all("label")) if n.attrs.get("for")}
    told = [labels[c.attrs["id"]] for c in controls if c.attrs.get("id") in labels]
    common = commonprefix(told)
    return common.strip() if len(common) > 3 else ""


@handles("form-related-controls-no-fieldset", "missing-fieldset", tags="form")
def group_controls(d: Document, node: Node, ask: Provider) -> Result:
    """In a form without a fieldset, what stands in a division with two controls or more goes into
    one; of nested divisions the outermost counts. Without such divisions, controls whose names begin
    alike (to the first underscore) make a group, and what is around its first one goes into a fieldset."""
    form = node if node.tag == "form" else d.around(node, "form")
    if form is None:
        return failed("it is in no form")
    if d.first("fieldset", under=form):
        return fine("the form has a fieldset") if node is form or d.around(node, "fieldset") is not None else failed("the form's fieldset leaves it out")
    groups: list[tuple[Node, str]] = []
    for div in d.all("div", under=form):
        inside = d.all(*CONTROLS, under=div)
        if len(inside) >= 2:
            groups.append((div, _legend(d, inside)))
    if not groups:
        alike: dict[str, list[Node]] = {}
        for c in d.all(*CONTROLS, under=form):
            if c.attrs.get("name"):
                alike.setdefault(c.attrs["name"].split("_")[0], []).append(c)
        groups = [(cs[0].parent, prefix.capitalize()) for prefix, cs in alike.items() if len(cs) >= 2]
    wrapped: set[int] = set()
    for parent, legend in groups:
        up = parent
        while up is not form and id(up) not in wrapped:
            up = up.parent
        if id(up) in wrapped:  # it is in a fieldset already
            continue
        wrapped.add(id(parent))
        box = d.make("fieldset")
        d.wrap(parent, list(parent.kids), box)
        if legend:
            d.insert(box, 0, d.make("legend", legend))
    return done(f"{len(wrapped)} fieldsets added") if wrapped else failed("no controls belong together")


_TEXT_COLOUR = re.compile(rf"color:\s*{COLOUR}")
_BACKGROUND = re.compile(rf"background-color:\s*{COLOUR}")


def _channels(colour: str) -> tuple[float, float, float]:
    """The channels, from 0 to 1, of #RGB, #RRGGBB or rgb()."""
    if colour.startswith("rgb"):
        r, g, b = (min(255, int(x)) for x in re.findall(r"\d+", colour))
    else:
        digits = colour[1:] if len(colour) > 4 else "".join(c * 2 for c in colour[1:])
        r, g, b = (int(digits.ljust(6, "0")[i : i + 2], 16) for i in (0, 2, 4))
    return r / 255, g / 255, b / 255


def _luminance(colour: str) -> float:
    linear = [v / 12.92 if v <= 0.03928 else ((v + 0.055) / 1.055) ** 2.4 for v in _channels(colour)]
    return sum(weight * v for weight, v in zip((0.2126, 0.7152, 0.0722), linear, strict=True))


def _ratio(one: str, other: str) -> float:
    low, high = sorted((_luminance(one), _luminance(other)))
    return (high + 0.05) / (low + 0.05)


def _size(n: Node, style: str) -> bool:
    """Large text, which needs less contrast."""
    m = re.search(r"font-size:\s*(\d+)(px|pt|em|rem)", style)
    pixels = int(m[1]) * {"px": 1, "pt": 1.333, "em": 16, "rem": 16}[m[2]] if m else 0
    bold = n.tag in ("b", "strong") or bool(re.search(r"font-weight:\s*(bold|700|800|900)", style))
    return n.tag in ("h1", "h2", "h3") or pixels >= 24 or (pixels >= 18.67 and bold)


@handles("insufficient-color-contrast", tags=TEXT_TAGS)
def contrast(d: Document, node: Node, ask: Provider) -> Result:
    """Text that is too near to the background it stands on, its own or that of the nearest element
    around it, becomes black or white, whichever is farther from it."""
    style = node.attrs.get("style", "")
    behind, up = None, node
    while behind is None and up is not None:
        own = _BACKGROUND.search(up.attrs.get("style", ""))
        behind = own[1] if own else "#FFFFFF" if up.tag == "html" else None
        up = up.parent
    behind = behind or "#FFFFFF"
    found = _TEXT_COLOUR.search(style)
    now = found[1] if found else "#000000"
    if not d.text(node) or _ratio(now, behind) >= (3.0 if _size(node, style) else 4.5):
        return fine("its contrast is enough")
    best = max(("#000000", "#ffffff"), key=lambda c: _ratio(c, behind))
    kept = re.sub(r"(?<![-\w])color:[^;]*;?\s*", "", style).strip().rstrip(";")
    # the colour stands before any background, as the rule reads the first that it finds
    node.attrs["style"] = f"color: {best}" + (f"; {kept}" if kept else "")
    return done(f"colour set to {best}")


def fixed(source: str, kinds: list[str], ask: Provider = stub_provider) -> tuple[str, list[str], list[str], list[str]]:
    """The document after the fixes of these kinds, wherever an element of it needs one, each kind once,
    in this order; and the kinds that changed it, that did not, and that have no fix."""
    d, changed, same, unknown = Document(source), [], [], []
    for kind in dict.fromkeys(kinds):
        if kind not in HANDLERS:
            unknown.append(kind)
            continue
        handler, tags = HANDLERS[kind]
        nodes = [n for n in d.nodes if n.tag in tags and id(n) not in d.gone] if tags else [d.root]
        results = [handler(d, n, ask) for n in nodes if id(n) not in d.gone]
        (changed if any(r.changes for r in results) else same).append(kind)
    return (d.written() if changed else source), changed, same, unknown


def settled(source: str, findings: list[tuple[str, int | None]], ask: Provider = stub_provider) -> tuple[str, list[Result]]:
    """The document after the fixes of findings (type, number of the element), in this order, and what
    became of each. A fix that breaks fails alone."""
    d, results = Document(source), []
    for kind, at in findings:
        if kind not in HANDLERS:
            results.append(skipped("no fix for this kind"))
            continue
        handler, tags = HANDLERS[kind]
        node = d.node(at)
        if tags and node is None:
            results.append(failed("the element is not there"))
            continue
        try:
            results.append(handler(d, node if node is not None else d.root, ask))
        except Exception as e:  # an injected provider may raise anything
            results.append(failed(f"{type(e).__name__}: {e}"))
    return (d.written() if any(r.changes for r in results) else source), results


OUTCOME = "issue_id:string,type:string,ord:int,outcome:string,note:string,changes:int"
_OUTCOMES = pa.list_(pa.struct([("issue_id", pa.string()), ("type", pa.string()), ("ord", pa.int32()), ("outcome", pa.string()), ("note", pa.string()), ("changes", pa.int32())]))


def remediated(pages: DataFrame, findings: DataFrame, ask: Provider = stub_provider, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """doc_id, html, outcomes: each document after its fixes, and per finding, in order, issue_id, type,
    ord, outcome, note and changes. Findings without an issue_id are numbered. A document's findings
    come as one array, so a document is one row and no group is gathered in Python."""
    told = findings if "issue_id" in findings.columns else numbered(findings)
    issue = F.struct("check_no", "emit_no", "type", "issue_id", "ord")
    work = told.filter("status = 'needs_remediation'").groupBy("doc_id").agg(F.array_sort(F.collect_list(issue)).alias("issues"))
    # written, as an audit's plan is long and what is made of the fixed pages would hold it again
    rows = pages.select(F.col(id_col).cast("long").alias("doc_id"), F.col(html_col).alias("html")).join(written(work, "findings"), "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            htmls, outcomes = [], []
            for html, issues in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                issues = issues or []
                out, results = settled(html or "", [(x["type"], x["ord"]) for x in issues], ask)
                htmls.append(out)
                outcomes.append([{"issue_id": x["issue_id"], "type": x["type"], "ord": x["ord"], **r._asdict()} for x, r in zip(issues, results, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(htmls, pa.string()), pa.array(outcomes, _OUTCOMES)], names=["doc_id", "html", "outcomes"])

    return rows.select("doc_id", "html", "issues").mapInArrow(run, f"doc_id long, html string, outcomes array<struct<{OUTCOME}>>")


def outcome_rows(fixes: DataFrame) -> DataFrame:
    """A row for each finding of fixes, as remediated() gives them."""
    return fixes.select("doc_id", F.inline("outcomes"))


def outcome_summary(fixes: DataFrame) -> DataFrame:
    """Per document: findings processed, remediated, failed and skipped, changes applied, and the types
    that failed."""
    def n(outcome: str) -> F.Column:
        return F.size(F.filter("outcomes", lambda x: x["outcome"] == outcome)).cast("long").alias(outcome)

    lost = F.array_sort(F.array_distinct(F.transform(F.filter("outcomes", lambda x: x["outcome"] != "remediated"), lambda x: x["type"])))
    return fixes.select("doc_id", F.size("outcomes").cast("long").alias("processed"), n("remediated"), n("failed"), n("skipped"), F.aggregate("outcomes", F.lit(0).cast("long"), lambda a, x: a + x["changes"]).alias("changes_applied"), lost.alias("failed_types"))
