"""HTML text to element rows: one Python walk per document, everything else is DataFrame work."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = {"script", "style", "template"}

_INTS, _STRINGS = pa.list_(pa.int32()), pa.list_(pa.string())
#: The columns of the element table, in order: Spark's type and Arrow's.
COLUMNS: dict[str, tuple[str, pa.DataType]] = {
    "doc_id": ("long", pa.int64()), "ord": ("int", pa.int32()), "parent_ord": ("int", pa.int32()), "end_ord": ("int", pa.int32()), "depth": ("int", pa.int32()), "tag": ("string", pa.string()),
    "attrs": ("map<string,string>", pa.map_(pa.string(), pa.string())), "classes": ("array<string>", _STRINGS), "text": ("string", pa.string()), "string": ("string", pa.string()),
    "nth_of_type": ("int", pa.int32()), "css_path": ("string", pa.string()), "snippet": ("string", pa.string()), "bg_style": ("string", pa.string()), "page_number": ("int", pa.int32()),
    "in_label": ("int", pa.int32()), "in_fieldset": ("boolean", pa.bool_()), "tables": ("array<int>", _INTS), "forms": ("array<int>", _INTS), "figures": ("array<int>", _INTS), "links": ("array<int>", _INTS), "near": ("array<int>", _INTS),
    "text_in": ("int", pa.int32()), "text_at": ("int", pa.int32()), "text_length": ("int", pa.int32()), "text_digest": ("string", pa.string()), "page_text": ("string", pa.string()), "own_text": ("string", pa.string()),
}

#: Tags whose text is a column of its own. Every element's text holds those of the elements in it, so
#: that all others' are read from the page's buffer, where text_at and text_length say, which is kept
#: once. text_digest stands for a text of any length.
TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 title a label legend caption figcaption".split())
# Fixed value: the largest prime below 2 ** 128, the modulus of digests.
PRIME = (1 << 128) - 159
#: Characters of texts and markup that an Arrow batch holds, about.
BATCH_CHARS = 4_000_000


class Node:
    __slots__ = ("attrs", "begin", "end", "kids", "ord", "parent", "tag")

    def __init__(self, ord_: int, tag: str, attrs: dict[str, str], parent: Node | None, begin: int) -> None:
        self.ord, self.tag, self.attrs, self.parent, self.begin, self.end = ord_, tag, attrs, parent, begin, ord_
        self.kids: list[Node | Comment | str] = []


class Comment:
    __slots__ = ("data",)

    def __init__(self, data: str) -> None:
        self.data = data


class TreeBuilder(HTMLParser):
    """An end tag closes up to the nearest open element of its name; stray ones are ignored; nothing
    is closed by implication, so unclosed paragraphs nest. Comments are left out unless asked for."""

    def __init__(self, comments: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.comments = comments
        self.root = Node(-1, "[document]", {}, None, 0)
        self.open, self.nodes, self.spans = [self.root], [], {}
        self.lines: list[int] = [0]

    def feed(self, data: str) -> None:
        self.lines = [0, *[m.end() for m in re.finditer("\n", data)]]
        super().feed(data)
        self.close()

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(len(self.nodes), tag, {k: v or "" for k, v in attrs}, self.open[-1], self._at())
        self.open[-1].kids.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_comment(self, data: str) -> None:
        if self.comments:
            self.open[-1].kids.append(Comment(data))

    def handle_data(self, data: str) -> None:
        kids = self.open[-1].kids
        if kids and isinstance(kids[-1], str):
            kids[-1] += data
        else:
            kids.append(data)


def own_string(node: Node) -> str | None:
    """The text of a node whose only child is a text, or such a node."""
    while len(node.kids) == 1:
        (kid,) = node.kids
        if isinstance(kid, str):
            return kid
        node = kid
    return None


_BG = re.compile(r"background-color:\s*(#[0-9a-fA-F]{3,6}|rgb\(\s*\d+\s*,\s*\d+\s*,\s*\d+\s*\))")
_PAGE = re.compile(r"page[_-]?(\d+)")


class Buffer:
    """Stripped text pieces in page order, with the places where they end; and, if asked for, their
    prefixes as numbers in base 256 modulo a prime, so that a digest of any stretch is two of these."""

    __slots__ = ("digests", "ends", "pieces", "prefixes", "sizes")

    def __init__(self, digests: bool) -> None:
        self.pieces: list[str] = []
        self.digests, self.ends, self.sizes, self.prefixes = digests, [0], [0], [0]

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.ends.append(self.ends[-1] + len(piece))
        if self.digests:
            data = piece.encode("utf-8", "surrogatepass")
            self.sizes.append(self.sizes[-1] + len(data))
            self.prefixes.append((self.prefixes[-1] * pow(256, len(data), PRIME) + int.from_bytes(data)) % PRIME)

    def digest(self, begin: int, end: int) -> str:
        before = self.prefixes[begin] * pow(256, self.sizes[end] - self.sizes[begin], PRIME)
        return f"{(self.prefixes[end] - before) % PRIME:032x}"


def _buffers(root: Node, digests: bool) -> dict[int, tuple[Buffer, int | None, int, int]]:
    """For each element the buffer that holds its text, that buffer's element (None: the page) and where
    its pieces begin and end there. What is in a script, style or template is in a buffer of its own."""
    spans: dict[int, tuple[Buffer, int | None, int, int]] = {}
    stack: list[tuple[Node, Iterator, Buffer, int | None, int]] = [(root, iter(root.kids), Buffer(digests), None, 0)]
    while stack:
        node, kids, held, of, begin = stack[-1]
        for kid in kids:
            if isinstance(kid, Node):
                hidden = kid.tag in HIDDEN
                own = Buffer(digests) if hidden else held
                stack.append((kid, iter(kid.kids), own, kid.ord if hidden else of, len(own.pieces)))
                break
            if isinstance(kid, str) and kid.strip():
                held.add(kid.strip())
        else:
            stack.pop()
            spans[node.ord] = (held, of, begin, len(held.pieces))
    return spans


_TEXT = {"text", "text_in", "text_at", "text_length", "text_digest", "page_text", "own_text"}
_CONTEXT = {"bg_style", "page_number", "in_label", "in_fieldset", "tables", "forms", "figures", "links", "near"}


def element_rows(doc_id: int | None, html: str | None, columns: tuple[str, ...] = tuple(COLUMNS)) -> Iterator[tuple]:
    """The elements of a document in page order; only what columns ask for is worked out."""
    source, want = html or "", set(columns)
    builder = TreeBuilder()
    builder.feed(source)
    nodes = builder.nodes
    if "end_ord" in want:
        for node in reversed(nodes):
            if node.parent is not None:
                node.parent.end = max(node.parent.end, node.end)
    spans = _buffers(builder.root, "text_digest" in want) if want & _TEXT else {}
    with_context, with_paths = bool(want & _CONTEXT), "css_path" in want
    paths: list[str] = []
    depths: list[int] = []
    context: list[tuple] = []
    seen: dict[tuple[int, str], int] = {}
    for node in nodes:
        parent = node.parent.ord if node.parent else -1
        row: dict[str, object] = {"doc_id": doc_id, "ord": node.ord, "parent_ord": parent if parent >= 0 else None, "end_ord": node.end, "tag": node.tag, "attrs": list(node.attrs.items())}
        depths.append(depths[parent] + 1 if parent >= 0 else 1)
        nth = seen[parent, node.tag] = seen.get((parent, node.tag), 0) + 1
        classes = node.attrs.get("class", "").split()
        row |= {"depth": depths[-1], "classes": classes, "nth_of_type": nth}
        if spans:
            held, of, begin, end = spans[node.ord]
            row |= {"text_in": of, "text_at": held.ends[begin], "text_length": held.ends[end] - held.ends[begin]}
            row["text"] = "".join(held.pieces[begin:end]) if node.tag in TEXT_TAGS else None
            row["page_text"] = "".join(spans[-1][0].pieces) if node.ord == 0 else None
            row["own_text"] = "".join(held.pieces) if of == node.ord else None
            row["text_digest"] = held.digest(begin, end) if held.digests else None
        if "string" in want:
            row["string"] = own_string(node)
        if "snippet" in want:
            row["snippet"] = source[node.begin : node.begin + 500]
        if with_paths:
            if node.attrs.get("id"):
                paths.append(f"{node.tag}#{node.attrs['id']}")
            else:
                part = f"{node.tag}.{'.'.join(classes)}" if classes else f"{node.tag}:nth-of-type({nth})" if nth > 1 else node.tag
                paths.append(f"{paths[parent] if parent >= 0 else '[document]'} > {part}")
            row["css_path"] = paths[-1]
        if with_context:
            up = context[parent] if parent >= 0 else (None, False, (), (), (), (), None, None, (-1,))
            label, fieldset, tables, forms, figures, links, bg, page, above_ords = up
            style = _BG.search(node.attrs.get("style", ""))
            number = node.attrs.get("data-page-number", "")
            found = int(number) if number.isdigit() else None
            if found is None and "page" in " ".join(classes):
                m = _PAGE.search(" ".join(classes)) or _PAGE.search(node.attrs.get("id", ""))
                found = int(m[1]) if m else None
            own_bg = style[1] if style else None if node.tag == "html" else bg
            context.append(
                (
                    node.ord if node.tag == "label" else label,
                    fieldset or node.tag == "fieldset",
                    (*tables, node.ord) if node.tag == "table" else tables,
                    (*forms, node.ord) if node.tag == "form" else forms,
                    (*figures, node.ord) if node.tag == "figure" else figures,
                    (*links, node.ord) if node.tag == "a" else links,
                    own_bg,
                    found if found is not None else page,
                    (*above_ords, node.ord)[-3:],
                )
            )
            row |= {"bg_style": own_bg, "page_number": context[-1][7], "in_label": label, "in_fieldset": fieldset, "tables": list(tables), "forms": list(forms), "figures": list(figures), "links": list(links), "near": list(above_ords)}
        yield tuple(row[c] for c in columns)


def elements(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", columns: list[str] | None = None) -> DataFrame:
    """One row per element of each document; a document's elements are numbered in page order. Of
    columns (all: None) only those asked for are worked out."""
    names = tuple(c for c in COLUMNS if columns is None or c in columns)
    kinds = [COLUMNS[c][1] for c in names]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for d, h in zip(batch.column(0), batch.column(1), strict=True):
                html = h.as_py()
                for row in element_rows(d.as_py(), html, names):
                    rows.append(row)
                    size += 50 + sum(len(v) for v in row if isinstance(v, str))
                    if size >= BATCH_CHARS:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    rows = pages.select(F.col(id_col).cast("long").alias("doc_id"), F.col(html_col).alias("html"))
    return rows.mapInArrow(parse, ", ".join(f"{c} {COLUMNS[c][0]}" for c in names))
