"""Edits at a place: an element found by a CSS selector, or by what a finding says, and changed.

Selectors are lists of compounds (tag, #id, .class, [attribute], :first-child, :last-child,
:first-of-type, :nth-child(n), :nth-of-type(n)) joined by the four combinators; the first element in
page order counts. An edit whose selector is not one of these, or meets nothing, fails alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.operators.remediate import Document
from pagewright.sources.html_tree import Comment, Node, TreeBuilder

_NAME = r"(?:\\.|[\w-])+"
_SIMPLE = re.compile(
    rf"""(?P<tag>\*|[a-zA-Z][\w-]*)|\#(?P<id>{_NAME})|\.(?P<class>{_NAME})
    |\[\s*(?P<name>[\w:-]+)\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<double>[^"]*)"|'(?P<single>[^']*)'|(?P<bare>[^\]\s"']+))\s*)?\]
    |:(?P<pseudo>first-child|last-child|first-of-type|nth-child|nth-of-type)(?:\(\s*(?P<n>\d+)\s*\))?""",
    re.X,
)
_JOINED = re.compile(r"\s*([>+~,])\s*|\s+")
Test = Callable[[Node], bool]

#: How an attribute's value is compared, by the operator.
_COMPARED: dict[str, Callable[[str, str], bool]] = {
    "=": lambda have, want: have == want,
    "~=": lambda have, want: want in have.split(),
    "|=": lambda have, want: have == want or have.startswith(f"{want}-"),
    "^=": lambda have, want: bool(want) and have.startswith(want),
    "$=": lambda have, want: bool(want) and have.endswith(want),
    "*=": lambda have, want: bool(want) and want in have,
}


def _siblings(node: Node, tag: str | None = None) -> list[Node]:
    return [k for k in node.parent.kids if isinstance(k, Node) and tag in (None, k.tag)]


def _test(m: re.Match) -> Test:
    if m["tag"]:
        return lambda node: m["tag"] in ("*", node.tag) or m["tag"].lower() == node.tag
    if m["id"] or m["class"]:
        want = re.sub(r"\\(.)", r"\1", m["id"] or m["class"])
        return (lambda node: node.attrs.get("id") == want) if m["id"] else (lambda node: want in node.attrs.get("class", "").split())
    if m["name"]:
        name, want = m["name"].lower(), next((x for x in (m["double"], m["single"], m["bare"]) if x is not None), "")
        return (lambda node: name in node.attrs and _COMPARED[m["op"]](node.attrs[name], want)) if m["op"] else (lambda node: name in node.attrs)
    if m["pseudo"].startswith("nth") != bool(m["n"]):
        raise ValueError(m[0])
    place = int(m["n"] or 1)
    of_type = m["pseudo"].endswith("of-type")

    def stands(node: Node) -> bool:
        row = _siblings(node, node.tag if of_type else None)
        k = len(row) if m["pseudo"] == "last-child" else place
        return 0 < k <= len(row) and row[k - 1] is node

    return stands


def parsed(selector: str) -> list[list[tuple[str, list[Test]]]]:
    """The alternatives of a selector: compounds in order, each with the combinator before it."""
    found: list[list[tuple[str, list[Test]]]] = [[("", [])]]
    at, selector = 0, selector.strip()
    while at < len(selector):
        m = _SIMPLE.match(selector, at)
        tests = found[-1][-1][1]
        if m and not (m["tag"] and tests):
            tests.append(_test(m))
        else:
            m = _JOINED.match(selector, at)
            if not m or not tests:
                raise ValueError(f"not a selector: {selector}")
            if m[1] == ",":
                found.append([("", [])])
            else:
                found[-1].append((m[1] or " ", []))
        at = m.end()
    if not all(tests for steps in found for _, tests in steps):
        raise ValueError(f"not a selector: {selector}")
    return found


def _before(node: Node, joined: str) -> Iterator[Node]:
    """The nodes that may stand before node under this combinator, nearest first."""
    if joined in (" ", ">"):
        up = node.parent
        while up is not None and up.parent is not None:
            yield up
            up = up.parent if joined == " " else None
    else:
        row = _siblings(node)
        place = next(k for k, x in enumerate(row) if x is node)
        yield from reversed(row[:place] if joined == "~" else row[max(0, place - 1) : place])


def _meets(node: Node, steps: list[tuple[str, list[Test]]]) -> bool:
    *rest, (joined, tests) = steps
    return all(t(node) for t in tests) and (not rest or any(_meets(x, rest) for x in _before(node, joined)))


def select(d: Document, selector: str) -> Node | None:
    """The first element that the selector meets; ValueError if it is none."""
    ways = parsed(selector)
    return next((node for node in d.all() if any(_meets(node, steps) for steps in ways)), None)


def _fragment(markup: str) -> list[Node | Comment | str]:
    builder = TreeBuilder(comments=True)
    builder.feed(markup)
    return builder.root.kids


def _put(node: Node, kids: list[Node | Comment | str]) -> None:
    """kids in the place of node."""
    for k in kids:
        if isinstance(k, Node):
            k.parent = node.parent
    at = next(i for i, k in enumerate(node.parent.kids) if k is node)
    node.parent.kids[at : at + 1] = kids


def edit(d: Document, action: str, selector: str, name: str | None, value: str | None) -> bool:
    """One edit: attribute sets name to value, content puts all nodes of the markup in value in the
    element's place, replace only the first one (and fails if there is none)."""
    try:
        node = select(d, selector or "")
    except ValueError:
        return False
    if node is None or action not in ("attribute", "content", "replace") or (action == "attribute" and not name):
        return False
    if action == "attribute":
        node.attrs[name.lower()] = value or ""
        return True
    kids = _fragment(value or "")
    if action == "replace":
        kids = kids[:1]
        if not kids:
            return False
    _put(node, kids)
    return True


def edited(pages: DataFrame, edits: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """doc_id, html, applied and failed (numbers of edits) for each page after its edits (doc_id,
    edit_no, action, selector, name, value) in the order of edit_no. Pages without edits stay as they
    are, a null page counts as empty, edits of other documents are left out."""
    work = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("edit_no", "action", "selector", "name", "value"))).alias("edits"))
    rows = pages.select(F.col(id_col).alias("doc_id"), F.col(html_col).alias("html")).join(work, "doc_id", "left")

    def one(source: str, todo: list) -> tuple[str, list[int], list[int]]:
        d, applied, failed = Document(source), [], []
        for e in todo:
            (applied if edit(d, e["action"], e["selector"], e["name"], e["value"]) else failed).append(e["edit_no"])
        return d.written() if applied else source, applied, failed

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(i, *one(h or "", [] if todo is None else list(todo))) for i, h, todo in zip(frame["doc_id"], frame["html"], frame["edits"], strict=True)]
            yield pd.DataFrame(out, columns=["doc_id", "html", "applied", "failed"])

    return rows.mapInPandas(run, "doc_id long, html string, applied array<int>, failed array<int>")


# The borders that preprocessing gives.
TABLE_BORDER = "border: 1px solid black; border-collapse: collapse;"
CELL_BORDER = "border: 1px solid black;"


def _own_rows(d: Document, table: Node) -> list[Node]:
    """The rows of a table without those of the tables in it."""
    rows = []
    for row in d.all("tr", under=table):
        up = row.parent
        while up.tag != "table":
            up = up.parent
        if up is table:
            rows.append(row)
    return rows


def looks_like_header(d: Document, row: Node) -> bool:
    """Whether the signs of headings (bold text, a bold style, a class named after headers) are more
    than half as many as the cells."""
    signs, cells = 0, d.all("td", under=row)
    for cell in cells:
        signs += d.first("b", "strong", under=cell) is not None
        signs += bool(re.search("bold|font-weight", cell.attrs.get("style", "").lower()))
        signs += "header" in cell.attrs.get("class", "").lower()
    return signs > len(cells) / 2


def prepared_tables(source: str) -> str:
    """The page with a border at each table, row and cell that names none, and with a first row that
    looks like headings made a head; the other rows become the body. Tables within tables keep their
    rows, and row groups that this empties go."""
    d = Document(source)
    for table in d.all("table"):
        if not d.first("tr", under=table):
            continue
        for node in [table, *d.all("th", "td", "tr", under=table)]:
            style = node.attrs.get("style", "")
            if "border" not in style.lower():
                node.attrs["style"] = f"{style}; {TABLE_BORDER if node is table else CELL_BORDER}"
        rows = _own_rows(d, table)
        if (d.first("thead", under=table) and d.first("tbody", under=table)) or d.first("th", under=table) or not rows or not looks_like_header(d, rows[0]):
            continue
        for row in rows:
            row.parent.kids = [k for k in row.parent.kids if k is not row]
        for cell in [c for c in rows[0].kids if isinstance(c, Node) and c.tag == "td"]:
            cell.tag, cell.attrs = "th", {"scope": "col"} | {k: v for k, v in cell.attrs.items() if k != "scope"}
        table.kids = [k for k in table.kids if not (isinstance(k, Node) and k.tag in ("thead", "tbody", "tfoot") and not any(isinstance(x, Node) or str(x).strip() for x in k.kids))]
        for tag, some in (("thead", rows[:1]), ("tbody", rows[1:])):
            group = d.make(tag)
            for row in some:
                d.insert(group, len(group.kids), row)
            d.insert(table, len(table.kids), group)
    return d.written()


def _lacks(d: Document, table: Node, kind: str) -> bool:
    """Whether a table has what this kind of finding is about."""
    heads = d.all("th", under=table)
    if kind in ("table-missing-scope", "table-irregular-headers"):
        return any(not h.attrs.get("scope") if kind == "table-irregular-headers" else "scope" not in h.attrs for h in heads)
    missing = {"table-missing-headers": "th", "table-missing-thead": "thead", "table-missing-tbody": "tbody"}.get(kind)
    return missing is not None and d.first(missing, under=table) is None


def located_table(d: Document, kind: str = "", selector: str = "", element: str = "", text: str = "", index: int = 0) -> Node | None:
    """The table of a finding: by its selector, then by a text in it or its index (where the element
    is told as table alone) or by its markup without white space, then the first that the kind of
    finding fits, then, for kinds of tables, the first."""
    tables = d.all("table")
    if selector:
        try:
            found = select(d, selector)
        except ValueError:
            found = None
        if found is not None and found.tag == "table":
            return found
    if element == "table":
        with_text = [t for t in tables if text and text in "".join(_strings(t))]
        if with_text or 0 <= index < len(tables):
            return with_text[0] if with_text else tables[index]
    elif element.startswith("<table"):
        bare = re.sub(r"\s+", "", element)
        same = [t for t in tables if re.sub(r"\s+", "", d.markup([t])) == bare]
        if same:
            return same[0]
    fitting = [t for t in tables if _lacks(d, t, kind)]
    if fitting:
        return fitting[0]
    return tables[0] if tables and kind.startswith("table-") else None


def _strings(node: Node) -> Iterator[str]:
    stack = [*reversed(node.kids)]
    while stack:
        k = stack.pop()
        if isinstance(k, str):
            yield k
        elif isinstance(k, Node):
            stack += reversed(k.kids)


def of_pages(pages: DataFrame, change: Callable[[str], str], id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """doc_id, html: each page after change; a null page counts as empty."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "html": [change(h or "") for h in frame["html"]]})

    return pages.select(F.col(id_col).alias("doc_id"), F.col(html_col).alias("html")).mapInPandas(run, "doc_id long, html string")


def tables_of(pages: DataFrame, findings: DataFrame) -> DataFrame:
    """doc_id, finding_no, place: for findings (doc_id, finding_no, type, selector, element, text,
    index) on pages (page_id, html), which table of the page, from 0, each is about; null if none."""
    names = ("type", "selector", "element", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, d = "", Document("")
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                if source != (r["html"] or ""):  # findings of a page come one after the other
                    source = r["html"] or ""
                    d = Document(source)
                at = located_table(d, *(r[k] or "" for k in names), index=int(r["index"]))
                out.append((r["doc_id"], r["finding_no"], None if at is None else next(i for i, t in enumerate(d.all("table")) if t is at)))
            yield pd.DataFrame(out, columns=["doc_id", "finding_no", "place"]).astype({"place": "Int32"})

    # Spark takes pages for small by their estimated size, which knows nothing of how long html is: never broadcast them
    rows = findings.join(pages.select(F.col("page_id").alias("doc_id"), "html").hint("merge"), "doc_id")
    return rows.select("doc_id", "finding_no", *names, F.coalesce("index", F.lit(0)).alias("index"), "html").mapInPandas(run, "doc_id long, finding_no int, place int")
