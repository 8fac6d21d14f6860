"""Layout-aware rendering of HTML to text.

A tree builder supplies implied tags, visibility rules leave out what a browser does not show, and the renderer
emits all other text: blocks on lines of their own, a blank line around paragraphs and headings, list
markers with indent, table cells in aligned columns, preformatted text as it is.  Tree and rendering use
explicit stacks, so no depth of nesting fails.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from rankfold.llm.common import text_chunks

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("head script style template noscript title iframe object datalist audio video canvas noframes".split())
#: What is not shown inside svg and math; other svg text is shown inside ``text`` and ``foreignObject``, which holds HTML.
_UNSEEN = {
    "svg": _HIDDEN | frozenset("defs desc metadata symbol clippath mask marker pattern lineargradient radialgradient".split()),
    "math": _HIDDEN | frozenset(("annotation", "annotation-xml", "mphantom")),
}
_LABELS = frozenset(("text", "foreignobject"))
#: Elements of svg and math whose content is HTML, and HTML elements that end an open svg or math.
_HOLDS_HTML = {"svg": frozenset(("foreignobject", "desc", "title")), "math": frozenset(("mi", "mo", "mn", "ms", "mtext"))}
_LEAVES = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Parts of a formula above or beside each other, and those after a base: a blank stands between them.
_STACKED = frozenset("mfrac mtable mtr mlabeledtr".split())
_SCRIPTED = frozenset("msub msup msubsup munder mover munderover mroot mmultiscripts".split())
_HEAD = frozenset("base basefont bgsound link meta title style script noscript template".split())
#: Blocks with a blank line around them, and those that only start a new line.
_SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset menu hr".split())
_BLOCK = _SPACED | frozenset(
    "address article aside body center details dialog dd div dt fieldset figcaption footer form header hgroup html legend li main nav option optgroup section summary search tr caption".split()
)
#: A start tag closes an open element of these names, up to the nearest of the scopes.
_LISTS, _TABLES = frozenset(("ul", "ol", "menu")), frozenset(("table",))
_CLOSES = {
    "li": (frozenset(("li",)), _LISTS),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th", "caption")), _TABLES),
    "td": (frozenset(("td", "th", "caption")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th", "caption")), frozenset(("tr", "table"))),
    "tbody": (frozenset(("tbody", "thead", "tfoot", "tr", "td", "th", "caption")), _TABLES),
    "thead": (frozenset(("tbody", "thead", "tfoot", "tr", "td", "th", "caption")), _TABLES),
    "tfoot": (frozenset(("tbody", "thead", "tfoot", "tr", "td", "th", "caption")), _TABLES),
    "option": (frozenset(("option",)), frozenset(("select",))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
}
_P_ENDS = _BLOCK - frozenset(("html", "body", "option", "optgroup", "tr", "caption", "legend", "summary"))
_P_SCOPE = frozenset(("table", "td", "th", "caption", "button", "object", "foreignobject", "mtext"))
_NO_SHOW = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_SPACE = re.compile(r"[\x20\x09\x0A\x0C\x0D]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "kind", "label", "apart")

    def __init__(self, tag: str, attrs: dict[str, str | None], kind: str = "", label: bool = False, apart: bool = False):
        self.tag, self.attrs, self.children = tag, attrs, []
        #: "svg", "math" or "" for HTML; text of svg that is shown; words that are not joined to those around them
        self.kind, self.label, self.apart = kind, label, apart

    def visible(self) -> bool:
        if self.kind == "svg" and (self.attrs.get("display") == "none" or self.attrs.get("visibility") in ("hidden", "collapse")):
            return False
        if self.tag in _UNSEEN.get(self.kind, _HIDDEN) or "hidden" in self.attrs or (self.tag == "dialog" and "open" not in self.attrs):
            return False
        return not _NO_SHOW.search(self.attrs.get("style") or "")


class Builder(HTMLParser):
    """Builds the tree: ``html`` and ``body`` exist, unclosed and misnested elements are closed where HTML implies it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.count = {"html": 1}

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)
        self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def _pop(self) -> None:
        self.count[self.open.pop().tag] -= 1

    def _close(self, names: frozenset[str], scope: frozenset[str]) -> None:
        """Close the outermost open element of ``names`` above the nearest ``scope``."""
        if not any(self.count.get(n) for n in names):
            return
        found = None
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in scope:
                break
            if self.open[k].tag in names:
                found = k
        while found and len(self.open) > found:
            self._pop()

    def _kind(self) -> str:
        """Whether a new element is one of "svg", "math" or HTML ("")."""
        top = self.open[-1]
        return "" if top.tag in _HOLDS_HTML.get(top.kind, ()) else top.kind

    def _foreign(self, tag: str, attrs: list[tuple[str, str | None]], kind: str) -> None:
        top, named = self.open[-1], dict(attrs)
        label = kind == "svg" and tag != "svg" and (top.label or tag in _LABELS)
        chunk = kind == "svg" and (tag == "text" or (tag == "tspan" and ("x" in named or "y" in named)))
        self._push(Node(tag, named, kind, label, chunk or (kind == top.kind == "math" and (top.tag in _STACKED or (top.tag in _SCRIPTED and bool(top.children))))))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _LEAVES or (tag == "font" and any(a in ("color", "face", "size") for a, _ in attrs)):
            while self._kind():
                self._pop()
        kind = tag if tag in ("svg", "math") else self._kind()
        if kind:
            if kind == tag:
                self._close(frozenset(("head",)), frozenset())
            self._foreign(tag, attrs, kind)
            return
        if tag in ("html", "body"):
            if tag == "body":
                self._close(frozenset(("head",)), frozenset())
                self.root.attrs.update(attrs)
            return
        if tag != "head" and tag not in _HEAD:
            self._close(frozenset(("head",)), frozenset())
        if tag in _P_ENDS:
            self._close(frozenset(("p",)), _P_SCOPE)
        if tag in _CLOSES:
            self._close(*_CLOSES[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self._push(Node("tr", {}))
        node = Node(tag, dict(attrs))
        if tag in _VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if self.open[-1].kind and self.open[-1].tag == tag:
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
        elif tag == "p" and not self.count.get("p"):
            self.open[-1].children.append(Node("p", {}))
        elif self.count.get(tag) and tag != "html":
            while self.open[-1].tag != tag:
                if self.open[-1].tag in ("td", "th", "table") and tag not in ("td", "th", "tr", "tbody", "thead", "tfoot", "table"):
                    return  # an end tag inside a cell closes nothing outside it
                self._pop()
            self._pop()

    def handle_data(self, data: str) -> None:
        if len(self.open) > 1 and self.open[-1].tag == "head" and data.strip():
            self._pop()
        if self.open[-1].kind != "svg" or self.open[-1].label:
            self.open[-1].children.append(data)


class Writer:
    """Lines of one flow of text: collapses white space, keeps the largest of the gaps asked for between blocks."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = 0
        self.marker = ""

    def text(self, data: str) -> None:
        for n, word in enumerate(_SPACE.split(data)):
            if n:
                self.space = True
            if word:
                if self.space and self.parts:
                    self.parts.append(" ")
                self.parts.append(word)
                self.space = False

    def part(self, raw: int) -> None:
        """What follows is a word of its own."""
        if raw and self.parts:
            self.parts.append(" ")
        self.space = True

    def flush(self) -> None:
        if self.parts:
            self.line("".join(self.parts))
            self.parts.clear()
        self.space = False

    def line(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.extend([""] * (self.gap - 1))
        self.gap = 0
        head = " " * max(0, self.indent - len(self.marker)) + self.marker
        self.marker = ""
        self.lines.append(f"{head}{line}".rstrip())

    def block(self, gap: int) -> None:
        """End the line; at least ``gap`` - 1 blank lines before the next one."""
        self.flush()
        self.gap = max(self.gap, gap)


def aligned(rows: list[list[list[str]]], wide: int) -> list[str]:
    """Lines of a table: cells padded to their column's width (at most ``wide``), two spaces between, lines of a cell below each other."""
    widths: list[int] = []
    for row in rows:
        for k, cell in enumerate(row):
            if k == len(widths):
                widths.append(0)
            widths[k] = max([widths[k], *(len(x) for x in cell if len(x) <= wide)])
    out = []
    for row in rows:
        for n in range(max(map(len, row), default=0)):
            cells = [cell[n] if n < len(cell) else "" for cell in row]
            out.append("  ".join(c.ljust(w) for c, w in zip(cells, widths, strict=False)).rstrip())
    return out


def render(html: str, wide: int = 60) -> str:
    """All visible text of a page."""
    builder = Builder()
    builder.feed(html)
    builder.close()
    writers, tables, lists, raw = [Writer()], [], [], 0
    stack: list[tuple[Node | str, bool]] = [(builder.root, False)]
    while stack:
        node, leaving = stack.pop()
        out = writers[-1]
        if isinstance(node, str):
            if not raw:
                out.text(node)
                continue
            for n, line in enumerate(node.replace("\r\n", "\n").split("\n")):
                if n:
                    out.line("".join(out.parts))
                    out.parts.clear()
                if line:
                    out.parts.append(line)
            continue
        tag = node.tag
        if not leaving:
            if not node.visible():
                continue
            if tag == "br":
                if out.parts:
                    out.flush()
                elif out.lines:
                    out.gap = max(out.gap, 2)
                continue
            if tag in ("td", "th") and tables:
                out.flush()
                writers.append(Writer())
            elif tag == "tr" and tables:
                out.flush()
                tables[-1].append([])
            elif node.apart:
                out.part(raw)
            elif tag == "math" and node.attrs.get("display") == "block":
                out.block(1)
            elif tag in _BLOCK:
                out.block(1 if tag not in _SPACED or (lists and tag in ("ul", "ol", "menu")) else 2)
            if tag == "table":
                tables.append([])
            elif tag in ("ul", "ol", "menu", "dl", "blockquote"):
                if tag in ("ul", "ol", "menu"):
                    try:
                        first = int(node.attrs.get("start") or 1)
                    except ValueError:
                        first = 1
                    lists.append([tag, first - 1])
                    out.indent += 2
                elif tag == "blockquote":
                    out.indent += 2
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 0]
                kind[1] += 1
                out.marker = f"{kind[1]}. " if kind[0] == "ol" else "- "
            elif tag == "dd":
                out.indent += 2
            elif tag == "pre":
                raw += 1
            if tag not in _VOID:
                stack.append((node, True))
                stack.extend((c, False) for c in reversed(node.children))
            continue
        if tag in ("td", "th") and tables and len(writers) > 1:
            cell = writers.pop()
            cell.block(0)
            if not tables[-1]:
                tables[-1].append([])
            span = node.attrs.get("colspan") or "1"
            tables[-1][-1] += [cell.lines, *([[]] * (min(int(span), 100) - 1 if span.isascii() and span.isdigit() else 0))]
            continue
        if node.apart:
            out.part(raw)
        elif tag == "math" and node.attrs.get("display") == "block":
            out.block(1)
        if tag == "pre":
            raw -= 1
        if tag in _BLOCK:
            out.block(0)
        if tag == "table":
            out.gap = max(out.gap, 2)
            for line in aligned(tables.pop(), wide):
                out.line(line)
        elif tag in ("ul", "ol", "menu"):
            lists.pop()
            out.indent -= 2
        elif tag in ("blockquote", "dd"):
            out.indent -= 2
        elif tag == "li":
            out.marker = ""
        if tag in _BLOCK:
            out.block(1 if tag not in _SPACED or (lists and tag in ("ul", "ol", "menu")) else 2)
    writers[0].flush()
    return "\n".join(writers[0].lines).strip("\n")


def extract(pages: DataFrame, wide: int = 60) -> DataFrame:
    """``page_id, text, n_lines`` of ``pages`` (``page_id, html``); a null html gives a null text and 0 lines.

    Malformed markup is closed as HTML implies; text outside any element is kept.  Repeated rows come out repeated; an
    empty table gives an empty result; other columns are left out.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "html"):
            texts = [None if h is None else render(h, wide) for h in batch.column(1).to_pylist()]
            lines = [t.count("\n") + 1 if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64())], ["page_id", "text", "n_lines"])

    return pages.select("page_id", "html").mapInArrow(run, f"page_id {kind}, text string, n_lines long")
