"""Layout-aware text rendering of web pages.

A page goes through a small tree builder (void elements, raw text,
implied end tags of paragraphs, list items, definition terms, options and
table parts) and a renderer that emits the text a reader would see:

* hidden content is left out: ``head``, scripts, styles, templates,
  ``hidden`` attributes, inline ``display:none`` / ``visibility:hidden``
  (a visible descendant shows again), the same set by simple ``.class``,
  ``#id`` or tag rules of the page's own style sheets, closed ``details``
  but for their summary, closed dialogs, hidden inputs;
* block elements start on lines of their own, and paragraphs, headings,
  lists, tables and quotations are set off by one blank line;
* list items carry ``-`` or their number and indent what they contain;
* text and elements that a table cannot hold stand before it, cells inside
  a row's other elements in the row; text of svg and math is kept;
* table cells stand in aligned columns (row and column spans kept), right
  aligned where the page says so; a table of one column is plain blocks;
* white space is collapsed except in ``pre`` and ``textarea``.

Pages are rendered inside Arrow tasks, one page at a time: no shuffle, and
memory follows one batch.  Scripts never run, so ``noscript`` is shown.

Defined cases: null or empty HTML renders as the empty text; unclosed and
stray tags are repaired as above; nesting beyond ``DEPTH`` levels is
flattened (its visible text stays, hidden text stays hidden); repeated rows are rendered each; an empty table
gives an empty result; only id and HTML are read, so names cannot clash.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierload.llm.common import arrow_map
from tierload.llm.text import blocks

DEPTH = 120
#: fixed value: the most columns a cell may span
COLSPAN = 1000

# Fixed names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title meta link iframe noembed noframes object audio video canvas datalist "
                   "map area param source track colgroup col".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
                  "search section summary table tbody td textarea tfoot th thead tr ul caption xmp".split())
SET_OFF = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table blockquote pre hr figure fieldset xmp".split())
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption option optgroup".split())
#: an opening tag ends these open elements, up to (not beyond) the scope
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}, {"table"}),
    "thead": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
#: what a table, its sections and rows keep; all else in them stands before the table
PARTS = frozenset("caption colgroup col tbody thead tfoot tr td th script style template".split())
SECTIONS = frozenset("tbody thead tfoot tr".split())
#: an end tag of a heading ends any of them; these end tags reach out of a cell
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
CELLS_END = ("tr", "table", "tbody", "thead", "tfoot")
#: never drawn inside svg and math
UNDRAWN = frozenset("title desc metadata defs symbol clippath mask marker pattern lineargradient radialgradient filter "
                    "annotation annotation-xml".split())
HEAD_ONLY = frozenset("head title meta link style script base template noscript".split())

# a quote opens a value only directly after "="
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+{_VALUE}?+)*+)>""", re.S)
_ATTR = re.compile(r"""([^\s=/>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in _ATTR.findall(raw):
        out.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return out


class Open:
    """The open elements, and where each tag stands among them: looking for
    one costs the same however deep a page is."""

    def __init__(self, root: Node) -> None:
        self.stack, self.at = [root], {}
        self.deepest = 1

    def push(self, n: Node) -> None:
        self.at.setdefault(n.tag, []).append(len(self.stack))
        self.stack.append(n)
        self.deepest = max(self.deepest, len(self.stack))

    def cut(self, i: int) -> None:
        """Close everything from the ``i``-th on."""
        for n in reversed(self.stack[i:]):
            self.at[n.tag].pop()
        del self.stack[i:]

    def last(self, tags) -> int:
        """The innermost element of some tags, 0 when there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)


def parse(page: str) -> Node:
    """The element tree of a page."""
    root = Node("#root", {})
    opened, at = Open(root), 0
    stack = opened.stack

    def text(s: str) -> None:
        if s:
            if stack[-1].tag == "head" and s.strip():
                opened.cut(len(stack) - 1)
            stack[-1].children.append(html.unescape(s))

    def close(tags: set, scope: set) -> None:
        i = opened.last(tags)
        if i <= opened.last(scope):
            return
        while i > 1 and stack[i - 1].tag in tags and stack[i - 1].tag not in scope:
            i -= 1
        opened.cut(i)

    last = page.rfind(">") + 1      # no tag ends after this: what is unclosed there is searched once
    for m in iter(lambda: _TAG.search(page, at, last), None):
        if m.start() < at:
            break
        text(page[at:m.start()])
        at = m.end()
        name = m[2]
        if not name:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(page)              # a comment that never ends
            continue
        name = name.lower()
        if m[1]:
            _end(opened, name)
            continue
        if stack[-1].tag == "head" and name not in HEAD_ONLY:
            opened.cut(len(stack) - 1)
        if name in ("html", "body") and opened.last((name,)):
            continue
        if name in CLOSES_P:
            close({"p"}, {"td", "th", "button", "caption", "table"})
        if name in ENDS:
            close(*ENDS[name])
        if name == "table":  # directly in another one: ends that
            close({"table"}, {"td", "th", "caption"})
        node = Node(name, attributes(m[3]) if m[3] else {})
        stack[-1].children.append(node)
        if m[3].endswith("/") and opened.last(("svg", "math")):
            pass
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            raw = page[at:end.start()] if end else page[at:]
            at = end.end() if end else len(page)
            node.children.append(html.unescape(raw) if name in ("textarea", "title") else raw)
        elif name not in VOID:
            opened.push(node)
        if at >= len(page):
            break
    text(re.split("<[!?]", page[at:], maxsplit=1)[0])
    if opened.deepest > DEPTH:
        _flatten(root, Renderer(Styles(root)))
    _settle(root, False)
    return root


def _flatten(root: Node, r: Renderer) -> None:
    """Give the deepest elements that are kept all visible text below them.

    What is hidden there is left out; a visibility that was set there stays
    with the text as a style of its own; block elements still end lines."""
    level = [root]
    for _ in range(DEPTH - 1):
        level = [c for n in level for c in n.children if isinstance(c, Node)]
    for n in level:
        out: list = []
        todo: list = [(c, "") for c in reversed(n.children)]
        while todo:
            c, seen = todo.pop()
            if isinstance(c, Node) and c.children:
                if not r.shown(c):
                    continue
                own = r.styles.of(c).get("visibility", "")
                seen = own if own in ("hidden", "collapse", "visible") else seen
                inner = c.children
                if c.tag == "details" and "open" not in c.attrs:
                    inner = [x for x in inner if isinstance(x, Node) and x.tag == "summary"][:1]
                edge = [(Node("p" if c.tag in SET_OFF else "div", {}), "")] if c.tag in BLOCK else []
                todo += [*edge, *((x, seen) for x in reversed(inner)), *edge]
            elif seen:
                out.append(Node("span", {"style": f"visibility:{seen}"}))
                out[-1].children.append(c)
            else:
                out.append(c)
        n.children = out


def _settle(n: Node, drawing: bool) -> None:
    """Move what a table cannot hold before it, and drop what svg and math do not draw."""
    out = []
    for c in n.children:
        if isinstance(c, Node):
            if drawing and c.tag in UNDRAWN:
                continue
            if c.tag == "table":
                strays = Node("#strays", {})
                c.children = _parts(c, strays.children)
                _settle(strays, drawing)
                out += strays.children
            elif drawing and c.tag == "text":  # placed on its own
                c.children = [" ", *c.children, " "]
            _settle(c, c.tag in ("svg", "math") or (drawing and c.tag != "foreignobject"))
        out.append(c)
    n.children = out


def _parts(n: Node, strays: list) -> list[Node]:
    """The table parts in ``n``, also those inside other elements; the rest goes to ``strays``."""
    parts = []
    for c in n.children:
        if isinstance(c, str):
            if strays or c.strip():
                strays.append(c)
        elif c.tag in PARTS:
            if c.tag in SECTIONS:
                c.children = _parts(c, strays)
            parts.append(c)
        elif c.tag == "table" or not _holds_parts(c):
            strays.append(c)
        else:
            inner: list = []
            parts += _parts(c, inner)
            c.children = inner
            strays.append(c)
    return parts


def _holds_parts(n: Node) -> bool:
    return any(isinstance(c, Node) and c.tag != "table" and (c.tag in SECTIONS or c.tag in ("td", "th", "caption") or _holds_parts(c))
               for c in n.children)


def _end(opened: Open, name: str) -> None:
    """Close the matching open element; a cell's content never closes what is around its table."""
    if name == "br":
        opened.stack[-1].children.append(Node("br", {}))
        return
    if name in ("body", "html"):
        return
    i = opened.last(HEADINGS if name in HEADINGS else (name,))
    if i and i >= opened.last(("table",) if name in CELLS_END else ("table", "td", "th")):
        opened.cut(i)
    elif name == "p":
        opened.stack[-1].children.append(Node("p", {}))


class Styles:
    """display:none and visibility:hidden of simple selectors."""

    def __init__(self, root: Node) -> None:
        self.rules: dict[str, dict[str, str]] = {}
        todo = [root]
        while todo:
            n = todo.pop()
            if n.tag == "style" and n.children:
                self._read(str(n.children[0]))
            todo.extend(c for c in n.children if isinstance(c, Node))

    def _read(self, sheet: str) -> None:
        for selectors, body in _RULE.findall(re.sub(r"/\*.*?\*/", "", sheet, flags=re.S)):
            found = _declared(body)
            if found:
                for s in selectors.split(","):
                    if re.fullmatch(r"\s*([A-Za-z][\w-]*|[.#][\w-]+)\s*", s):
                        self.rules.setdefault(s.strip(), {}).update(found)

    def of(self, node: Node) -> dict[str, str]:
        out: dict[str, str] = {}
        if self.rules:
            keys = [node.tag, *("." + c for c in node.attrs.get("class", "").split()), "#" + node.attrs.get("id", "")]
            for k in keys:
                out.update(self.rules.get(k, {}))
        if "style" in node.attrs:
            out.update(_declared(node.attrs["style"]))
        return out


def _declared(body: str) -> dict[str, str]:
    out = {}
    for part in body.split(";"):
        name, _, value = part.partition(":")
        if name.strip().lower() in ("display", "visibility", "text-align"):
            out[name.strip().lower()] = value.replace("!important", "").strip().lower()
    return out


def width(s: str) -> int:
    """Columns on a fixed-width display."""
    if s.isascii():
        return len(s)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


class Flow:
    """Lines of a block context: inline text is gathered and closed by blocks."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.run: list[str] = []
        self.gap = False

    def word(self, s: str) -> None:
        self.run.append(s)

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.run)).strip(" ")
        self.run = []
        if text:
            self._add([text])

    def line_break(self) -> None:
        text = _SPACE.sub(" ", "".join(self.run)).strip(" ")
        self.run = []
        self._add([text])

    def block(self, lines: list[str], set_off: bool) -> None:
        self.end_line()
        if set_off:
            self.gap = True
        if lines:
            self._add(lines)
        if set_off:
            self.gap = True

    def _add(self, lines: list[str]) -> None:
        if self.gap and self.lines and self.lines[-1] != "":
            self.lines.append("")
        self.gap = False
        self.lines.extend(lines)

    def done(self) -> list[str]:
        self.end_line()
        return trimmed(self.lines)


def trimmed(lines: list[str]) -> list[str]:
    a, z = 0, len(lines)
    while a < z and not lines[a].strip():
        a += 1
    while z > a and not lines[z - 1].strip():
        z -= 1
    return lines[a:z]


class Renderer:
    def __init__(self, styles: Styles) -> None:
        self.styles = styles

    def render(self, node: Node, seen: bool = True) -> list[str]:
        flow = Flow()
        self.children(node, flow, seen)
        return flow.done()

    def children(self, node: Node, flow: Flow, seen: bool) -> None:
        number = _integer(node.attrs.get("start"), 1)
        for c in node.children:
            if isinstance(c, str):
                if seen:
                    flow.word(c)
            elif c.tag == "li" and node.tag in ("ul", "ol", "menu", "dir"):
                if self.shown(c):
                    number = _integer(c.attrs.get("value"), number)
                    self.item(c, flow, f"{number}. " if node.tag == "ol" else "- ", self.visible(c, seen))
                    number += 1
            else:
                self.element(c, flow, seen)

    def shown(self, n: Node) -> bool:
        if n.tag in UNSEEN or "hidden" in n.attrs or (n.tag == "dialog" and "open" not in n.attrs):
            return False
        if n.tag == "input" and n.attrs.get("type", "").lower() == "hidden":
            return False
        return self.styles.of(n).get("display") != "none"

    def visible(self, n: Node, seen: bool) -> bool:
        v = self.styles.of(n).get("visibility")
        return {"hidden": False, "collapse": False, "visible": True}.get(v, seen) if v else seen

    def element(self, n: Node, flow: Flow, seen: bool) -> None:
        if not self.shown(n):
            return
        seen, tag = self.visible(n, seen), n.tag
        if tag == "br":
            flow.line_break()
        elif tag in ("img", "wbr", "embed"):
            return
        elif tag == "input":
            if seen and n.attrs.get("type", "text").lower() not in ("checkbox", "radio", "password", "file", "image", "color", "range"):
                flow.word(" " + n.attrs.get("value", "") + " ")
        elif tag == "select":
            options = [o for o in _all(n, "option") if self.shown(o)]
            chosen = [o for o in options if "selected" in o.attrs] or options[:1]
            if seen and chosen:
                flow.word(" " + " ".join(" ".join(self.render(o)) for o in chosen) + " ")
        elif tag in ("pre", "textarea", "xmp"):
            text = _text(n, self, seen)
            text = text.removeprefix("\n")
            lines = [x.rstrip() for x in text.expandtabs(8).splitlines()]
            flow.block(trimmed(lines), True)
        elif tag == "details" and "open" not in n.attrs:
            for c in n.children:
                if isinstance(c, Node) and c.tag == "summary":
                    self.element(c, flow, seen)
                    break
        elif tag == "table":
            flow.block(self.table(n, seen), True)
        elif tag == "li":
            self.item(n, flow, "- ", seen)
        elif tag in ("blockquote", "dd"):
            flow.block(["  " + x if x else x for x in self.render(n, seen)], tag in SET_OFF)
        elif tag in ("ul", "ol", "menu", "dir"):
            flow.block(self.render(n, seen), True)
        elif tag in BLOCK:
            flow.block(self.render(n, seen), tag in SET_OFF)
        elif tag in ("td", "th"):  # a stray cell
            flow.word(" ")
            self.children(n, flow, seen)
        else:
            self.children(n, flow, seen)

    def item(self, n: Node, flow: Flow, mark: str, seen: bool) -> None:
        lines = self.render(n, seen)
        if not lines:
            return
        pad = " " * len(mark)
        # a nested list follows its item without a blank line
        lines = [x for i, x in enumerate(lines) if x or not (i + 1 < len(lines) and re.match(r"(- |\d+\. )", lines[i + 1]))]
        flow.block([mark + lines[0], *(pad + x if x else x for x in lines[1:])], False)

    def table(self, n: Node, seen: bool) -> list[str]:
        caption, rows = [], []
        for part in n.children:
            if not isinstance(part, Node) or not self.shown(part):
                continue
            if part.tag == "caption":
                caption += self.render(part, seen)
            elif part.tag == "tr":
                rows.append(part)
            elif part.tag in ("tbody", "thead", "tfoot"):
                rows += [r for r in part.children if isinstance(r, Node) and r.tag == "tr" and self.shown(r)]
                loose = [c for c in part.children if isinstance(c, Node) and c.tag in ("td", "th")]
                if loose:
                    row = Node("tr", {})
                    row.children = loose
                    rows.append(row)
            elif part.tag in ("td", "th"):
                if not rows or rows[-1].attrs.get("#") != "implied":
                    rows.append(Node("tr", {"#": "implied"}))
                rows[-1].children.append(part)
        grid: list[dict[int, tuple[list[str], int, str]]] = []
        down: list[tuple[int, int, int]] = []      # (first column, end, row in which it is free again), by column
        for r, row in enumerate(rows):
            down = sorted(d for d in down if d[2] > r)
            cells, col, k, more = {}, 0, 0, []
            for c in row.children:
                if not isinstance(c, Node) or c.tag not in ("td", "th") or not self.shown(c):
                    continue
                while k < len(down) and down[k][0] <= col:
                    col = max(col, down[k][1])
                    k += 1
                span = min(max(_integer(c.attrs.get("colspan"), 1), 1), COLSPAN)
                until = r + min(max(_integer(c.attrs.get("rowspan"), 1), 1), len(rows) - r)
                if until > r + 1:
                    more.append((col, col + span, until))
                align = c.attrs.get("align", "").lower() or self.styles.of(c).get("text-align", "")
                cells[col] = (self.render(c, self.visible(c, self.visible(row, seen))), span, align)
                col += span
            down += more
            grid.append(cells)
        # columns in which no cell starts have no width of their own
        starts = sorted({col for cells in grid for col in cells})
        place = {col: i for i, col in enumerate(starts)}
        grid = [{place[col]: (lines, bisect_left(starts, col + span) - place[col], align)
                 for col, (lines, span, align) in cells.items()} for cells in grid]
        columns = max((col + span for cells in grid for col, (_, span, _) in cells.items()), default=0)
        if columns <= 1:
            return [*caption, *(x for cells in grid for _, (lines, _, _) in sorted(cells.items()) for x in lines)]
        wide = [0] * columns
        for cells in grid:
            for col, (lines, span, _) in cells.items():
                if span == 1:
                    wide[col] = max([wide[col], *map(width, lines)])
        for cells in grid:
            for col, (lines, span, _) in cells.items():
                lack = max([0, *map(width, lines)]) - sum(wide[col:col + span]) - 2 * (span - 1)
                if span > 1 and lack > 0:
                    wide[col + span - 1] += lack
        begin = [0, *accumulate(w + 2 for w in wide)]        # where a column starts in a line
        out = list(caption)
        for cells in grid:
            placed = sorted(cells.items())
            for i in range(max((len(lines) for lines, _, _ in cells.values()), default=0)):
                line, at = [], 0
                for col, (lines, span, align) in placed:
                    s = lines[i] if i < len(lines) else ""
                    lead = begin[col]
                    if align in ("right", "end"):
                        lead = begin[col + span] - 2 - width(s)
                    line += [" " * (lead - at), s]
                    at = lead + width(s)
                out.append("".join(line).rstrip())
        return out


def _integer(s: str | None, default: int) -> int:
    return int(s) if s and re.fullmatch(r"\s*-?[0-9]{1,9}\s*", s) else default


def _all(n: Node, tag: str) -> list[Node]:
    return [x for c in n.children if isinstance(c, Node) for x in ([c] if c.tag == tag else _all(c, tag))]


def _text(n: Node, r: Renderer, seen: bool) -> str:
    out = []
    for c in n.children:
        if isinstance(c, str):
            out.append(c if seen else "")
        elif c.tag == "br":
            out.append("\n")
        elif r.shown(c):
            out.append(_text(c, r, r.visible(c, seen)))
    return "".join(out)


def render_page(page: str | None) -> str:
    """The visible text of one page."""
    if not page:
        return ""
    root = parse(page)
    return "\n".join(x.rstrip() for x in Renderer(Styles(root)).render(root))


def render_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text) of every page."""
    src = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, "html"):
            texts = [render_page(x) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    kind = src.schema["id"].dataType.simpleString()
    return arrow_map(src, fn, f"id {kind}, text string").withColumnRenamed("id", id_col)
