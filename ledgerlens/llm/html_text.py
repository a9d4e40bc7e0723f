"""Visible text of HTML pages, laid out.

A tree builder with the implied tags of HTML (list items, paragraphs, table
parts, options) feeds a renderer: blocks start on lines of their own, paragraphs
and the like are set apart by a blank line, list items get bullets or numbers and
are indented by depth, preformatted text keeps its spaces, a line break on an empty
line leaves a blank line, and the cells of a table are aligned in columns, cells that
span columns or rows included. A table whose padding would be a multiple of its own
text (``PADDING``) has its cells two spaces apart instead. Content that stands in a
table but in no cell comes before the table, as in browsers. Fields show their values.
Invisible are comments, scripts, styles, templates, heads (but for the title), what
stands in for something that is not loaded (``noscript``, ``iframe``, ``object``,
``canvas``, ``audio``, ``video`` and the like), choices offered while typing, hints in
empty fields, the definitions and descriptions of drawings, the annotations of
formulas, the brackets around ruby text, and elements that are hidden by attribute or
inline style; what is only made invisible may hold visible elements. All other text is
emitted, whether it is an article or navigation.

Nulls: a null page has null text and title; an empty one has empty text. Broken
markup never fails: unknown end tags are passed over, open elements end with
their parents. Nesting is walked without recursion, so its depth is not limited.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import text_slices

# Attributes as in the standard's tokenizer: a quote opens a value only directly after "=", elsewhere it is a character.
BLANK = r"[ \t\n\r\f]"
NAME = r"=[^ \t\n\r\f/>=]*+|[^ \t\n\r\f/>=]++"
VALUE = r"\"[^\"]*+\"|'[^']*+'|[^ \t\n\r\f>\"'][^ \t\n\r\f>]*+|(?=>|\Z)"
IS = rf"{BLANK}*+={BLANK}*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^ \t\n\r\f/>]*+)"
    rf"((?:{BLANK}++|/|(?:{NAME})(?:{IS}(?:{VALUE})|(?!{IS})))*+)>|<[!?/][^>]*>?|[^<]+|<",
    re.DOTALL,
)
ATTRIBUTE = re.compile(rf"({NAME})(?:{IS}({VALUE}))?")
SPACE = re.compile(r"[ \t\n\r\f\v]+")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|content-visibility\s*:\s*hidden", re.IGNORECASE)
VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(visible|hidden|collapse)", re.IGNORECASE)
#: Spaces that may align a table: this many for each character of its cells, and this many at least.
PADDING = (20, 20_000)

# Fixed values of the HTML standard.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
UNSEEN = {
    "script", "style", "template", "head", "noscript", "iframe", "noembed", "noframes", "object", "canvas",
    "audio", "video", "datalist", "param", "rp",
    "desc", "metadata", "defs", "symbol", "clippath", "mask", "marker", "pattern",  # in svg
    "annotation", "annotation-xml",  # in math
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section",
    "summary", "table", "text", "ul", "caption", "tr", "xmp",
}
SPACED = {"blockquote", "dl", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "ol", "p", "pre", "table", "ul", "xmp"}
LISTS = {"ul", "ol", "menu", "dir"}
#: Stands in place of a mark for a list directly inside a list item.
NESTED = "nested"
#: An opening tag ends the open elements named here, up to the nearest of the second set.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "thead": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "caption": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "colgroup": ({"caption", "colgroup", "thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, set()),
}
CLOSE_P = BLOCKS - {"body", "html", "option", "optgroup", "caption", "tr", "text"}
#: Directly in these only parts of tables may stand.
TABLE_ONLY = {"table", "thead", "tbody", "tfoot", "tr", "colgroup"}
TABLE_PARTS = {"caption", "colgroup", "col", "thead", "tbody", "tfoot", "tr", "td", "th"}
#: Fields that show no value as text.
NO_VALUE = {"hidden", "checkbox", "radio", "password", "file", "image", "range", "color"}
SCOPE = {"table", "td", "th", "caption", "html", "object", "template"}


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for name, value in ATTRIBUTE.findall(source):
        if value[:1] in "\"'" and value:
            value = value[1:-1]
        found.setdefault(name.lower(), html.unescape(value))
    return found


def parse(page: str) -> Node:
    """The tree of a page; text is str children."""
    root = Node("#root", {})
    stack = [root]
    open_: Counter[str] = Counter()
    at, size = 0, len(page)

    def cut(depth: int) -> None:
        for node in stack[depth:]:
            open_[node.name] -= 1
        del stack[depth:]

    def close(names: set[str], until: set[str]) -> None:
        # Ends the open elements of ``names`` that are nearer than any of ``until``, with all inside them.
        if not any(open_[n] > 0 for n in names):
            return
        found = None
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in until:
                break
            if stack[depth].name in names:
                found = depth
        if found is not None:
            cut(found)

    def holder() -> int:
        # Depth of the nearest open part of a table, if only parts of tables may stand in it, else 0.
        if open_["table"] > 0:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in TABLE_ONLY:
                    return depth
                if stack[depth].name in SCOPE:
                    break
        return 0

    def place(child: Node | str) -> None:
        # Into the innermost open element; what may not stand there in a table goes before the table.
        if stack[-1].name in TABLE_ONLY and open_["table"] > 0:
            depth = len(stack) - 1
            while stack[depth].name != "table":
                depth -= 1
            beside = stack[depth - 1].children  # the open table is the last of them
            beside.insert(len(beside) - 1, child)
        else:
            stack[-1].children.append(child)

    while at < size:
        token = TOKEN.match(page, at)
        at = token.end()
        text = token.group()
        name = token.group(2)
        if name is None:
            if text == "<" and page[at : at + 2].lstrip("/")[:1].isalpha() and page[at : at + 1].isascii():
                break  # a tag that never ends hides the rest
            if text[0] != "<" or text == "<":
                if "&" in text:
                    text = html.unescape(text)
                if text.isspace():
                    stack[-1].children.append(text)
                else:
                    place(text)
            continue
        name = name.lower()
        if token.group(1):
            if open_[name] <= 0:
                if name == "p":
                    place(Node("p", {}))
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    cut(depth)
                    break
                if stack[depth].name in ("table", "td", "th") and name not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                    break
            continue
        if name in CLOSE_P:
            close({"p"}, SCOPE)
        if name in IMPLIED_END:
            close(*IMPLIED_END[name])
        if name in TABLE_PARTS and (depth := holder()):
            cut(depth + 1)
        elif name == "table" and (depth := holder()):  # ends the table around it
            while stack[depth].name != "table":
                depth -= 1
            cut(depth)
        if name in ("td", "th") and stack[-1].name in ("table", "tbody", "thead", "tfoot"):
            row = Node("tr", {})
            stack[-1].children.append(row)
            stack.append(row)
            open_["tr"] += 1
        source = token.group(3)
        node = Node(name, _attributes(source) if source.strip(" /") else {})
        if name in TABLE_PARTS:
            stack[-1].children.append(node)
        else:
            alone = name == "form" and stack[-1].name in TABLE_ONLY and open_["table"] > 0  # holds nothing there
            place(node)
            if alone:
                continue
        foreign = name in ("svg", "math") or open_["svg"] + open_["math"] > open_["foreignobject"]
        if name in VOID or source.endswith("/") and foreign:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
            body = page[at : end.start() if end else size]
            node.children.append(html.unescape(body) if name in ("title", "textarea") else body)
            at = end.end() if end else size
            continue
        stack.append(node)
        open_[name] += 1
    return root


def hidden(node: Node) -> bool:
    if node.name in UNSEEN:
        return True
    a = node.attributes
    if not a:
        return False
    return (
        "hidden" in a
        or a.get("aria-hidden", "").lower() == "true"
        or bool(HIDDEN_STYLE.search(a.get("style", "")))
        or (node.name == "input" and a.get("type", "").lower() == "hidden")
        or (node.name == "dialog" and "open" not in a)
    )


def visible(node: Node, inherited: bool) -> bool:
    """Whether the node's own text shows; unlike ``hidden``, elements inside may differ."""
    style = node.attributes.get("style", "") if node.attributes else ""
    said = VISIBILITY.findall(style) if style else []
    return said[-1].lower() == "visible" if said else inherited


class Lines:
    """Lines under construction: collapses white space and remembers the spacing due before the next text."""

    def __init__(self):
        self.done: list[str] = []
        self.parts: list[str] = []
        self.gap, self.ends_in_space, self.mark = 0, True, ""

    def block(self, blank: bool) -> None:
        if self.parts:
            line = "".join(self.parts).rstrip(" ")
            self.parts, self.ends_in_space = [], True
            self.done.append(line)
            self.gap = 0
        if blank:
            self.gap = 1

    def line_break(self) -> None:
        """Ends the line; on an empty one, a blank line follows."""
        self.block(blank=not self.parts)

    def start(self, indent: str) -> None:
        if self.gap and self.done and self.done[-1]:
            self.done.append("")
        self.gap = 0
        self.parts.append(self.mark or indent)
        self.mark = ""

    def text(self, text: str, indent: str) -> None:
        text = SPACE.sub(" ", text)
        if self.ends_in_space:
            text = text.lstrip(" ")
        if text:
            if not self.parts:
                self.start(indent)
            self.parts.append(text)
            self.ends_in_space = text[-1] == " "

    def line(self, text: str, indent: str) -> None:
        """A finished line whose inner spaces stay."""
        self.block(False)
        if text:
            self.start(indent)
            self.parts.append(text)
            self.block(False)

    def finish(self) -> list[str]:
        self.block(False)
        while self.done and not self.done[-1]:
            self.done.pop()
        return self.done


def _table_rows(table: Node) -> tuple[list[list[Node]], list[int]]:
    """Rows of cells, without those of tables inside, and for each row the end of its group of rows."""
    rows: list[list[Node]] = []
    ends: list[int] = []
    queue: list[Node | None] = [c for c in reversed(table.children) if isinstance(c, Node)]

    def end_group() -> None:
        ends.extend([len(rows)] * (len(rows) - len(ends)))

    while queue:
        node = queue.pop()
        if node is None:
            end_group()
        elif hidden(node):
            continue
        elif node.name == "tr":
            rows.append([c for c in node.children if isinstance(c, Node) and c.name in ("td", "th") and not hidden(c)])
        elif node.name in ("tbody", "thead", "tfoot"):
            end_group()
            queue += [None, *[c for c in reversed(node.children) if isinstance(c, Node)]]
    end_group()
    return rows, ends


def _columns(rows: list[list[Node]], ends: list[int]) -> list[list[tuple[int, int]]]:
    """First column and end column of each cell, with the columns that cells of earlier rows still fill left out."""
    placed: list[list[tuple[int, int]]] = []
    filled: list[tuple[int, int, int]] = []  # (first column, end column, end row), in order, apart from each other
    for number, row in enumerate(rows):
        filled = [span for span in filled if span[2] > number]
        now, later, column, k = [], [], 0, 0
        for cell in row:
            while k < len(filled) and filled[k][0] <= column:
                column = max(column, filled[k][1])
                k += 1
            end = column + max(1, min(_whole(cell.attributes.get("colspan"), 1), 1000))
            if k < len(filled):
                end = min(end, filled[k][0])
            down = _whole(cell.attributes.get("rowspan"), 1)
            last = ends[number] if down == 0 else min(number + max(1, down), ends[number])
            now.append((column, end))
            if last > number + 1:
                if later and later[-1][1:] == (column, last):
                    later[-1] = (later[-1][0], end, last)
                else:
                    later.append((column, end, last))
            column = end
        placed.append(now)
        if later:
            filled = sorted([*filled, *later])
    return placed


def _aligned(rows: list[list[list[str]]], columns: list[list[tuple[int, int]]]) -> list[str]:
    """Cells as lines, columns padded to their widest cell that spans one column; a column is one that a cell starts in."""
    starts = sorted({first for row in columns for first, _ in row})
    number = {first: k for k, first in enumerate(starts)}
    widths = [0] * len(starts)
    for row, places in zip(rows, columns, strict=True):
        for cell, (first, end) in zip(row, places, strict=True):
            k = number[first]
            if k + 1 == len(starts) or starts[k + 1] >= end:
                widths[k] = max(widths[k], max(map(len, cell), default=0))
    at = [0, *accumulate(width + 2 for width in widths)]
    text = sum(len(line) for row in rows for cell in row for line in cell)
    padding = sum(at[number[places[-1][0]]] * max(map(len, row)) for row, places in zip(rows, columns, strict=True) if row)
    apart = padding > max(PADDING[0] * text, PADDING[1])
    lines = []
    for row, places in zip(rows, columns, strict=True):
        for k in range(max((len(c) for c in row), default=0)):
            out, length = [], 0
            for cell, (first, _) in zip(row, places, strict=True):
                gap = 2 if out else 0
                if not apart:
                    gap = max(gap if length else 0, at[number[first]] - length)
                part = " " * gap + (cell[k] if k < len(cell) else "")
                out.append(part)
                length += len(part)
            line = "".join(out).rstrip()
            if line or k:
                lines.append(line)
    return lines


def _whole(text: str | None, default: int) -> int:
    text = (text or "").strip()
    return int(text) if re.fullmatch(r"-?[0-9]{1,6}", text) else default


def _preformatted(out: Lines, text: str, indent: str) -> None:
    first, *more = text.replace("\r\n", "\n").expandtabs(4).split("\n")
    for number, line in enumerate([first, *more]):
        if number:
            if out.parts:
                out.block(False)
            elif out.done and not out.gap:
                out.done.append("")
        if line.strip() or line and out.parts:
            if not out.parts:
                out.start(indent)
            out.parts.append(line)
            out.ends_in_space = False


def render(root: Node) -> list[str]:
    """Lines of the visible text below ``root``.

    A stack of what is still to be done replaces recursion. Each table cell is
    rendered into lines of its own; the table is laid out after its last cell.
    """
    result = Lines()
    todo: list[tuple] = [("open", root, result, "", False, "", True)]
    while todo:
        what, node, out, indent, pre, mark, seen = todo.pop()
        if what == "close":
            out.block(node.name in SPACED and mark != NESTED)
            out.mark = ""
            continue
        if what == "table":
            cells, columns = node
            for line in _aligned([[c.finish() for c in row] for row in cells], columns):
                out.line(line, indent)
            out.block(True)
            continue
        if isinstance(node, str):
            if not seen:
                pass
            elif pre:
                _preformatted(out, node, indent)
            else:
                out.text(node, indent)
            continue
        name = node.name
        if hidden(node) or name == "title":
            continue
        seen = visible(node, seen)
        if name == "br":
            out.line_break()
        elif name == "img":
            out.text(node.attributes.get("alt", "") if seen else "", indent)
        elif name == "input":
            kind = node.attributes.get("type", "text").lower()
            shown = "alt" if kind == "image" else "" if kind in NO_VALUE else "value"
            out.text(node.attributes.get(shown, "") if seen else "", indent)
        elif name == "table":
            out.block(True)
            rows, ends = _table_rows(node)
            cells = [[Lines() for _ in row] for row in rows]
            todo.append(("table", (cells, _columns(rows, ends)), out, indent, pre, "", seen))
            shows = _shown_rows(node, seen)
            for row, sheets in zip(rows, cells, strict=True):
                for cell, sheet in zip(row, sheets, strict=True):
                    todo.append(("open", cell, sheet, "", False, "", shows.get(id(cell), seen)))
            for child in reversed(node.children):  # captions and stray text stand before the rows
                if isinstance(child, str) or child.name not in ("tr", "tbody", "thead", "tfoot"):
                    todo.append(("open", child, out, indent, False, "", seen))
        else:
            if name in BLOCKS:
                out.block(name in SPACED and mark != NESTED)
                todo.append(("close", node, out, indent, pre, mark, seen))
            inner = indent
            if name == "li":
                mark = mark or "- "
                out.mark, inner = (indent + mark) * seen, indent + " " * len(mark)
            elif name in ("dd", "blockquote"):
                inner = indent + "  "
            pre = pre or name in ("pre", "xmp", "textarea")
            number = _whole(node.attributes.get("start"), 1) if name == "ol" else None
            later = []
            for child in node.children:
                mark = ""
                if number is not None and isinstance(child, Node) and child.name == "li" and not hidden(child):
                    number = _whole(child.attributes.get("value"), number)
                    mark, number = f"{number}. ", number + 1
                elif name == "li" and isinstance(child, Node) and child.name in LISTS:
                    mark = NESTED
                later.append(("open", child, out, inner, pre, mark, seen))
            todo += reversed(later)
    return result.finish()


def _shown_rows(table: Node, seen: bool) -> dict[int, bool]:
    """What cells of rows with a visibility of their own inherit, by identity."""
    found: dict[int, bool] = {}
    queue = [(c, seen) for c in table.children if isinstance(c, Node)]
    while queue:
        node, inherited = queue.pop()
        if node.name in ("tbody", "thead", "tfoot", "tr"):
            own = visible(node, inherited)
            queue += [(c, own) for c in node.children if isinstance(c, Node)]
        elif node.name in ("td", "th") and inherited != seen:
            found[id(node)] = inherited
    return found


def title_of(root: Node) -> str:
    todo: list = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, Node):
            if node.name == "title":
                return SPACE.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip()
            if node.name not in ("svg", "body"):
                todo += reversed(node.children)
    return ""


def page_text(page: str) -> tuple[str, str]:
    """(title, visible text)."""
    root = parse(page)
    return title_of(root), "\n".join(render(root))


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns in ``keep`` and ``title, text`` for every row."""

    def run(batches):
        for batch, sources in text_slices(batches, "html"):
            found = [(None, None) if s is None else page_text(s) for s in sources]
            kept = [batch.column(f"k{i}") for i in range(len(keep))]
            made = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*kept, *made], [*[f"k{i}" for i in range(len(keep))], "title", "text"])

    rows = pages.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{html_col}`").alias("html"))
    schema = "".join(f"k{i} {pages.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    out = rows.mapInArrow(run, f"{schema}title string, text string")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "title", "text")
