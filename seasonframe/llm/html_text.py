"""HTML to text by layout: a tree with implied tags, visibility rules, blocks, lists and tables."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonframe.llm.common import whole_text

# Fixed values of the HTML standard: how elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("area base datalist head link meta noembed noframes param rp script style template title iframe audio video canvas object noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table caption tbody thead tfoot tr td th ul".split()
)
#: Blocks that stand apart by an empty line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl table blockquote pre figure".split())
#: Start tags that end an open p.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr main menu nav ol p pre search section summary table ul li dd dt".split()
)
#: Elements that a start tag ends, and the elements beyond which it does not look.
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset("select datalist optgroup".split())),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset("table tbody thead tfoot".split())),
    "td": (frozenset(["td", "th"]), frozenset("tr table".split())),
    "th": (frozenset(["td", "th"]), frozenset("tr table".split())),
    **{x: (frozenset("tr td th tbody thead tfoot caption colgroup".split()), frozenset(["table"])) for x in ("tbody", "thead", "tfoot")},
}
#: Parents that a start tag implies when they are missing.
IMPLIED_PARENT = {"td": "tr", "th": "tr"}
IN_HEAD = frozenset("base basefont bgsound link meta noframes script style template title".split())
#: Lists, tables and quotes nested deeper than this are laid out as plain blocks; their text stays.
MAX_NESTING = 40
#: Rows that a cell spans at most, as the standard has it.
MAX_ROWSPAN = 65_534
#: End tags do not reach beyond these.
SCOPE = frozenset("table td th caption template html".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*>?|<\?[^>]*>?|</[A-Za-z][^>]*>?"
    r"|<(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?P<end>>?)|(?P<text>[^<]++|<)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_INVISIBLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!\s*important\s*)?(?:;|$)", re.IGNORECASE)
_SHOWN = re.compile(r"(?:^|;)\s*visibility\s*:\s*visible\s*(?:!\s*important\s*)?(?:;|$)", re.IGNORECASE)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    """An element: its name, the attributes that matter, and its children (elements and strings)."""

    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes = name, attributes
        self.children: list[Node | str] = []


class _Open:
    """The open elements, outermost first, and how many there are of each name."""

    def __init__(self, *nodes: Node):
        self.nodes, self.count = list(nodes), Counter(n.name for n in nodes)

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.count[node.name] += 1

    def cut(self, place: int) -> None:
        self.count.subtract(n.name for n in self.nodes[place:])
        del self.nodes[place:]


def parse(source: str) -> Node:
    """The element tree of a page. Any input gives a tree; tags left open are closed at the end."""
    root = Node("html", {})
    head_open, body = True, Node("body", {})
    root.children.append(body)
    stack = _Open(root, body)
    at, size = 0, len(source)
    while at < size:
        token = _TOKEN.match(source, at)
        if token is None:  # a quote that is never closed: the tag ends at the next >
            end = source.find(">", at)
            at = size if end < 0 else end + 1
            continue
        at = token.end()
        if token["text"]:
            stack.nodes[-1].children.append(html.unescape(token["text"]))
            continue
        if not token["name"]:
            if source.startswith("</", token.start()):
                _end_tag(stack, re.split(r"[\s/>]", source[token.start() + 2 : at], maxsplit=1)[0].lower())
            continue
        if not token["end"] and at < size:
            end = source.find(">", at)
            at = size if end < 0 else end + 1
        name = token["name"].lower()
        if name in ("html", "body", "head"):
            head_open = name == "head"
            if name == "body":
                body.attributes.update(_attributes(token["rest"]))
            continue
        if head_open and name not in IN_HEAD:
            head_open = False
        node = Node(name, _attributes(token["rest"]) if token["rest"] else {})
        _start_tag(stack, node)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(source, at)
            stop = end.start() if end else size
            raw = source[at:stop]
            node.children.append(html.unescape(raw) if name in ("title", "textarea") else raw)
            at = stop
            if end:
                close = source.find(">", stop)
                at = size if close < 0 else close + 1
            if stack.nodes[-1] is node:
                stack.cut(len(stack.nodes) - 1)
    return root


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        name = m.group(1).lower()
        if name in ("hidden", "style", "type", "open", "start", "value", "colspan", "rowspan", "alt", "reversed") and name not in found:
            found[name] = html.unescape(next((g for g in m.groups()[1:] if g is not None), ""))
    return found


def _start_tag(stack: _Open, node: Node) -> None:
    name = node.name
    if name in CLOSES_P:
        _close(stack, frozenset(["p"]), SCOPE | {"button"})
    if name in IMPLIED_END:
        _close(stack, *IMPLIED_END[name])
    parent = IMPLIED_PARENT.get(name)
    if parent and stack.nodes[-1].name != parent and stack.count["table"]:
        _start_tag(stack, Node(parent, {}))
    stack.nodes[-1].children.append(node)
    if name not in VOID:
        stack.push(node)


def _close(stack: _Open, names: frozenset[str], until: frozenset[str]) -> None:
    """Close the outermost open element of ``names`` that lies within the innermost of ``until``."""
    left = sum(stack.count[n] for n in names)
    found, place = 0, len(stack.nodes) - 1
    while left and place > 1 and stack.nodes[place].name not in until:
        if stack.nodes[place].name in names:
            found, left = place, left - 1
        place -= 1
    if found:
        stack.cut(found)


def _end_tag(stack: _Open, name: str) -> None:
    if name in ("html", "body", "head"):
        return
    if name == "br":
        stack.nodes[-1].children.append(Node("br", {}))
        return
    scope = frozenset(["table"]) if name in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else SCOPE
    place = len(stack.nodes) - 1 if stack.count[name] else 0
    while place > 1:
        if stack.nodes[place].name == name:
            stack.cut(place)
            return
        if stack.nodes[place].name in scope and name != "table":
            break
        place -= 1
    if name == "p":
        stack.nodes[-1].children.append(Node("p", {}))


def width(text: str) -> int:
    """Columns that a text takes on a terminal: wide characters take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class _Lines:
    """Text in lines as it is laid out: runs of white space join, blocks start lines."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False
        self.gap = 0  # empty lines owed before the next text

    def add(self, text: str) -> None:
        parts = _SPACE.split(text)
        for i, part in enumerate(parts):
            if i:
                self.space = True
            if part:
                if self.space and self.now:
                    self.now.append(" ")
                self.space = False
                self._start()
                self.now.append(part)

    def add_kept(self, text: str) -> None:
        for i, line in enumerate(text.split("\n")):
            if i:
                self._start()
                self.lines.append("".join(self.now).rstrip())
                self.now = []
            if line:
                self._start()
                self.now.append(line.expandtabs(8))
        self.space = False

    def _start(self) -> None:
        if not self.now:
            if self.gap and self.lines:
                self.lines += [""] * self.gap
            self.gap = 0

    def line(self) -> None:
        """End the line, if one is begun."""
        if self.now:
            self.lines.append("".join(self.now).rstrip())
        self.now, self.space = [], False

    def forced(self) -> None:
        """A line break of the page: ends the line, or leaves an empty one."""
        if self.now:
            self.line()
        elif self.lines and self.lines[-1] != "":
            self.lines.append("")

    def block(self, empty: int) -> None:
        self.line()
        self.gap = max(self.gap, empty)

    def take(self, lines: list[str]) -> None:
        """Lines laid out elsewhere."""
        self.line()
        if lines:
            self._start()
            self.lines += lines

    def done(self) -> list[str]:
        self.line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _is_hidden(node: Node) -> bool:
    if node.name in HIDDEN:
        return True
    attributes = node.attributes
    if not attributes:
        return node.name == "dialog"
    return (
        "hidden" in attributes
        or (node.name == "input")
        or (node.name == "dialog" and "open" not in attributes)
        or ("style" in attributes and _INVISIBLE.search(attributes["style"]) is not None)
    )


def _shown_inside(node: Node) -> bool:
    """Whether ``visibility`` alone hides the element, so that a descendant may be visible again."""
    style = node.attributes.get("style", "")
    return bool(_INVISIBLE.search(style)) and "hidden" not in node.attributes and not re.search(r"display\s*:\s*none", style, re.IGNORECASE)


def _visibility(node: Node, visible: bool) -> bool | None:
    """Whether the element's own text shows, given its parent's; None where nothing inside can."""
    if _is_hidden(node):
        return False if node.name not in HIDDEN and _shown_inside(node) else None
    return visible or _SHOWN.search(node.attributes.get("style", "")) is not None


def render(node: Node) -> str:
    """All visible text of the tree, block by block."""
    out = _Lines()
    _render_children(node, out, False, 0)
    return "\n".join(out.done())


def _render_children(top: Node, out: _Lines, preserve: bool, depth: int, shown: bool = True) -> None:
    """Walk the tree with a stack of its own, so that depth is no limit."""
    work: list[tuple] = [("in", top, preserve, shown)]
    while work:
        what, item, kept, visible = work.pop()
        if what == "gap":
            out.block(item)
            continue
        if isinstance(item, str):
            if visible:
                (out.add_kept if kept else out.add)(item)
            continue
        if what == "in":
            work += [("node", child, kept, visible) for child in reversed(item.children)]
            continue
        name = item.name
        state = _visibility(item, visible)
        if state is None:
            continue
        visible = state
        if name == "details" and "open" not in item.attributes:
            # closed: its summary shows, the rest does not
            closed = Node("div", {})
            closed.children = [c for c in item.children if isinstance(c, Node) and c.name == "summary"][:1]
            work.append(("node", closed, kept, visible))
            continue
        if name == "br":
            if visible:
                out.forced()
        elif name == "wbr":
            continue
        elif name == "img":
            if visible and item.attributes.get("alt"):
                out.add(item.attributes["alt"])
        elif name == "hr":
            out.block(1)
        elif name == "table" and visible and depth < MAX_NESTING:
            out.block(1)
            out.take(_table(item, depth + 1))
            out.block(1)
        elif name in ("ul", "ol", "menu", "dir") and visible and depth < MAX_NESTING:
            nested = 0 if top.name in ("li", "dd") else 1
            out.block(nested)
            out.take(_list(item, depth + 1))
            out.block(nested)
        elif name in ("blockquote", "dd") and visible and depth < MAX_NESTING:
            out.block(name == "blockquote")
            inner = _Lines()
            _render_children(item, inner, kept, depth + 1)
            out.take([f"    {line}" if line else "" for line in inner.done()])
            out.block(name == "blockquote")
        elif name in BLOCK:
            empty = 1 if name in SPACED else 0
            out.block(empty)
            work.append(("gap", empty, kept, visible))
            if name == "pre" and item.children and isinstance(item.children[0], str):
                item.children[0] = item.children[0].removeprefix("\r").removeprefix("\n")
            work.append(("in", item, kept or name == "pre", visible))
        else:
            work.append(("in", item, kept, visible))


def _list(node: Node, depth: int) -> list[str]:
    """Items with a mark, their later lines indented below it; ordered lists count."""
    lines: list[str] = []
    step = -1 if "reversed" in node.attributes else 1
    items = [c for c in node.children if isinstance(c, Node) and c.name == "li" and _visibility(c, True) is not None]
    number = _whole(node.attributes.get("start"), len(items) if step < 0 else 1)
    for child in node.children:
        inner = _Lines()
        if isinstance(child, str) or child.name != "li":
            holder = Node("div", {})
            holder.children.append(child)
            _render_children(holder, inner, False, depth)
            lines += [f"  {line}" if line else "" for line in inner.done()]
            continue
        shown = _visibility(child, True)
        if shown is None:
            continue
        mark = "- "
        if node.name == "ol":
            number = _whole(child.attributes.get("value"), number)
            mark = f"{number}. "
            number += step
        _render_children(child, inner, False, depth, shown)
        body = inner.done()
        if not shown:
            # the mark is hidden with the item; what shows inside keeps its place
            lines += ["  " + line if line else "" for line in body]
            continue
        body = body or [""]
        lines.append((mark + body[0]).rstrip())
        lines += [" " * len(mark) + line if line else "" for line in body[1:]]
    return lines


def _whole(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"\s*[+-]?[0-9]{1,9}\s*", text) else default


def _row_groups(node: Node, shown: bool = True) -> Iterator[list[tuple[Node, bool]]]:
    """The rows of each section with whether they show; rows outside a section form groups between sections."""
    own: list[tuple[Node, bool]] = []
    for child in node.children:
        state = _visibility(child, shown) if isinstance(child, Node) else None
        if state is None:
            continue
        if child.name == "tr":
            own.append((child, state))
        elif child.name in ("tbody", "thead", "tfoot"):
            if own:
                yield own
                own = []
            yield from _row_groups(child, state)
    if own:
        yield own


def _cells(row: Node, shown: bool, depth: int) -> Iterator[tuple[list[str], int, int]]:
    """Lines, columns and rows of each cell; what stands between cells counts as a cell if it has text."""
    for cell in row.children:
        inner = _Lines()
        if isinstance(cell, str):
            if shown and cell.strip():
                yield [" ".join(cell.split())], 1, 1
            continue
        state = _visibility(cell, shown)
        if state is None:
            continue
        if cell.name in ("td", "th"):
            _render_children(cell, inner, False, depth, state)
            columns, rows = (_whole(cell.attributes.get(x), 1) for x in ("colspan", "rowspan"))
            yield inner.done(), min(max(columns, 1), 1000), MAX_ROWSPAN if rows == 0 else min(max(rows, 1), MAX_ROWSPAN)
            continue
        holder = Node("div", {})
        holder.children.append(cell)
        _render_children(holder, inner, False, depth, shown)
        if found := inner.done():
            yield found, 1, 1


def _grid(node: Node, depth: int) -> list[list[tuple[int, list[str], int]]]:
    """The cells of each row with text: column, lines, columns that it spans. A cell that spans rows keeps its
    columns in the rows below, to the end of its section at most."""
    grid = []
    for group in _row_groups(node):
        taken: dict[int, int] = {}  # column -> rows for which a cell from above still has it
        for row, shown in group:
            column, cells, fresh = 0, [], {}
            for text, span, rows in _cells(row, shown, depth):
                while taken.get(column, 0) > 0:
                    column += 1
                cells.append((column, text, span))
                if rows > 1:
                    fresh.update(dict.fromkeys(range(column, column + span), rows - 1))
                column += span
            taken = {c: n - 1 for c, n in taken.items() if n > 1} | fresh
            if any(text for _, text, _ in cells):
                grid.append(cells)
    return grid


def _table(node: Node, depth: int) -> list[str]:
    """The caption, what stands between the rows, and the rows with cells aligned in columns."""
    before = _Lines()
    sections = [(c, _visibility(c, True)) for c in node.children if isinstance(c, Node) and c.name in ("tbody", "thead", "tfoot")]
    for group, shown in [(node, True), *sections]:
        if shown is None:
            continue
        loose = Node("div", {})
        loose.children = [c for c in group.children if isinstance(c, str) or c.name not in ("tr", "tbody", "thead", "tfoot", "colgroup")]
        before.block(0)
        _render_children(loose, before, False, depth, shown)
    lines = before.done()
    grid = _grid(node, depth)
    widths: dict[int, int] = {}
    for cells in grid:
        for column, text, span in cells:
            if span == 1:
                widths[column] = max(widths.get(column, 0), max(map(width, text), default=0))
    starts: dict[int, int] = {}

    def start(column: int) -> int:
        if column not in starts:
            starts[column] = sum(widths.get(c, 0) + 2 for c in range(column))
        return starts[column]

    for cells in grid:
        for i in range(max(len(text) for _, text, _ in cells)):
            line = ""
            for column, text, _ in cells:
                if column:
                    line += " " * max(start(column) - width(line), 2)
                line += text[i] if i < len(text) else ""
            lines.append(line.rstrip())
    return lines


def text_of(source: str) -> str:
    """All visible text of a page."""
    return render(parse(source))


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col, text`` per row: the page's visible text as it is laid out.

    Tags that HTML implies are added; scripts, styles, the head, templates and what attributes or
    inline styles hide is left out, and so is the body of closed details; everything else stays, navigation
    and notices included, and so does what is visible again inside a hidden element. Blocks
    start lines, paragraphs, headings, lists and tables stand apart by an empty line, list items have
    a mark or number with nested lists indented, and table cells are padded to columns, with those below a
    cell of several rows in their own. Lists, tables and quotes nested more than ``MAX_NESTING`` deep are
    laid out as plain blocks. A null or empty page gives an empty text; broken markup gives what can be read of it.
    Null ids and repeated rows stay rows, an empty table gives an empty one; extra columns are ignored. Pages are
    independent and no page's size is limited.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_of(x.as_py()) for x in batch.column("_html")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.string())], names=["_id", "text"])

    chosen = pages.select(F.col(id_col).alias("_id"), whole_text(F.col(html_col)).alias("_html"))
    kind = chosen.schema["_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"_id {kind}, text string").withColumnRenamed("_id", id_col)
