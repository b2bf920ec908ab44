"""Layout-aware text of web pages.

Tags become a tree, with the elements that HTML leaves out put in or closed
(paragraphs before blocks, list items, table rows and cells, the end of the
head), then every visible text is laid out: blocks on lines of their own with the
spacing of their kind, list items marked and indented, table cells in aligned
columns, preformatted text as it stands.  Pages are independent: one pass, no
shuffle; neither the builder nor the layout recurses, so depth has no limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from eventide.llm.common import ref

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
HEADINGS = frozenset(f"h{i}" for i in range(1, 7))
#: Blocks with an empty line around them, and blocks that only have lines of their own.
SPACED = HEADINGS | frozenset("p blockquote pre ul ol menu dl table figure fieldset hr article section".split())
PLAIN = frozenset("address aside body caption center dd details dialog div dt figcaption footer form header hgroup "
                  "html legend li main nav optgroup option search summary tbody td tfoot th thead tr".split())
BLOCKS = SPACED | PLAIN
ENDS_P = (SPACED | frozenset("address aside center dd details dialog dir div dt figcaption footer form header hgroup "
                             "legend li main nav search summary".split()))
HIDDEN = frozenset("area audio base canvas datalist embed head iframe link map meta noembed noframes noscript "
                   "object param rp script style template title video".split())
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
CELLS = frozenset(("td", "th"))
#: A start tag ends the open elements of ``ends``, not looking beyond those of ``within``.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    **dict.fromkeys(SECTIONS, ({*SECTIONS, "caption", "colgroup"}, {"table"})),
    "caption": ({"caption", "colgroup", *SECTIONS}, {"table"}),
    **dict.fromkeys(HEADINGS, (HEADINGS, BLOCKS - HEADINGS)),
}
#: An end tag does not look beyond these for its element.
SCOPE = frozenset(("table", "td", "th", "caption", "button", "object", "template"))
OUT_OF_TABLE = SCOPE | {"tr"}
IN_TABLE = SECTIONS | CELLS | {"table", "tr", "caption"}
HEAD_KEEPS = frozenset(("template", "noscript"))
ONLY_TABLE, NOTHING = frozenset(("table",)), frozenset(())
#: Start tags that end all open elements of their kind, and parents of rows or cells.
END_ALL = SECTIONS | {"tr", "optgroup", "caption"}
TABLE_PARTS = SECTIONS | {"table", "tr"}
ROW_PARENTS = SECTIONS | {"table"}
#: Start tags that stand in a table as they are; other elements directly in a table,
#: section or row go before the table, as text does.
STRUCTURE = IN_TABLE | {"col", "colgroup"}
KEPT_IN_TABLE = STRUCTURE | {"script", "style", "template"}
TABLE_PLACES = IN_TABLE | {"html"}
SPACES = re.compile("[ \t\n\x0c\r]+")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(\w+)", re.I)
#: Elements nested deeper become siblings in the tree, as in browsers; so every page costs at
#: most this many steps per piece.  What stands in them stays hidden or shown as it was.
#: Indentation stops earlier.
MAX_DEPTH, MAX_INDENT = 512, 24
TAG = re.compile(r"<(/?)([a-zA-Z][^ \t\n\r\f/>]*)")
ATTRIBUTE = re.compile(r"[ \t\n\r\f/]*([^ \t\n\r\f/>][^ \t\n\r\f/>=]*)[ \t\n\r\f]*(=?)[ \t\n\r\f]*")
UNQUOTED = re.compile(r"[^ \t\n\r\f>]*")
#: Elements whose content is text up to their end tag.
RAW_TEXT = {t: re.compile(rf"</{t}(?=[ \t\n\r\f/>])", re.I) for t in
            ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript")}
#: A column is padded to at most so many characters; where a cell is longer, the next one
#: stands in its column on the line below.
COLUMN = 80
MAX_SPAN = 1000


INDENTED = frozenset(("li", "blockquote", "dd"))


class Node:
    __slots__ = ("attrs", "children", "parent", "tag", "under")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None, under: Node | None = None):
        """``under`` is the element open around it: the parent, unless it was moved before a table."""
        self.tag, self.attrs, self.parent, self.under = tag, attrs, parent, under or parent
        self.children: list[Node | str] = []


class Over(NamedTuple):
    """An open element beyond MAX_DEPTH: its latest node, and what it hands down."""

    tag: str
    node: Node
    hidden: bool
    visibility: str


class TreeBuilder:
    """Reads tags and text in one pass over the page and builds the tree."""

    def __init__(self) -> None:
        self.root = Node("html", {}, None)
        self.at, self.depth = self.root, 0
        self.in_scope: dict[str, int] = {}  # open elements by tag: most end searches stop here
        self.over: list[Over] = []  # open elements beyond MAX_DEPTH, in ``at``
        self.over_scope: dict[str, int] = {}
        self.last_shown: Node | None = None  # of the nodes beyond MAX_DEPTH

    def feed(self, page: str) -> None:
        """What begins like a tag but is none is text; a comment, tag or raw element
        that the page does not end goes on to its end."""
        at, text, n = 0, [], len(page)
        while at < n:
            i = page.find("<", at)
            if i < 0:
                i = n
            text.append(page[at:i])
            if i == n:
                break
            c = page[i + 1:i + 2]
            if page.startswith("<!--", i):
                end = page.find("-->", i + 2)
                at = n if end < 0 else end + 3
            elif c in ("!", "?") or (c == "/" and not page[i + 2:i + 3].isalpha() and i + 2 < n):
                end = page.find(">", i + 1)
                at = n if end < 0 else end + 1
            elif name := TAG.match(page, i):
                self.text(text)
                tag = name[2].lower()
                attrs, at = attributes(page, name.end())
                if attrs is None:
                    return
                if name[1]:
                    self.handle_endtag(tag)
                    continue
                self.handle_starttag(tag, attrs)
                if tag in RAW_TEXT:
                    end = RAW_TEXT[tag].search(page, at)
                    stop = end.start() if end else n
                    text.append(page[at:stop])
                    self.text(text, tag in ("textarea", "title"))
                    at = stop
            else:
                text.append("<")
                at = i + 1
        self.text(text)

    def text(self, parts: list[str], references: bool = True) -> None:
        data = "".join(parts)
        parts.clear()
        if data:
            self.handle_data(unescape(data) if references and "&" in data else data)

    def push(self, tag: str, attrs: dict[str, str | None]) -> None:
        table = self.open_table() if self.at.tag in TABLE_PARTS and tag not in KEPT_IN_TABLE else None
        if table is None:
            node = Node(tag, attrs, self.at)
            self.at.children.append(node)
        else:
            node = Node(tag, attrs, table.parent, self.at)
            put_before(table, node)
        if tag in VOID:
            return
        if self.depth < MAX_DEPTH:
            self.at = node
            self.depth += 1
            self.in_scope[tag] = self.in_scope.get(tag, 0) + 1
        else:
            self.open_over(tag, node)

    def open_over(self, tag: str, node: Node) -> None:
        """An element beyond MAX_DEPTH: in the tree a sibling of those around it, with what
        they hand down written on it."""
        style = node.attrs.get("style") or ""
        said = VISIBILITY.search(style)
        hidden, visibility = (self.over[-1].hidden, self.over[-1].visibility) if self.over else (False, "")
        hidden = hidden or not is_shown(node)
        if hidden:
            node.attrs["hidden"] = ""
        else:
            self.last_shown = node
        if said:
            visibility = f";visibility:{said[1]}"
        elif visibility:
            node.attrs["style"] = style + visibility
        self.over.append(Over(tag, node, hidden, visibility))
        self.over_scope[tag] = self.over_scope.get(tag, 0) + 1

    def close_over(self, tag: str) -> None:
        """Close the innermost such element and what is open in it."""
        while self.over:
            closed = self.over.pop()
            self.over_scope[closed.tag] -= 1
            if closed.tag == tag:
                return

    def start_over(self, tag: str, attrs: dict[str, str | None]) -> None:
        if (tag in ENDS_P and self.over[-1].tag == "p") or (tag in ENDS and self.over[-1].tag in ENDS[tag][0]):
            self.close_over(self.over[-1].tag)
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.open_over(tag, node)
        elif self.over and self.over[-1].hidden:
            attrs["hidden"] = ""
        else:
            self.last_shown = node

    def data_over(self, data: str) -> None:
        """Text of such an element; behind an element inside it, in a further node."""
        open_ = self.over[-1]
        if open_.node is not self.last_shown and open_.node is not self.at.children[-1]:
            attrs = {k: v for k, v in open_.node.attrs.items() if k in ("hidden", "style")}
            node = Node("div" if open_.tag in BLOCKS else "span", attrs | ({"hidden": ""} if open_.hidden else {}), self.at)
            self.at.children.append(node)
            self.over[-1] = open_._replace(node=node)
            self.last_shown = self.last_shown if open_.hidden else node
        self.over[-1].node.children.append(data)

    def pop_to(self, node: Node) -> None:
        """Close everything up to and including ``node``."""
        while True:
            closed, self.at = self.at, self.at.under or self.root
            self.depth -= 1
            self.in_scope[closed.tag] -= 1
            if closed is node:
                return

    def close(self, tags, within) -> bool:
        """Close the innermost open element of ``tags`` unless one of ``within`` is in between."""
        open_now = self.in_scope
        for t in tags:
            if open_now.get(t):
                break
        else:
            return False
        node = self.at
        while node is not self.root:
            if node.tag in tags:
                self.pop_to(node)
                return True
            if node.tag in within:
                return False
            node = node.under
        return False

    def open_table(self) -> Node | None:
        """The table whose part is open here."""
        table = self.at
        while table is not None and table.tag != "table":
            table = table.parent
        return table

    def back_to_table(self, tag: str) -> None:
        """A part of a table ends what stands open directly in the table, section or
        row around; another table ends the table itself."""
        part = self.at
        while part.tag not in TABLE_PLACES:
            part = part.under
        if part.tag in TABLE_PARTS:
            while self.at is not part:
                self.pop_to(self.at)
            if tag == "table":
                self.close(("table",), NOTHING)

    def handle_starttag(self, tag: str, attrs: dict[str, str | None]) -> None:
        if self.over and tag not in ("html", "body"):
            self.start_over(tag, attrs)
            return
        if tag in ("html", "body"):
            self.close(("head",), NOTHING)
            self.root.attrs |= {k: v for k, v in attrs.items() if k not in self.root.attrs}
            return
        if self.in_scope.get("head") and tag not in IN_HEAD:
            self.close(("head",), HEAD_KEEPS)
        if tag in STRUCTURE and self.in_scope.get("table"):
            self.back_to_table(tag)
        if tag in ENDS_P:
            self.close(("p",), SCOPE)
        if tag in ENDS:
            ends, within = ENDS[tag]
            while self.close(ends, within) and tag in END_ALL:
                pass
            self.imply(tag)
        self.push(tag, attrs)

    def imply(self, tag: str) -> None:
        """The section and row that a row or cell in a table must have."""
        if tag in CELLS and self.at.tag in ROW_PARENTS:
            self.imply("tr")
            self.push("tr", {})
        elif tag == "tr" and self.at.tag == "table":
            self.push("tbody", {})

    def handle_endtag(self, tag: str) -> None:
        if self.over:
            if tag == "br":
                self.start_over(tag, {})
                return
            if self.over_scope.get(tag):
                self.close_over(tag)
                return
            if not self.in_scope.get(tag):
                return
            self.over.clear()  # an element around them ends
            self.over_scope.clear()
        if tag == "br":
            self.push("br", {})
        elif tag not in VOID and tag not in ("html", "body"):
            within = OUT_OF_TABLE if tag not in IN_TABLE else NOTHING if tag == "table" else ONLY_TABLE
            self.close((tag,), within)

    def handle_data(self, data: str) -> None:
        if self.over:
            self.data_over(data)
            return
        if self.in_scope.get("head") and self.at.tag == "head" and not data.isspace():
            self.close(("head",), NOTHING)
        if self.at.tag in TABLE_PARTS:
            if data.isspace():
                return
            if (table := self.open_table()) is not None:  # text between cells goes before the table
                put_before(table, data)
                return
        self.at.children.append(data)


def put_before(table: Node, piece: Node | str) -> None:
    own = table.parent.children
    own.insert(len(own) - 1 - next(i for i, x in enumerate(reversed(own)) if x is table), piece)


def attributes(page: str, at: int) -> tuple[dict[str, str | None] | None, int]:
    """The attributes from ``at`` on (the first of equal names counts) and the place
    after the tag; None if the page ends within it."""
    found: dict[str, str | None] = {}
    if page.startswith(">", at):
        return found, at + 1
    while part := ATTRIBUTE.match(page, at):
        at, value = part.end(), None
        if part[2]:
            quote = page[at:at + 1]
            if quote and quote in "\"'":
                end = page.find(quote, at + 1)
                if end < 0:
                    return None, len(page)
                value, at = page[at + 1:end], end + 1
            else:
                value = UNQUOTED.match(page, at)[0]
                at += len(value)
        found.setdefault(part[1].lower(), unescape(value) if value and "&" in value else value)
    end = page.find(">", at)
    return (None, len(page)) if end < 0 else (found, end + 1)


class Block(NamedTuple):
    lines: list[str]
    spaced: bool


#: A piece of laid out content: text, its text as it stands (pre), a line break, or a block.
class Raw(NamedTuple):
    text: str


BREAK = object()


def fold_lines(pieces: list) -> list[str]:
    """Lines of a block: inline pieces run together with spaces collapsed, blocks on
    lines of their own, one empty line beside spaced ones."""
    if len(pieces) == 1 and isinstance(pieces[0], Block):
        return pieces[0].lines
    lines: list[str] = []
    run: list[str] = []
    apart = False

    def put(new: list[str], spaced: bool) -> None:
        nonlocal apart
        if new:
            if lines and (spaced or apart):
                lines.append("")
            lines.extend(new)
            apart = spaced

    def flush(always: bool = False) -> None:
        text = SPACES.sub(" ", "".join(run)).strip(" ").replace("\0", " ")
        run.clear()
        if text or (always and lines and not apart):
            put(text.replace("\1", "\n").split("\n") if text else [""], False)

    for p in pieces:
        if p is BREAK:
            flush(always=True)
        elif isinstance(p, Block):
            flush()
            put(p.lines, p.spaced)
        elif isinstance(p, Raw):
            run.append(p.text.replace(" ", "\0").replace("\t", "\0").replace("\n", "\1"))
        else:
            run.append(p)
    flush()
    while lines and not lines[-1]:
        lines.pop()
    return lines


def marked(lines: list[str], mark: str) -> list[str]:
    return [(mark if i == 0 else " " * len(mark)) + x if x or i == 0 else x for i, x in enumerate(lines)]


def span_of(node: Node, name: str) -> int:
    value = (node.attrs.get(name) or "").strip()
    return min(MAX_SPAN, max(1, int(value))) if value.isascii() and value.isdigit() and len(value) < 6 else 1


def grid(rows: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Aligned lines of rows of cells (columns spanned, rows spanned, lines)."""
    taken: dict[int, int] = {}  # column -> rows below that a cell above still takes
    placed: list[list[tuple[int, int, list[str]]]] = []
    widths: dict[int, int] = {}
    for cells in rows:
        at, own = 0, []
        for columns, down, lines in cells:
            while taken.get(at, 0):
                at += 1
            own.append((at, columns, lines))
            if columns == 1:
                widths[at] = max(widths.get(at, 0), min(COLUMN, max(map(len, lines), default=0)))
            for c in range(at, at + columns):
                taken[c] = max(taken.get(c, 0), down)
            at += columns
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        placed.append(own)
    for own in placed:  # cells over several columns widen their last one
        for first, columns, lines in own:
            if columns > 1:
                have = sum(widths.get(c, 0) + 2 for c in range(first, first + columns - 1))
                need = min(COLUMN * columns, max(map(len, lines), default=0)) - have
                widths[first + columns - 1] = max(widths.get(first + columns - 1, 0), min(COLUMN, need))
    starts, at = {}, 0
    for c in range(max([0, *(a + n for own in placed for a, n, _ in own)])):
        starts[c] = at
        at += widths.get(c, 0) + 2
    out = []
    for own in placed:
        for i in range(max([0, *(len(x) for _, _, x in own)])):
            line = ""
            for c, _, lines in own:
                if i < len(lines) and lines[i]:
                    if line and len(line) + 2 > starts[c]:  # a long cell: on the next line
                        out.append(line)
                        line = ""
                    line = line.ljust(starts[c]) + lines[i]
            out.append(line)
    return out


def is_shown(node: Node) -> bool:
    if node.tag in HIDDEN:
        return False
    if node.attrs and ("hidden" in node.attrs or ("style" in node.attrs and NO_DISPLAY.search(node.attrs["style"] or ""))):
        return False
    if node.tag == "dialog" and "open" not in node.attrs:
        return False
    closed = node.parent is not None and node.parent.tag == "details" and "open" not in node.parent.attrs
    return not (closed and node.tag != "summary")


def lay_out(root: Node) -> list[str]:
    """Lines of the tree, children before parents on an explicit stack."""
    done: dict[int, list] = {}
    cells: dict[int, list] = {}  # rows and cells gathered for tables
    stack: list[tuple[Node, bool, bool, bool, int]] = [(root, False, True, False, 0)]
    while stack:
        node, finished, visible, pre, level = stack.pop()
        if not finished:
            if "style" in node.attrs and (said := VISIBILITY.search(node.attrs["style"] or "")):
                visible = said[1].lower() not in ("hidden", "collapse")
            pre = pre or node.tag in ("pre", "textarea")
            stack.append((node, True, visible, pre, level))
            level += node.tag in INDENTED
            stack += [(c, False, visible, pre, level) for c in reversed(node.children) if isinstance(c, Node) and is_shown(c)]
            continue
        pieces: list = []
        closed = node.tag == "details" and "open" not in node.attrs
        for c in node.children:
            if isinstance(c, str):
                if visible and not closed:
                    pieces.append(Raw(c) if pre else c)
            elif (own := done.pop(id(c), None)) is not None:
                if len(node.children) == 1:
                    pieces = own
                else:
                    pieces.extend(own)
        done[id(node)] = laid(node, pieces, cells, level)
    return fold_lines(done[id(root)])


def laid(node: Node, pieces: list, cells: dict[int, list], level: int) -> list:
    """What an element gives its parent."""
    tag = node.tag
    if tag in ("br", "hr"):
        return [BREAK] if tag == "br" else [Block(["-" * 3], True)]
    if tag == "wbr" or tag in VOID:
        return []
    if tag not in BLOCKS:
        return pieces
    lines = fold_lines(pieces)
    if tag in CELLS and node.parent is not None and node.parent.tag == "tr":
        cells.setdefault(id(node.parent), []).append((span_of(node, "colspan"), span_of(node, "rowspan"), lines))
        return []
    if tag == "tr" and (own := cells.pop(id(node), None)) is not None:
        table = node.parent
        while table is not None and table.tag in SECTIONS:
            table = table.parent
        if table is not None and table.tag == "table":
            cells.setdefault(id(table), []).append(own)
            return [Block(lines, False)] if lines else []
        lines = lines + grid([own])
    if tag == "table":
        lines = lines + grid(cells.pop(id(node), []))
    elif tag == "li":
        up = node.parent
        number = None
        if up is not None and up.tag == "ol":
            cells[id(up)] = [(cells.get(id(up)) or [start_of(up) - 1])[0] + 1]
            number = cells[id(up)][0]
        mark = "- " if number is None else f"{number}. "
        lines = marked(lines or [""], mark) if level < MAX_INDENT else [mark + (lines[0] if lines else ""), *lines[1:]]
    elif tag == "ol":
        cells.pop(id(node), None)
    elif tag in ("blockquote", "dd"):
        lines = marked(lines, "  ") if level < MAX_INDENT else lines
    spaced = tag in SPACED and not (tag in ("ul", "ol", "menu") and node.parent is not None and node.parent.tag == "li")
    return [Block(lines, spaced)] if lines else []


def start_of(node: Node) -> int:
    value = (node.attrs.get("start") or "").strip()
    return int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else 1


def page_text(html: str | None) -> str:
    """The visible text of a page."""
    builder = TreeBuilder()
    builder.feed((html or "").replace("\0", "").replace("\1", ""))
    return "\n".join(x.rstrip(" ") for x in lay_out(builder.root))


def extracted(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add the visible text of each page.

    Null and empty pages have an empty text; what is no HTML is text.  Unclosed,
    misplaced and unknown tags follow the rules above.  Repeated rows get equal
    texts; an empty table gives an empty result; a column called ``text`` is
    replaced.
    """
    @F.pandas_udf(StringType())
    def rendered(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([page_text(p) for p in pages], dtype=object)

    return df.withColumn(text, rendered(F.coalesce(ref(html), F.lit(""))))
