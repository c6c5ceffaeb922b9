"""Visible text of web pages, laid out: blocks, lists and tables keep their shape.

A tree builder turns markup into properly nested open and close events: it
supplies end tags that HTML lets authors omit, drops stray ones and closes what
is left. Visibility rules leave out elements that are never shown, hidden by an
attribute or inline style, or by a simple selector (tag, .class, #id) of the
page's own style sheet. The renderer writes the rest line by line: white space
collapses outside ``pre``, paragraphs and headings stand apart, list items are
marked and indented, and the cells of a table are lines under each other.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from quillsieve.llm import arrow

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_BLANK = re.compile(r"[ \t\n\r\f]+")

# Elements of HTML by their part in layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER_SHOWN = frozenset(
    "audio canvas datalist head iframe math noembed noframes noscript object script style svg template title video".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table ul xmp".split()
)
APART = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("dir menu ol ul".split())
# An open element of the first kind ends before a new one of the key, unless one of the second kind lies between.
IMPLIED_ENDS = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["td", "th", "tr", "caption", "colgroup"]), frozenset(["table"])),
    "tbody": (frozenset(["td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
}
IMPLIED_ENDS["thead"] = IMPLIED_ENDS["tfoot"] = IMPLIED_ENDS["tbody"]
CELL_SCOPE = frozenset(["table", "td", "th", "caption"])
# Characters of a cell that still is set in a column, and of a table whose columns are aligned.
CELL_WIDTH = 80
ROW_WIDTH = 400


def attributes(source: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return found


class Lines:
    """Text of one flow (the page, or a cell) as lines."""

    def __init__(self):
        self.done: list[str] = []
        self.line: list[str] = []
        self.indent: list[str] = []
        self.mark = ""  # of a list item that has no text yet
        self.gap = 0  # lines to end before more text: 1 the line, 2 with an empty line after
        self.space = False

    def close_line(self) -> None:
        if self.line:
            self.done.append("".join(self.line).rstrip(" "))
            self.line = []
        self.space = False

    def apart(self, gap: int) -> None:
        self.close_line()
        self.gap = max(self.gap, gap)

    def start(self) -> None:
        if self.gap == 2 and self.done:
            self.done.append("")
        self.gap = 0
        if self.mark:
            self.line.append("".join(self.indent[:-1]) + self.mark)
            self.mark = ""
        elif self.indent:
            self.line.append("".join(self.indent))

    def text(self, text: str) -> None:
        """Text whose white space collapses."""
        words = _BLANK.sub(" ", text)
        if words[:1] == " ":
            self.space = True
            words = words[1:]
        if not words:
            return
        if not self.line:
            self.start()
        elif self.space:
            self.line.append(" ")
        self.space = words[-1] == " "
        self.line.append(words.rstrip(" ") if self.space else words)

    def verbatim(self, text: str) -> None:
        """Lines as they are."""
        for n, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if n:
                if not self.line:
                    self.start()
                    if not self.line:
                        self.line.append("")
                self.close_line()
            if part:
                if not self.line:
                    self.start()
                self.line.append(part)

    def whole(self, lines: list[str]) -> None:
        """Finished lines, as by verbatim."""
        if self.indent or self.mark or self.line:
            self.verbatim("\n".join(lines))
            return
        self.start()
        self.done += lines[:-1]
        if lines[-1]:
            self.line.append(lines[-1])

    def finish(self) -> list[str]:
        self.close_line()
        return self.done


def table_lines(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Rows of (lines, columns spanned) with the columns aligned and two spaces between them.

    A row with a cell longer than ``CELL_WIDTH`` is no line of a table: its cells
    stand below each other as they are. In a table wider than ``ROW_WIDTH`` the
    cells of a row are only set apart. So no line gets more than ROW_WIDTH blanks.
    """
    widths: dict[int, int] = {}
    for row in rows:
        column = 0
        for lines, span in row:
            width = max(map(len, lines), default=0)
            if span == 1 and width <= CELL_WIDTH:
                widths[column] = max(widths.get(column, 0), width)
            column += span
    columns = sorted(widths)
    starts = list(accumulate((widths[c] + 2 for c in columns), initial=0))
    aligned = starts[-1] <= ROW_WIDTH
    out: list[str] = []
    for row in rows:
        if len(row) == 1 or any(len(line) > CELL_WIDTH for lines, _ in row for line in lines):
            for lines, _ in row:
                out += [line.rstrip() for line in lines]
            continue
        made: list[list[str]] = [[] for _ in range(max((len(lines) for lines, _ in row), default=0))]
        ends = [0] * len(made)
        column = 0
        for lines, span in row:
            # Only columns that hold a cell of their own take up room.
            start = starts[bisect.bisect_left(columns, column)] if aligned else 0
            for n, piece in enumerate(lines):
                if piece:
                    place = max(start, ends[n] + 2 if ends[n] else 0)
                    made[n].append(" " * (place - ends[n]) + piece)
                    ends[n] = place + len(piece)
            column += span
        out += ["".join(parts).rstrip() for parts in made]
    return out


class Page:
    """Builds the tree of one page and renders it as it goes."""

    def __init__(self):
        self.stack: list[str] = []
        self.places: defaultdict[str, list[int]] = defaultdict(list)  # in the stack, by name
        self.hidden_from: int | None = None  # depth of the outermost element that is not shown
        self.flows = [Lines()]
        self.tables: list[list[list[tuple[list[str], int]]]] = []
        self.cells: list[tuple[int, int]] = []  # (depth, span) of open cells
        self.counters: list[int | None] = []  # next number of open lists
        self.pre = 0
        self.closed_details: list[int] = []
        self.unseen: set[str] = set()

    # --- tree ---

    def run(self, source: str) -> str:
        at = 0
        while found := _TAG.search(source, at):
            self.text(source[at : found.start()])
            at = found.end()
            name = found["name"]
            if name is None:
                continue
            name = name.lower()
            if found["end"]:
                self.end(name)
                continue
            self.begin(name, found["attributes"])
            if name in RAW:
                stop = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I).search(source, at)
                inside = source[at : stop.start() if stop else len(source)]
                if name == "style":
                    self.style_sheet(inside)
                self.text(inside)
                at = stop.start() if stop else len(source)
        self.text(source[at:])
        while self.stack:
            self.pop()
        return "\n".join(self.flows[0].finish()).strip("\n")

    def style_sheet(self, source: str) -> None:
        for selectors, body in _RULE.findall(_COMMENT.sub("", source)):
            if _UNSEEN.search(body):
                self.unseen.update(s.strip().lower() for s in selectors.split(",") if re.fullmatch(r"\s*[.#]?[\w-]+\s*", s))

    def begin(self, name: str, source: str) -> None:
        if name in BLOCKS:
            self.end_implied(frozenset(["p"]), CELL_SCOPE)
            if name in HEADINGS and self.stack and self.stack[-1] in HEADINGS:
                self.pop()
        if name in IMPLIED_ENDS:
            self.end_implied(*IMPLIED_ENDS[name])
        known = attributes(source) if source.strip(" /\n") else {}
        if name in VOID:
            if self.hidden_from is None and not self.is_hidden(name, known):
                if name == "br":
                    flow = self.flows[-1]
                    if not flow.line:
                        flow.start()
                        flow.line.append("")
                    flow.close_line()
                elif name == "hr":
                    self.flows[-1].apart(2)
            return
        self.stack.append(name)
        self.places[name].append(len(self.stack) - 1)
        if self.hidden_from is None:
            if self.is_hidden(name, known) or self.in_closed_details(name):
                self.hidden_from = len(self.stack)
            else:
                self.open(name, known)

    def end_implied(self, kinds: frozenset[str], limits: frozenset[str]) -> None:
        """Close the outermost open element of ``kinds`` inside the innermost of ``limits``."""
        limit = self.innermost(limits)
        found = []
        for kind in kinds:
            places = self.places[kind]
            n = bisect.bisect(places, limit)
            found += places[n : n + 1]
        if found:
            depth = min(found)
            while len(self.stack) > depth:
                self.pop()

    def innermost(self, names: frozenset[str]) -> int:
        """Place of the innermost open element of ``names``, or -1."""
        return max((self.places[name][-1] for name in names if self.places[name]), default=-1)

    def end(self, name: str) -> None:
        if name == "br":
            return self.begin("br", "")
        limits = CELL_SCOPE if name not in CELL_SCOPE | {"tr", "tbody", "thead", "tfoot"} else frozenset(["table"])
        n = self.innermost(frozenset([name]))
        if n >= 0 and n >= self.innermost(limits):
            while len(self.stack) > n:
                self.pop()

    def pop(self) -> None:
        name, depth = self.stack[-1], len(self.stack)
        if self.hidden_from is None:
            self.close(name, depth)
        elif self.hidden_from == depth:
            self.hidden_from = None
        if self.closed_details and self.closed_details[-1] == depth:
            self.closed_details.pop()
        self.stack.pop()
        self.places[name].pop()

    # --- visibility ---

    def is_hidden(self, name: str, known: dict[str, str]) -> bool:
        if name in NEVER_SHOWN or name in self.unseen:
            return True
        if not known:
            return False
        if "hidden" in known or _UNSEEN.search(known.get("style", "")) or name == "dialog" and "open" not in known:
            return True
        names = [f".{c.lower()}" for c in known.get("class", "").split()] + [f"#{known.get('id', '').lower()}"]
        return bool(self.unseen) and any(n in self.unseen for n in names)

    def in_closed_details(self, name: str) -> bool:
        return bool(self.closed_details) and self.closed_details[-1] == len(self.stack) - 1 and name != "summary"

    # --- layout ---

    def text(self, source: str) -> None:
        if not source or self.hidden_from is not None:
            return
        if self.closed_details and self.closed_details[-1] == len(self.stack):
            return
        text = html.unescape(source) if "&" in source and (not self.stack or self.stack[-1] != "xmp") else source
        if self.pre:
            self.flows[-1].verbatim(text)
        else:
            self.flows[-1].text(text)

    def open(self, name: str, known: dict[str, str]) -> None:
        flow = self.flows[-1]
        if name in BLOCKS:
            close = flow.mark or name in LISTS and self.counters  # at the start of an item, or a list in a list
            flow.apart(1 if close or name not in APART else 2)
        if name in LISTS:
            start = known.get("start", "1")
            self.counters.append((int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1) if name == "ol" else None)
        elif name == "li":
            mark = "- "
            if self.counters and self.counters[-1] is not None:
                mark = f"{self.counters[-1]}. "
                self.counters[-1] += 1
            flow.indent.append(" " * len(mark))
            flow.mark = mark
        elif name in ("dd", "blockquote"):
            flow.indent.append("  ")
        elif name in ("pre", "xmp", "textarea"):
            self.pre += 1
        elif name == "details" and "open" not in known:
            self.closed_details.append(len(self.stack))
        elif name == "table":
            self.tables.append([])
        elif name == "tr" and self.tables:
            self.tables[-1].append([])
        elif name in ("td", "th"):
            if self.tables:
                if not self.tables[-1]:
                    self.tables[-1].append([])
                span = known.get("colspan", "1")
                self.cells.append((len(self.stack), max(1, int(span[:4]) if len(span) < 5 else 1000) if re.fullmatch(r"[0-9]+", span) else 1))
                self.flows.append(Lines())
            else:
                flow.apart(1)

    def close(self, name: str, depth: int) -> None:
        flow = self.flows[-1]
        if self.cells and self.cells[-1][0] == depth:
            lines, (_, span) = self.flows.pop().finish(), self.cells.pop()
            self.tables[-1][-1].append((lines, span))
            return
        if name == "table":
            flow.apart(2)
            lines = table_lines(self.tables.pop())
            if any(lines):
                flow.whole(lines)
        if name in LISTS:
            self.counters.pop()
        elif name == "li":
            if flow.mark:  # an item without text
                flow.mark = ""
            flow.indent.pop()
        elif name in ("dd", "blockquote"):
            flow.indent.pop()
        elif name in ("pre", "xmp", "textarea"):
            self.pre -= 1
        if name in BLOCKS:
            flow.apart(2 if name in APART and not (name in LISTS and self.counters) else 1)


def page_text(source: str | None) -> str | None:
    """The visible text of a page; a null page has none, an empty one an empty text."""
    return None if source is None else Page().run(source)


def extract(pages: DataFrame, column: str = "html", into: str = "page_text") -> DataFrame:
    """``pages`` with the visible text of ``column`` in ``into`` (which replaces a column of that name).

    Every row is kept; a null page has a null text. Work is row by row, without a shuffle.
    """
    kept = [c for c in pages.columns if c != into]
    rows = pages.select(*kept)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow.slices(batches, column):
            texts = [page_text(x) for x in part.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, into])

    return rows.mapInArrow(render, StructType([*rows.schema.fields, StructField(into, StringType())]))
