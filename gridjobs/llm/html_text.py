"""Visible text of HTML, laid out as a page shows it: a tree builder with implied tags, then rendering block by block."""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole

# In a tag a quote opens a string only right after an equals sign; elsewhere it is part of a name or value.
TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+))*+)(?:>|\Z)"""
    r"""|<[!?/][^>]*(?:>|\Z)""",
    re.S,
)
ATTR = re.compile(r"""([^\s=/>]+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+)))?""")
SPACE = re.compile(r"[ \t\n\f\r]+")
NOT_DISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\s*(?:!\s*important\s*)?(?=;|$)", re.I)

# Fixed values of the HTML standard: void elements, raw-text elements, elements that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
# Elements that are never shown, and those that begin and end a line; those with a blank line about them.
HIDDEN = frozenset("head title script style template noscript iframe noembed noframes object svg math datalist audio video canvas meta link base".split())
BLOCK = ENDS_P | frozenset("html body li dt dd option optgroup caption legend tr thead tbody tfoot td th xmp".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table blockquote pre figure fieldset xmp hr".split())
# What an opening tag closes by implication: (closed, not beyond).
LISTS, TABLE = frozenset("ul ol menu dir".split()), frozenset(["table"])
ROWS, CELLS = frozenset("thead tbody tfoot".split()), frozenset("td th".split())
IMPLIED = {
    "li": (frozenset(["li"]), LISTS | TABLE),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"]) | TABLE),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"]) | TABLE),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
    "tr": (CELLS | frozenset("tr caption colgroup".split()), TABLE),
    "td": (CELLS, TABLE | frozenset(["tr"])),
    "th": (CELLS, TABLE | frozenset(["tr"])),
    **dict.fromkeys(ROWS, (CELLS | ROWS | frozenset("tr caption colgroup".split()), TABLE)),
    "body": (frozenset(["head"]), frozenset()),
}
HEAD_ONLY = frozenset("head title meta link base script style noscript template html".split())
#: Scopes that an end tag of a formatting or block element doesn't leave.
FENCE = CELLS | TABLE | frozenset(["caption"])


class Node:
    __slots__ = ("attrs", "kids", "name")

    def __init__(self, name: str, attrs: str = ""):
        self.name, self.attrs, self.kids = name, attrs, []


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(ATTR.finditer(text)))}


def parse(source: str) -> Node:
    """The tree of a page. Tags that the standard implies are closed or opened; stray end tags are dropped."""
    root = Node("html")
    open_, held = [root], Counter(["html"])  # the open elements, and how many there are of each name
    pos, n = 0, len(source)

    def push(node: Node) -> None:
        open_.append(node)
        held[node.name] += 1

    def cut(i: int) -> None:
        held.subtract(x.name for x in open_[i:])
        del open_[i:]

    def add(text: str) -> None:
        if open_[-1].name == "head" and text.strip():
            cut(-1)
        if open_[-1].name in TABLE | ROWS | {"tr"} and not text.strip():
            return
        open_[-1].kids.append(html.unescape(text) if "&" in text else text)

    def close(names: frozenset[str], fence: frozenset[str]) -> bool:
        if not any(map(held.__getitem__, names)):
            return False
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].name in names:
                cut(i)
                return True
            if open_[i].name in fence:
                return False
        return False

    while pos < n:
        m = TOKEN.search(source, pos)
        if m is None:
            add(source[pos:])
            break
        if m.start() > pos:
            add(source[pos : m.start()])
        pos = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            if name in ("html", "body"):
                continue
            if name == "br":
                open_[-1].kids.append(Node("br"))
            elif name == "p" and not held["p"]:
                open_[-1].kids.append(Node("p"))
            elif name in TABLE:
                close(TABLE, frozenset())
            elif name in LISTS or name == "li":
                close(frozenset([name]), FENCE | (LISTS if name == "li" else frozenset()))
            elif name in ROWS | CELLS | {"tr"}:
                close(frozenset([name]), TABLE)
            else:
                close(frozenset([name]), FENCE)
            continue
        if name == "html":
            root.attrs = root.attrs or m["attrs"]
            continue
        if name == "body" and held["body"]:
            continue
        if open_[-1].name == "head" and name not in HEAD_ONLY:
            cut(-1)
        if name in IMPLIED:
            names, fence = IMPLIED[name]
            while close(names, fence):
                pass
        if name in ENDS_P:
            close(frozenset(["p"]), FENCE | frozenset("button object template".split()))
        if name[0] == "h" and name in ("h1", "h2", "h3", "h4", "h5", "h6") and open_[-1].name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            cut(-1)
        if name in CELLS and open_[-1].name in TABLE | ROWS:  # a cell without its row
            open_[-1].kids.append(row := Node("tr"))
            push(row)
        open_[-1].kids.append(node := Node(name, m["attrs"]))
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, pos)
            body, pos = (source[pos : end.start()], end.end()) if end else (source[pos:], n)
            if name in ("textarea", "title"):
                body = html.unescape(body)
            node.kids.append(body)
        elif name not in VOID:
            push(node)
    return root


def visible(node: Node, inherited: bool) -> tuple[bool, bool]:
    """Is the element displayed at all, and is its own text visible? Only visibility can be given back to what is inside."""
    if node.name in HIDDEN:
        return False, False
    if not node.attrs or not re.search("hidden|style|open", node.attrs, re.I):
        return node.name != "dialog", inherited
    found = attributes(node.attrs)
    style = found.get("style", "")
    displayed = "hidden" not in found and not NOT_DISPLAYED.search(style) and (node.name != "dialog" or "open" in found)
    said = VISIBILITY.findall(style)
    return displayed, said[-1].lower() == "visible" if said else inherited


class Lines:
    """Lines of text as blocks add them: words of a line flow together, blocks begin lines, spaced blocks leave a blank one."""

    def __init__(self, first: str = "", rest: str = ""):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.indents = [(first, rest)]
        self.blank = False

    def text(self, s: str) -> None:
        s = SPACE.sub(" ", s)
        if not self.parts or self.parts[-1].endswith((" ", "\n")):
            s = s.lstrip(" ")
        if s:
            self.parts.append(s)

    def literal(self, s: str) -> None:
        if s:
            self.parts.append(s)

    def end(self, blank: bool = False, force: bool = False) -> None:
        """End the line, if it holds anything; blank: the next one has a blank line before it."""
        line = "".join(self.parts)
        self.parts = []
        if line.strip(" \n") or force:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            for x in line.rstrip(" ").split("\n"):
                first, rest = self.indents[-1]
                self.lines.append((first + x).rstrip(" "))
                self.indents[-1] = (rest, rest)
        self.blank |= blank

    def push(self, first: str, rest: str) -> None:
        a, b = self.indents[-1]
        self.indents.append((a + first, b + rest))

    def pop(self) -> None:
        first, rest = self.indents.pop()
        if first == rest:  # its marker has been shown, and with it what stood before
            a, b = self.indents[-1]
            self.indents[-1] = (b, b)


Cell = tuple[list[str], int, int]
#: Times a table's text that aligning it may add in spaces.
PADDING = 4


class Held:
    """The columns that cells of earlier rows reach down into, as disjoint runs; each part of a run knows the row at which it ends."""

    def __init__(self):
        self.runs: list[list[int]] = []  # [first, last + 1], sorted, no two adjacent
        self.ends: list[tuple[int, int, int]] = []  # a heap of (row, first, last + 1)

    def free(self, at: int) -> int:
        """The first column from `at` on that isn't held."""
        i = bisect_right(self.runs, [at, 1 << 62]) - 1
        return max(at, self.runs[i][1]) if i >= 0 else at

    def hold(self, first: int, last: int, row: int) -> None:
        """Columns that are held already stay so for as long as they were to."""
        while first < last:
            i = bisect_right(self.runs, [first, 1 << 62])
            stop = min(last, self.runs[i][0]) if i < len(self.runs) else last
            heappush(self.ends, (row, first, stop))
            before, after = i > 0 and self.runs[i - 1][1] == first, i < len(self.runs) and self.runs[i][0] == stop
            if before and after:
                self.runs[i - 1][1] = self.runs.pop(i)[1]
            elif before:
                self.runs[i - 1][1] = stop
            elif after:
                self.runs[i][0] = first
            else:
                self.runs.insert(i, [first, stop])
            first = self.free(stop)

    def release(self, row: int) -> None:
        """End what ends at this row."""
        while self.ends and self.ends[0][0] <= row:
            _, first, last = heappop(self.ends)
            i = bisect_right(self.runs, [first, 1 << 62]) - 1
            a, b = self.runs[i]
            self.runs[i : i + 1] = [x for x in ([a, first], [last, b]) if x[0] < x[1]]


def placed(rows: list[list[Cell]]) -> Iterator[list[tuple[int, list[str], int]]]:
    """Each row's cells with their first column: those that cells of earlier rows reach down into are passed over."""
    held = Held()
    for n, row in enumerate(rows):
        held.release(n)
        at, out, new = 0, [], []
        for lines, span, down in row:
            at = held.free(at)
            out.append((at, lines, span))
            if down > 1:
                new.append((at, at + span, n + down))
            at += span
        for cell in new:
            held.hold(*cell)
        yield out


def aligned(rows: list[list[Cell]]) -> list[str]:
    """Rows of (lines of a cell, columns and rows that it spans) with each column as wide as its widest cell.

    A column that no cell has for itself takes no room. A table in which the padding would come to more than PADDING times its text
    keeps its cells two spaces apart.
    """
    grid, wide, text = list(placed(rows)), {}, 0
    for row in grid:
        for at, lines, span in row:
            text += sum(map(len, lines)) + 2
            if span == 1:
                wide[at] = max(wide.get(at, 0), max(map(len, lines), default=0))
    columns = sorted(wide)
    upto = list(accumulate((wide[c] + 2 for c in columns), initial=0))
    start = {at: upto[bisect_left(columns, at)] for at in {at for row in grid for at, _, _ in row}}
    if sum(start[row[-1][0]] * max(len(lines) for _, lines, _ in row) for row in grid if row) > PADDING * text + 1_000:
        start = dict.fromkeys(start, 0)
    out = []
    for row in grid:
        for i in range(max((len(lines) for _, lines, _ in row), default=0)):
            line = ""
            for at, lines, _ in row:
                line = (f"{line}  " if line else "").ljust(start[at]) + (lines[i] if i < len(lines) else "")
            out.append(line.rstrip(" "))
    return out


def spans(node: Node) -> tuple[int, int]:
    """Columns and rows of a cell; no rows (0) means all that follow."""
    found = attributes(node.attrs) if "span" in node.attrs.lower() else {}
    across, down = found.get("colspan", "1"), found.get("rowspan", "1")
    down = int(down) if re.fullmatch(r"\d{1,5}", down) else 1
    return max(1, int(across)) if re.fullmatch(r"\d{1,3}", across) else 1, down or 1 << 30


def render(root: Node) -> str:
    """Visible text, without recursion: a page may be nested as deep as it is long."""
    out, stack = [Lines()], [(root, False)]
    counts: list[int | None] = []  # of open lists: the next number, or None for bullets
    tables: list[list[list[Cell]]] = []
    seen = [True]  # of open elements: is their text visible?
    kept = 0  # open elements that keep white space
    while stack:
        node, ending = stack.pop()
        here = out[-1]
        if isinstance(node, str):
            if not seen[-1]:
                continue
            here.literal(node.replace("\r\n", "\n")) if kept else here.text(node)
            continue
        name = node.name
        block, spaced = name in BLOCK, name in SPACED and not (counts and name in LISTS)
        if not ending:
            displayed, shown = visible(node, seen[-1])
            if not displayed:
                continue
            if name in VOID:
                if not shown:
                    continue
                if name == "br":
                    here.end(force=True) if not here.parts else here.end()
                elif name == "hr":
                    here.end(blank=True)
                    here.literal("---")
                    here.end(blank=True)
                continue
            if name in CELLS and tables:
                out.append(Lines())
            elif block and not (name == "tr" and tables):
                here.end(blank=spaced and shown)
            if name in LISTS:
                start = attributes(node.attrs).get("start", "1") if name == "ol" else ""
                counts.append((int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1) if name == "ol" else None)
                here.push("", "")
            elif name == "li":
                mark = "- "
                if counts and counts[-1] is not None:
                    mark = f"{counts[-1]}. "
                    counts[-1] += 1
                if not shown:
                    mark = " " * len(mark)
                here.push(mark, " " * len(mark))
            elif name in ("blockquote", "dd"):
                here.push("  ", "  ")
            elif name == "table":
                tables.append([])
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name == "q" and shown:
                here.text('"')
            seen.append(shown)
            kept += name in ("pre", "textarea", "xmp")
            stack.append((node, True))
            kids = node.kids
            if name == "pre" and kids and isinstance(kids[0], str):
                kids = [kids[0].removeprefix("\r").removeprefix("\n"), *kids[1:]]
            stack.extend((k, False) for k in reversed(kids))
            continue
        kept -= name in ("pre", "textarea", "xmp")
        shown = seen.pop()
        if name in CELLS and tables:
            here.end()
            out.pop()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((here.lines, *spans(node)))
            continue
        if name == "table":
            here.end()
            for line in aligned(tables.pop()):
                here.literal(line)
                here.end()
        elif name in ("li", "blockquote", "dd") or name in LISTS:
            here.end()
            here.pop()
            if name in LISTS:
                counts.pop()
        elif name == "q" and shown:
            here.text('"')
        if block and not (name == "tr" and tables):
            here.end(blank=spaced and shown)
    out[0].end()
    return "\n".join(out[0].lines).strip("\n")


def html_to_text(source: str | None) -> str:
    return render(parse(source)) if source else ""


def extract_text(pages: DataFrame, source: str = "html", key: str = "page_id") -> DataFrame:
    """Visible text of every whole page: key, text.

    Blocks begin lines, paragraphs, headings, lists and tables have a blank line about them, list items their bullet or
    number, table cells stand in aligned columns, below those that span rows too. Scripts, styles, heads and elements hidden
    by attribute or inline style give nothing; what is visible again inside a `visibility: hidden` element is shown. A null or empty page gives an empty text; broken mark-up never fails; repeated rows each keep a row; an
    empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "text": [html_to_text(x) for x in pdf["h"]]})

    return pages.select(F.col(key), whole(F.col(source)).alias("h")).mapInPandas(run, f"{key} {dict(pages.dtypes)[key]}, text string")
