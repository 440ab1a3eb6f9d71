"""Layout-aware rendering of HTML as text.

A linear scanner yields tags and text; the tree builder keeps the stack of
open elements, closes elements whose end tags are implied and opens implied
table rows; the renderer, driven by the builder's open and close events, emits
all visible text with block spacing, list markers and aligned table cells.

Not visible: comments, head, script, style, template, noscript (scripting is
taken as on), title, iframe, noembed, noframes, datalist, audio, video, canvas,
``rp``, and elements with ``hidden`` or ``display:none``, a ``dialog`` without
``open``, with all they contain; text under ``visibility:hidden`` or
``collapse``, unless an element within is ``visible`` again; in svg all but
``text`` and ``foreignObject``, and these within the elements of SVG_INVISIBLE;
in math annotations and ``mphantom``.  Nothing is loaded, so an object shows
its fallback.

Work grows with the page, however deep it nests: open elements are found by
name, not by walking the stack.

Defined results: null or empty html renders as empty text; plain text renders
as itself with white space collapsed; a tag that never ends drops the rest, as
in browsers; unknown elements are inline; repeated rows get one result each;
columns other than ``page_id`` and ``html`` are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar.llm.common import arrow_map, slices, table

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
INVISIBLE = frozenset("head script style template noscript title iframe noembed noframes "
                      "datalist audio video canvas rp".split())
SVG_INVISIBLE = frozenset("defs desc metadata title style script symbol clippath mask marker "
                          "pattern".split())
MATH_INVISIBLE = frozenset("annotation annotation-xml mphantom".split())
#: Elements of svg and math that hold html again.
HTML_INSIDE = {"svg": frozenset("foreignobject desc title".split()),
               "label": frozenset("foreignobject desc title".split()),
               "math": frozenset("mi mo mn ms mtext".split())}
#: Start tags that end svg and math.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
    "listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Elements of svg and math that are parted from their neighbours by a blank.
APART = frozenset("text mtd mtr".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta noframes script style template title "
                      "noscript".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that close an open paragraph.
CLOSE_P = HEADINGS | frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption "
    "figure footer form header hgroup hr li main menu nav ol p pre search section summary table "
    "ul".split())
#: Blocks with a blank line around them, and blocks that only start a new line.
SPACED = HEADINGS | frozenset("p ul ol menu dir dl blockquote pre table figure hr fieldset".split())
BLOCKS = CLOSE_P | SPACED | frozenset("body html caption option optgroup legend textarea".split())
#: Elements that limit the search for an element to close.
SCOPE = frozenset("html table td th caption button object template marquee applet "
                  "foreignobject".split())
#: Start tag -> open elements it ends, and where the search for them stops.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select", "datalist")),
    "tr": (("td", "th", "tr", "caption", "colgroup"), ("table",)),
    "td": (("td", "th", "caption", "colgroup"), ("table", "tr")),
    "th": (("td", "th", "caption", "colgroup"), ("table", "tr")),
    "thead": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tbody": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "caption": (("caption", "colgroup"), ("table",)),
    "colgroup": (("caption", "colgroup"), ("table",)),
}
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534

# A quote opens a string only right behind "=", elsewhere it is an ordinary character.
_TAG = re.compile(r"<(/?)([a-zA-Z][^ \t\n\r\f>/]*+)("
                  r"(?>[ \t\n\r\f/]++|[^ \t\n\r\f>/][^ \t\n\r\f>/=]*+"
                  r"(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:\"[^\"]*+\"|'[^']*+'|[^ \t\n\r\f>\"'][^ \t\n\r\f>]*+|(?=>))"
                  r"|(?![ \t\n\r\f]*+=)))*+)>")
_ATTR = re.compile(r"([^ \t\n\r\f>/][^ \t\n\r\f>/=]*+)(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+"
                   r"(?:\"([^\"]*+)\"|'([^']*+)'|([^ \t\n\r\f>\"'][^ \t\n\r\f>]*+))?+)?+")
_BLANKS = str.maketrans("\t\n\r\f", "    ")
# Strings, comments and parentheses of a style, which may hold ";" and ":".
_STYLE_OPAQUE = re.compile(r"\"[^\"]*+\"|'[^']*+'|/\*.*?\*/|\([^)]*+\)", re.S)
_COMMENT_END = re.compile(r"--!?>")


def scan(html: str, foreign: Callable[[], bool] = lambda: False) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("start", name, attributes) and ("end", name, "");
    ``foreign`` tells whether the reader is inside svg or math."""
    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            yield "text", html[at:], ""
            return
        if lt > at:
            yield "text", html[at:lt], ""
        m = _TAG.match(html, lt)
        if m:
            at = m.end()
            name = m[2].lower()
            if m[1]:
                yield "end", name, ""
                continue
            markup = (name in RAW_TEXT or name == "plaintext") and foreign()
            yield "start", name, m[3]
            if markup:
                continue
            if name in RAW_TEXT:
                close = re.compile(rf"</{name}(?=[\s>/])", re.I).search(html, at)
                stop = close.start() if close else n
                if name not in INVISIBLE and stop > at:
                    yield "text", html[at:stop], ""
                at = stop
            elif name == "plaintext":
                yield "text", html[at:], ""
                return
        elif html.startswith("<!--", lt):
            if html.startswith((">", "->"), lt + 4):       # <!--> and <!---> are whole comments
                at = html.index(">", lt) + 1
            else:
                end = _COMMENT_END.search(html, lt + 4)
                at = end.end() if end else n
        elif html.startswith("<![CDATA[", lt) and foreign():
            end = html.find("]]>", lt + 9)
            yield "text", html[lt + 9:end if end >= 0 else n].replace("&", "&amp;"), ""
            at = n if end < 0 else end + 3
        elif html.startswith(("<!", "<?", "</"), lt):
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
        elif lt + 1 < n and html[lt + 1].isascii() and html[lt + 1].isalpha():
            return                                  # a tag that never ends
        else:
            yield "text", "<", ""
            at = lt + 1


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def declared(style: str) -> dict[str, str]:
    """The values of ``display`` and ``visibility`` that a style ends up with."""
    out: dict[str, tuple[bool, str]] = {}
    if "display" in style.lower() or "visibility" in style.lower():
        for part in _STYLE_OPAQUE.sub(" ", style).lower().split(";"):
            name, colon, value = part.partition(":")
            value, _, weight = value.partition("!")
            key, important = name.strip(), weight.strip() == "important"
            if colon and key in ("display", "visibility") and important >= out.get(key, (False, ""))[0]:
                out[key] = (important, value.strip())
    return {key: value for key, (_, value) in out.items()}


def self_closing(text: str) -> bool:
    """Whether attributes end with a slash that is not part of a value."""
    return text.endswith("/") and all(m.end() < len(text) for m in _ATTR.finditer(text))


class Flow:
    """Lines of text with collapsed white space and pending block breaks."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.blank = False
        self.mark = ""                              # list marker for the next line

    def words(self, text: str) -> None:
        parts = text.translate(_BLANKS).split(" ")
        before, after = not parts[0], not parts[-1]
        body = " ".join(filter(None, parts))
        if not body:
            self.space = self.space or (len(parts) > 1 and bool(self.line))
            return
        if before and self.line:
            self.space = True
        self._open()
        self.line.append(" " + body if self.space else body)
        self.space = after

    def _open(self) -> None:
        if not self.line:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = self.space = False
            if self.mark:
                self.line.append(self.mark)
                self.mark = ""

    def verbatim(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self._open()
        self.line.append(first)
        for more in rest:
            self.end_line(keep=True)
            self.line.append(more)

    def end_line(self, keep: bool = False) -> None:
        if self.line or keep:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        self.space = False

    def add(self, lines: list[str], spaced: bool) -> None:
        """Lines laid out elsewhere (a list item, a table)."""
        self.end_line()
        if not lines:
            return
        if (self.blank or spaced) and self.lines:
            self.lines.append("")
        self.blank = False
        self.lines += lines

    def finish(self) -> list[str]:
        self.end_line()
        return self.lines


class Grid:
    """Cells of one table: each is placed in its first free column."""

    def __init__(self) -> None:
        self.rows: list[dict[int, tuple[list[str], int]]] = []
        self.taken: dict[int, int] = {}             # column -> rows still covered
        self.caption: list[str] = []

    def new_row(self) -> None:
        if self.rows:
            self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.rows.append({})

    def cell(self, lines: list[str], colspan: int, rowspan: int) -> None:
        if not self.rows:
            self.new_row()
        row, col = self.rows[-1], 0
        if row:
            last = next(reversed(row))              # columns ascend
            col = last + row[last][1]
        while col in self.taken:
            col += 1
        row[col] = (lines, colspan)
        if rowspan > 1:
            for c in range(col, col + colspan):
                self.covered_later.append((c, rowspan))

    covered_later: list[tuple[int, int]]

    def begin(self) -> None:
        self.covered_later = []

    def end_row(self) -> None:
        for c, n in self.covered_later:
            self.taken[c] = max(self.taken.get(c, 0), n)
        self.covered_later = []

    def lines(self) -> list[str]:
        """Columns padded to their widest cell, two blanks between them; a
        spanning cell lies over its columns, the last of which is widened if
        it needs more."""
        rows = [r for r in self.rows if any(cell for cell, _ in r.values())]
        columns = sorted({c for r in rows for c in r})
        at = {c: i for i, c in enumerate(columns)}
        width = [0] * len(columns)
        spans = []
        for r in rows:
            for c, (cell, span) in r.items():
                end = bisect_left(columns, c + span)
                longest = max(map(len, cell), default=0)
                if end - at[c] == 1:
                    width[at[c]] = max(width[at[c]], longest)
                else:
                    spans.append((end - at[c], at[c], end, longest))
        for _, start, end, longest in sorted(spans):
            width[end - 1] += max(0, longest - sum(width[start:end]) - 2 * (end - start - 1))
        out = list(self.caption)
        for r in rows:
            for k in range(max(len(cell) for cell, _ in r.values())):
                parts, i = [], 0
                while i < len(columns):
                    cell, span = r.get(columns[i], ([], 1))
                    end = max(i + 1, bisect_left(columns, columns[i] + span))
                    parts.append((cell[k] if k < len(cell) else "").ljust(
                        sum(width[i:end]) + 2 * (end - i - 1)))
                    i = end
                out.append("  ".join(parts).rstrip())
        return out


class Renderer:
    """Receives the builder's events; one flow per list item, cell or quote."""

    def __init__(self) -> None:
        self.flows = [Flow()]
        self.grids: list[Grid] = []
        self.lists: list[list] = []                 # [ordered, next number]
        self.pre = 0

    def text(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        if self.pre:
            self.flows[-1].verbatim(text)
        else:
            self.flows[-1].words(text)

    def open(self, name: str, attrs: dict[str, str]) -> None:
        flow = self.flows[-1]
        if name == "br":
            flow.end_line(keep=True) if not flow.blank or flow.line else flow.end_line()
            return
        if name in BLOCKS:
            flow.end_line()
            if name in SPACED and not (name in ("ul", "ol") and self.lists):
                flow.blank = True
        if name == "hr":
            flow.add(["---"], True)
            flow.blank = True
        elif name in ("ul", "ol", "menu", "dir"):
            start = attrs.get("start", "")
            self.lists.append([name == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
        elif name == "li":
            self.flows.append(Flow())
        elif name == "table":
            self.grids.append(Grid())
            self.grids[-1].begin()
        elif name == "tr" and self.grids:
            self.grids[-1].end_row()
            self.grids[-1].new_row()
        elif name in ("td", "th", "caption") or name in ("blockquote", "dd"):
            self.flows.append(Flow())
        elif name in ("pre", "textarea"):
            self.pre += 1

    def close(self, name: str, attrs: dict[str, str]) -> None:
        flow = self.flows[-1]
        if name == "li":
            lines = self.flows.pop().finish()
            mark = "- "
            if self.lists and self.lists[-1][0]:
                value = attrs.get("value", "")
                number = int(value) if re.fullmatch(r"-?\d{1,9}", value) else self.lists[-1][1]
                self.lists[-1][1] = number + 1
                mark = f"{number}. "
            self.flows[-1].add([(mark if i == 0 else " " * len(mark)) + x if x else x
                                for i, x in enumerate(lines)], False)
        elif name in ("td", "th", "caption"):
            lines = self.flows.pop().finish()
            if not self.grids:
                self.flows[-1].add(lines, False)
            elif name == "caption":
                self.grids[-1].caption += lines
            else:
                span = lambda key, most: min(most, int(v)) if (                  # noqa: E731
                    v := attrs.get(key, "")).isascii() and v.isdigit() and 0 < len(v) < 9 else 1
                self.grids[-1].cell(lines, max(1, span("colspan", MAX_COLSPAN)),
                                    max(1, span("rowspan", MAX_ROWSPAN)))
        elif name in ("blockquote", "dd"):
            lines = self.flows.pop().finish()
            self.flows[-1].add([f"  {x}" if x else x for x in lines], name == "blockquote")
        elif name == "table":
            grid = self.grids.pop()
            grid.end_row()
            flow.add(grid.lines(), True)
        elif name in ("pre", "textarea"):
            self.pre -= 1
            flow.end_line() if flow.line != [""] else flow.line.clear()
        elif name in ("ul", "ol", "menu", "dir") and self.lists:
            self.lists.pop()
        if name in BLOCKS:
            flow = self.flows[-1]
            flow.end_line()
            if name in SPACED and not (name in ("ul", "ol") and self.lists):
                flow.blank = True


class Element(NamedTuple):
    """An open element."""

    name: str                                       # empty: ended while inner ones stay open
    attrs: dict[str, str]
    unseen: bool                                    # not rendered, with all it contains
    kind: str                                       # "" for html, else the kind of foreign content
    seen: bool                                      # its own text is visible


def render(html: str | None) -> str:
    """The visible text of a page."""
    if not html:
        return ""
    out = Renderer()
    stack: list[Element] = []
    places: dict[str, list[int]] = defaultdict(list)       # name -> its places in the stack
    hidden = 0

    def kind_now() -> str:
        return stack[-1].kind if stack else ""

    def seen_now() -> bool:
        return not hidden and (not stack or stack[-1].seen)

    def kind_of(name: str, outer: str) -> str:
        if name in ("svg", "math"):
            return name
        if outer and name in HTML_INSIDE[outer]:
            return ""
        return "label" if outer == "svg" and name == "text" else outer

    def apart(name: str, outer: str) -> None:
        if outer and name in APART and not hidden:
            out.text(" ")

    def push(name: str, attrs: dict[str, str]) -> None:
        nonlocal hidden
        outer = kind_now()
        apart(name, outer)
        style = declared(attrs["style"]) if "style" in attrs else {}
        unseen = (name in INVISIBLE or (name in MATH_INVISIBLE if outer == "math" else
                                        bool(outer) and name in SVG_INVISIBLE) or "hidden" in attrs
                  or (name == "dialog" and "open" not in attrs) or style.get("display") == "none")
        seen = not stack or stack[-1].seen
        if style.get("visibility") in ("hidden", "collapse", "visible"):
            seen = style["visibility"] == "visible"
        if not hidden and not unseen:
            out.open(name, attrs)
        places[name].append(len(stack))
        stack.append(Element(name, attrs, unseen, kind_of(name, outer), seen))
        hidden += unseen

    def pop() -> None:
        nonlocal hidden
        e = stack.pop()
        places[e.name].pop()
        hidden -= e.unseen
        while stack and not stack[-1].name:                # ended before
            stack.pop()
        if not hidden and not e.unseen:
            out.close(e.name, e.attrs)
        apart(e.name, kind_now())

    def end_alone(i: int) -> None:
        """Take the i-th element out; what was opened inside stays open."""
        nonlocal hidden
        e = stack[i]
        places[e.name].pop()
        hidden -= e.unseen
        stack[i] = Element("", {}, False, stack[i - 1].kind if i else "", e.seen)

    def last(names: Iterable[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def find(names: tuple[str, ...], stops: frozenset | tuple) -> int:
        """The innermost of ``names`` that no stop lies within, or -1."""
        i = last(names)
        return i if i >= 0 and i >= last(stops) else -1

    def close_to(i: int) -> None:
        while len(stack) > i and stack:
            pop()

    def leave_foreign() -> None:
        while kind_now():
            pop()

    for kind, name, rest in scan(html, lambda: bool(kind_now())):
        top = stack[-1].name if stack else ""
        if kind == "text":
            if top == "head" and name.strip(" \t\n\r\f"):
                pop()
            if seen_now() and kind_now() != "svg":
                out.text(name)
            continue
        if kind == "start":
            if name in BREAKOUT:
                leave_foreign()
            if top == "head" and name not in HEAD_ONLY:
                pop()
            if name in ("html", "body") and places.get(name):
                continue
            if name in CLOSE_P and (i := find(("p",), SCOPE)) >= 0:
                close_to(i)
            if name in HEADINGS and stack and stack[-1].name in HEADINGS:
                pop()
            if name in IMPLIED:
                ends, stops = IMPLIED[name]
                while (i := find(ends, stops)) >= 0:
                    close_to(i)
                if name in ("td", "th") and find(("tr",), ("table",)) < 0 \
                        and find(("table",), ()) >= 0:
                    push("tr", {})
            attrs = attributes(rest) if rest and rest != "/" else {}
            if name in VOID:
                if seen_now() and "hidden" not in attrs and declared(attrs.get("style", "")).get(
                        "display") != "none":
                    out.open(name, attrs)
                continue
            outer = kind_now()
            push(name, attrs)
            if (outer or name in ("svg", "math")) and self_closing(rest):
                pop()
            continue
        if name in ("br", "p"):
            leave_foreign()
        if name == "br":
            if not hidden:
                out.open("br", {})
        elif name == "p" and find(("p",), SCOPE) < 0:
            if not hidden:
                out.open("p", {})
                out.close("p", {})
        elif name in ("table", "tr", "td", "th", "thead", "tbody", "tfoot", "caption"):
            stops = ("table",) if name != "table" else ()
            if (i := find((name,), stops)) >= 0:
                close_to(i)
        elif name in BLOCKS or name in INVISIBLE or kind_now() \
                or name in ("select", "object", "svg", "math", "foreignobject"):
            if (i := find((name,), SCOPE - {name})) >= 0:
                close_to(i)
        else:
            # an inline element ends alone: blocks opened inside it stay open
            i = find((name,), SCOPE)
            if i == len(stack) - 1 >= 0:
                pop()
            elif i >= 0:
                end_alone(i)
    close_to(0)
    lines = out.flows[0].finish()
    return "\n".join(lines).strip("\n")


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, text, n_chars, n_lines of every page."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "html"):
            texts = [render(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                ["page_id", "text", "n_chars", "n_lines"])
    return arrow_map(pages.select(F.col("page_id").cast("bigint").alias("page_id"), "html"), run,
                     "page_id bigint, text string, n_chars bigint, n_lines bigint")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))
