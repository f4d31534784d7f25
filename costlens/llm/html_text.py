"""Operator 3: HTML extraction by layout-aware rendering.

A tokenizer and a tree builder read the page (implied end tags of paragraphs,
list items, table parts, options and terms; void and raw-text elements; stray
end tags are ignored), visibility rules decide what a reader sees, and a
renderer lays the tree out as plain text:

* inline white space collapses, ``pre`` and ``textarea`` keep it, ``br`` ends a line;
* paragraphs, headings, lists, quotes and tables stand apart by an empty line,
  other blocks by a line end;
* list items get their bullet or number and are indented by level;
* formulas and the texts of drawings are inline text, inputs show their value;
* table cells are padded to the width of their column (wide characters count
  twice), spans included; cells may hold several lines.

Not visible: ``head`` and script-like elements, comments, ``hidden``, dialogs and
details that are not open, ``display:none`` and ``visibility:hidden`` by style
attribute or by simple rules (tag, .class, #id) of the page's style elements.  The
declaration that a browser obeys decides (importance, style attribute, specificity,
order); rules under ``@media`` and style elements count where they hold for a
screen of ``SCREEN`` with scripts on.

Elements nested deeper than ``MAX_DEPTH`` become siblings; their text is kept.

Defined results: a null page gives an empty text; plain text without tags is
one paragraph; broken markup never fails; repeated rows get equal results; a
null id or url is passed on; an empty table gives an empty result; further
columns are ignored.  Pages are handled one by one; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from costlens.llm.common import map_batches

MAX_DEPTH = 150
SCREEN = (1280, 800)  # width and height in CSS pixels that media queries are asked for

# Element kinds of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set(
    "head title script style template noscript iframe noembed noframes object canvas audio video"
    " datalist annotation annotation-xml".split()
)
# parts of a drawing that are not drawn themselves
UNDRAWN = set("defs symbol clippath mask pattern marker metadata desc".split())
MATH_PARTS = set("mfrac mroot msub msup msubsup munder mover munderover mtr mtd".split())
NO_VALUE = set("hidden password checkbox radio file image color range".split())  # of inputs
APART = set(  # stand apart by an empty line
    "p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure hr fieldset".split()
)
BLOCKS = APART | set(
    "html body div section article aside nav header footer main address li dt dd form details"
    " summary dialog figcaption legend center dir hgroup search optgroup option caption".split()
)
ENDS_PARAGRAPH = BLOCKS - set("html body caption option optgroup".split())
# a start tag ends the open elements named here, up to one of the second set
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "thead": ({"td", "th", "tr", "caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"td", "th", "tr", "caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
}
CELLS = {"td", "th", "caption", "table"}  # end tags from inside never close these

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+))(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_STRING = re.compile(r"\"[^\"\n]*\"|'[^'\n]*'")
_STYLE_PART = re.compile(r"[{};]")
_SHOW = re.compile(r"display|visibility", re.I)
_LENGTH = re.compile(r"([+-]?\d+(?:\.\d+)?|[+-]?\.\d+)(px|em|rem|in|cm|mm|pt|pc)?")
_PIXELS = {"px": 1, "em": 16, "rem": 16, "in": 96, "cm": 96 / 2.54, "mm": 9.6 / 2.54, "pt": 4 / 3, "pc": 16}
_RANGE = re.compile(r"(?:([^<>=]+?)\s*([<>]=?|=)\s*)?(width|height)\s*(?:([<>]=?|=)\s*([^<>=]+))?")
# media features with a keyword: those that hold for a desktop screen
_FEATURES = {
    "orientation": "landscape",
    "prefers-color-scheme": "light",
    "prefers-reduced-motion": "no-preference",
    "prefers-contrast": "no-preference",
    "hover": "hover",
    "any-hover": "hover",
    "pointer": "fine",
    "any-pointer": "fine",
    "scripting": "enabled",
    "display-mode": "browser",
    "update": "fast",
}
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.children: list[Element | str] = []


def parse(page: str) -> tuple[Element, list[str]]:
    """(root element, texts of the style elements that count on a screen)."""
    root = Element("html", {})
    stack = [root]
    styles: list[str] = []

    def close(names: set[str], within: set[str]) -> None:
        """End the open elements in ``names``, looking no farther up than ``within``."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in within:
                break
            if stack[i].tag in names:
                del stack[i:]
                return close(names, within)

    at, n = 0, len(page)
    while at < n:
        m = _MARKUP.search(page, at)
        text = page[at : m.start() if m else n]
        if text:
            stack[-1].children.append(html.unescape(text))
        if not m:
            break
        at = m.end()
        slash, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if slash:
            _end_tag(tag, stack)
            continue
        attributes = {}
        for a in _ATTRIBUTE.finditer(rest or ""):
            value = next((v for v in a.groups()[1:] if v is not None), "")
            attributes.setdefault(a[1].lower(), html.unescape(value))
        if tag in ("html", "body") and len(stack) == 1:
            root.attributes = attributes | root.attributes
            if tag == "html":
                continue
        if tag in ENDS_PARAGRAPH:
            close({"p"}, CELLS | {"button"})
        if tag in ("body", *ENDS_PARAGRAPH):
            close({"head"}, {"body"})
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        element = Element(tag, attributes)
        stack[-1].children.append(element)
        if (rest or "").endswith("/") and (
            tag in ("svg", "math") or any(e.tag in ("svg", "math") for e in stack)
        ):
            continue  # formulas and drawings may close a tag at once
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            inside = page[at : end.start() if end else n]
            at = end.end() if end else n
            if tag == "style" and _counts(attributes, stack):
                styles.append(inside)
            element.children.append(html.unescape(inside) if tag in ("textarea", "title") else inside)
        elif tag not in VOID and len(stack) < MAX_DEPTH:
            stack.append(element)
    return root, styles


def _counts(attributes: dict[str, str], stack: list[Element]) -> bool:
    """Whether a style element's rules hold: for a screen, and not where scripts are off."""
    kind = attributes.get("type", "").strip().lower()
    return (
        kind in ("", "text/css")
        and media_holds(attributes.get("media", ""))
        and not any(e.tag in ("noscript", "template") for e in stack)
    )


def _top_level(text: str, word: str) -> list[str]:
    """``text`` cut at ``word`` (a comma, or a word between blanks) outside of brackets."""
    parts, depth, begin = [], 0, 0
    for m in re.finditer(r"[()]|,|(?<![\w-])(?:and|or)(?![\w-])", text):
        depth += {"(": 1, ")": -1}.get(m[0], 0)
        if m[0] == word and depth == 0:
            parts.append(text[begin : m.start()])
            begin = m.end()
    return [x.strip() for x in [*parts, text[begin:]]]


def media_holds(query: str) -> bool:
    """Whether a media query list holds for ``SCREEN``; unknown features do not."""
    query = query.strip().lower()
    return not query or any(_one_query(q) for q in _top_level(query, ","))


def _one_query(query: str) -> bool:
    if re.match(r"not(?![\w-])", query):
        return not _one_query(query[3:].strip())
    query = re.sub(r"^only\s+", "", query)
    if len(either := _top_level(query, "or")) > 1:
        return any(_one_query(q) for q in either)
    if len(both := _top_level(query, "and")) > 1:
        return all(_one_query(q) for q in both)
    if query.startswith("(") and query.endswith(")"):
        inside = query[1:-1].strip()
        return _one_query(inside) if re.match(r"\(|not(?![\w-])", inside) else _feature(inside)
    return query in ("all", "screen")


def _pixels(value: str) -> float | None:
    m = _LENGTH.fullmatch(value.strip())
    return float(m[1]) * _PIXELS[m[2] or "px"] if m else None


def _compare(a: float | None, sign: str, b: float | None) -> bool:
    if a is None or b is None:
        return False
    return a == b if sign == "=" else (a < b if "<" in sign else a > b) or ("=" in sign and a == b)


def _feature(text: str) -> bool:
    """One media feature: a size against ``SCREEN`` or a keyword of ``_FEATURES``."""
    sizes = {"width": SCREEN[0], "height": SCREEN[1]}
    name, colon, value = (x.strip() for x in text.partition(":"))
    if colon:
        bound, _, size = name.replace("device-", "").partition("-")
        if bound in ("min", "max") and size in sizes:
            return _compare(sizes[size], ">=" if bound == "min" else "<=", _pixels(value))
        if name in sizes:
            return _compare(sizes[name], "=", _pixels(value))
        return _FEATURES.get(name) == value
    if m := _RANGE.fullmatch(text):
        size = sizes[m[3]]
        return (not m[2] or _compare(_pixels(m[1]), m[2], size)) and (
            not m[4] or _compare(size, m[4], _pixels(m[5]))
        )
    return text in _FEATURES or text == "color"


def _end_tag(tag: str, stack: list[Element]) -> None:
    if tag == "br":
        stack[-1].children.append(Element("br", {}))
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].tag in CELLS and tag not in ("tr", "tbody", "thead", "tfoot", "table"):
            break
    if tag == "p":
        stack[-1].children.append(Element("p", {}))


def _declarations(body: str) -> Iterator[tuple[str, str, bool]]:
    """(property, value, important) of the declarations that hide or show."""
    if _SHOW.search(body):
        for part in body.split(";"):
            name, _, value = part.partition(":")
            name = name.strip().lower()
            if name in ("display", "visibility"):
                value, _, mark = value.partition("!")
                if value := value.strip().lower():
                    yield name, value, mark.strip().lower() == "important"


def _specificity(selector: str) -> tuple[int, int, int]:
    tag = selector[:1] not in (".", "#", "*")
    return selector.count("#"), selector.count("."), int(tag)


class Rules:
    """Which elements a page's simple style rules hide."""

    def __init__(self, styles: list[str]):
        # selector -> (rank, property, value); the highest rank decides
        self.by_selector: dict[str, list[tuple[tuple, str, str]]] = {}
        self._n = 0
        for css in styles:
            if _SHOW.search(css):
                self._read(css)

    def _read(self, css: str) -> None:
        css = re.sub(r"/\*.*?(?:\*/|\Z)", " ", css, flags=re.DOTALL)
        css = _STRING.sub('""', css).replace("<!--", " ").replace("-->", " ")
        # open blocks: the selectors they speak of (None at the top), whether they hold
        open_: list[tuple[list[str] | None, bool]] = [(None, True)]
        at = 0
        for m in _STYLE_PART.finditer(css):
            part, at = css[at : m.start()].strip(), m.end()
            names, holds = open_[-1]
            if m[0] == "{":
                if part.startswith("@"):
                    open_.append((names, holds and self._group_holds(part[1:].lower())))
                else:  # a rule inside a rule speaks of no simple selector
                    own = [x.strip().lower() for x in part.split(",")] if names is None else []
                    open_.append((own, holds))
                continue
            if names and holds:
                self._add(names, part)
            if m[0] == "}" and len(open_) > 1:
                open_.pop()
        names, holds = open_[-1]
        if names and holds:
            self._add(names, css[at:])

    @staticmethod
    def _group_holds(prelude: str) -> bool:
        kind, _, query = re.sub(r"^([\w-]+)", r"\1 ", prelude).partition(" ")
        if kind == "media":
            return media_holds(query)
        return kind in ("supports", "layer", "scope", "starting-style") and not re.match(r"\s*not\b", query)

    def _add(self, names: list[str], part: str) -> None:
        for prop, value, important in _declarations(part):
            self._n += 1
            for name in names:
                rank = (important, False, _specificity(name), self._n)
                self.by_selector.setdefault(name, []).append((rank, prop, value))

    def declared(self, e: Element, prop: str) -> str | None:
        """The value of ``prop`` that holds for an element, if any is declared."""
        found = []
        if self.by_selector:
            names = [e.tag, "*"]
            for c in set(e.attributes.get("class", "").lower().split()):
                names += [f".{c}", f"{e.tag}.{c}"]
            if "id" in e.attributes:
                own = e.attributes["id"].lower()
                names += [f"#{own}", f"{e.tag}#{own}"]
            for x in names:
                found += [(r, v) for r, p, v in self.by_selector.get(x, ()) if p == prop]
        if "style" in e.attributes:
            own = _declarations(e.attributes["style"])
            found += [((i, True, (0, 0, 0), n), v) for n, (p, v, i) in enumerate(own) if p == prop]
        return max(found)[1] if found else None

    def shown(self, e: Element) -> bool:
        if e.tag in UNSEEN:
            return False
        display = self.declared(e, "display")
        if display is None or display.startswith("revert"):
            return "hidden" not in e.attributes and (e.tag != "dialog" or "open" in e.attributes)
        return display != "none"

    def visible(self, e: Element, inherited: bool) -> bool:
        value = self.declared(e, "visibility")
        if value in ("hidden", "collapse"):
            return False
        return True if value in ("visible", "initial") else inherited


def _width(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(
        0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1
        for c in text
    )


class Flow:
    """Lines of one container: collapsing inline text and margins between blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self._line: list[str] = []
        self._space = False  # a collapsed space waits for the next word
        self._margin = 0  # empty lines that wait for the next content

    def text(self, value: str, keep: bool = False) -> None:
        if keep:
            first, *more = value.replace("\r\n", "\n").split("\n")
            self._put(first)
            for line in more:
                self._end_line()
                self._put(line)
            return
        if value[:1] in " \t\n\r\f" and value:
            self._space = True
        for word in _SPACE.split(value.strip(" \t\n\r\f")):
            if word:
                self._put((" " if self._space and self._line else "") + word)
                self._space = True
        self._space = value[-1:] in " \t\n\r\f" if value else self._space

    def _put(self, piece: str) -> None:
        if piece:
            self._open()
            self._line.append(piece)

    def _open(self) -> None:
        if not self._line and self._margin:
            if self.lines:
                self.lines.extend([""] * self._margin)
            self._margin = 0

    def _end_line(self) -> None:
        self._open()
        self.lines.append("".join(self._line).rstrip(" "))
        self._line, self._space = [], False

    def line_break(self) -> None:
        self._end_line()

    def block(self, margin: int) -> None:
        """Begin or end a block: finish the line, ask for ``margin`` empty lines."""
        if self._line:
            self._end_line()
        self._space = False
        self._margin = max(self._margin, margin)

    def add(self, lines: list[str], margin: int) -> None:
        self.block(margin)
        if lines:
            if self.lines:
                self.lines.extend([""] * self._margin)
            self._margin = 0
            self.lines.extend(lines)
        self.block(margin)

    def finish(self) -> list[str]:
        self.block(0)
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        while self.lines and not self.lines[0]:
            self.lines.pop(0)
        return self.lines


def _number(value: str | None, default: int) -> int:
    m = re.match(r"\s*[+-]?\d{1,9}", value or "", re.ASCII)
    return int(m[0]) if m else default


class Renderer:
    def __init__(self, rules: Rules):
        self.rules = rules

    def children(self, e: Element, flow: Flow, visible: bool, keep: bool) -> None:
        for child in e.children:
            if isinstance(child, str):
                if visible:
                    flow.text(child, keep)
            else:
                self.element(child, flow, visible, keep)

    def element(self, e: Element, flow: Flow, visible: bool, keep: bool) -> None:
        if not self.rules.shown(e):
            return
        visible = self.rules.visible(e, visible)
        tag = e.tag
        if tag == "br":
            flow.line_break()
        elif tag == "hr":
            flow.block(1)
        elif tag == "table":
            flow.add(self.table(e, visible), 1)
        elif tag in ("ul", "ol", "menu", "dir"):
            self.list(e, flow, visible)
        elif tag == "input":
            kind = e.attributes.get("type", "text").lower()
            if visible and kind.strip() not in NO_VALUE:
                flow.text(f" {e.attributes.get('value', '')} ")
        elif tag == "svg":
            self.drawing(e, flow, visible, keep)
        elif tag in MATH_PARTS:
            for child in e.children:
                if isinstance(child, Element):
                    self.element(child, flow, visible, keep)
                    flow.text(" ")
                elif visible:
                    flow.text(child, keep)
        elif tag == "details" and "open" not in e.attributes:
            flow.block(0)
            for child in e.children:
                if isinstance(child, Element) and child.tag == "summary":
                    self.element(child, flow, visible, keep)
                    break
            flow.block(0)
        elif tag == "dd":
            flow.add(["  " + x if x else x for x in self.inner(e, visible, keep)], 0)
        elif tag == "blockquote":
            flow.add(["  " + x if x else x for x in self.inner(e, visible, keep)], 1)
        elif tag == "q":
            if visible:
                flow.text('"')
            self.children(e, flow, visible, keep)
            if visible:
                flow.text('"')
        elif tag in BLOCKS:
            margin = 1 if tag in APART else 0
            if tag == "pre" and e.children and isinstance(e.children[0], str):
                e.children[0] = re.sub(r"^\r?\n", "", e.children[0])
            flow.block(margin)
            self.children(e, flow, visible, keep or tag == "pre")
            flow.block(margin)
        else:
            self.children(e, flow, visible, keep or tag == "textarea")

    def drawing(self, e: Element, flow: Flow, visible: bool, keep: bool) -> None:
        """The text elements of a drawing, and pages set into it."""
        for child in e.children:
            if isinstance(child, str) or child.tag in UNDRAWN or not self.rules.shown(child):
                continue
            seen = self.rules.visible(child, visible)
            if child.tag in ("text", "foreignobject"):
                flow.text(" ")
                self.children(child, flow, seen, keep)
                flow.text(" ")
            else:
                self.drawing(child, flow, seen, keep)

    def inner(self, e: Element, visible: bool, keep: bool = False) -> list[str]:
        flow = Flow()
        self.children(e, flow, visible, keep)
        return flow.finish()

    def list(self, e: Element, flow: Flow, visible: bool) -> None:
        items: list[str] = []
        number = _number(e.attributes.get("start"), 1)
        loose = Flow()
        for child in e.children:
            if not isinstance(child, Element) or child.tag != "li":
                if isinstance(child, Element):
                    self.element(child, loose, visible, False)
                elif visible:
                    loose.text(child)
                continue
            items += loose.finish()
            loose = Flow()
            if not self.rules.shown(child):
                continue
            number = _number(child.attributes.get("value"), number)
            mark = f"{number}. " if e.tag == "ol" else "- "
            number += 1
            lines = self.inner(child, self.rules.visible(child, visible))
            if lines:
                pad = " " * len(mark)
                items += [mark + lines[0], *(pad + x if x else x for x in lines[1:])]
        items += loose.finish()
        flow.add(items, 1)

    def table(self, e: Element, visible: bool) -> list[str]:
        out: list[str] = []
        rows: list[tuple[Element, bool]] = []
        after = Flow()  # content that stands in no row
        todo = [(e, visible)]
        while todo:
            part, seen = todo.pop()
            inner: list[tuple[Element, bool]] = []
            for child in part.children:
                if isinstance(child, str):
                    if seen and child.strip():
                        after.text(child)
                elif not self.rules.shown(child):
                    continue
                elif child.tag in ("thead", "tbody", "tfoot", "tr"):
                    inner.append((child, self.rules.visible(child, seen)))
                elif child.tag == "caption":
                    out += self.inner(child, self.rules.visible(child, seen))
                elif child.tag in ("td", "th"):  # a cell without a row
                    row = Element("tr", {})
                    row.children.append(child)
                    inner.append((row, seen))
                elif child.tag not in ("colgroup", "col"):
                    self.element(child, after, seen, False)
            for child, seen_child in reversed(inner):
                todo.append((child, seen_child))
            if todo and todo[-1][0].tag == "tr":
                while todo and todo[-1][0].tag == "tr":
                    rows.append(todo.pop())
        grid = [self.row(r, seen) for r, seen in rows]
        out += _aligned(grid)
        return out + after.finish()

    def row(self, e: Element, visible: bool) -> list[tuple[list[str], int, int]]:
        """(lines, columns, rows) of each cell."""
        cells = []
        for child in e.children:
            if isinstance(child, str):
                if visible and child.strip():
                    cells.append(([_SPACE.sub(" ", child).strip()], 1, 1))
            elif self.rules.shown(child):
                span = child.attributes if child.tag in ("td", "th") else {}
                if child.tag in ("td", "th"):
                    lines = self.inner(child, self.rules.visible(child, visible))
                else:
                    flow = Flow()
                    self.element(child, flow, visible, False)
                    lines = flow.finish()
                    if not lines:
                        continue
                wide = min(max(_number(span.get("colspan"), 1), 1), 1000)
                tall = min(max(_number(span.get("rowspan"), 1), 1), 65534)
                cells.append((lines, wide, tall))
        return cells


def _aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table, every cell padded to its column."""
    taken: dict[int, int] = {}  # column -> rows it stays occupied by a cell above
    placed: list[list[tuple[int, int, list[str]]]] = []
    for row in rows:
        at, here = 0, []
        new: dict[int, int] = {}
        for lines, wide, tall in row:
            while taken.get(at, 0):
                at += 1
            here.append((at, wide, lines))
            for c in range(at, at + wide):
                new[c] = tall - 1
            at += wide
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | {c: n for c, n in new.items() if n}
        placed.append(here)
    widths: dict[int, int] = {}
    for alone in (True, False):  # cells of one column first, spans share the rest
        for row in placed:
            for at, wide, lines in row:
                if (wide == 1) != alone:
                    continue
                need = max((_width(x) for x in lines), default=0)
                have = sum(widths.get(c, 0) for c in range(at, at + wide)) + 2 * (wide - 1)
                if need > have:
                    widths[at + wide - 1] = widths.get(at + wide - 1, 0) + need - have
    columns = max(widths, default=-1) + 1
    begins = [0]
    for c in range(columns):
        begins.append(begins[-1] + widths.get(c, 0) + 2)
    out = []
    for row in placed:
        for i in range(max((len(lines) for _, _, lines in row), default=0)):
            pieces, end = [], 0
            for at, _, lines in row:
                if i < len(lines) and lines[i]:
                    start = begins[min(at, columns)]
                    pieces.append(" " * (start - end) + lines[i])
                    end = start + _width(lines[i])
            out.append("".join(pieces).rstrip(" "))
    return out


def render(page: str | None) -> str:
    """The visible text of a page."""
    root, styles = parse((page or "").replace("\x00", ""))
    renderer = Renderer(Rules(styles))
    flow = Flow()
    if "hidden" not in root.attributes:
        renderer.children(root, flow, True, False)
    return "\n".join(flow.finish()).replace("\xa0", " ")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_lines of every page."""
    source = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        pages["html"].cast("string").alias("html"),
    )

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [render(v.as_py()) for v in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars", "n_lines"],
        )

    return map_batches(
        source, run, "page_id long, url string, text string, n_chars long, n_lines long"
    )
