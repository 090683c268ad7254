"""Visible text of one HTML page, laid out: blocks, lists and aligned tables."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

# Fixed values of the HTML standard.
_VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_HIDDEN = frozenset(
    "head title base link meta script style template noscript iframe noembed noframes object canvas audio video svg math datalist "
    "area param source track".split()
)
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section summary table ul li dd dt xmp".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CELL = frozenset(("td", "th", "caption"))
_SECTION = frozenset(("thead", "tbody", "tfoot"))
_TABLE = _CELL | _SECTION | {"tr", "table", "colgroup"}
#: A start tag closes the open elements of the second kind, looking no further than the third.
_IMPLIED = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir")) | _TABLE),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",)) | _TABLE),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",)) | _TABLE),
    "option": (frozenset(("option",)), frozenset(("select", "datalist")) | _TABLE),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",)) | _TABLE),
    "a": (frozenset(("a",)), _TABLE),
    "button": (frozenset(("button",)), _TABLE),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "tr": (frozenset(("tr", "caption", "colgroup")), frozenset(("table",))),
    **dict.fromkeys(_SECTION, (_SECTION | {"tr", "caption", "colgroup"}, frozenset(("table",)))),
}
#: Newlines before and after.
_LINE = frozenset(
    "address article aside center dd details dialog dir div dt figcaption figure footer form header hgroup legend li main nav option "
    "optgroup section summary tr caption body html".split()
)
_SPACED = frozenset("blockquote dl fieldset h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul xmp".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANK = re.compile(r"[ \t\n\r\f]+")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!important\s*)?(?:;|$)", re.I)
_SIMPLE = re.compile(r"([a-z][a-z0-9]*)?([.#][\w-]+)?$", re.I)
#: A column is padded to its widest cell, up to so many characters; longer cells run over.
WIDEST = 60
#: Columns are lined up as far as this place of a line; cells further on follow after a gap.
ALIGNED = 1000
#: Elements nest this deep, as in browsers; one more takes the place of the innermost.
DEEPEST = 512
_GAP = "  "


class _Flow:
    """Lines under way: text is collapsed, breaks are held back until text follows."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.words: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = ""
        self.bullet: str | None = None

    def _start(self) -> None:
        if self.lines and self.gap > 1:
            self.lines.append("")
        self.gap = 0

    def text(self, text: str, keep: bool) -> None:
        if keep:
            first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            if first:
                self.words.append(first)
            for part in rest:
                self.end_line(True)
                if part:
                    self.words.append(part)
            return
        text = _BLANK.sub(" ", text)
        if text == " ":
            self.space = bool(self.words)
            return
        if self.words and (self.space or text[0] == " "):
            self.words.append(" ")
        self.space = text[-1] == " "
        self.words.append(text.strip(" "))

    def end_line(self, always: bool = False) -> None:
        if self.words or always:
            self._start()
            head = self.indent if self.bullet is None else self.bullet
            self.lines.append((head + "".join(self.words)).rstrip(" "))
            self.words, self.bullet = [], None
        self.space = False

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def table(self, rows: list[list[tuple[list[str], int, int]]]) -> None:
        """Rows of cells (lines, columns, rows): each column as wide as its widest cell."""
        placed: list[list[tuple[int, int, list[str]]]] = []
        taken: dict[int, int] = {}
        widths: dict[int, int] = {}
        for row in rows:
            at, line = 0, []
            busy = {c for c, n in taken.items() if n > 0}
            taken = {c: n - 1 for c, n in taken.items() if n > 1}
            for lines, columns, down in row:
                while at in busy:
                    at += 1
                if down > 1:
                    taken |= dict.fromkeys(range(at, at + columns), down - 1)
                line.append((at, columns, lines))
                if columns == 1:
                    widths[at] = max(widths.get(at, 0), min(WIDEST, max(map(len, lines), default=0)))
                at += columns
            placed.append(line)
        starts, total = {}, 0
        for column in range(max((c + n for line in placed for c, n, _ in line), default=0) + 1):
            starts[column] = total
            total += widths.get(column, 0) + (len(_GAP) if column in widths else 0)
        for line in placed:
            for k in range(max((len(lines) for _, _, lines in line), default=0)):
                out = ""
                for column, _, lines in line:
                    if k < len(lines) and lines[k]:
                        if out:
                            out += _GAP
                        out = out.ljust(min(starts[column], ALIGNED)) + lines[k]
                self.words = [out]
                self.end_line(True)


class _Page:
    """The open elements of a page and the flows they write to."""

    def __init__(self) -> None:
        self.open: list[tuple[str, dict, bool]] = []  # tag, what to undo, whether hidden
        self.flows = [_Flow()]
        self.tables: list[list[list[tuple[list[str], int, int]]]] = []
        self.rules: list[tuple[str, str]] = []
        self.keep = 0
        self.count: Counter[str] = Counter()  # open elements by tag

    def hidden(self) -> bool:
        return bool(self.open) and self.open[-1][2]

    def _unseen(self, tag: str, attributes: dict[str, str]) -> bool:
        if tag in _HIDDEN or "hidden" in attributes or _NOT_SHOWN.search(attributes.get("style", "")):
            return True
        if tag == "input" and attributes.get("type", "").lower() == "hidden":
            return True
        if not self.rules:
            return False
        names = {f".{c}" for c in attributes.get("class", "").split()} | {f"#{attributes.get('id', '')}"}
        return any((not t or t == tag) and (not n or n in names) for t, n in self.rules)

    def style(self, sheet: str) -> None:
        """Keeps the rules of a style sheet that hide a plain selector (element, class or id)."""
        for rule in re.sub(r"/\*.*?(?:\*/|\Z)", "", sheet, flags=re.S).split("}"):
            selectors, _, body = rule.rpartition("{")
            if _NOT_SHOWN.search(body):
                for selector in selectors.rpartition("{")[2].split(","):
                    m = _SIMPLE.match(selector.strip())
                    if m and m.group():
                        self.rules.append(((m.group(1) or "").lower(), m.group(2) or ""))

    def _close_to(self, index: int) -> None:
        while len(self.open) > index:
            tag, undo, hidden = self.open.pop()
            self.count[tag] -= 1
            self._leave(tag, undo, hidden)

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in _ENDS_P:
            self._imply(frozenset(("p",)), _TABLE | {"button", "object"})
        if tag in _HEADINGS and self.open and self.open[-1][0] in _HEADINGS:
            self._close_to(len(self.open) - 1)
        if tag == "body" and self.count["head"]:
            self._close_to(next(k for k, o in enumerate(self.open) if o[0] == "head"))
        rule = _IMPLIED.get(tag)
        if rule:
            self._imply(*rule)
        if tag in ("td", "th") and not any(t == "tr" for t, _, _ in self._within("table")) and self.tables:
            self.start("tr", {})
        if tag in ("html", "body") and self.count[tag]:
            return
        hidden = self.hidden() or self._unseen(tag, attributes)
        if len(self.open) >= DEEPEST and tag not in _VOID:
            self._close_to(DEEPEST - 1)
        if not hidden:
            undo = self._enter(tag, attributes)
        else:
            undo = {}
        if tag not in _VOID:
            self.open.append((tag, undo, hidden))
            self.count[tag] += 1

    def _within(self, limit: str) -> list:
        k = len(self.open)
        while k and self.open[k - 1][0] != limit:
            k -= 1
        return self.open[k:]

    def _imply(self, closed: frozenset, limit: frozenset) -> None:
        """Closes the outermost open element of a kind, not looking past the limit."""
        found, k = None, len(self.open) - 1
        if not any(self.count[tag] for tag in closed):
            return
        while k >= 0:
            tag = self.open[k][0]
            if tag in closed:
                found = k
            elif tag in limit:
                break
            k -= 1
        if found is not None:
            self._close_to(found)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
            return
        k = len(self.open) - 1 if self.count[tag] else -1
        while k >= 0 and self.open[k][0] != tag:
            if self.open[k][0] in _TABLE and tag not in _TABLE:
                return  # an end tag inside a cell closes nothing outside
            if self.open[k][0] == "table" and tag in _TABLE - {"table"}:
                return
            k -= 1
        if k >= 0:
            self._close_to(k)
        elif tag == "p" and not self.hidden():
            self.flows[-1].block(2)

    def _enter(self, tag: str, attributes: dict[str, str]) -> dict:
        flow, undo = self.flows[-1], {}
        if tag == "br":
            flow.end_line(True)
        elif tag == "hr":
            flow.block(2)
        elif tag in ("ul", "ol", "menu", "dir"):
            nested = self.count["li"] > 0
            flow.block(1 if nested else 2)
            start = attributes.get("start", "1").strip()
            undo["count"] = int(start) if tag == "ol" and re.fullmatch(r"-?\d{1,9}", start) else 1
            undo["ordered"] = tag == "ol"
        elif tag == "li":
            flow.block(1)
            mark = "- "
            for t, u, _ in reversed(self.open):
                if "ordered" in u:
                    if u["ordered"]:
                        mark = f"{u['count']}. "
                        u["count"] += 1
                    break
            undo["indent"], undo["bullet"] = flow.indent, flow.bullet
            flow.bullet = (flow.indent if flow.bullet is None else flow.bullet) + mark
            flow.indent += " " * len(mark)
        elif tag in ("blockquote", "dd"):
            flow.block(2 if tag == "blockquote" else 1)
            undo["indent"] = flow.indent
            flow.indent += "  "
        elif tag == "table":
            flow.block(2)
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables:
            undo["cell"] = tuple(
                min(int(n), 1000) or 1 if re.fullmatch(r"\d{1,6}", n := attributes.get(a, "1").strip()) else 1
                for a in ("colspan", "rowspan")
            )
            self.flows.append(_Flow())
        elif tag in _SPACED:
            flow.block(2)
        elif tag in _LINE:
            flow.block(1)
        if tag in ("pre", "xmp", "textarea"):
            self.keep += 1
            undo["keep"] = True
        return undo

    def _leave(self, tag: str, undo: dict, hidden: bool) -> None:
        if hidden:
            return
        flow = self.flows[-1]
        if "cell" in undo:
            flow.end_line()
            self.flows.pop()
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.tables[-1][-1].append((flow.lines, *undo["cell"]))
            return
        if "keep" in undo:
            self.keep -= 1
        if tag == "table" and self.tables:
            flow.end_line()
            flow.table(self.tables.pop())
        if tag in _SPACED or "ordered" in undo:
            nested = "ordered" in undo and self.count["li"] > 0
            flow.block(1 if nested else 2)
        elif tag in _LINE:
            flow.block(1)
        if "indent" in undo:
            flow.indent = undo["indent"]
        if "bullet" in undo:
            flow.bullet = undo["bullet"]

    def text(self, raw: str) -> None:
        if raw and not self.hidden():
            if self.open and self.open[-1][0] in ("table", "tr", "thead", "tbody", "tfoot", "colgroup") and not raw.strip():
                return
            self.flows[-1].text(unescape(raw) if "&" in raw else raw, self.keep > 0)


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def render(page: str) -> str:
    """The visible text of a page, line by line.

    Tags that authors leave out are implied: ends of paragraphs, items, cells, rows and
    options, rows around cells. Not shown are scripts, styles, the head, templates,
    embedded media, and what an attribute (``hidden``), an inline style or a plain rule of
    the page's own style sheet hides. White space collapses except in ``pre``. Blocks
    start on a line of their own, paragraphs, headings, lists and tables after a blank
    line; items carry ``-`` or their number and indent what follows; cells of a column
    start at the same place. Unclosed tags, comments and quotes end with the page.
    """
    state = _Page()
    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            state.text(page[at:])
            break
        if m.start() > at:
            state.text(page[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            state.end(tag)
            continue
        rest = m.group(3)
        attributes = _attributes(rest) if rest.strip(" /\n\t\r\f") else {}
        state.start(tag, attributes)
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if tag == "style":
                state.style(page[at:stop])
            elif tag not in _HIDDEN:
                state.text(page[at:stop])
            at = stop
            if not end:
                break
    state._close_to(0)
    flow = state.flows[0]
    flow.end_line()
    return "\n".join(flow.lines).strip("\n")
