"""HTML extraction by layout-aware rendering.

``tree_events`` reads a page as a browser's tree builder would, in short: elements that HTML closes by implication
(the head by anything that does not belong there, paragraphs, list items, table parts, options) are closed, void elements have no content, end tags without an open
element are ignored, raw text is not read as markup, and whatever is open at the end is closed.  ``Renderer`` turns
the elements into text: all that is visible and nothing else.  Blocks start on new lines, paragraphs, headings,
lists and tables are set off by a blank line, list items carry a dash or their number and are indented by depth,
preformatted text keeps its spaces, table columns are padded to the same width (cells wider than ``PAD_TO`` are not
padded to, so that a long cell does not blow up its column).

Not visible: head, script, style, template, noscript, comments, elements with ``display:none`` or with ``hidden`` and
no other display, what is ``visibility:hidden`` but for parts inside that are ``visibility:visible`` again, closed
details but for their summary, closed dialogs, and fallback content of media.  Of inputs the value is shown where a
browser writes it out (not of passwords, boxes, files, ranges, colours and hidden ones), of option groups the label.
Alternatives of images and placeholders are not text of the page.  Cells outside a table are set apart by a space, their
rows by lines; cells that span rows keep their column free in the rows below.  Both steps keep a stack, never recursion, so depth is not limited.

Defined results: a null or empty page has empty text; repeated rows are rendered alike; broken markup is read as far
as it goes; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import per_text

PAD_TO = 40

#: A quote opens a value only directly behind "="; elsewhere it is a letter like others.  A quote never closed opens none.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?=[^a-zA-Z]))[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|(?![\"'])[^\s>]++|(?=>)|\Z))?)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|(?![\"'])([^\s>]++)))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_STYLE = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
TEXT_ONLY = frozenset("textarea title".split())
UNSEEN = frozenset(
    "head title script style template noscript iframe noembed noframes object video audio canvas datalist area base link meta".split()
)
#: What a head may hold; anything else ends it.
HEAD_CONTENT = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Inputs whose value is not written out.
UNWRITTEN_INPUTS = frozenset("hidden password checkbox radio file image range color".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SET_OFF = HEADINGS | frozenset("p ul ol dl table pre blockquote figure hr".split())
BLOCKS = SET_OFF | frozenset(
    "html body div section article aside header footer nav main address li dt dd form fieldset legend figcaption details summary"
    " center dir menu hgroup search caption option optgroup dialog".split()
)
CLOSES_PARAGRAPH = BLOCKS - frozenset("html body caption option optgroup legend".split())
#: What a start tag closes, and the elements beyond which it does not look.
CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table".split())),
    "dt": (frozenset("dt dd".split()), frozenset("dl table".split())),
    "dd": (frozenset("dt dd".split()), frozenset("dl table".split())),
    "option": (frozenset(["option"]), frozenset("select optgroup datalist".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "tr": (frozenset("tr td th caption colgroup".split()), frozenset("table thead tbody tfoot".split())),
    **{part: (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])) for part in ("thead", "tbody", "tfoot")},
    "body": (frozenset(["head"]), frozenset()),
}
IN_TABLE = frozenset("td th caption".split())
TABLE_PARTS = IN_TABLE | frozenset("table tr thead tbody tfoot".split())


class OpenElements:
    """The open elements, innermost last, with a count of each name so that looking for one that is not open is free."""

    def __init__(self):
        self.names: list[str] = []
        self.count: Counter[str] = Counter()

    def push(self, name: str):
        self.names.append(name)
        self.count[name] += 1

    def end_from(self, at: int) -> Iterator[tuple[str, str, None]]:
        while len(self.names) > at:
            name = self.names.pop()
            self.count[name] -= 1
            yield "end", name, None

    def end_outermost(self, names: frozenset[str], barrier: frozenset[str]) -> Iterator[tuple[str, str, None]]:
        """End the outermost open element in ``names`` above the barrier, and all inside it."""
        left = sum(self.count[name] for name in names)
        at = found = len(self.names)
        while left and at and self.names[at - 1] not in barrier:
            at -= 1
            if self.names[at] in names:
                found, left = at, left - 1
        return self.end_from(found)

    def end_tag(self, name: str) -> Iterator[tuple[str, str, None]]:
        """End the innermost open ``name``; inside a cell nothing outside of it, unless it is a part of the table."""
        table_part = name in TABLE_PARTS
        for at in range(len(self.names) - 1, -1, -1) if self.count[name] else ():
            if self.names[at] == name:
                return self.end_from(at)
            if self.names[at] == "table" or self.names[at] in IN_TABLE and not table_part:
                break
        return iter(())


def tree_events(page: str) -> Iterator[tuple[str, str, dict[str, str] | str | None]]:
    """``("start", name, attributes)``, ``("end", name, None)`` and ``("text", "", text)`` of a well-formed tree."""
    tree = OpenElements()
    place, size = 0, len(page)
    begun = False  # whether the head or the body has begun
    while place < size:
        token = _TOKEN.search(page, place)
        upto = token.start() if token else size
        if upto > place:
            text = html.unescape(page[place:upto])
            if text.strip(" \t\n\r\f"):
                begun = True
                if tree.names and tree.names[-1] == "head":
                    yield from tree.end_from(len(tree.names) - 1)
            yield "text", "", text
        if not token:
            break
        place = token.end()
        name = (token[2] or "").lower()
        if not name:
            if (tree.count["svg"] or tree.count["math"]) and page.startswith("<![CDATA[", upto):
                end = page.find("]]>", upto)
                end, place = (size, size) if end < 0 else (end, end + 3)
                yield "text", "", page[upto + 9 : end]
            continue
        if token[1]:
            if name == "br" or name == "p" and not tree.count["p"]:
                yield "start", name, {}
                yield "end", name, None
            else:
                yield from tree.end_tag(name)
            continue
        if name == "head" and begun:
            continue
        if name != "html":
            begun = True
        if tree.names and tree.names[-1] == "head" and name not in HEAD_CONTENT:
            yield from tree.end_from(len(tree.names) - 1)
        if name in CLOSES_PARAGRAPH:
            yield from tree.end_outermost(frozenset(["p"]), IN_TABLE | frozenset(["table", "button", "object"]))
        if name in HEADINGS and tree.names and tree.names[-1] in HEADINGS:
            yield from tree.end_from(len(tree.names) - 1)
        if name in CLOSES:
            yield from tree.end_outermost(*CLOSES[name])
        if name in ("td", "th") and tree.count["table"] and tree.names[-1] != "tr":
            tree.push("tr")
            yield "start", "tr", {}
        attributes = {}
        for found in _ATTRIBUTE.finditer(token[3] or ""):
            attributes.setdefault(found[1].lower(), html.unescape(found[2] or found[3] or found[4] or ""))
        yield "start", name, attributes
        if name in VOID:
            yield "end", name, None
        elif name in RAW or name in TEXT_ONLY:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, place)
            inner = page[place : end.start() if end else size]
            yield "text", "", inner if name in RAW else html.unescape(inner)
            yield "end", name, None
            place = end.end() if end else size
        else:
            tree.push(name)
    yield from tree.end_from(0)


class Flow:
    """Lines of text being laid out."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.spaced = True
        self.blank = False

    def words(self, text: str):
        text = _SPACES.sub(" ", text)
        if self.spaced:
            text = text[1:] if text[:1] == " " else text
        if text:
            self.parts.append(text)
            self.spaced = text[-1] == " "

    def literal(self, text: str):
        first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.parts.append(first)
        for line in rest:
            self.end_line(force=True)
            self.parts.append(line)
        self.spaced = not self.parts[-1]

    def end_line(self, force: bool = False, prefix: str = ""):
        line = "".join(self.parts).rstrip(" ")
        self.parts, self.spaced = [], True
        if line or force:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.append(line)

    def gap(self):
        self.end_line()
        self.blank = True

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines)


class Renderer:
    """Visible text of the elements, laid out."""

    def __init__(self):
        self.flow = Flow()
        self.unseen = 0
        self.pre = 0
        #: For each open element: whether it hides its content, whether it is a closed ``details``, whether text in it is
        #: visible by its style.
        self.open: list[tuple[bool, bool, bool]] = []
        self.lists: list[int | None] = []
        self.tables: list[dict] = []

    def run(self, page: str) -> str:
        for kind, name, more in tree_events(page):
            if kind == "text":
                self.write(more)
            elif kind == "start":
                self.start(name, more)
            else:
                self.end(name)
        return self.flow.text().strip("\n")

    def _is_visible(self) -> bool:
        return not self.open or self.open[-1][2]

    def write(self, text: str):
        if self.unseen or self.open and self.open[-1][1] or not self._is_visible():
            return
        if self.tables and self.tables[-1]["cell"] is None and not text.strip():
            return
        if self.pre:
            self.flow.literal(text)
        else:
            self.flow.words(text)

    def start(self, name: str, attributes: dict[str, str]):
        # The last declaration of a property counts.
        style = {key.lower(): value.lower() for key, value in _STYLE.findall(attributes.get("style", ""))}
        display = style.get("display", "none" if "hidden" in attributes else "")
        hides = (
            name in UNSEEN
            or display == "none"
            or name == "dialog" and "open" not in attributes
            or name != "summary" and bool(self.open) and self.open[-1][1]
        )
        visibility = style.get("visibility", "inherit")
        visible = visibility not in ("hidden", "collapse") and (visibility in ("visible", "initial") or self._is_visible())
        self.open.append((hides, name == "details" and "open" not in attributes, visible))
        self.unseen += hides
        if self.unseen:
            return
        if name in SET_OFF and not (name in ("ul", "ol") and self.lists):
            self.flow.gap()
        elif name in BLOCKS:
            self.flow.end_line()
        if name == "br":
            self.flow.end_line(force=True)
        elif name == "hr":
            self.flow.gap()
        elif name in ("ul", "menu", "dir"):
            self.lists.append(None)
        elif name == "ol":
            start = attributes.get("start", "1")
            self.lists.append(int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1)
        elif name == "li":
            self._item(attributes)
        elif name == "dd":
            self.flow.parts.append("    ")
        elif name == "pre":
            self.pre += 1
        elif name == "table":
            self.tables.append({"rows": [], "row": None, "taken": set(), "spans": {}, "cell": None, "outer": self.flow, "lists": self.lists})
            self.lists = []
        elif name == "tr" and self.tables:
            self._new_row()
        elif name == "tr":
            self.flow.end_line()
        elif name in ("td", "th") and not self.tables:
            self.flow.words(" ")
        elif name in IN_TABLE and self.tables:
            self._cell(name, attributes)
        elif name == "input" and visible and attributes.get("type", "").lower() not in UNWRITTEN_INPUTS:
            self.flow.words(attributes.get("value", ""))
        elif name == "optgroup" and visible:
            self.flow.words(attributes.get("label", ""))
            self.flow.end_line()

    def _item(self, attributes: dict[str, str]):
        depth = max(0, len(self.lists) - 1)
        mark = "-"
        if self.lists and self.lists[-1] is not None:
            value = attributes.get("value", "")
            number = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else self.lists[-1]
            mark, self.lists[-1] = f"{number}.", number + 1
        if self._is_visible():
            self.flow.parts.append(f"{'  ' * depth}{mark} ")

    def _cell(self, name: str, attributes: dict[str, str]):
        table = self.tables[-1]
        if name != "caption" and table["row"] is None:
            self._new_row()
        wide, high = (
            int(span) if re.fullmatch(r"[1-9][0-9]{0,2}", span) else 1
            for span in (attributes.get("colspan", ""), attributes.get("rowspan", ""))
        )
        table["cell"] = (name, wide, high)
        self.flow = Flow()

    def _new_row(self):
        """A row in which the columns of cells from above that span it are taken."""
        table = self.tables[-1]
        table["row"] = []
        table["rows"].append(table["row"])
        table["taken"] = set(table["spans"])
        table["spans"] = {column: left - 1 for column, left in table["spans"].items() if left > 1}

    def end(self, name: str):
        hides, _, _ = self.open.pop()
        self.unseen -= hides
        if self.unseen or hides:
            return
        if name in ("ul", "ol", "menu", "dir"):
            if self.lists:
                self.lists.pop()
        elif name == "pre":
            self.pre = max(0, self.pre - 1)
        elif name in IN_TABLE and self.tables and self.tables[-1]["cell"]:
            self._end_cell()
            return
        elif name == "tr" and self.tables:
            self.tables[-1]["row"] = None
            return
        elif name == "table" and self.tables:
            self._end_table()
        if name in SET_OFF and not (name in ("ul", "ol") and self.lists):
            self.flow.gap()
        elif name in BLOCKS:
            self.flow.end_line()

    def _end_cell(self):
        table = self.tables[-1]
        (name, wide, high), inner = table["cell"], self.flow.text()
        table["cell"], self.flow = None, table["outer"]
        text = " ".join(inner.split("\n")).strip()
        if name == "caption":
            self.flow.words(text)
            self.flow.end_line()
        else:
            row = table["row"]
            while len(row) in table["taken"]:
                row.append("")
            if high > 1:
                table["spans"] |= dict.fromkeys(range(len(row), len(row) + wide), high - 1)
            row += [text] + [""] * (wide - 1)

    def _end_table(self):
        table = self.tables.pop()
        self.lists, self.flow = table["lists"], table["outer"]
        self.flow.end_line()
        rows = [row for row in table["rows"] if any(row)]
        widths = [0] * max(map(len, rows), default=0)
        for row in rows:
            for at, cell in enumerate(row):
                if len(cell) <= PAD_TO:
                    widths[at] = max(widths[at], len(cell))
        for row in rows:
            self.flow.parts.append("  ".join(cell.ljust(widths[at]) for at, cell in enumerate(row)))
            self.flow.end_line()


def rendered(page: str) -> str:
    return Renderer().run(page)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id`` and the visible ``text`` of every row."""
    text = per_text(lambda raw: pa.array([rendered(page.decode()) for page in raw], pa.string()), "string")(F.col("html"))
    return pages.select(F.col("page_id"), text.alias("text"))
