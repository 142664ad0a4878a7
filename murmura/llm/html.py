"""HTML to text by layout: a tree with implied tags, visibility rules, and a renderer of blocks, lists and tables.

The tree builder closes what HTML lets authors leave open (paragraphs before blocks, list items, table parts,
options, terms, the head at whatever doesn't belong to it) and ignores stray end tags. Invisible are scripts, styles,
templates, the head, noscript, embedded objects, what SVG and MathML don't draw themselves (descriptions, definitions),
comments, hidden inputs, elements with `hidden` or whose style declares display:none, and text whose nearest declared
visibility is hidden or collapse. All other text comes out, in document order.

Blocks begin on a line of their own; paragraphs, headings, lists, tables and the like have an empty line around
them. White space collapses but in preformatted text. List items have a bullet or number and are indented by depth.
Rows of a table are lines, their cells padded to the width of the widest cell of each column (cells that span
columns take the width of those; columns of cells that span rows stay free below). Cells keep their own lines, side
by side; a table of one row inside a cell goes on in the cell's line. Formulas are their symbols in order, with a
blank between the parts of fractions, powers and the like; every text of a drawing is a line.

Time and space grow with the page, hostile ones too: the builder knows the places of open elements by name, cells
that reach down end with their row group, and layout alone has bounds (no text is lost to them): columns align up to
the `COLUMNS`th, blanks before a cell or an indented line end at `WIDEST` characters, and tables inside `DEEPEST`
others are plain blocks. A tag that is never closed is text from its `<` on, an open comment hides what follows, and a quote that
never ends is part of a bare value.

Defined cases: null html gives null text; html without visible text an empty one; broken markup never fails; texts
of any length and depth are rendered without recursion; repeated rows are rendered each; an empty table gives an
empty table; other columns of the input are not carried.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmura.llm.common import map_batches

# Element names of the HTML standard by the role they play here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INVISIBLE = set("script style template head title noscript noframes iframe object applet canvas audio video datalist meta link base".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr fieldset details article section main".split())
BLOCK = SPACED | set("div header footer nav aside address form li dt dd tr thead tbody tfoot caption figcaption legend summary body html option optgroup select menu dir center td th".split())
#: Start tag to the open elements that it closes, up to the elements that stop the search.
IMPLIED = {
    **dict.fromkeys("li".split(), ({"li"}, {"ul", "ol", "menu", "dir"})),
    **dict.fromkeys("dt dd".split(), ({"dt", "dd"}, {"dl"})),
    **dict.fromkeys("option".split(), ({"option"}, {"select", "datalist"})),
    **dict.fromkeys("optgroup".split(), ({"option", "optgroup"}, {"select"})),
    **dict.fromkeys("td th".split(), ({"td", "th"}, {"tr", "table"})),
    **dict.fromkeys("tr".split(), ({"td", "th", "tr"}, {"table"})),
    **dict.fromkeys("thead tbody tfoot caption".split(), ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"})),
    **dict.fromkeys("body".split(), ({"head"}, {"html"})),
}
CLOSES_P = BLOCK - {"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "option", "optgroup", "html", "body", "legend", "summary", "figcaption"}
SCOPE = {"td", "th", "caption", "table", "button", "html"}
#: What SVG and MathML don't draw, elements in them that hold HTML again, what may be in a head, and MathML's parts side by side.
UNDRAWN = set("desc metadata defs symbol clippath mask pattern marker annotation annotation-xml".split())
HTML_AGAIN = {"foreignobject", "desc", "title", "annotation-xml"}
IN_HEAD = set("html head base basefont bgsound link meta noframes noscript script style template title".split())
APART = set("mfrac msup msub msubsup munder mover munderover mroot mmultiscripts mtr".split())
DRAWN_LINE = {"text", "foreignobject", "mtr"}
TABLE_PARTS = set("table thead tbody tfoot tr td th caption".split())
COLUMNS = 1000
WIDEST = 1000
DEEPEST = 32
_STYLE_MARK = re.compile(r"[;\"'()]")
_STYLE_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SPACE = re.compile(r"[ \t\n\r\f]+")
#: Elements whose content holds no tags; character references count in the last two.
RAW = set("script style xmp iframe noembed noframes textarea title".split())
RAW_WITH_REFERENCES = {"textarea", "title"}
_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str | None]):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []

    def hidden(self) -> bool:
        """Whether the element and all that is in it is not displayed."""
        a = self.attributes
        if self.tag in INVISIBLE or "hidden" in a or (self.tag == "input" and (a.get("type") or "").lower() == "hidden"):
            return True
        return declared(a.get("style"), "display") == "none"

    def visible(self, inherited: bool) -> bool:
        """Whether text right inside the element is seen; a descendant may declare otherwise."""
        own = declared(self.attributes.get("style"), "visibility")
        return own == "visible" or (inherited and own not in ("hidden", "collapse"))


def declarations(style: str) -> Iterator[str]:
    """The parts of a style between semicolons that are in no string and no parentheses."""
    quote, depth, start = "", 0, 0
    for mark in _STYLE_MARK.finditer(style):
        c = mark[0]
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")":
            depth = max(0, depth - 1)
        elif not depth:
            yield style[start : mark.start()]
            start = mark.end()
    yield style[start:]


def declared(style: str | None, name: str) -> str | None:
    """The value that counts of a property: the last one, before others an important one."""
    if not style or name not in style.lower():
        return None
    value, important = None, False
    for part in declarations(_STYLE_COMMENT.sub(" ", style)):
        prop, _, said = part.lower().partition(":")
        said, bang, _ = said.partition("!")
        if prop.strip() == name and said.strip() and (bang or not important):
            value, important = said.strip(), bool(bang)
    return value


class TreeBuilder:
    def __init__(self) -> None:
        self.root = Node("#root", {})
        self.open = [self.root]
        #: Places in `open` of the open elements of each name.
        self.places: dict[str, list[int]] = {}

    def _close_to(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.places[node.tag].pop()
        del self.open[depth:]

    def _innermost(self, tags: set[str]) -> int:
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=0)

    def _close_implied(self, tags: set[str], stops: set[str]) -> None:
        """Close the outermost open element of `tags` above the last of `stops`."""
        stop = self._innermost(stops - tags)
        above = [at[k] for t in tags if (at := self.places.get(t)) and (k := bisect_right(at, stop)) < len(at)]
        if above:
            self._close_to(min(above))

    def _foreign(self) -> bool:
        return bool(self.places.get("svg") or self.places.get("math")) and not any(self.places.get(t) for t in HTML_AGAIN)

    def handle_starttag(self, tag: str, attributes: dict[str, str | None]) -> None:
        if tag in CLOSES_P and self._foreign():
            self._close_implied({"svg", "math"}, set())
        if self.places.get("p") and tag in CLOSES_P:
            self._close_implied({"p"}, SCOPE)
        if tag in IMPLIED:
            self._close_implied(*IMPLIED[tag])
        if self.places.get("head") and tag in BLOCK and tag != "html":
            self._close_implied({"head"}, {"html"})
        if self.open[-1].tag == "head" and tag not in IN_HEAD:
            self._close_to(len(self.open) - 1)
        node = Node(tag, attributes)
        if tag in UNDRAWN and (self.places.get("svg") or self.places.get("math")):
            node.attributes["hidden"] = ""
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attributes: dict[str, str | None]) -> None:
        foreign = tag in ("svg", "math") or self._foreign() and tag not in CLOSES_P
        self.handle_starttag(tag, attributes)
        if foreign and tag not in VOID:
            self._close_to(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", {})
        if tag == "p" and not self.places.get("p"):
            self.handle_starttag("p", {})
        if not self.places.get(tag):
            return
        stops = {"table"} if tag in {"td", "th", "tr", "thead", "tbody", "tfoot", "caption"} else {"td", "th", "caption"}
        at = self.places[tag][-1]
        if tag in ("table", "tbody", "thead", "tfoot", "tr", "body", "html") or self._innermost(stops - {tag}) < at:
            self._close_to(at)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and _SPACE.sub("", data):
            self._close_to(len(self.open) - 1)
        self.open[-1].children.append(data)


class Reader:
    """Cuts a page into tags and text for a tree builder; every character is passed over a bounded number of times."""

    def __init__(self, page: str, builder: TreeBuilder):
        self.page, self.builder = page, builder
        self.last_close = page.rfind(">")
        #: Quotes and raw elements that are known not to end any more.
        self.endless: set[str] = set()

    def read(self) -> None:
        page, at = self.page, 0
        while at < len(page):
            mark = page.find("<", at)
            if mark < 0:
                mark = len(page)
            if mark > at:
                self.builder.handle_data(unescape(page[at:mark]))
            at = self._markup(mark) if mark < len(page) else mark

    def _after(self, sign: str, at: int) -> int:
        end = self.page.find(sign, at)
        return len(self.page) if end < 0 else end + len(sign)

    def _markup(self, at: int) -> int:
        """Takes the markup at a `<`; the place after it."""
        page = self.page
        second = page[at + 1 : at + 2]
        if second == "!" or second == "?":
            if page.startswith("<!--", at):
                end = _COMMENT_END.search(page, at + 2)
                return end.end() if end else len(page)
            if page.startswith("<![CDATA[", at) and self.builder._foreign():
                end = self._after("]]>", at)
                self.builder.handle_data(page[at + 9 : end].removesuffix("]]>"))
                return end
            return self._after(">", at)
        closing = second == "/"
        name = _TAG_NAME.match(page, at + 1 + closing)
        if not name:
            if closing and page[at + 2 : at + 3]:
                return self._after(">", at)
            self.builder.handle_data("<")
            return at + 1
        found = self._attributes(name.end()) if at < self.last_close else None
        if found is None:
            self.builder.handle_data(unescape(page[at:]))
            return len(page)
        attributes, end, empty = found
        tag = name[0].lower()
        if closing:
            self.builder.handle_endtag(tag)
            return end
        raw = tag in RAW and not self.builder._foreign()
        (self.builder.handle_startendtag if empty else self.builder.handle_starttag)(tag, attributes)
        return self._raw(tag, end) if raw else end

    def _attributes(self, at: int) -> tuple[dict[str, str | None], int, bool] | None:
        """Attributes (of equal ones the first), the place after the tag, whether it ends in a slash; None without an end."""
        page, found = self.page, {}
        while True:
            gap = _GAP.match(page, at).end()
            if gap == len(page):
                return None
            if page[gap] == ">":
                return found, gap + 1, gap > at and page[gap - 1] == "/"
            name = _ATTRIBUTE.match(page, gap)
            at, value = name.end(), None
            if name[2]:
                quote, end = page[at : at + 1], -1
                if quote in ("'", '"') and quote not in self.endless:
                    end = page.find(quote, at + 1)
                    if end < 0:
                        self.endless.add(quote)
                if end < 0:
                    value = _BARE.match(page, at)[0]
                    at += len(value)
                else:
                    value, at = page[at + 1 : end], end + 1
                value = unescape(value)
            found.setdefault(name[1].lower(), value)

    def _raw(self, tag: str, at: int) -> int:
        """Takes the content of a raw element up to its end tag. Script and style last to the end of the page if need be."""
        end = None if tag in self.endless else _RAW_END[tag].search(self.page, at)
        if not end:
            self.endless.add(tag)
            if tag not in ("script", "style"):
                return at
        stop = end.start() if end else len(self.page)
        content = self.page[at:stop]
        if content:
            self.builder.handle_data(unescape(content) if tag in RAW_WITH_REFERENCES else content)
        return stop


def tree(page: str) -> Node:
    builder = TreeBuilder()
    Reader(page, builder).read()
    return builder.root


class Flow:
    """Lines of a block of text: the page, a list item or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False  # an empty line is due
        self.space = False
        self.prefix: list[str] = []  # of the next line: a list mark
        self.indent = 0

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *rest = data.split("\n")
            self._put(first)
            for part in rest:
                self.end_line(force=True)
                self._put(part)
            return
        words = _SPACE.sub(" ", data)
        if words[:1] == " ":
            self.space, words = True, words[1:]
        if words:
            ends = words[-1] == " "
            if self.space and self.line:
                self.line.append(" ")
            self.line.append(words[:-1] if ends else words)
            self.space = ends

    def _put(self, part: str) -> None:
        if part:
            if self.space and self.line:
                self.line.append(" ")
            self.line.append(part)
        self.space = False

    def end_line(self, force: bool = False) -> None:
        if self.line or force:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            mark = self.prefix.pop() if self.prefix else ""
            pad = " " * min(self.indent - len(mark), WIDEST) + mark
            self.lines.append((pad + "".join(self.line)).rstrip())
            self.line = []
        self.space = False

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = self.gap or spaced

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


class Table:
    def __init__(self, at: int, joined: bool) -> None:
        #: Lines of the flow before the table; whether the last of them was cut short by it.
        self.at, self.joined = at, joined
        self.group = 0
        #: Row group, and cells as (lines, columns, rows).
        self.rows: list[tuple[int, list[tuple[list[str], int, int]]]] = []

    def placed(self) -> list[list[tuple[int, int, list[str]]]]:
        """For each row (column, columns, lines) of its cells, beside the cells that reach down from above."""
        ends = {group: i + 1 for i, (group, _) in enumerate(self.rows)}
        out, held, last = [], [], 0  # held: the row at which a column is free again
        for i, (group, cells) in enumerate(self.rows):
            if group != last:
                held, last = [], group
            row, at = [], 0
            for lines, span, down in cells:
                while at < len(held) and held[at] > i:
                    at += 1
                span = min(span, max(1, COLUMNS - at))
                row.append((at, span, lines))
                if at < COLUMNS:
                    until = min(i + down, ends[group])
                    held += [0] * (at + span - len(held))
                    held[at : at + span] = [max(h, until) for h in held[at : at + span]]
                at += span
            out.append(row)
        return out

    def lines(self) -> list[str]:
        widths: list[int] = []
        rows = self.placed()
        for spanning in (False, True):
            for row in rows:
                for at, span, lines in row:
                    widths += [0] * (at + span - len(widths))
                    if (span > 1) == spanning:
                        room = sum(widths[at : at + span]) + 2 * (span - 1)
                        widths[at + span - 1] += max(0, max(map(len, lines), default=0) - room)
        starts = [0]
        for w in widths:
            starts.append(min(starts[-1] + w + 2, WIDEST))
        out = []
        for row in rows:
            for k in range(max((len(lines) for *_, lines in row), default=0)):
                line, end = [], 0
                for at, _, lines in row:
                    if k < len(lines) and lines[k]:
                        # Only cells that overlap by their spans can meet; they stay apart.
                        pad = max(starts[at] - end, 2 if end else 0)
                        line.append(" " * pad + lines[k])
                        end += pad + len(lines[k])
                out.append("".join(line).rstrip())
        return out


def _number(node: Node, name: str, least: int, most: int) -> int:
    try:
        return min(max(least, int(node.attributes.get(name) or 1)), most)
    except ValueError:
        return 1


def _trimmed(lines: list[str]) -> list[str]:
    """Without the empty lines at both ends."""
    first, end = 0, len(lines)
    while first < end and not lines[first].strip():
        first += 1
    while end > first and not lines[end - 1].strip():
        end -= 1
    return lines[first:end]


def render(root: Node) -> str:
    """The visible text. Works on a stack of (node, next child, its text is seen, its tables are plain), so depth is no matter."""
    flows, tables, lists = [Flow()], [], []
    stack: list[list] = [[root, 0, True, False]]
    pre = 0
    while stack:
        node, at, seen, plain = stack[-1]
        flow = flows[-1]
        if at < len(node.children):
            stack[-1][1] += 1
            child = node.children[at]
            if isinstance(child, str):
                if seen:
                    flow.text(child, pre > 0)
                continue
            if child.hidden():
                continue
            if child.tag == "br":
                if seen:
                    flow.end_line(force=True)
                continue
            seen = child.visible(seen)
            plain = plain or (child.tag == "table" and len(tables) >= DEEPEST)
            if plain and child.tag in TABLE_PARTS:
                child.tag = "div"
            tag = child.tag
            if node.tag in APART and at and flow.line:
                flow.space = True
            if tag in DRAWN_LINE:
                flow.block(False)
            cut = bool(flow.line)
            if tag in BLOCK and tag not in ("td", "th", "tr", "thead", "tbody", "tfoot") or tag in ("td", "th", "tr") and not tables:
                # A list inside a list needs no empty line.
                flow.block(tag in SPACED and not (tag in ("ul", "ol", "dl") and lists))
            if tag == "pre":
                pre += 1
            elif tag in ("ul", "ol", "menu", "dir"):
                try:
                    start = int(child.attributes.get("start") or 1)
                except ValueError:
                    start = 1
                lists.append([tag == "ol", start])
            elif tag == "li":
                numbered = bool(lists) and lists[-1][0]
                mark = f"{lists[-1][1]}. " if numbered else "- "
                if numbered:
                    lists[-1][1] += 1
                flow.indent += len(mark)
                mark = mark if seen else " " * len(mark)
                flow.prefix.append(mark)
                child.attributes["#mark"] = mark
            elif tag == "dd":
                flow.indent += 2
            elif tag == "blockquote":
                flow.indent += 2
            elif tag == "table":
                tables.append(Table(len(flow.lines), cut))
            elif tag in ("thead", "tbody", "tfoot") and tables:
                tables[-1].group += 1
            elif tag == "tr" and tables:
                tables[-1].rows.append((tables[-1].group, []))
            elif tag in ("td", "th") and tables:
                if not tables[-1].rows:
                    tables[-1].rows.append((tables[-1].group, []))
                flows.append(Flow())
            stack.append([child, 0, seen, plain])
            continue
        stack.pop()
        tag = node.tag
        if tag in ("td", "th") and tables and len(flows) > 1:
            lines = _trimmed(flows.pop().done())
            down = node.attributes.get("rowspan") or ""
            rows = 65534 if down.strip() == "0" else _number(node, "rowspan", 1, 65534)
            tables[-1].rows[-1][1].append((lines, _number(node, "colspan", 1, 1000), rows))
            continue
        if tag == "table":
            table = tables.pop()
            lines = table.lines()
            if len(flows) > 1 and len(lines) == 1 and len(flow.lines) == table.at and not (flow.line or flow.indent or flow.prefix or pre):
                if table.joined:
                    flow.line, flow.gap = [flow.lines.pop(), " "], False
                flow.line.append(lines[0])
                flow.space = True
                continue
            flow.block(True)
            for line in lines:
                flow.line.append(line)
                flow.end_line(force=True)
            flow.block(True)
            continue
        if tag in BLOCK and tag not in ("tr", "thead", "tbody", "tfoot") or tag == "tr" and not tables:
            flow.block(tag in SPACED and not (tag in ("ul", "ol", "dl") and len(lists) > 1))
        if tag in DRAWN_LINE:
            flow.block(False)
        if tag == "pre":
            pre -= 1
        elif tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        elif tag == "li":
            mark = node.attributes.pop("#mark")
            if flow.prefix and flow.prefix[-1] == mark:
                flow.prefix.pop()  # an item without text
            flow.indent -= len(mark)
        elif tag in ("dd", "blockquote"):
            flow.indent -= 2
    return "\n".join(_trimmed(flows[0].done()))


def visible_text(html: str | None) -> str | None:
    return None if html is None else render(tree(html))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text."""
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        return {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "text": [visible_text(h) for h in batch.column("html").to_pylist()],
        }

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_batches(rows, run, schema, small=64)
