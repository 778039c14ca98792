"""Layout-aware rendering of HTML pages to plain text.

A page is read once. Tags go through a stack of open elements that closes what HTML closes by itself
(paragraphs before blocks, list items, table rows and cells), ignores what was never opened, and puts text that stands between rows before its
table. What a browser does not show is left out: the head, scripts, styles, templates, embedded objects, of drawings all but their text, closed dialogs, of closed details all but the first summary, fallbacks of
ruby, annotations of formulas, elements with ``hidden``, ``display:none`` or ``visibility:hidden`` (the last declaration of a property counts, unless
an earlier one is important), hidden inputs. All other text is emitted, also the values of inputs that show theirs: blank runs
collapse except in preformatted text, blocks begin a line, paragraphs, headings, lists and tables are set apart by an empty line,
list items get bullets or numbers and an indent by depth, and table cells are padded to columns, with spans.

Defined results: a null or empty page has an empty text; tags that never end are read to the end of the page;
repeated rows are rendered one by one; an empty table gives no rows; other columns are ignored whatever their names. There is no recursion;
indents end at ``MAX_DEPTH`` levels, columns are padded to ``MAX_WIDTH`` and begin at ``MAX_START`` at most, so the text is in proportion to
the page. So is the time, but that lines of a table in a table are laid out once per level.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpline.session import ship_package

#: A column is padded to the width of its widest cell, or to this if that is less.
MAX_WIDTH = 120
MAX_SPAN = 1000
#: Columns further to the right are set apart by two blanks only.
MAX_START = 480
#: Lists and quotations inside so many others are not indented further.
MAX_DEPTH = 32

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title plaintext".split())
HIDDEN = frozenset("head script style template iframe noembed noframes noscript title object audio video canvas datalist rp annotation annotation-xml".split())
#: Of a drawing only the content of the first is shown, and of that nothing in the second.
DRAWN = frozenset("text foreignobject".split())
NOT_DRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta title style script noscript noframes template head".split())
BLOCK = frozenset("address article aside body center details dialog dir div fieldset figcaption footer form header hgroup html legend main menu nav optgroup option search section summary dt dd li".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 listing ol p plaintext pre table ul xmp".split())
CLOSES_P = (BLOCK | SPACED | {"hr"}) - {"html", "body", "option", "optgroup"}
SECTIONS = frozenset("thead tbody tfoot".split())
CELLS = frozenset("td th".split())
LISTS = frozenset("ul ol menu dir".split())
#: Elements across which nothing is closed by implication.
BARRIERS = frozenset("table td th caption html template object button marquee applet".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?>[^>"'=]+|=[ \t\n\r\f]*+(?>"[^"]*"|'[^']*')|["'=])*+)>""")
COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:[ \t\n\r\f]*=[ \t\n\r\f]*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
BLANK = re.compile(r"[ \t\n\r\f]+")
STYLE_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
IMPORTANT = re.compile(r"!\s*important\s*\Z", re.IGNORECASE)
# Inputs that do not show their value; words that values of two properties are made of.
NO_VALUE = frozenset("hidden checkbox radio file image color range password".split())
WIDE = frozenset("inherit initial unset revert revert-layer".split())
STYLES = {
    "display": WIDE | frozenset("none block inline inline-block flow flow-root flex inline-flex grid inline-grid table inline-table table-row table-cell table-row-group table-header-group table-footer-group table-column table-column-group table-caption list-item contents run-in ruby ruby-base ruby-text math".split()),
    "visibility": WIDE | frozenset("visible hidden collapse".split()),
}
_ends: dict[str, re.Pattern] = {}


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def declared(style: str) -> dict[str, str]:
    """The values of ``STYLES`` that count; what is no value of its property is left out, as browsers do."""
    found: dict[str, str] = {}
    fixed: set[str] = set()
    for part in STYLE_COMMENT.sub(" ", style).split(";"):
        name, _, value = part.partition(":")
        name = name.strip().lower()
        if name not in STYLES:
            continue
        plain = IMPORTANT.sub("", value.strip())
        words = plain.lower().split()
        if not words or not STYLES[name].issuperset(words) or (name in fixed and plain == value.strip()):
            continue
        found[name] = " ".join(words)
        if plain != value.strip():
            fixed.add(name)
    return found


def _number(text: str | None, default: int) -> int:
    match = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return int(match[1]) if match else default


class Canvas:
    """Lines of one flow of blocks: the page, or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False
        #: The line holds preformatted text: blanks at its begin stay.
        self.solid = False
        #: The whole indent at each level.
        self.indents: list[str] = []
        self.marker: str | None = None

    def text(self, text: str, preformatted: bool) -> None:
        if preformatted:
            self.solid = True
            first, *others = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self.line.append(first)
            for other in others:
                self.end(keep=True)
                self.solid = True
                self.line.append(other)
            return
        text = BLANK.sub(" ", text)
        if text[:1] == " " and (not self.line or self.line[-1][-1:] in ("", " ")):
            text = text[1:]
        if text:
            self.line.append(text)

    def end(self, keep: bool = False) -> None:
        """End the line; an empty one is kept only if asked for."""
        text = "".join(self.line)
        text = text.rstrip() if self.solid else text.strip(" ")
        self.line.clear()
        self.solid = False
        if text:
            self.put([text])
        elif keep and self.lines:
            self.lines.append("")

    def put(self, lines: list[str]) -> None:
        """Finished lines, under the indent."""
        if self.gap and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = False
        indent = self.indents[-1] if self.indents else ""
        for text in lines:
            if self.marker is not None and text:
                self.lines.append(indent[: len(indent) - len(self.marker)] + self.marker + text)
                self.marker = None
            else:
                self.lines.append(indent + text if text else "")

    def block(self, spaced: bool) -> None:
        if self.line:
            self.end()
        self.gap |= spaced


class Table:
    """Rows of cells on their way to a layout."""

    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.caption: list[str] = []
        self.in_row = False

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        if not self.rows:
            self.rows.append([])
        self.rows[-1].append((lines, columns, rows))

    def placed(self) -> list[list[tuple[int, int, list[str]]]]:
        """The cells of each row with their first column and how many they span.

        Columns that cells of earlier rows reach down to are stretches with the row they end before, in order.
        """
        grid, busy = [], []
        for row, cells in enumerate(self.rows):
            if busy and min(until for _, _, until in busy) <= row:
                busy = [stretch for stretch in busy if stretch[2] > row]
            placed, new, at, passed = [], [], 0, 0
            for lines, columns, rows in cells:
                while passed < len(busy) and busy[passed][0] <= at:
                    at = max(at, busy[passed][1])
                    passed += 1
                placed.append((at, columns, lines))
                if rows > 1:
                    new.append((at, at + columns, row + rows))
                at += columns
            if new:
                busy = self._merged(sorted(busy + new))
            grid.append(placed)
        return grid

    @staticmethod
    def _merged(stretches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        out: list[tuple[int, int, int]] = []
        for begin, end, until in stretches:
            if out and out[-1][1] == begin and out[-1][2] == until:
                out[-1] = (out[-1][0], end, until)
            else:
                out.append((begin, end, until))
        return out

    def layout(self) -> list[str]:
        grid, width = self.placed(), Counter()
        for placed in grid:
            for at, columns, lines in placed:
                if columns == 1:
                    width[at] = max(width[at], min(MAX_WIDTH, max(map(len, lines), default=0)))
        wide = [(at, columns, lines) for placed in grid for at, columns, lines in placed if columns > 1 and lines]
        sums = Sums(set(width) | {at + columns - 1 for at, columns, _ in wide})
        for column, own in width.items():
            sums.add(column, own)
        for at, columns, lines in wide:
            more = min(MAX_WIDTH, max(map(len, lines))) - (sums.before(at + columns) - sums.before(at) + 2 * columns - 2)
            if more > 0:
                width[at + columns - 1] += more
                sums.add(at + columns - 1, more)
        used = sorted(c for c in width if width[c])
        starts, x = [], 0
        for column in used:
            starts.append(min(x, MAX_START))
            x += width[column] + 2
        out = list(self.caption)
        for placed in grid:
            cells = []
            for at, columns, lines in placed:
                if lines:
                    first = bisect.bisect_left(used, at)
                    cells.append((starts[first] if first < len(used) and used[first] < at + columns else 0, lines))
            i = 0
            while cells:
                row, size = [], 0
                for start, lines in cells:
                    if lines[i]:
                        blanks = start - size if size < start or not size else 2
                        row += [" " * blanks, lines[i]]
                        size += blanks + len(lines[i])
                out.append("".join(row))
                i += 1
                cells = [cell for cell in cells if len(cell[1]) > i]
        return out


class Sums:
    """Sums of numbers at some places, up to a place; adding and asking take steps by the logarithm of the places."""

    def __init__(self, places: Iterable[int]):
        self.places = sorted(places)
        self.tree = [0] * (len(self.places) + 1)

    def add(self, place: int, value: int) -> None:
        i = bisect.bisect_left(self.places, place) + 1
        while i < len(self.tree):
            self.tree[i] += value
            i += i & -i

    def before(self, place: int) -> int:
        i, total = bisect.bisect_left(self.places, place), 0
        while i:
            total += self.tree[i]
            i -= i & -i
        return total


class Renderer:
    """One pass over a page."""

    def __init__(self):
        self.canvas = Canvas()
        self.canvases: list[Canvas] = []
        self.tables: list[Table] = []
        #: Open elements: name, how many elements it hides, visibility before it, and what its end does.
        self.open: list[tuple[str, int, bool, object]] = []
        self.count: Counter[str] = Counter()
        self.where: dict[str, list[int]] = {}
        self.hidden = 0
        self.visible = True
        self.preformatted = 0
        self.numbers: list[int | None] = []
        #: Places of open details whose summary was there.
        self.summarized: set[int] = set()

    def last(self, name: str) -> int:
        places = self.where.get(name)
        return places[-1] if places else -1

    def text(self, text: str) -> None:
        if self.hidden and self.last("head") == len(self.open) - 1 and self.hidden == 1 and text.strip(" \t\n\r\f"):
            # text ends the head
            self.close_to(len(self.open) - 1)
        if self.hidden or not self.visible:
            return
        target = self.canvas
        if self.tables and self.open and self.open[-1][0] in ("table", "tr", *SECTIONS):
            # between rows: it stands before the table, which is laid out when it ends
            if not text.strip(" \t\n\r\f"):
                return
        target.text(html.unescape(text) if "&" in text else text, self.preformatted > 0)

    def push(self, name: str, hides: int, does: object = None) -> None:
        self.where.setdefault(name, []).append(len(self.open))
        if name in BARRIERS:
            self.where.setdefault("#", []).append(len(self.open))
        self.open.append((name, hides, self.visible, does))
        self.hidden += hides

    def pop(self) -> None:
        if self.open[-1][1] < 0:
            self.text(" ")
        name, hides, visible, does = self.open.pop()
        self.where[name].pop()
        if name in BARRIERS:
            self.where["#"].pop()
        if name == "table":
            self.end_table()
        elif name in CELLS or name == "caption":
            self.end_cell(name, does)
        elif name == "tr" and self.tables:
            self.tables[-1].in_row = False
        elif not self.hidden:
            if name == "pre" or name == "listing":
                self.preformatted -= 1
                self.canvas.block(True)
            elif name in SPACED or name in BLOCK:
                self.canvas.block(name in SPACED and not (name in LISTS and len(self.numbers) > 1))
            if isinstance(does, str):
                self.canvas.indents.pop()
                if name == "li":
                    self.canvas.marker = None
            if name in LISTS:
                self.numbers.pop()
        self.hidden -= hides
        self.visible = visible

    def close_to(self, size: int) -> None:
        while len(self.open) > size:
            self.pop()

    def close(self, name: str, barrier: str | None = None) -> bool:
        """Close the last open element of a name, and what is open inside, unless a barrier stands between."""
        place = self.last(name)
        if place < 0 or place < self.last("#") or (barrier and place < self.last(barrier)):
            return False
        self.close_to(place)
        return True

    def end_cell(self, name: str, spans: tuple[int, int] | None) -> None:
        canvas, self.canvas = self.canvas, self.canvases.pop()
        canvas.end()
        while canvas.lines and not canvas.lines[-1]:
            canvas.lines.pop()
        if self.tables:
            if name == "caption":
                self.tables[-1].caption += canvas.lines
            else:
                self.tables[-1].cell(canvas.lines, *spans)

    def end_table(self) -> None:
        lines = self.tables.pop().layout()
        self.canvas.block(True)
        if any(lines):
            self.canvas.put(lines)
        self.canvas.gap = True

    def close_in_table(self, *names: str) -> None:
        """Close the innermost open element of these names that belongs to the current table."""
        table = self.last("table")
        place = max((self.last(n) for n in names), default=-1)
        if place > table:
            self.close_to(min(p for p in (self.last(n) for n in names) if p > table))

    def start(self, name: str, rest: str) -> None:
        if self.last("head") >= 0 and name not in HEAD_ONLY:
            self.close_to(self.last("head"))
        if name in CLOSES_P:
            self.close("p")
        drawing = self.last("svg") > self.last("foreignobject")
        if drawing and rest and rest.rstrip().endswith("/"):
            return
        low = rest.lower() if rest else ""
        attributes = _attributes(rest) if rest and (name in ("ol", "li", "td", "th", "input", "dialog", "details") or "hidden" in low or "style" in low) else {}
        style = declared(attributes["style"]) if "style" in attributes else {}
        # a declared display wins over the attribute
        unseen = style["display"] == "none" if style.get("display", "inherit") not in WIDE else "hidden" in attributes
        unseen |= name in HIDDEN or (name == "input" and attributes.get("type", "").lower() == "hidden")
        unseen |= name in ("dialog", "details") and "open" not in attributes and not drawing
        hides = int(unseen or (drawing and name in NOT_DRAWN))
        if name == "svg":
            hides += 1
        elif drawing and name in DRAWN and self.last("text") < self.last("svg"):
            # takes back what the drawing hides
            hides -= 1
        elif name == "summary" and not hides and self.open and self.open[-1][0] == "details" and len(self.open) - 1 not in self.summarized:
            # takes back what closed details hide
            self.summarized.add(len(self.open) - 1)
            hides -= int(self.open[-1][1] > 0)
        shows = style.get("visibility", "inherit")
        if name == "br":
            if not self.hidden and self.visible:
                self.canvas.end(keep=True) if self.preformatted else self.line_break()
            return
        if name in VOID:
            if name == "hr" and not self.hidden:
                self.canvas.block(True)
            elif name == "input" and not hides and not self.hidden and self.visible and rest:
                values = _attributes(rest)
                if values.get("type", "").lower() not in NO_VALUE and values.get("value"):
                    self.canvas.text(values["value"], False)
            return
        if name in ("tr", "caption", *CELLS, *SECTIONS) and not self.tables:
            return
        if name == "li":
            place = max((self.last(n) for n in LISTS), default=-1)
            if self.last("li") > place and self.last("li") > self.last("#"):
                self.close_to(self.last("li"))
        elif name in ("dt", "dd"):
            for other in ("dt", "dd"):
                self.close(other, "dl")
        elif name in ("option", "optgroup"):
            self.close("option")
        elif name in SECTIONS or name == "caption":
            self.close_in_table("tr", "td", "th", "caption", *SECTIONS)
        elif name == "tr":
            self.close_in_table("tr", "td", "th", "caption")
            self.tables[-1].rows.append([])
            self.tables[-1].in_row = True
        elif name in CELLS:
            self.close_in_table("td", "th", "caption")
            if not self.tables[-1].in_row:
                self.start("tr", "")
        elif name in ("html", "body") and self.last(name) >= 0:
            return
        does = self.enter(name, attributes, self.hidden + hides > 0)
        if name == "details":
            self.summarized.discard(len(self.open))
        self.push(name, hides, does)
        if hides < 0:
            self.text(" ")
        if shows not in WIDE or shows == "initial":
            self.visible = shows in ("visible", "initial")

    def enter(self, name: str, attributes: dict[str, str], hidden: bool) -> object:
        """What the begin of an element does to the layout; its end gets what is returned."""
        if name == "table":
            if not self.hidden:
                self.canvas.block(True)
            self.tables.append(Table())
            return None
        if name in CELLS or name == "caption":
            self.canvases.append(self.canvas)
            self.canvas = Canvas()
            spans = (_number(attributes.get("colspan"), 1), _number(attributes.get("rowspan"), 1))
            return tuple(max(1, min(s, MAX_SPAN)) for s in spans)
        if hidden:
            # its end is hidden as well, before the element is taken off: nothing to undo
            return None
        canvas = self.canvas
        if name in SPACED or name in BLOCK:
            canvas.block(name in SPACED and not (name in LISTS and self.numbers))
        if name in ("pre", "listing"):
            self.preformatted += 1
        if name in LISTS:
            self.numbers.append(_number(attributes.get("start"), 1) if name == "ol" else None)
        indent = None
        if name == "li":
            number = self.numbers[-1] if self.numbers else None
            marker = "* "
            if number is not None:
                number = _number(attributes.get("value"), number)
                marker = f"{number}. "
                self.numbers[-1] = number + 1
            canvas.marker, indent = marker, " " * len(marker)
        elif name in ("blockquote", "dd"):
            indent = "  "
        if indent is not None:
            above = canvas.indents[-1] if canvas.indents else ""
            canvas.indents.append(above + indent if len(canvas.indents) < MAX_DEPTH else above)
        return indent

    def line_break(self) -> None:
        if self.canvas.line:
            self.canvas.end()
        elif self.canvas.lines and self.canvas.lines[-1] and not self.canvas.gap:
            self.canvas.lines.append("")

    def finish(self, name: str) -> None:
        """An end tag."""
        if name == "br":
            self.line_break()
        elif name == "p":
            if not self.close("p") and not self.hidden:
                self.canvas.block(True)
        elif name in ("body", "html"):
            return
        elif name in ("table", "tr", "caption", *CELLS, *SECTIONS):
            place = self.last(name)
            if place >= 0 and (name == "table" or place > self.last("table")):
                self.close_to(place)
        elif name[:1] == "h" and name[1:] in "123456" and len(name) == 2:
            place = max(self.last(f"h{i}") for i in range(1, 7))
            if place > self.last("#"):
                self.close_to(place)
        elif name == "li":
            place = max((self.last(n) for n in LISTS), default=-1)
            if self.last("li") > max(place, self.last("#")):
                self.close_to(self.last("li"))
        else:
            place = self.last(name)
            if place >= 0 and (place > self.last("#") or name in BARRIERS):
                self.close_to(place)

    def page(self, text: str) -> str:
        at, size = 0, len(text)
        while at < size:
            tag = text.find("<", at)
            if tag < 0:
                self.text(text[at:])
                break
            match = TAG.match(text, tag)
            if match:
                if tag > at:
                    self.text(text[at:tag])
                at = match.end()
                ends, name, rest = match.groups()
                name = name.lower()
                if ends:
                    self.finish(name)
                    continue
                self.start(name, rest)
                if name in RAW:
                    at = self.raw(text, at, name)
            elif text.startswith("<!--", tag):
                self.text(text[at:tag])
                at = COMMENT.match(text, tag).end()
            elif text[tag + 1 : tag + 2] in ("!", "?", "/"):
                self.text(text[at:tag])
                end = text.find(">", tag)
                at = size if end < 0 else end + 1
            elif text[tag + 1 : tag + 2].isalpha() and text[tag + 1].isascii():
                # a tag without an end
                self.text(text[at:tag])
                break
            else:
                self.text(text[at : tag + 1])
                at = tag + 1
        self.close_to(0)
        self.canvas.end()
        lines = self.canvas.lines
        while lines and not lines[-1]:
            lines.pop()
        return "\n".join(lines)

    def raw(self, text: str, at: int, name: str) -> int:
        """The content of an element in which no other begins; where its end tag begins."""
        if name == "plaintext":
            end = len(text)
        else:
            pattern = _ends.setdefault(name, re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE))
            match = pattern.search(text, at)
            end = match.start() if match else len(text)
        if name in ("textarea", "xmp", "plaintext") and not self.hidden and self.visible:
            body = text[at:end]
            self.canvas.text(html.unescape(body) if name == "textarea" else body, True)
        return end


def render(page: str) -> str:
    """The visible text of a page."""
    return Renderer().page(page)


def _render_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [render(page) if page else "" for page in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["page_id"], pa.array(texts, pa.string())], names=["page_id", "text"])


def visible_text(pages: DataFrame, page_id: str = "page_id", page: str = "html") -> DataFrame:
    """``page_id, text``, a row per page. Pages are rendered where they are read; nothing is shuffled."""
    ship_package(pages.sparkSession)
    named = pages.select(F.col(page_id).alias("page_id"), F.col(page).cast("string").alias("html"))
    return named.mapInArrow(_render_batches, f"page_id {named.schema['page_id'].dataType.simpleString()}, text string")
