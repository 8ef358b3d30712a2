"""Visible text of HTML pages by layout: a tree with implied tags, rendered with block spacing, lists and tables."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from collections.abc import Generator, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their end tag.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes title datalist object audio video canvas".split())
#: Parts of SVG and MathML that aren't drawn where they stand, and elements in which HTML begins anew.
UNDRAWN = frozenset("desc defs metadata symbol clippath mask pattern marker filter lineargradient radialgradient annotation annotation-xml mphantom".split())
FOREIGN, ANEW = ("svg", "math"), frozenset("foreignobject annotation-xml desc mi mo mn ms mtext".split())
#: HTML elements that end SVG and MathML.
BREAKS = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu meta nobr ol p pre ruby s small span strong "
    "strike sub sup table tt u ul var".split()
)
#: Formulas' parts that stand apart.
APART = frozenset("mfrac mtable mtr".split())

#: Blocks with an empty line around them, and those that only begin a line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset menu".split())
PLAIN = frozenset(
    "html body div section article aside header footer nav main address form li dt dd figcaption legend details summary "
    "caption center dir option optgroup select search hgroup".split()
)
BLOCKS = SPACED | PLAIN
#: A start tag closes these open elements, looked for up to the elements after them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
#: End tags of other elements don't close these from inside.
WALLS = frozenset("table td th caption button object template".split())
#: Indentation doesn't grow beyond so many characters, and tables in so many others aren't laid out in columns: rows are lines there.
INDENT, TABLES = 300, 50
#: The largest spans of columns and rows that browsers take.
COLUMNS, ROWS = 1000, 65_534

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_UNQUOTED = re.compile(r"=\s*[^\s\"'>]+/\Z")
_DISPLAY = re.compile(r"(?:^|[;{\s])display\s*:\s*([a-z-]+)", re.I)
_VISIBILITY = re.compile(r"(?:^|[;{\s])visibility\s*:\s*([a-z]+)", re.I)
#: A rule of a style sheet, and the selectors that are understood: one element by tag, id and classes.
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_SELECTOR = re.compile(r"\s*([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+)*)\s*\Z")
_COMMENT, _NESTED = re.compile(r"/\*.*?(?:\*/|\Z)", re.S), re.compile(r"@[^{};]*(?:;|\{(?:[^{}]|\{[^{}]*\})*(?:\}|\Z))")
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children", "sheet")

    def __init__(self, tag: str, attributes: dict[str, str], sheet: Sheet | None = None):
        self.tag, self.attributes, self.children, self.sheet = tag, attributes, [], sheet

    def _style(self, pattern: re.Pattern, own: int) -> str:
        """The value that holds of a property: the last one of the style attribute, else of the page's rules."""
        found = pattern.findall(self.attributes["style"]) if "style" in self.attributes else None
        return found[-1].lower() if found else self.sheet.value(self, own) if self.sheet and self.sheet.rules else ""

    def hidden(self) -> bool:
        """Whether neither the element nor anything in it is drawn."""
        a = self.attributes
        if self.tag in HIDDEN or self.tag == "input" or (self.tag == "dialog" and "open" not in a):
            return True
        display = self._style(_DISPLAY, 0)
        return display == "none" or ("hidden" in a and not display)

    def unseen(self, around: bool) -> bool:
        """Whether its own text is invisible; elements in it can be visible again."""
        value = self._style(_VISIBILITY, 1)
        return value in ("hidden", "collapse") or (around and value != "visible")


class Sheet:
    """Rules of the page's style elements that hide or show elements; those for some media or with combinators don't count."""

    def __init__(self) -> None:
        self.rules: list[tuple[tuple, str, frozenset, frozenset, tuple[str, str]]] = []

    def add(self, text: str) -> None:
        if "display" not in text.lower() and "visibility" not in text.lower():
            return
        for selectors, body in _RULE.findall(_NESTED.sub("", _COMMENT.sub("", text))):
            shown = tuple((p.findall(body) or [""])[-1].lower() for p in (_DISPLAY, _VISIBILITY))
            for selector in selectors.split(",") if any(shown) else ():
                one = _SELECTOR.match(selector)
                if one and (one[1] or one[2]):
                    ids, classes = (frozenset(re.findall(rf"{mark}([\w-]+)", one[2])) for mark in ("#", r"\."))
                    tag = "" if one[1] in (None, "*") else one[1].lower()
                    rank = (len(ids), len(classes), bool(tag), len(self.rules))
                    self.rules.append((rank, tag, ids, classes, shown))

    def value(self, node: Node, own: int) -> str:
        classes, name = frozenset(node.attributes.get("class", "").split()), node.attributes.get("id")
        fits = [
            (rank, shown[own]) for rank, tag, ids, needed, shown in self.rules
            if shown[own] and (not tag or tag == node.tag) and needed <= classes and (not ids or ids == {name})
        ]
        return max(fits)[1] if fits else ""


class _Path:
    """The open elements, with the places of each tag among them."""

    def __init__(self, root: Node):
        self.nodes, self.at = [root], defaultdict(list)

    def push(self, node: Node) -> None:
        self.at[node.tag].append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, place: int) -> None:
        """End the element at a place and those in it."""
        while len(self.nodes) > place:
            self.at[self.nodes.pop().tag].pop()

    def last(self, tags: Iterable[str]) -> int:
        """The place of the innermost open element of some tags, 0 without one."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def foreign(self) -> bool:
        return self.last(FOREIGN) > self.last(ANEW)


def tree(page: str) -> Node:
    """The page's elements; missing end tags are implied, stray ones ignored."""
    sheet = Sheet()
    root = Node("html", {}, sheet)
    path, at, end = _Path(root), 0, len(page)
    while at < end:
        token = _TOKEN.match(page, at)
        at = token.end()
        tag = token[2]
        if not tag:
            if token[0].startswith("<![CDATA[") and path.foreign():
                stop = page.find("]]>", token.start())
                at = stop + 3 if stop >= 0 else end
                path.nodes[-1].children.append(page[token.start() + 9 : stop if stop >= 0 else end])
            elif token[0][:2] not in ("<!", "<?"):
                path.nodes[-1].children.append(html.unescape(token[0]))
            continue
        tag = tag.lower()
        if token[1]:
            _close(path, tag)
            continue
        attributes = {n.lower(): html.unescape(a or b or c or "") for n, a, b, c in _ATTRIBUTE.findall(token[3])} if token[3] else {}
        if tag in ("html", "body"):
            _imply(path, "body")
            root.attributes |= attributes
            continue
        _imply(path, tag)
        foreign = path.foreign()
        if foreign and (tag in UNDRAWN or attributes.get("display") == "none" or attributes.get("visibility") in ("hidden", "collapse")):
            attributes["hidden"] = ""
        if tag in ("td", "th") and path.nodes[-1].tag in ("table", "thead", "tbody", "tfoot"):  # a row is implied
            row = Node("tr", {}, sheet)
            path.nodes[-1].children.append(row)
            path.push(row)
        node = Node(tag, attributes, sheet)
        path.nodes[-1].children.append(node)
        if (foreign or tag in FOREIGN) and token[3].endswith("/") and not _UNQUOTED.search(token[3]):
            continue
        if tag in RAW:
            stop = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            inner = page[at : stop.start() if stop else end]
            node.children.append(html.unescape(inner) if tag == "textarea" else inner)
            if tag == "style" and not foreign:
                sheet.add(inner)
            at = stop.start() if stop else end
            closing = _TOKEN.match(page, at) if stop else None
            at = closing.end() if closing else at
        elif tag not in VOID:
            path.push(node)
    return root


def _imply(path: _Path, tag: str) -> None:
    """End the elements that a start tag ends."""
    if path.nodes[-1].tag == "head" and tag not in ("meta", "link", "base", "title", "style", "script", "template", "noscript"):
        path.cut(len(path.nodes) - 1)
    if tag in BREAKS and path.foreign():
        anew = path.last(ANEW)
        path.cut(min(i for t in FOREIGN for i in path.at[t] if i > anew))
    if tag in BLOCKS and tag != "option":
        place = path.last(("p",))
        if place > path.last(WALLS):
            path.cut(place)
    closed, scope = CLOSES.get(tag, ((), ()))
    while (place := path.last(closed)) > path.last(scope):
        path.cut(place)
        if tag not in ("tr", "thead", "tbody", "tfoot"):
            break


def _close(path: _Path, tag: str) -> None:
    place = path.last((tag,))
    if place and (place >= path.last(WALLS) or tag in ("table", "tr", "tbody", "thead", "tfoot")):
        path.cut(place)


class _Page:
    """Lines of text; margins between blocks collapse to the larger."""

    def __init__(self, tables: int = 0):
        self.lines: list[str] = []
        self.tables = tables
        self.line, self.margin, self.prefix, self.mark = "", 0, "", ""

    def write(self, text: str, exact: bool) -> None:
        if exact:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self._put(first)
            for more in rest:
                self.end()
                self.margin = 0
                self._put(more) if more else None
            return
        text = _BLANK.sub(" ", text)
        if not self.line or self.line.endswith(" "):
            text = text.lstrip(" ")
        self._put(text)

    def _put(self, text: str) -> None:
        if not text:
            return
        if not self.line:
            if self.lines:
                self.lines.extend([""] * (self.margin - 1))
            self.margin = 0
            self.line = self.mark or self.prefix
            if self.mark:
                self.mark = ""
        self.line += text

    def end(self) -> None:
        """End the line, if one has begun."""
        if self.line:
            self.lines.append(self.line.rstrip(" "))
            self.line = ""

    def block(self, margin: int) -> None:
        self.end()
        self.margin = max(self.margin, margin)

    def text(self) -> str:
        self.end()
        return "\n".join(self.lines)


def _run(step: Generator):
    """What a step returns; the steps it yields are run in between, without recursion however deep they go."""
    steps, given = [step], None
    while steps:
        try:
            steps.append(steps[-1].send(given))
            given = None
        except StopIteration as done:
            steps.pop()
            given = done.value
    return given


def _deeper(prefix: str) -> str:
    return prefix + "  " if len(prefix) < INDENT else prefix


def _number(text: str | None, otherwise: int) -> int:
    return int(text.strip()) if text is not None and re.fullmatch(r"\s*[+-]?\d{1,9}\s*", text) else otherwise


def _render(node: Node, page: _Page, exact: bool = False, unseen: bool = False) -> Generator:
    step, closed = 1, node.tag == "details" and "open" not in node.attributes
    if node.tag == "ol":
        items = [c for c in node.children if not isinstance(c, str) and c.tag == "li"] if "reversed" in node.attributes else []
        step = -1 if "reversed" in node.attributes else 1
        number = _number(node.attributes.get("start"), len(items) if step < 0 else 1) - step
    for child in node.children:
        if closed and (isinstance(child, str) or child.tag != "summary"):
            continue
        if isinstance(child, str):
            if not unseen:
                page.write(child, exact)
            continue
        if child.hidden():
            continue
        dark = child.unseen(unseen)
        if child.tag == "br":
            if page.line:
                page.end()
            else:
                page.margin = max(page.margin, 2) if page.lines else 0
        elif child.tag == "hr":
            page.block(2)
            if not dark:
                page.write("---", False)
            page.block(2)
        elif child.tag == "table" and page.tables < TABLES:
            page.block(2)
            for line in (yield _table(child, page.tables + 1, dark)):
                page.write(line, True)
                page.end()
            page.block(2)
        elif child.tag == "li":
            outer, page.prefix = page.prefix, _deeper(page.prefix)
            page.block(1)
            if node.tag == "ol":
                number = _number(child.attributes.get("value"), number + step)
            page.mark = outer + (f"{number}. " if node.tag == "ol" else "- ")
            yield _render(child, page, exact, dark)
            page.block(1)
            page.prefix, page.mark = outer, ""
        else:
            nested = child.tag in ("ul", "ol", "menu") and bool(page.prefix)
            margin = 1 if nested else 2 if child.tag in SPACED else 1 if child.tag in BLOCKS or (child.tag == "tr" and page.tables >= TABLES) else 0
            outer = page.prefix
            if margin:
                page.block(margin)
            if child.tag in ("blockquote", "dd"):
                page.prefix = _deeper(page.prefix)
            apart = child.tag == "text" or node.tag in APART or (child.tag in ("td", "th") and page.tables >= TABLES)
            if apart:
                page.write(" ", False)
            yield _render(child, page, exact or child.tag in ("pre", "textarea"), dark)
            if apart:
                page.write(" ", False)
            if margin:
                page.block(margin)
            page.prefix = outer


def _span(cell: Node, name: str, most: int) -> int:
    span = cell.attributes.get(name, "1").strip()
    return min(int(span[:6]), most) if span.isdecimal() else 1


def _width(text: str) -> int:
    """Columns a text takes on a screen: wide characters two, marks upon others none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) or c in "\u200d\ufe0f" else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _table(table: Node, depth: int, unseen: bool = False) -> Generator:
    """A table's caption and rows; the cells of a column begin at one place, and a cell over several rows keeps its columns free below it."""
    lines: list[str] = []
    rows: list[list[list[str]]] = []
    waiting: list[tuple[Node | str, Node, bool]] = [(c, table, unseen) for c in reversed(table.children)]
    group, held = table, {}
    while waiting:
        child, owner, dark = waiting.pop()
        if isinstance(child, str):
            if child.strip() and not dark:
                lines.append(_BLANK.sub(" ", child).strip())
        elif child.hidden():
            continue
        elif child.tag == "tr":
            dark = child.unseen(dark)
            if owner is not group:
                group, held = owner, {}
            row: list[list[str]] = []
            taken: dict[int, int] = {}
            place = 0
            for cell in child.children:
                across, down = 1, 1
                if isinstance(cell, str):
                    if not cell.strip() or dark:
                        continue
                    text = [_BLANK.sub(" ", cell).strip()]
                elif cell.hidden():
                    continue
                else:
                    inner = _Page(depth)
                    yield _render(cell, inner, unseen=cell.unseen(dark))
                    text = inner.text().split("\n")
                    across, down = max(1, _span(cell, "colspan", COLUMNS)), _span(cell, "rowspan", ROWS) or ROWS
                while place in held:
                    place += 1
                row.extend([[""]] * (place - len(row)))
                row.append(text)
                if down > 1:
                    taken |= dict.fromkeys(range(place, place + across), down)
                place += across
            rows.append(row)
            held = {i: n - 1 for i, n in (held | taken).items() if n > 1}
        elif child.tag in ("thead", "tbody", "tfoot"):
            waiting.extend((c, child, child.unseen(dark)) for c in reversed(child.children))
        else:
            inner = _Page(depth)
            yield _render(child, inner, unseen=child.unseen(dark))
            lines.extend(x for x in inner.text().split("\n") if x)
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            if i == len(widths):
                widths.append(0)
            widths[i] = max(widths[i], *map(_width, cell))
    for row in rows:
        for i in range(max(map(len, row), default=0)):
            cells = (cell[i] if i < len(cell) else "" for cell in row)
            line = "  ".join(c + " " * (w - _width(c)) for c, w in zip(cells, widths, strict=False)).rstrip()
            if line:
                lines.append(line)
    return lines


def visible_text(page: str) -> str:
    """What a reader sees of a page, as lines of plain text."""
    out = _Page()
    _run(_render(tree(page), out))
    return out.text()


def html_extraction(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(page_id, text, n_chars)`` of every row, and the columns named in ``keep``.

    NULL and empty pages have an empty text, as have pages with nothing
    visible. Broken markup never fails: unfinished tags are text, missing end
    tags and rows are implied. Hidden elements are left out, by attribute,
    style or simple rules of the page's own style elements, and so is what a
    closed dialog or details holds. Very long and deep pages are read whole.
    Repeated rows and NULL ids are pages like others.
    """
    names = [f"keep_{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [visible_text((p or b"").decode("utf-8", "replace")) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *batch.columns[2:]], names=["page_id", "text", *names])

    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"), pages[html_col].cast("binary").alias("html"),
        *(pages[c].alias(n) for c, n in zip(keep, names, strict=True)),
    )
    schema = "page_id long, text string" + "".join(f", {n} {rows.schema[n].dataType.simpleString()}" for n in names)
    out = rows.mapInArrow(run, schema)
    return out.select("page_id", "text", F.length("text").alias("n_chars"), *(F.col(n).alias(c) for c, n in zip(keep, names, strict=True)))
