"""HTML extraction by layout-aware rendering.

A tree builder follows the rules for implied tags (a paragraph ends where a block begins, a list item
where the next one begins, and so on), visibility rules leave out what a browser doesn't show, and a
renderer writes the visible text: blocks on lines of their own, with a blank line between paragraphs,
list items marked and indented, table cells aligned in columns, with those free that a cell above or
beside spans. A page is read once, without recursion.

Defined cases: a null or empty page gives an empty text; broken markup is read as browsers do in
common cases (stray end tags ignored, open elements closed at the end); repeated rows are rendered one
by one; an empty table gives an empty result; extra columns are kept unless they bear a result's name.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tickloom.llm.arrow import slices, texts

START = re.compile(r"<(?:!|\?|/?[a-zA-Z])")
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: What follows a tag's name; a quote opens a value only after "=". A quote that never closes is a letter.
REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?)*+")
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NO_BOX = re.compile(r"display\s*:\s*none", re.IGNORECASE)
VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.IGNORECASE)
NUMBER = re.compile(r"\s*([+-]?[0-9]{1,9})")
SPACE = re.compile(r"[ \t\n\r\f]+")
#: Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
UNSEEN = frozenset("script style head title noscript template iframe noembed noframes datalist object canvas svg math audio video select option optgroup map rp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
ENDS_P = BLOCK - frozenset("html body td th tr tbody thead tfoot caption legend".split())
#: New element -> open elements that it ends, unless one of the fences stands between.
IMPLIED = {
    "li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
    "td": ("td th", ("table", "tr")), "th": ("td th", ("table", "tr")), "tbody": ("tbody thead tfoot tr td th caption", ("table",)),
    "thead": ("tbody thead tfoot tr td th caption", ("table",)), "tfoot": ("tbody thead tfoot tr td th caption", ("table",)),
    "option": ("option", ("select",)), "body": ("head", ()),
}


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []


class Open:
    """The open elements, with the places of each tag, so that no nesting is searched through."""

    def __init__(self, root: Element):
        self.items, self.places = [root], defaultdict(list)

    @property
    def top(self) -> Element:
        return self.items[-1]

    def push(self, element: Element) -> None:
        self.places[element.tag].append(len(self.items))
        self.items.append(element)

    def pop(self, down_to: int) -> None:
        while len(self.items) > down_to:
            self.places[self.items.pop().tag].pop()

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, wanted, fences) -> bool:
        """End the innermost element of the wanted tags, unless a fence is open within it."""
        i = self.last(wanted)
        if i and i >= self.last(fences):
            self.pop(i)
            return True
        return False


def parse(page: str) -> Element:
    """The tree of elements and strings."""
    root = Element("html")
    opened, at, last = Open(root), 0, page.rfind(">")
    while at < len(page):
        m = START.search(page, at)
        begin = m.start() if m else len(page)
        comment = page.startswith("<!--", begin)
        if begin > last and not comment:  # no tag ends any more
            begin = len(page)
        if begin > at:
            _text(opened, page[at:begin])
        if begin == len(page):
            break
        if comment:
            at = page.find("-->", begin + 2) + 3
            if at == 2:
                break
            continue
        if page[begin + 1] in "!?":
            at = page.find(">", begin) + 1
            continue
        name = NAME.match(page, begin)
        end = REST.match(page, name.end()).end()
        if end == len(page):
            end = page.find(">", name.end())
        tag, said, at = name[2].lower(), page[name.end() : end], end + 1
        if tag == "html":
            continue
        if name[1]:
            _end(opened, tag)
            continue
        attributes = {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(said)} if said else {}
        _imply(opened, tag)
        element = Element(tag, attributes)
        opened.top.children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            text = page[at : end.start() if end else len(page)]
            element.children.append(html.unescape(text) if tag in ("title", "textarea") else text)
            at = end.end() if end else len(page)
        elif tag not in VOID:
            opened.push(element)
    return root


def _text(opened: Open, raw: str) -> None:
    if opened.top.tag == "head" and SPACE.sub("", raw):
        opened.pop(len(opened.items) - 1)
    opened.top.children.append(html.unescape(raw))


def _imply(opened: Open, tag: str) -> None:
    if opened.top.tag == "head" and tag not in HEAD:
        opened.pop(len(opened.items) - 1)
    if tag in ENDS_P:
        opened.close(("p",), ("table", "td", "th", "button", "caption"))
    if tag in IMPLIED:
        ended, fences = IMPLIED[tag]
        while opened.close(ended.split(), fences):
            pass
    if tag in HEADINGS and opened.top.tag in HEADINGS:
        opened.pop(len(opened.items) - 1)


def _end(opened: Open, tag: str) -> None:
    if tag in ("html", "body"):
        return
    if tag == "p" and not opened.last(("p",)):
        opened.top.children.append(Element("p"))
    fences = () if tag == "table" else ("table",) if tag in BLOCK else ("td", "th", "table")
    opened.close((tag,), fences)


def visible(element: Element) -> bool:
    """False if the element makes no box at all, whatever is within."""
    a = element.attributes
    if element.tag in UNSEEN or "hidden" in a:
        return False
    if element.tag == "input" or element.tag == "dialog" and "open" not in a:
        return False
    return not ("style" in a and NO_BOX.search(a["style"]))


def shown(element: Element, before: bool) -> bool:
    """Whether the element's own text is seen: its style says so, or what holds around it (before) goes on."""
    said = VISIBILITY.findall(element.attributes["style"]) if "style" in element.attributes else ()
    return said[-1].lower() == "visible" if said else before


class Writer:
    """Lines of a block: runs of spaces are one, breaks and blank lines come when asked for."""

    def __init__(self):
        self.lines, self.now, self.blank = [], "", False

    def text(self, s: str, kept: bool = False) -> None:
        if kept:
            first, *rest = s.split("\n")
            self.now += first
            for line in rest:
                self.lines.append(self.now)
                self.now = line
            return
        s = SPACE.sub(" ", s)
        if s.startswith(" ") and (not self.now or self.now.endswith(" ")):
            s = s[1:]
        if s and not self.now and self.blank:
            self.lines.append("")
        if s:
            self.blank = False
        self.now += s

    def line_end(self) -> None:
        if self.now.strip(" "):
            self.lines.append(self.now.rstrip(" "))
        self.now = ""

    def gap(self) -> None:
        self.line_end()
        self.blank = bool(self.lines)

    def put(self, lines: list[str]) -> None:
        self.line_end()
        if lines and self.blank:
            self.lines.append("")
        if lines:
            self.blank = False
        self.lines += lines

    def done(self) -> list[str]:
        self.line_end()
        return self.lines


def run(step: Generator):
    """The result of a step; a step yields the steps that it waits for, so that no nesting is too deep."""
    steps, value = [step], None
    while steps:
        try:
            steps.append(steps[-1].send(value))
            value = None
        except StopIteration as end:
            steps.pop()
            value = end.value
    return value


def render(element: Element, out: Writer, pre: bool = False, seen: bool = True) -> Generator:
    """Write the visible text of the element's children; deep trees are walked with an own stack."""
    work: list = [(c, pre, seen) for c in reversed(element.children)]
    while work:
        item, kept, seen = work.pop()
        if callable(item):
            item()
        elif isinstance(item, str):
            out.text(item if seen else " ", kept and seen)
        elif not visible(item):
            continue
        elif item.tag == "br":
            if out.now.strip(" ") or kept:
                out.lines.append(out.now.rstrip(" "))
                out.now = ""
        elif item.tag == "hr":
            out.gap()
        elif item.tag == "img":
            continue
        elif item.tag in ("ul", "ol", "menu", "dir"):
            out.gap()
            out.put((yield list_lines(item, shown(item, seen))))
            out.gap()
        elif item.tag == "table":
            out.gap()
            out.put((yield table_lines(item, shown(item, seen))))
            out.gap()
        elif item.tag in BLOCK:
            edge = out.gap if item.tag in SPACED else out.line_end
            edge()
            if item.tag == "pre" and out.blank:
                out.lines.append("")
                out.blank = False
            work.append((edge, False, True))
            work.extend((c, kept or item.tag == "pre", shown(item, seen)) for c in reversed(item.children))
        else:
            work.extend((c, kept, shown(item, seen)) for c in reversed(item.children))


def _inner(element: Element, seen: bool = True) -> Generator:
    out = Writer()
    yield render(element, out, seen=seen)
    return out.done()


def _number(element: Element, name: str) -> int | None:
    """An attribute's whole number, as far as it begins with one."""
    m = NUMBER.match(element.attributes.get(name, ""))
    return int(m[1]) if m else None


def list_lines(element: Element, seen: bool = True) -> Generator:
    """Items with their marks: numbers go on from start or an item's own value, downwards if reversed."""
    lines, step = [], -1 if "reversed" in element.attributes else 1
    number = _number(element, "start")
    if number is None:
        number = 1 if step > 0 else sum(isinstance(c, Element) and c.tag == "li" and visible(c) for c in element.children)
    for c in element.children:
        if isinstance(c, str):
            if c.strip() and seen:
                lines.append(SPACE.sub(" ", c).strip())
            continue
        if not visible(c):
            continue
        if c.tag != "li":
            box = Element("div")
            box.children = [c]
            lines += yield _inner(box, seen)
            continue
        own = _number(c, "value")
        number = number if own is None else own
        mark = f"{number}. " if element.tag == "ol" else "- "
        number += step
        body = yield _inner(c, shown(c, seen))
        first = mark if shown(c, seen) else " " * len(mark)
        lines += [(first if i == 0 else " " * len(mark)) + x if x else x for i, x in enumerate(body)]
    return lines


def width(text: str) -> int:
    """Columns on a terminal: wide letters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _span(element: Element, name: str) -> int:
    try:
        return min(1000, max(1, int(element.attributes.get(name, 1))))
    except ValueError:
        return 1


def table_lines(element: Element, seen: bool = True) -> Generator:
    """Cells in columns as wide as their widest cell; a row holds its own cells by column, so that places which
    cells of rows above reach down to take no room in memory, and columns without text none on the page."""
    captions, rows, below = [], [], {}
    work: list = [(c, seen) for c in reversed(element.children)]
    while work:
        c, here = work.pop()
        if isinstance(c, str):
            if c.strip() and here:
                captions.append(SPACE.sub(" ", c).strip())
        elif not visible(c):
            continue
        elif c.tag == "tr":
            row, at, here = {}, 0, shown(c, here)
            for d in c.children:
                if isinstance(d, Element) and visible(d):
                    box = d if d.tag in ("td", "th") else Element("td")
                    if box is not d:
                        box.children = [d]
                    across, down = _span(d, "colspan"), _span(d, "rowspan")
                    while at in below:
                        at += 1
                    if down > 1:
                        below.update((k, down) for k in range(at, at + across))
                    row[at] = yield _inner(box, shown(box, here))
                    at += across
                elif isinstance(d, str) and d.strip() and here:
                    row[at] = [SPACE.sub(" ", d).strip()]
                    at += 1
            below = {k: n - 1 for k, n in below.items() if n > 1}
            if row:
                rows.append(row)
        elif c.tag in ("td", "th"):
            rows.append({0: (yield _inner(c, shown(c, here)))})
        elif c.tag in ("tbody", "thead", "tfoot", "colgroup"):
            work.extend((x, shown(c, here)) for x in reversed(c.children))
        else:
            box = Element("div")
            box.children = [c]
            captions += yield _inner(box, here)
    wide: dict[int, int] = {}
    for r in rows:
        for k, cell in r.items():
            wide[k] = max(wide.get(k, 0), max(map(width, cell), default=0))
    starts, start = {}, 0
    for k in sorted(k for k, w in wide.items() if w):
        starts[k], start = start, start + wide[k] + 2
    lines = []
    for r in rows:
        cells = [(starts[k], cell) for k, cell in sorted(r.items()) if k in starts]
        for i in range(max((len(c) for _, c in cells), default=0)):
            line, done = [], 0
            for at, cell in cells:
                if i < len(cell) and cell[i]:
                    line += [" " * (at - done), cell[i]]
                    done = at + width(cell[i])
            lines.append("".join(line).rstrip(" "))
    return captions + lines


def page_text(page: str) -> str:
    """All visible text of a page."""
    if not page:
        return ""
    out = Writer()
    run(render(parse(page), out))
    return "\n".join(out.done()).strip("\n")


def extract_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """pages with text (all visible text of the page) in place of the HTML."""
    names = [c for c in pages.columns if c not in (column, "text")]
    schema = T.StructType([*pages.select(*names).schema.fields, T.StructField("text", T.StringType())])

    def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            text = [page_text(p) for p in texts(batch, column)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(text, pa.string())], schema.names)

    return pages.select(*names, column).mapInArrow(texts_of, schema)
