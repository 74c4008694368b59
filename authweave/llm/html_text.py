"""Visible text of HTML pages, laid out: a tree with implied tags, visibility, block spacing,
lists and aligned tables."""

import hashlib
import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEPTH = 200  # elements nested deeper become siblings, as in browsers; no text is lost
ALIGNED = 80  # columns are filled up to the widest cell, at most this wide
GAP = "  "  # between table cells
HELD = "\x00"  # a space that does not collapse, while a line is built

# The elements of HTML by how they are parsed and laid out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style title template iframe noembed noframes datalist audio video "
    "canvas object meta link base param source track area rp".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dl ul ol menu dir figure fieldset hr table xmp".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside header footer nav main address details summary dialog "
    "dt dd li form center figcaption legend optgroup option caption tr td th thead tbody tfoot "
    "hgroup search textarea".split()
)
CLOSES_P = BLOCK - frozenset("html body td th tr thead tbody tfoot caption option optgroup legend textarea".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GROUPS = frozenset("thead tbody tfoot".split())
FENCES = frozenset("table td th caption html button template object".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: start tag: (open elements it ends, elements the search for them does not leave)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"} | FENCES),
    "dt": ({"dt", "dd"}, {"dl"} | FENCES),
    "dd": ({"dt", "dd"}, {"dl"} | FENCES),
    "option": ({"option"}, {"select", "datalist", "optgroup"} | FENCES),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"} | FENCES),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "thead": (GROUPS | {"caption", "colgroup"}, {"table"}),
    "tbody": (GROUPS | {"caption", "colgroup"}, {"table"}),
    "tfoot": (GROUPS | {"caption", "colgroup"}, {"table"}),
    "a": ({"a"}, FENCES),
    "rt": ({"rt", "rp"}, {"ruby"} | FENCES),
    "rp": ({"rt", "rp"}, {"ruby"} | FENCES),
}
BUTTONS = frozenset("submit reset button".split())
SILENT = frozenset("hidden checkbox radio file image color range password".split())

UNFINISHED = re.compile(r"<(?:[A-Za-z!?]|/.)", re.S)
MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|</[^a-zA-Z>][^>]*+>|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WHITE = re.compile(r"[ \t\n\r\f]+")
RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
SELECTOR = re.compile(r"([a-zA-Z][\w-]*)?(?:([.#])([\w-]+))?")
DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(\w+)", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        value = double or single or bare
        found.setdefault(name.lower(), html.unescape(value) if "&" in value else value)
    return found


class Tree:
    """Elements of a page; end tags that may be left out are put in."""

    def __init__(self, page: str):
        self.root = Node("#root", {})
        self.open = [self.root]
        self.styles: list[str] = []
        self._build(page)

    def _close(self, place: int) -> None:
        del self.open[max(place, 1):]

    def _find(self, wanted, fences) -> int:
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.open[place].tag
            if tag in wanted:
                return place
            if tag in fences:
                return 0
        return 0

    def _leave_head(self) -> None:
        """An open head, or its noscript, ends at what may not stand in a head."""
        place = len(self.open) - 1
        if self.open[place].tag == "noscript":
            place -= 1
        if self.open[place].tag == "head":
            self._close(place)

    def _start(self, tag: str, attributes: dict[str, str]) -> Node:
        if tag not in IN_HEAD:
            self._leave_head()
        if tag in CLOSES_P and (place := self._find(("p",), FENCES)):
            self._close(place)
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.open.pop()
        if tag in IMPLIED and (place := self._find(*IMPLIED[tag])):
            self._close(place)
        if tag in ("td", "th") and self.open[-1].tag in GROUPS | {"table"}:
            self._start("tr", {})
        node = Node(tag, attributes)
        parent = self.open[-1]
        if len(self.open) > DEPTH and tag not in VOID:
            self.open.pop()
            parent = self.open[-1]
        parent.children.append(node)
        if tag not in VOID:
            self.open.append(node)
        return node

    def _end(self, tag: str) -> None:
        if tag == "br":
            self._start("br", {})
            return
        if tag == "p" and not self._find(("p",), FENCES):
            self._start("p", {})
        if tag in HEADINGS:
            place = self._find(HEADINGS, FENCES)
        elif tag in FENCES | GROUPS | {"tr", "body"}:
            place = self._find((tag,), {"table"} - {tag} if tag != "table" else ())
        else:
            place = self._find((tag,), FENCES)
        if place:
            self._close(place)

    def _text(self, text: str) -> None:
        if text:
            text = html.unescape(text) if "&" in text else text
            if text.strip(" \t\n\r\f"):
                self._leave_head()
            self.open[-1].children.append(text)

    def _build(self, page: str) -> None:
        at, last = 0, page.rfind(">")
        while (start := page.find("<", at)) >= 0 and start < last:
            found = MARKUP.match(page, start)
            if found is None:  # a bare < is text
                self._text(page[at:start + 1])
                at = start + 1
                continue
            self._text(page[at:start])
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                continue
            if found[1]:
                self._end(tag)
                continue
            node = self._start(tag, _attributes(found[3]))
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
                inside = page[at:end.start() if end else len(page)]
                at = end.end() if end else len(page)
                if tag == "style":
                    self.styles.append(inside)
                elif tag in ("textarea", "xmp"):
                    self._text(inside)
                if self.open[-1] is node:
                    self.open.pop()
        cut = UNFINISHED.search(page, at)  # a tag or comment that the page's end leaves open
        self._text(page[at:cut.start()] if cut else page[at:])


def hiding_rules(styles: list[str]) -> dict[tuple[str, str, str], str]:
    """Simple selectors (tag, .class, #id, or tag with one of them) that style sheets hide."""
    found = {}
    for sheet in styles:
        for selectors, body in RULE.findall(re.sub(r"/\*.*?\*/", "", sheet, flags=re.S)):
            seen = VISIBILITY.search(body)
            kind = "none" if DISPLAY.search(body) else seen[1].lower() if seen else ""
            if not kind:
                continue
            for selector in selectors.split(","):
                if part := SELECTOR.fullmatch(selector.strip()):
                    tag, sign, name = part[1] or "", part[2] or "", part[3] or ""
                    if tag or name:
                        found[tag.lower(), sign, name] = kind
    return found


class Flow:
    """Lines of a block; None stands for the space between spaced blocks."""

    def __init__(self):
        self.lines: list[str | None] = []
        self.waiting: list[str] = []

    def flush(self) -> None:
        if not self.waiting:
            return
        text = "".join(self.waiting)
        self.waiting = []
        parts = text.split("\n")
        if len(parts) > 1 and not parts[-1].strip(" "):
            parts.pop()  # a break before a block's end opens no line
        elif len(parts) == 1 and not text.strip(" "):
            return
        for part in parts:
            self.lines.append(re.sub(" {2,}", " ", part).strip(" ").replace(HELD, " ").rstrip())

    def space(self) -> None:
        self.flush()
        self.lines.append(None)

    def done(self) -> list[str]:
        self.flush()
        out: list[str] = []
        gap = False
        for line in self.lines:
            if line is None:
                gap = bool(out)
                continue
            if gap:
                out.append("")
                gap = False
            out.append(line)
        while out and not out[-1]:
            out.pop()
        return out


class Page:
    """Renders a tree. `hidden`: rules of its style sheets."""

    def __init__(self, page: str):
        tree = Tree(page)
        self.root, self.rules = tree.root, hiding_rules(tree.styles)

    def text(self) -> str:
        flow = Flow()
        self._inside(self.root, flow, True, False)
        return "\n".join(flow.done())

    def _sight(self, node: Node, visible: bool) -> bool | None:
        """None: not laid out at all. Otherwise whether the element's own text is seen."""
        tag, attributes = node.tag, node.attributes
        if tag in HIDDEN or (tag == "dialog" and "open" not in attributes):
            return None
        if not attributes and not self.rules:
            return visible
        if "hidden" in attributes:
            return None
        for key, kind in self.rules.items():
            if key[0] in ("", tag) and (
                not key[1] or (key[1] == "#" and attributes.get("id") == key[2])
                or (key[1] == "." and key[2] in attributes.get("class", "").split())
            ):
                if kind == "none":
                    return None
                visible = kind not in ("hidden", "collapse")
        style = attributes.get("style", "")
        if style:
            if DISPLAY.search(style):
                return None
            if found := VISIBILITY.search(style):
                visible = found[1].lower() not in ("hidden", "collapse")
        return visible

    def _inside(self, node: Node, flow: Flow, visible: bool, kept: bool) -> None:
        for child in node.children:
            if isinstance(child, Node):
                self._element(child, flow, visible, kept)
            elif visible:
                child = child.replace(HELD, "")
                if kept:
                    child = child.replace("\r\n", "\n").replace("\t", HELD * 4).replace(" ", HELD)
                    flow.waiting.append(child)
                else:
                    flow.waiting.append(WHITE.sub(" ", child))

    def _element(self, node: Node, flow: Flow, visible: bool, kept: bool) -> None:
        tag = node.tag
        sight = self._sight(node, visible)
        if sight is None:
            return
        visible = sight
        if tag == "br":
            flow.waiting.append("\n")
        elif tag == "input":
            kind = node.attributes.get("type", "text").lower()
            value = node.attributes.get("value", kind.title() if kind in BUTTONS - {"button"} else "")
            if visible and kind not in SILENT:
                flow.waiting.append(WHITE.sub(" ", value))
        elif tag == "table":
            flow.space()
            flow.lines += self._table(node, visible)
            flow.space()
        elif tag in ("ul", "ol", "menu", "dir"):
            self._list(node, flow, visible)
        elif tag == "li":
            self._item(node, flow, visible, "- ")
        elif tag in BLOCK:
            spaced = tag in SPACED
            flow.space() if spaced else flow.flush()
            if tag == "details" and "open" not in node.attributes:
                node = self._summary(node)
            if tag in ("blockquote", "dd"):
                self._indented(node, flow, visible, kept)
            else:
                self._inside(node, flow, visible, kept or tag in ("pre", "textarea", "xmp"))
            flow.space() if spaced else flow.flush()
        else:
            self._inside(node, flow, visible, kept)

    @staticmethod
    def _summary(node: Node) -> Node:
        """What a closed details element shows."""
        shown = Node(node.tag, {})
        shown.children = [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
        return shown

    def _indented(self, node: Node, flow: Flow, visible: bool, kept: bool) -> None:
        inner = Flow()
        self._inside(node, inner, visible, kept)
        flow.lines += [("  " + line).rstrip() for line in inner.done()]

    def _item(self, node: Node, flow: Flow, visible: bool, marker: str) -> None:
        flow.flush()
        inner = Flow()
        self._inside(node, inner, visible, False)
        lines = inner.done()
        if lines:
            flow.lines.append((marker + lines[0]).rstrip())
            flow.lines += [(" " * len(marker) + line).rstrip() for line in lines[1:]]

    def _list(self, node: Node, flow: Flow, visible: bool) -> None:
        nested = any(line is not None for line in flow.lines) or flow.waiting
        flow.space() if nested and not self._only_item(flow) else flow.flush()
        ordered = node.tag == "ol"
        number = _whole(node.attributes.get("start"), 1)
        for child in node.children:
            if isinstance(child, Node) and child.tag == "li":
                sight = self._sight(child, visible)
                if sight is None:
                    continue
                number = _whole(child.attributes.get("value"), number)
                self._item(child, flow, sight, f"{number}. " if ordered else "- ")
                number += 1
            elif isinstance(child, Node):
                self._element(child, flow, visible, False)
            elif visible and child.strip():
                flow.waiting.append(WHITE.sub(" ", child))
        flow.space()

    @staticmethod
    def _only_item(flow: Flow) -> bool:
        """True for the first list inside an item: it follows the item's line directly."""
        return not flow.lines and bool(flow.waiting)

    def _rows(self, node: Node, visible: bool, rows: list, above: list[str]) -> None:
        loose: list[tuple[Node, bool]] = []
        for child in node.children:
            if not isinstance(child, Node):
                if visible and child.strip():
                    above.append(WHITE.sub(" ", child).strip())
                continue
            sight = self._sight(child, visible)
            if sight is None or child.tag in ("colgroup", "col"):
                continue
            if child.tag in GROUPS or child.tag in ("tr",):
                if child.tag == "tr":
                    cells = []
                    for cell in child.children:
                        if isinstance(cell, Node):
                            seen = self._sight(cell, sight)
                            if seen is not None:
                                cells.append((cell, seen))
                        elif sight and cell.strip():
                            above.append(WHITE.sub(" ", cell).strip())
                    rows.append(cells)
                else:
                    self._rows(child, sight, rows, above)
            else:
                loose.append((child, sight))
        for child, sight in loose:  # captions, and what does not belong into a table
            flow = Flow()
            self._inside(child, flow, sight, False)
            above += flow.done()

    def _table(self, node: Node, visible: bool) -> list[str]:
        rows: list[list[tuple[Node, bool]]] = []
        out: list[str] = []
        self._rows(node, visible, rows, out)
        grid, busy, widths = [], {}, {}
        for cells in rows:
            column, line = 0, []
            busy = {c: n - 1 for c, n in busy.items() if n > 1}
            for cell, seen in cells:
                while column in busy:
                    column += 1
                flow = Flow()
                self._inside(cell, flow, seen, False)
                text = flow.done()
                span = min(max(1, _whole(cell.attributes.get("colspan"), 1)), 1000)
                down = min(max(1, _whole(cell.attributes.get("rowspan"), 1)), 65_534)
                if span == 1:
                    wide = max(map(len, text), default=0)
                    widths[column] = min(ALIGNED, max(widths.get(column, 0), wide))
                line.append((column, text))
                if down > 1:
                    busy |= {c: down for c in range(column, column + span)}
                column += span
            grid.append(line)
        starts, at = {}, 0
        for column in range(max(widths, default=-1) + 1):
            starts[column] = at
            wide = widths.get(column, 0)
            at += wide + len(GAP) if wide else 0
        for line in grid:
            for k in range(max((len(text) for _, text in line), default=0)):
                made = ""
                for column, text in line:
                    if k < len(text) and text[k]:
                        made = made.ljust(starts.get(column, at))
                        made += GAP + text[k] if made and not made.endswith(" ") else text[k]
                if made:
                    out.append(made.rstrip())
        return out


def _whole(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"\s*-?\d{1,9}\s*", text) else default


def render(page: str | None) -> str:
    """The visible text of a page; empty for none."""
    return Page(page).text() if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_chars, n_lines, text_sha256 of each page's visible text.

    One pass without a shuffle. A null or empty page has an empty text of no lines; repeated
    rows stay repeated, null ids stay null, an empty table gives no rows, and other columns,
    whatever their names, are not looked at. A page of any length or depth is rendered whole, one
    at a time.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), 1000):
                part = frame.iloc[start:start + 1000]
                texts = [render(page) for page in part["html"]]
                yield pd.DataFrame({
                    "page_id": part["page_id"].tolist(), "text": texts,
                    "n_chars": [len(t) for t in texts],
                    "n_lines": [t.count("\n") + 1 if t else 0 for t in texts],
                    "text_sha256": [
                        hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in texts
                    ],
                })

    schema = "page_id string, text string, n_chars long, n_lines long, text_sha256 string"
    kept = pages.select(F.col("page_id").cast("string").alias("page_id"), "html")
    return kept.mapInPandas(run, schema).withColumn("page_id", F.col("page_id").cast("long"))
