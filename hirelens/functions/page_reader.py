"""Small HTML reader that runs inside tasks; standard library only."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from html.parser import HTMLParser

VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)
# a start tag ends the open elements it lists, unless one of the containers was opened since
_LISTS, _CELLS = ("ul", "ol", "menu"), ("table", "tr")
_BLOCKS = ("div", "section", "article", "li", "dd", "dt", "td", "th", "button", "blockquote")
IMPLIED_ENDS = {
    "li": (("li",), _LISTS),
    "p": (("p",), _BLOCKS),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), _CELLS),
    "th": (("td", "th"), _CELLS),
}


class _Capture:
    """Collects the content of one open element."""

    def __init__(self, name: str, kind: str, depth: int, start: int):
        self.name, self.kind, self.depth, self.start = name, kind, depth, start
        self.parts: list[str] = []
        self.comment: str | None = None


class PageReader(HTMLParser):
    """One pass over a page, taking the first element each selector matches."""

    def __init__(self, selectors: Mapping[str, tuple], criteria: Sequence[tuple]):
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.criteria_item, *parts = criteria
        self.criteria_parts = tuple(zip(("key", "value"), parts))
        self.values: dict[str, str | None] = {}
        self.markup: dict[str, str] = {}
        self.criteria: dict[str, str] = {}
        self._open: list[str] = []
        self._depths: dict[str, list[int]] = defaultdict(list)  # open elements by tag
        self._captures: list[_Capture] = []
        self._item: dict[str, str] | None = None
        self._item_depth = 0
        self._source = ""
        self._lines: list[int] = []

    def read(self, html: str) -> "PageReader":
        self._source = html
        self._lines = [0]
        for line in html.split("\n"):
            self._lines.append(self._lines[-1] + len(line) + 1)
        self.feed(html)
        self.close()
        while self._open:
            self._close_top(len(html))
        return self

    def _offset(self) -> int:
        line, column = self.getpos()
        return self._lines[line - 1] + column

    def _innermost(self, tags: Sequence[str]) -> int:
        return max((self._depths[t][-1] for t in tags if self._depths[t]), default=-1)

    def handle_starttag(self, tag, attrs):
        if tag in IMPLIED_ENDS:
            ended, containers = IMPLIED_ENDS[tag]
            depth = self._innermost(ended)
            if depth > self._innermost(containers):
                while len(self._open) > depth:
                    self._close_top(self._offset())
        given = dict(attrs)
        classes = (given.get("class") or "").split()
        start = self._offset()
        for name, (kind, wanted_tag, wanted, conditions, attribute) in self.selectors.items():
            if name in self.values or (wanted_tag and tag != wanted_tag):
                continue
            if any(c not in classes for c in wanted):
                continue
            if any(given.get(k) != v for k, v in conditions.items()):
                continue
            self.values[name] = None
            if kind == "attribute":
                self.values[name] = given.get(attribute)
            elif tag not in VOID_TAGS:
                self._captures.append(_Capture(name, kind, len(self._open), start))
        item_tag, item_classes = self.criteria_item
        if tag == item_tag and all(c in classes for c in item_classes):
            self._item, self._item_depth = {}, len(self._open)
        if self._item is not None:
            for part, (part_tag, part_classes) in self.criteria_parts:
                if (tag == part_tag and part not in self._item
                        and all(c in classes for c in part_classes)):
                    self._item[part] = ""
                    self._captures.append(_Capture(part, "criteria", len(self._open), start))
        if tag not in VOID_TAGS:
            self._depths[tag].append(len(self._open))
            self._open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self._depths[tag]:
            return
        end = self._source.find(">", self._offset()) + 1
        while self._open:
            top = self._open[-1]
            self._close_top(end if top == tag else self._offset())
            if top == tag:
                break

    def _close_top(self, end: int) -> None:
        self._depths[self._open.pop()].pop()
        depth = len(self._open)
        while self._captures and self._captures[-1].depth == depth:
            capture = self._captures.pop()
            text = " ".join(p for p in (" ".join(x.split()) for x in capture.parts) if p)
            if capture.kind == "criteria":
                if self._item is not None:
                    self._item[capture.name] = text
            elif capture.kind == "comment" and capture.comment is not None:
                self.values[capture.name] = capture.comment
            else:
                self.values[capture.name] = text
            if capture.kind == "markup":
                self.markup[capture.name] = self._source[capture.start:end]
        if self._item is not None and depth == self._item_depth:
            key, value = self._item.get("key"), self._item.get("value")
            if key and value:
                self.criteria[key.lower().replace(" ", "_").replace("-", "_")] = value
            self._item = None

    def handle_data(self, data):
        for capture in self._captures:
            capture.parts.append(data)

    def handle_comment(self, data):
        if self._captures:
            capture = self._captures[-1]
            if (capture.kind == "comment" and capture.comment is None
                    and capture.depth == len(self._open) - 1):
                capture.comment = data.strip().strip('"')


def read_payload(html: str, selectors: Mapping[str, tuple], criteria: Sequence[tuple]) -> dict:
    """Payload of one page; fields that are not found are None."""
    page = PageReader(selectors, criteria).read(html)
    values = {}
    for name, (kind, *_rest) in selectors.items():
        text = page.values.get(name)
        cleaned = " ".join(text.split()) if text and kind != "comment" else text
        if kind == "markup":
            values[f"{name}_html"] = page.markup.get(name)
            values[f"{name}_text"] = cleaned or None
        else:
            values[name] = cleaned or None
    values["criteria"] = page.criteria
    values["html_size"] = len(html)
    return values
