"""Elements of a captured page as arrays.

The markup is not well-formed XML, so Spark's own ``xpath`` functions refuse it.
This is the one place where page text goes through Python: an Arrow function that
receives only the page column and returns arrays, with all further rules in columns.
"""

from __future__ import annotations

import html
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

# The code below travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements that never have content, and elements whose content is not page text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset(("script", "style"))

NAME_END = re.compile(r"[\s/>]")
QUOTE_OR_END = re.compile("[\"'>]")
# An ordinary tag: quotes in pairs and no other tag begun inside, so a try that fails reads no further than the next "<".
PLAIN = re.compile(r"""<(/?)([A-Za-z][^\s/<>]*+)([^"'<>]*+(?:(?:"[^"<]*+"|'[^'<]*+')[^"'<>]*+)*+)>""")
ATTRIBUTE = re.compile(r"""([^\s/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s]+))?""")


class Tags:
    """Finds the tags, comments and declarations of a page one after another, in time linear in the page.

    A quote without a partner further on is an ordinary character. What cannot
    be closed is no tag but text. Whatever a search has learned about the rest
    of the page (no further quote, no way to a closing bracket from here) is
    kept, so broken markup is not searched again from every tag start. Ordinary
    tags are found by one pattern, which agrees with that search.
    """

    def __init__(self, source: str) -> None:
        self.source, self.at = source, 0
        self.last_end = source.rfind(">")
        self.last_quote = {'"': source.rfind('"'), "'": source.rfind("'")}
        self.dead: set[int] = set()
        self.name_from = self.name_to = -1
        self.sign_from, self.sign_to = 0, -1

    def _name_end(self, start: int) -> int:
        if not self.name_from <= start <= self.name_to:
            found = NAME_END.search(self.source, start)
            self.name_from, self.name_to = start, found.start() if found else len(self.source)
        return self.name_to

    def _sign(self, start: int) -> int:
        """Where the next quote or closing bracket is; the end of the page if there is none."""
        if not self.sign_from <= start <= self.sign_to:
            found = QUOTE_OR_END.search(self.source, start)
            self.sign_from, self.sign_to = start, found.start() if found else len(self.source)
        return self.sign_to

    def _close(self, at: int) -> int | None:
        """Where a tag ends whose name ends here: the first ``>`` outside quotes."""
        source, path = self.source, []
        while at not in self.dead:
            path.append(at)
            at = self._sign(at) + 1
            if at > len(source):
                break
            sign = source[at - 1]
            if sign == ">":
                return at
            if self.last_quote[sign] >= at:
                at = source.find(sign, at) + 1
        self.dead.update(path)
        return None

    def next(self) -> tuple[int, int, str, str | None, str] | None:
        """(start, end, "/" of an end tag, name, rest inside) of the next tag; the name is None for what is no element."""
        source = self.source
        while (start := source.find("<", self.at)) >= 0:
            if plain := PLAIN.match(source, start):
                self.at = plain.end()
                return start, self.at, *plain.groups()
            self.at = start + 1
            first = source[start + 1 : start + 2]
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                self.at = len(source) if end < 0 else end + 3
                return start, self.at, "", None, ""
            if start > self.last_end:
                continue
            if first in ("!", "?"):
                self.at = source.index(">", start + 2) + 1
                return start, self.at, "", None, ""
            slash = "/" if first == "/" else ""
            begin = start + 1 + len(slash)
            letter = source[begin : begin + 1]
            if not (letter.isascii() and letter.isalpha()):
                continue
            name_end = self._name_end(begin)
            end = self._close(name_end)
            if end is not None:
                self.at = end
                return start, end, slash, source[begin:name_end], source[name_end : end - 1]
        return None


class _Element:
    """An element as ranges: of elements below it, of texts below it, and of its source."""

    __slots__ = ("tag", "raw", "index", "last", "text_from", "text_to", "start", "end")

    def __init__(self, tag: str, raw: str, index: int, text_from: int, start: int, end: int) -> None:
        self.tag, self.raw, self.index, self.last = tag, raw, index, index
        self.text_from, self.text_to, self.start, self.end = text_from, text_from, start, end

    def attribute(self, name: str) -> str | None:
        if name not in self.raw.lower():
            return None
        for key, value in ATTRIBUTE.findall(self.raw):
            if key.lower() == name:
                return html.unescape(value[1:-1] if value[:1] in ("'", '"') else value)
        return None

    def has_class(self, wanted: str) -> bool:
        if wanted not in self.raw and "&" not in self.raw:
            return False
        value = self.attribute("class") or ""
        return value == wanted or wanted in value.split()


class _Page:
    """The elements of a page in document order.

    Forgiving about markup: an end tag closes the nearest open element of its name
    and all inside it, an end tag without one is ignored.
    """

    def __init__(self, source: str) -> None:
        self.source, self.elements, self.texts = source, [], []
        self.by_tag: dict[str, list[_Element]] = {}
        open_elements, open_tags, at = [], {}, 0
        elements, texts, by_tag = self.elements, self.texts, self.by_tag

        def close(end: int) -> str:
            element = open_elements.pop()
            element.last, element.text_to, element.end = len(elements) - 1, len(texts), end
            open_tags[element.tag] -= 1
            return element.tag

        tags = Tags(source)
        while (found := tags.next()) is not None:
            start, end, slash, tag, raw = found
            if start > at:
                text = source[at:start]
                texts.append(html.unescape(text) if "&" in text else text)
            at = end
            if tag is None:
                continue
            tag = tag.lower()
            if slash:
                while open_tags.get(tag) and close(at) != tag:
                    pass
                continue
            element = _Element(tag, raw, len(elements), len(texts), start, at)
            elements.append(element)
            by_tag.setdefault(tag, []).append(element)
            if tag in RAW:
                # What follows is no markup up to the end tag; the search for tags goes on there.
                end = re.compile(f"</{tag}", re.I).search(source, at)
                at = end.start() if end else len(source)
                tags.at = at
            if tag not in VOID and not raw.endswith("/"):
                open_elements.append(element)
                open_tags[tag] = open_tags.get(tag, 0) + 1
        if at < len(source):
            texts.append(html.unescape(source[at:]))
        while open_elements:
            close(len(source))

    def select(self, tag: str, css_class: str | None = None) -> list[_Element]:
        return [e for e in self.by_tag.get(tag, ()) if css_class is None or e.has_class(css_class)]

    def below(self, element: _Element, tag: str) -> list[_Element]:
        return [e for e in self.elements[element.index + 1:element.last + 1] if e.tag == tag]

    def text(self, element: _Element) -> str:
        return "".join(self.texts[element.text_from:element.text_to])

    def parts(self, element: _Element) -> list[str | _Element]:
        """Texts and elements directly inside an element, in order."""
        found, text_at, index = [], element.text_from, element.index + 1
        while index <= element.last:
            child = self.elements[index]
            found += self.texts[text_at:child.text_from]
            found.append(child)
            text_at, index = child.text_to, child.last + 1
        return found + self.texts[text_at:element.text_to]

    def lead(self, element: _Element) -> str:
        """Text before the first element inside."""
        first = next(iter(self.parts(element)), "")
        return first if isinstance(first, str) else ""

    def outer(self, element: _Element) -> str:
        return self.source[element.start:element.end]


def _field(page: _Page, element: _Element, field: str) -> str | None:
    if field == "text":
        return page.text(element)
    if field == "lead":
        return page.lead(element)
    return element.attribute(field.removeprefix("attr:"))


def select_fields(content: Column, wanted: dict[str, tuple[str, str | None, str]]) -> Column:
    """Struct of ``array<string>``: for each name the (tag, class, field) of the matching elements.

    ``field`` is ``text`` (all text below), ``lead`` (text before the first child
    element) or ``attr:<name>``; elements without the attribute are left out.
    """
    result = pa.struct([(name, pa.list_(pa.string())) for name in wanted])

    @arrow_udf("struct<" + ", ".join(f"{name}: array<string>" for name in wanted) + ">")
    def extract(pages: pa.Array) -> pa.Array:
        rows = []
        for content in pages:
            page = _Page(content.as_py() or "")
            row = {}
            for name, (tag, css_class, field) in wanted.items():
                values = (_field(page, element, field) for element in page.select(tag, css_class))
                row[name] = [value for value in values if value is not None]
            rows.append(row)
        return pa.array(rows, type=result)

    return extract(content)


REVIEW_LISTS = (
    "struct<reviews: array<struct<parts: array<string>, single: string>>, names: array<string>, "
    "times: array<string>, stars: array<struct<label: string, outer: string>>>"
)
_REVIEW_LISTS_ARROW = pa.struct([
    ("reviews", pa.list_(pa.struct([("parts", pa.list_(pa.string())), ("single", pa.string())]))),
    ("names", pa.list_(pa.string())),
    ("times", pa.list_(pa.string())),
    ("stars", pa.list_(pa.struct([("label", pa.string()), ("outer", pa.string())]))),
])


def _review(page: _Page, block: _Element, full_class: str, single_class: str) -> dict:
    spans = page.below(block, "span")
    full = next((span for span in spans if span.has_class(full_class)), None)
    if full is not None:
        parts = [part if isinstance(part, str) else page.text(part) for part in page.parts(full)]
        return {"parts": parts, "single": None}
    holder = next((span for span in spans if span.has_class(single_class)), None)
    parts = page.parts(holder) if holder is not None else []
    group = parts[1] if len(parts) > 1 else None
    return {"parts": None, "single": page.lead(group) if isinstance(group, _Element) else ""}


def review_lists(content: Column, stars: Column, review: Column, single: Column, full: Column,
                 name_class: str, time_class: str) -> Column:
    """The four lists of a review page; the class names may differ from row to row."""

    @arrow_udf(REVIEW_LISTS)
    def extract(pages: pa.Array, stars: pa.Array, review: pa.Array, single: pa.Array, full: pa.Array) -> pa.Array:
        rows = []
        for row in zip(*(column.to_pylist() for column in (pages, stars, review, single, full))):
            content, stars_class, review_class, single_class, full_class = row
            if None in row[1:]:
                rows.append({"reviews": [], "names": [], "times": [], "stars": []})
                continue
            page = _Page(content or "")
            rows.append({
                "reviews": [_review(page, block, full_class, single_class) for block in page.select("div", review_class)],
                "names": [page.text(element) for element in page.select("div", name_class)],
                "times": [page.text(element) for element in page.select("div", time_class)],
                "stars": [
                    {"label": element.attribute("aria-label"), "outer": page.outer(element)}
                    for element in page.select("span", stars_class)
                ],
            })
        return pa.array(rows, type=_REVIEW_LISTS_ARROW)

    return extract(content, stars, review, single, full)
