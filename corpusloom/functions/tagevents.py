"""Pages as tag events: one pass finds all tags and which of them close each other, and everything else is read from that.

An element ends where as many tags of its name have closed as were opened since its own; one stack for each name tells this
for all elements of a page together, so a page takes time in proportion to its length however deep it nests. The expressions
of `functions.html` give the same for short fragments.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.entities import html5

import pyarrow as pa

from corpusloom import fixed_values as fixed
from corpusloom.functions.html import BLOCK_TAGS, ENTITIES, _opening

TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[\s/][^>]*)?)>", re.A)
# Where a block of code begins and ends, by the two parts of the fixed patterns.
CODE = [re.compile(r"<\s*?%s[^>]*?>" % name, re.A | re.I) for name in ("script", "style")]
CODE_END = [re.compile(r"<\s*?/\s*?%s\s*?>" % name, re.A | re.I) for name in ("script", "style")]
OPEN_CODE = re.compile(r"<(?:script|style)[\s/>]", re.A | re.I)
COMMENT, COMMENT_END = "<!--", "-->"
BLOCK_TAG = re.compile(r"</?(?:" + "|".join(BLOCK_TAGS) + r")(?:[\s/][^>]*)?>", re.A | re.I)
ANY_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
SPACE = re.compile(r"\s+", re.A)
ENTITY = re.compile(r"&(?:#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6})|([a-zA-Z][a-zA-Z0-9]*));")
# Blanks that do not break stay plain blanks.
NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")} | ENTITIES


def _upto(html: str) -> int:
    """Where the last tag can end: a `<` behind it begins none, and is not tried out to the end of the page."""
    return html.rfind(">") + 1


def without_code(html: str) -> str:
    """HTML without script and style blocks; one that is never closed reaches to the end."""
    for start, end in zip(CODE, CODE_END):
        kept, at = [], 0
        for opened in start.finditer(html, 0, _upto(html)):
            if opened.start() < at:
                continue
            closed = end.search(html, opened.end())
            if closed is None:
                # Nothing closes behind this place, so no later block is whole either.
                break
            kept.append(html[at:opened.start()])
            at = closed.end()
        if at:
            html = "".join([*kept, html[at:]])
    opened = OPEN_CODE.search(html)
    return html[:opened.start()] if opened else html


def _character(found: re.Match) -> str:
    number, name = found.groups()
    if name is not None:
        return NAMED.get(name, found[0])
    code = int(number[1:], 16) if number[0] in "xX" else int(number)
    return chr(code) if 0 < code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else found[0]


def decode_entities(text: str) -> str:
    """All named references of the HTML standard that end in a semicolon, and numeric ones; each is decoded once."""
    return ENTITY.sub(_character, text) if "&" in text else text


def plain_text(html: str) -> str:
    """Visible text of a fragment: block tags part words, inline tags do not, white space runs become one blank."""
    if COMMENT in html:
        parts, at = [], 0
        while (start := html.find(COMMENT, at)) >= 0 and (end := html.find(COMMENT_END, start + len(COMMENT))) >= 0:
            parts.append(html[at:start])
            at = end + len(COMMENT_END)
        html = "".join([*parts, html[at:]])
    last = _upto(html)
    text = ANY_TAG.sub("", BLOCK_TAG.sub(" ", html[:last])) + html[last:]
    return SPACE.sub(" ", decode_entities(text)).strip(" ")


def attribute(tag: str, name: str) -> str:
    """Decoded value of an attribute of one tag, empty when it is absent."""
    found = re.search(rf"""\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", tag, re.A | re.I)
    if not found:
        return ""
    value = found[1]
    return decode_entities(re.sub(r"""^["']|["']$""", "", value))


@dataclass
class Tags:
    """The tags of a fragment in order: `opens` with name, start and end, and where the element of each one ends."""

    html: str
    names: list[str] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    inner_ends: list[int] = field(default_factory=list)
    titles: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, html: str) -> Tags:
        found = cls(html)
        names, starts, ends, inner_ends = found.names, found.starts, found.ends, found.inner_ends
        open_tags: dict[str, list[int]] = {}
        title = None
        for tag in TAG.finditer(html, 0, _upto(html)):
            closing, name, rest = tag.groups()
            name = name.lower()
            if not closing:
                open_tags.setdefault(name, []).append(len(names))
                names.append(name)
                starts.append(tag.start())
                ends.append(tag.end())
                inner_ends.append(len(html))
                if name == "title" and title is None and (not rest or not rest.startswith("/")):
                    title = tag.end()
                continue
            if open_tags.get(name):
                inner_ends[open_tags[name].pop()] = tag.start()
            if name == "title" and title is not None and not rest.strip():
                found.titles.append(html[title:tag.start()])
                title = None
        return found

    def tag(self, i: int) -> str:
        return self.html[self.starts[i]:self.ends[i]]

    def inner(self, i: int, until: int | None = None) -> str:
        end = self.inner_ends[i]
        return self.html[self.ends[i]:end if until is None else min(end, until)]

    def selected(self, selector: str, first: int = 0, until: int | None = None) -> Iterator[int]:
        """The tags from the one numbered `first` that `tag`, `.class` or `#id` selects, up to the place `until`."""
        kind, name = selector[0], selector[1:]
        pattern = re.compile(_opening(selector), re.A)
        for i in range(first, len(self.names)):
            if until is not None and self.starts[i] >= until:
                return
            if kind not in ".#":
                if self.names[i] == selector.lower():
                    yield i
            elif name in (tag := self.tag(i)) and pattern.match(tag):
                yield i

    def first(self, selector: str, first: int = 0, until: int | None = None) -> int | None:
        return next(self.selected(selector, first, until), None)

    def title(self) -> str:
        return plain_text(" ".join(self.titles))

    def content(self, selectors: list[str]) -> str:
        """Text of the content container: the last selector of the list that is present counts, none gives ''."""
        for selector in reversed(selectors):
            chosen = self.selected(selector)
            inner = [self.inner(i) for i in ([f for f in [next(chosen, None)] if f is not None] if selector[0] == "#" else chosen)]
            if inner:
                return plain_text(" ".join(inner))
        return ""

    def meta(self, name: str) -> str:
        """Content of the first meta tag of that name."""
        pattern = re.compile(rf"""<meta\s(?:[^>]*\s)?name\s*=\s*["']?{name}["'\s/>]""", re.A | re.I)
        for i, tag_name in enumerate(self.names):
            if tag_name == "meta" and pattern.match(tag := self.tag(i)):
                return attribute(tag, "content")
        return ""

    def links(self) -> list[str]:
        """`href` of every anchor in order, duplicates kept."""
        tags = (self.tag(i) for i, name in enumerate(self.names) if name == "a")
        return [h for h in (attribute(t, "href") for t in tags if t[2:3].isspace()) if h]


def read_page(html: str | None, content: list[str], tags: str, meta: str) -> dict:
    """content, title, tags, keyword and hrefs of one page. A page without content has none of the others either."""
    nothing = {"content": "", "title": "", "tags": "", "keyword": "", "hrefs": []}
    if not html:
        return nothing
    events = Tags.of(without_code(html))
    text = events.content(content)
    if not text:
        return nothing
    tagged = events.first(tags)
    return {
        "content": text, "title": events.title(), "tags": "" if tagged is None else plain_text(events.inner(tagged)),
        "keyword": events.meta(meta), "hrefs": events.links(),
    }


def read_list_page(html: str | None) -> dict:
    """title, dicts (href, name, count) and pager numbers of a dictionary list page, as texts."""
    if not html:
        return {"title": "", "dicts": [], "pager": []}
    events = Tags.of(without_code(html))
    dicts = []
    for block in events.selected(fixed.DICT_BLOCK):
        until = events.inner_ends[block]
        title = events.first(fixed.DICT_TITLE, block + 1, until)
        inner = "" if title is None else events.inner(title, until)
        anchor = re.search(r"<a\s[^>]*>", inner, re.A | re.I)
        cells = events.selected(fixed.DICT_CELL, block + 1, until)
        next(cells, None)
        second = next(cells, None)
        dicts.append({
            "href": attribute(anchor[0], "href") if anchor else "", "name": plain_text(inner),
            "count": None if second is None else plain_text(events.inner(second, until)),
        })
    pager = events.first(fixed.PAGER_SELECTOR)
    numbers = []
    if pager is not None:
        inner = events.inner(pager)
        for anchor in re.finditer(r"(<a\s.*?</a\s*>)", inner, re.A | re.I | re.S):
            tag = re.match(r"<a\s[^>]*>", anchor[0], re.A | re.I)
            text = plain_text(anchor[0])
            if tag and attribute(tag[0], "href").startswith(fixed.PAGER_LINK_PREFIX) and text not in fixed.PAGER_SKIPPED:
                numbers.append(text)
    return {"title": events.title(), "dicts": dicts, "pager": numbers}


#: Pages that are read together: what Python holds of them at once does not follow the batches of the session.
AT_ONCE = 64


def read_all(pages: pa.Array, read: Callable[[str | None], dict], kind: pa.DataType) -> pa.Array:
    """What `read` makes of each page of an array, as an array of that type."""
    parts = [
        pa.array([read(page) for page in pages.slice(start, AT_ONCE).to_pylist()], kind)
        for start in range(0, len(pages), AT_ONCE)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


PAGE_TYPE = "struct<content:string,title:string,tags:string,keyword:string,hrefs:array<string>>"
PAGE_ARROW = pa.struct([*((n, pa.string()) for n in ("content", "title", "tags", "keyword")), ("hrefs", pa.list_(pa.string()))])
LIST_TYPE = "struct<title:string,dicts:array<struct<href:string,name:string,count:string>>,pager:array<string>>"
LIST_ARROW = pa.struct([
    ("title", pa.string()), ("dicts", pa.list_(pa.struct([("href", pa.string()), ("name", pa.string()), ("count", pa.string())]))), ("pager", pa.list_(pa.string())),
])
