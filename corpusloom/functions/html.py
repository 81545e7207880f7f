"""Reading HTML with column expressions: elements, text, attributes and links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.keys import _col, canonical_url, let

MARK = "\u0001"

# Elements that break the line, so that their tags separate words (HTML standard).
BLOCK_TAGS = (
    "address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link main "
    "menu meta nav noframes noscript ol option p pre section select summary table tbody td template tfoot th thead "
    "title tr ul"
).split()

# What an unclosed script or style takes with it.
OPEN_CODE = r"(?is)<(?:script|style)[\s/>].*"

# Named entities of plain prose (HTML standard); `amp` comes last so that nothing is decoded twice.
ENTITIES = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "copy": "©", "reg": "®", "trade": "™",
    "middot": "·", "bull": "•", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’",
    "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "deg": "°", "sect": "§", "para": "¶", "times": "×",
    "divide": "÷", "plusmn": "±", "euro": "€", "pound": "£", "yen": "¥", "cent": "¢", "amp": "&",
}


def without_code(html: Column | str) -> Column:
    """HTML without script and style blocks; one that is never closed reaches to the end."""
    closed = F.regexp_replace(F.regexp_replace(_col(html), fixed.SCRIPT_BLOCK, ""), fixed.STYLE_BLOCK, "")
    return F.regexp_replace(closed, OPEN_CODE, "")


def decode_entities(text: Column | str) -> Column:
    def decode(text: Column) -> Column:
        decoded = F.when(F.contains(text, F.lit("&#")), _numeric_entities(text)).otherwise(text)
        for name, character in ENTITIES.items():
            decoded = F.replace(decoded, F.lit(f"&{name};"), F.lit(character))
        return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)

    return let(_col(text), decode)


def _numeric_entities(text: Column) -> Column:
    """Decode `&#8212;` and `&#x2014;`: each piece after a `&#` starts with its code, or was no entity."""

    def decode(piece: Column) -> Column:
        code = F.regexp_extract(piece, r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        number = F.when(
            F.lower(F.substring(code, 1, 1)) == "x", F.conv(F.substr(code, F.lit(2)), 16, 10)
        ).otherwise(code).try_cast("int")
        valid = (code != "") & number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32")
        return F.when(valid, F.concat(character, F.substr(piece, F.length(code) + 2))).otherwise(
            F.concat(F.lit("&#"), piece)
        )

    pieces = F.split(text, "&#")
    rest = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.concat(F.element_at(pieces, 1), F.array_join(F.transform(rest, decode), ""))


def plain_text(html: Column | str) -> Column:
    """Visible text of a fragment: block tags part words, inline tags do not, white space runs become one blank."""
    text = F.regexp_replace(_col(html), r"(?s)<!--.*?-->", "")
    text = F.regexp_replace(text, r"(?i)</?(?:" + "|".join(BLOCK_TAGS) + r")(?:[\s/][^>]*)?>", " ")
    text = F.regexp_replace(text, r"<[a-zA-Z/!?][^>]*>", "")
    return F.trim(F.regexp_replace(decode_entities(text), r"\s+", " "))


def elements(html: Column | str, selector: str) -> Column:
    """Inner HTML of every element that `tag`, `.class` or `#id` selects, in order; nested tags are balanced."""
    html = F.replace(F.coalesce(_col(html), F.lit("")), F.lit(MARK), F.lit(""))
    parts = F.split(F.regexp_replace(html, "(" + _opening(selector) + ")", MARK + "$1"), MARK)

    def from_each(parts: Column) -> Column:
        found = F.size(parts) - 1
        every = F.transform(
            F.sequence(F.lit(1), F.greatest(found, F.lit(1))),
            lambda i: _inner(F.array_join(F.slice(parts, i + 1, found), "")),
        )
        return F.when(found < 1, F.array().cast("array<string>")).otherwise(every)

    return let(parts, from_each)


def first_element(html: Column | str, selector: str) -> Column:
    """Inner HTML of the first selected element, null when there is none."""
    html = F.coalesce(_col(html), F.lit(""))
    rest = F.regexp_extract(html, r"(?s)(" + _opening(selector) + r".*)", 1)
    return _inner(rest)


def _inner(rest: Column) -> Column:
    """`rest` starts with an opening tag; what lies between it and its closing tag, null for an empty `rest`."""

    def between(row: Column) -> Column:
        rest, tag = row["rest"], row["tag"]
        same_tag = F.concat(F.lit(r"(?i)(</?"), tag, F.lit(r"(?:[\s/][^>]*)?>)"))
        cut = F.struct(F.split(rest, same_tag).alias("pieces"), F.regexp_extract_all(rest, same_tag, F.lit(1)).alias("tags"))
        return F.when(rest != "", let(cut, _balanced))

    tag = lambda rest: F.lower(F.regexp_extract(rest, r"^<([a-zA-Z][a-zA-Z0-9]*)", 1))
    return let(let(rest, lambda r: F.struct(r.alias("rest"), tag(r).alias("tag"))), between)


def _balanced(cut: Column) -> Column:
    """Text up to the tag that closes the first one, from the pieces between tags of one name and these tags."""
    pieces, tags = cut["pieces"], cut["tags"]
    closing = F.aggregate(
        tags,
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen")),
        lambda s, t: F.when((s.seen > 0) & (s.depth == 0), s).otherwise(
            F.struct((s.depth + F.when(F.startswith(t, F.lit("</")), -1).otherwise(1)).alias("depth"), (s.seen + 1).alias("seen"))
        ),
        lambda s: F.when(s.depth == 0, s.seen - 1).otherwise(s.seen),
    )
    inside = lambda n: F.array_join(
        F.zip_with(
            F.slice(pieces, 2, n), F.slice(tags, 2, F.greatest(n - 1, F.lit(0))), lambda p, t: F.concat(p, F.coalesce(t, F.lit("")))
        ),
        "",
    )
    return let(closing, inside)


def _opening(selector: str) -> str:
    kind, name = selector[0], selector[1:]
    if kind == ".":
        return _tag_with("class", rf'"(?:[^"]*\s)?{name}(?:\s[^"]*)?"', rf"'(?:[^']*\s)?{name}(?:\s[^']*)?'", name)
    if kind == "#":
        return _tag_with("id", f'"{name}"', f"'{name}'", name)
    return rf"(?i:<{selector})(?:[\s/][^>]*)?>"


def _tag_with(attribute: str, double: str, single: str, bare: str) -> str:
    value = rf"(?:{double}|{single}|{bare}(?=[\s/>]))"
    return rf"<[a-zA-Z][a-zA-Z0-9]*(?=[\s])(?:[^>]*?\s)(?i:{attribute})\s*=\s*{value}[^>]*>"


def attribute(tag: Column | str, name: str) -> Column:
    """Decoded value of an attribute of one tag, empty when it is absent."""
    value = F.regexp_extract(
        _col(tag), rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1
    )
    return decode_entities(F.regexp_replace(value, r"""^["']|["']$""", ""))


def page_title(html: Column | str, suffix: str = "") -> Column:
    """Text of the title element without a site suffix."""
    found = F.regexp_extract_all(_col(html), F.lit(r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"), F.lit(1))
    title = plain_text(F.array_join(found, " "))
    return F.replace(title, F.lit(suffix), F.lit("")) if suffix else title


def meta_content(html: Column | str, name: str) -> Column:
    """Content of the first meta tag of that name."""
    tag = F.regexp_extract(_col(html), rf"""(?is)<meta\s(?:[^>]*\s)?name\s*=\s*["']?{name}["'\s/>][^>]*>?""", 0)
    return attribute(tag, "content")


def links(html: Column | str) -> Column:
    """`href` of every anchor in order, duplicates kept."""
    tags = F.regexp_extract_all(_col(html), F.lit(r"(?i)(<a\s[^>]*>)"), F.lit(1))
    return F.filter(F.transform(tags, lambda t: attribute(t, "href")), lambda h: h != "")


def page_links(html: Column | str, prefixes: list[str]) -> Column:
    """Links that contain one of the prefixes, without query and fragment."""
    wanted = F.filter(links(html), lambda h: _any(h, prefixes))
    return F.transform(wanted, canonical_url)


def _any(href: Column, prefixes: list[str]) -> Column:
    test = F.lit(False)
    for prefix in prefixes:
        test = test | F.contains(href, F.lit(prefix))
    return test


def content_text(html: Column | str, selectors: list[str]) -> Column:
    """Text of the content container: the last selector of the list that is present counts, none gives ''."""
    text = F.lit("")
    for selector in selectors:
        if selector.startswith("#"):
            inner = first_element(html, selector)
        else:
            found = elements(html, selector)
            inner = F.when(F.size(found) > 0, F.array_join(found, " "))
        text = F.coalesce(plain_text(inner), text)
    return text


def leading_title(title: Column | str) -> Column:
    """Category in a page title: the part before the first `_`."""
    return F.split_part(_col(title), F.lit("_"), F.lit(1))
