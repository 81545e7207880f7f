"""Keys, paddings and URL expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def row_key(value: Column | str) -> Column:
    """MD5 of the UTF-8 text as 32 hex digits: the key of every table row."""
    return F.md5(_col(value).cast("string"))


def pair_key(left: Column | str, right: Column | str) -> Column:
    """Key of a row that is known by two values."""
    return F.concat_ws("-", row_key(left), row_key(right))


def pad_bytes(value: Column | str, width: int, fill: str, left: bool) -> Column:
    """Add `fill` once for each byte the text is short of `width`; longer text stays whole."""
    value = _col(value)
    padding = F.repeat(F.lit(fill), F.greatest(F.lit(width) - F.octet_length(value), F.lit(0)))
    return F.concat(padding, value) if left else F.concat(value, padding)


def canonical_url(url: Column | str) -> Column:
    """The part of a URL before the first `?` or `#`."""
    return F.regexp_replace(_col(url), r"(?s)[?#].*$", "")


def ids_in_url(url: Column | str, pattern: str, *names: str) -> Column:
    """Struct of the integers that the groups of `pattern` catch in the URL, null where it does not match."""
    found = [F.regexp_extract(_col(url), pattern, i + 1).try_cast("int").alias(n) for i, n in enumerate(names)]
    return F.struct(*found)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once per row, however often `body` uses it."""
    return F.transform(F.array(value), body).getItem(0)
