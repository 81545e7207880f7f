"""Text, tag and term expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.keys import _col

NOT_A_LETTER = r"[^\p{L}]+"


def words(text: Column | str) -> Column:
    """Lower-cased runs of letters in order. Splitting is several times faster than extracting all matches."""
    return F.array_remove(F.split(F.lower(F.coalesce(_col(text), F.lit(""))), NOT_A_LETTER), "")


def map_characters(text: Column | str, pairs: dict[str, str]) -> Column:
    """Replace single characters, as from traditional to simplified script."""
    return F.translate(_col(text), "".join(pairs.keys()), "".join(pairs.values()))


def split_tags(tags: Column | str, separator: str = fixed.TAG_SEPARATOR) -> Column:
    """Trimmed tags in order; empty tags at the end do not count and an empty text has none."""
    tags = F.coalesce(_col(tags), F.lit(""))
    kept = F.regexp_replace(tags, f"(?:{separator})+$", "")
    return F.when(tags == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.split(kept, separator), lambda t: F.trim(t))
    )


def clean_lexicon_term(term: Column | str) -> Column:
    """Without Latin letters and commas, unless nothing else is left."""
    term = _col(term)
    rest = F.regexp_replace(term, fixed.LEXICON_NOISE, "")
    return F.when(rest != "", rest).otherwise(term)


def short_enough(term: Column | str, below: int = fixed.TERM_BYTES_BELOW) -> Column:
    return (_col(term) != "") & (F.octet_length(_col(term)) < below)


def weighted_text(**fields: Column | str) -> Column:
    """Title, tags, keywords and body of a page, each repeated as often as it counts."""
    parts = []
    for name, times in fixed.FIELD_WEIGHTS.items():
        field = F.coalesce(_col(fields[name]), F.lit(""))
        parts.append(field if name == "content" else F.repeat(F.concat(field, F.lit(" ")), times))
    return F.concat(*parts)


def weighted_words(**fields: Column | str) -> Column:
    """The words of `weighted_text`, each field split only once."""
    return F.flatten(
        F.array(*[F.flatten(F.array_repeat(words(fields[n]), k)) for n, k in fixed.FIELD_WEIGHTS.items()])
    )


def parse_ids(text: Column | str) -> Column:
    """Integers of a blank-separated text; an inner blank piece is 0, blanks at the end do not count."""
    pieces = F.split(F.regexp_replace(_col(text), " +$", ""), " ")
    return F.transform(pieces, lambda p: F.coalesce(F.trim(p).try_cast("int"), F.lit(0)))


def join_ids(ids: Column | str) -> Column:
    return F.concat_ws(" ", F.transform(_col(ids), lambda i: i.cast("string")))


def kept_class(term: Column | str, term_class: Column | str) -> Column:
    """True for terms that carry meaning: not a stop term and not of a dropped class."""
    term_class = _col(term_class)
    dropped = term_class.isin(fixed.DROPPED_CLASSES) | term_class.rlike(
        "^(" + "|".join(fixed.DROPPED_CLASS_LETTERS) + ")"
    )
    return ~F.trim(_col(term)).isin(fixed.STOP_TERMS) & ~F.coalesce(dropped, F.lit(True))
