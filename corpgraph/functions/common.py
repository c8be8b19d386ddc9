"""Column helpers shared by the text functions. Null in gives null out unless said otherwise."""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Separate the entries of the decomposition table, and its parts of so many code points.
_APART, _PART, PART_SIZE = "\x01", "\x02", 64


def sub(text: Column, pattern: str, to: str = " ") -> Column:
    return F.regexp_replace(text, pattern, to)


def collapse(text: Column) -> Column:
    """Runs of white space to one space, ends trimmed."""
    return F.trim(sub(text, r"(?U)\s+"))


def text_of(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


@functools.cache
def _decompositions() -> tuple[str, str, str, str]:
    """Each character that has one, with its compatibility decomposition, behind a separator, in parts by code point; and the parts of Korean syllables."""
    rows = ((chr(c), unicodedata.normalize("NFKD", chr(c))) for c in range(0x80, sys.maxunicode + 1) if not (0xAC00 <= c < 0xAC00 + 11172 or 0xD800 <= c < 0xE000))
    parts = ("".join(map(chr, range(first, first + n))) for first, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27)))
    table = [_APART] * (sys.maxunicode // PART_SIZE + 1)
    for c, d in rows:
        if c != d:
            table[ord(c) // PART_SIZE] += c + d + _APART
    return (_PART.join(table).rstrip(_APART + _PART), *parts)


def decomposed(text: Column) -> Column:
    """Compatibility decomposition (NFKD) of every character; marks that follow each other keep their order."""
    table, lead, vowel, tail = (F.lit(x) for x in _decompositions())
    table = F.split(table, _PART)  # folded once; a character looks through its own part only
    div = lambda a, b: F.call_function("div", a, F.lit(b)).cast("int")

    def syllable(c: Column) -> Column:
        s = F.ascii(c) - F.lit(0xAC00)
        return F.concat(F.substr(lead, div(s, 588) + 1, F.lit(1)), F.substr(vowel, div(s % 588, 28) + 1, F.lit(1)), F.when(s % 28 > 0, F.substr(tail, s % 28, F.lit(1))).otherwise(""))

    def known(c: Column) -> Column:
        part = F.concat(F.get(table, div(F.ascii(c), PART_SIZE)), F.lit(_APART))
        found = F.substring_index(F.call_function("substring_index", part, F.concat(F.lit(_APART), c), F.lit(-1)), _APART, 1)
        return F.when(F.contains(part, F.concat(F.lit(_APART), c)), found).otherwise(c)

    def one(c: Column) -> Column:
        return F.when(c < F.lit("\x80"), c).when(c.between("\uac00", "\ud7a3"), syllable(c)).otherwise(known(c))

    whole = F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), one), "")
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(whole)


def title_case(text: Column) -> Column:
    """Every run of letters capitalised (``domino's`` gives ``Domino'S``)."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substr(x, F.lit(2))))), "")


def first_match(text: Column, rules: Iterable[tuple[str, str]], otherwise: Column) -> Column:
    """Value of the first (pattern, value) rule that matches: rule order is the meaning."""
    out = None
    for pattern, value in rules:
        out = F.when(text.rlike(pattern), F.lit(value)) if out is None else out.when(text.rlike(pattern), F.lit(value))
    return out.otherwise(otherwise)


def replace_all(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    return functools.reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def look_up(text: Column, table: dict[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, text), text)


def words(text: Column) -> Column:
    """White-space words; none for blank text."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda x: x != "")
