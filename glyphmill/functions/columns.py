"""Small helpers for building columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: the characters of Unicode's White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lookup(table: dict[str, str], key: Column, default: Column | None = None) -> Column:
    """The entry of a fixed table, or the default (the key itself if there is none)."""
    default = key if default is None else default
    if not table:
        return default
    entries = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in table.items())), F.lit("\x01"), F.lit("\x02"))
    return F.coalesce(F.try_element_at(entries, key), default)


def any_of(words: Iterable[str]) -> str:
    """A pattern for one of several strings, the first that fits."""
    return "|".join(re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", w) for w in words)


def longest_first(words: Iterable[str]) -> list[str]:
    return sorted(dict.fromkeys(words), key=len, reverse=True)


def subs(text: Column, *rules: tuple[str, str]) -> Column:
    """Regular-expression replacements, one after another."""
    for pattern, new in rules:
        text = F.regexp_replace(text, pattern, new)
    return text


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit(WHITE))


def blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def pieces(text: Column, pattern: str) -> Column:
    """All matches of a pattern, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def restored(new: Column, old: Column, upper_with_digits: bool = True) -> Column:
    """new in the case of old: all capitals, a capital first letter with the rest small, or as it is."""
    capital = (F.upper(old) == old) & (F.lower(old) != old)
    if not upper_with_digits:
        capital = capital & ~old.rlike(r"(?U)\d")
    first = F.substring(old, 1, 1)
    title = (F.upper(first) == first) & (F.lower(first) != first)
    return let(new, lambda n: F.when(capital, F.upper(n)).when(title, F.concat(F.upper(F.substring(n, 1, 1)), F.lower(F.substring(n, 2, 1 << 30)))).otherwise(n))
