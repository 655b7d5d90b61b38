"""Conversions as functions of SQL, generated from the systems' tables: CREATE TEMPORARY FUNCTION with an expression as its body, so they run
in the JVM and can be called wherever Spark reads SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from glyphmill.functions.columns import any_of, longest_first
from glyphmill.functions.syllables import SPOKEN
from glyphmill.functions.systems import PIVOT, named


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _lookup(table: dict[str, str], key: str, default: str) -> str:
    if not table:
        return default
    return f"coalesce(element_at(map({', '.join(f'{quoted(k)}, {quoted(v)}' for k, v in table.items())}), {key}), {default})"


def _let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def leg(source: str, target: str) -> str:
    """The expression for typed syllables in ``text`` from one system's letters to another's; one of the two is the pivot."""
    a, b = named(source), named(target)
    if PIVOT not in (a.name, b.name):
        raise ValueError("one of the two systems must be the pivot")
    maps = a.to_pivot if b.name == PIVOT else b.from_pivot
    fixed = {k: {x: y for x, y in v.items() if not callable(y)} for k, v in maps.items()}
    if any(len(fixed[k]) < len(v) for k, v in maps.items()):
        raise ValueError("a map with callables has no expression in SQL")
    front, nasal = ({}, {}) if b.name == PIVOT else (b.before_front, b.nasal_first)
    initials = any_of(longest_first(a.initials.split()))
    endings = any_of(longest_first(f"{a.stops} {a.nasals} {b.stops} {b.nasals}".split()))
    alone = f"x.base RLIKE {quoted(f'^(?:{initials})$')}"
    ending = f"CASE WHEN {alone} THEN '' ELSE regexp_extract(x.base, {quoted(f'^(.+?)({endings})$')}, 2) END"
    rest = "substring(y.base, 1, length(y.base) - length(y.ending))"
    initial = f"CASE WHEN y.alone THEN y.base ELSE regexp_extract({rest}, {quoted(f'^(?:{initials})')}, 0) END"
    vowel = f"substring({rest}, length(z.initial) + 1)".replace("y.", "z.")
    new = _lookup(fixed.get("initial", {}), "w.initial", "w.initial")
    if front:
        new = f"CASE WHEN w.vowel RLIKE '^[ie]' THEN {_lookup(front, 'w.initial', new)} ELSE {new} END"
    left = _lookup({k: v[1] for k, v in nasal.items()}, "w.ending", "w.ending")
    out = [new, _lookup({k: v[0] for k, v in nasal.items()}, "w.ending", "''") if nasal else "''", _lookup(fixed.get("vowel", {}), "w.vowel", "w.vowel"), _lookup(fixed.get("ending", {}), left, left), "w.tone"]
    body = f"concat({', '.join(out)})"
    body = _let(f"named_struct('initial', z.initial, 'vowel', {vowel}, 'ending', z.ending, 'tone', z.tone)", "w", body)
    body = _let(f"named_struct('base', y.base, 'ending', y.ending, 'tone', y.tone, 'initial', {initial})", "z", body)
    body = _let(f"named_struct('base', x.base, 'tone', x.tone, 'alone', {alone}, 'ending', {ending})", "y", body)
    body = _let("named_struct('base', lower(regexp_replace(p, '[0-9]$', '')), 'tone', regexp_extract(p, '([0-9])$', 1))", "x", body)
    pieces = f"regexp_extract_all(text, {quoted(rf'(?s)[{SPOKEN}]+[0-9]?|[^{SPOKEN}]')}, 0)"
    return f"array_join(transform({pieces}, p -> CASE WHEN p RLIKE {quoted(f'^[{SPOKEN}]')} THEN {body} ELSE p END), '')"


def define(spark: SparkSession, *systems: str) -> list[str]:
    """Defines for each system <system>_to_pivot(text) and pivot_to_<system>(text), over typed syllables. Returns the names."""
    names = []
    for s in systems:
        for name, a, b in ((f"{s.lower()}_to_pivot", s, PIVOT), (f"pivot_to_{s.lower()}", PIVOT, s)):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS STRING DETERMINISTIC RETURN {leg(a, b)}")
            names.append(name)
    return names
