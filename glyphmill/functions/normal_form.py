"""Unicode's canonical normal forms as columns, for all of Unicode: C, composed, and D, decomposed.

A text is cut into clusters, a character and what may join it, and runs between them. A text's different clusters are few, so each of
them is put in normal form once for a text: characters are decomposed by table, marks after a starter are sorted by combining class
(equal ones stay in order), and then a starter takes up, from left to right, each mark that the table of pairs joins with it and no mark
between blocks. Hangul is composed by rule. Texts in which nothing can change are left alone. The tables come from Python's Unicode
data when they are first used.
"""

from __future__ import annotations

import sys
from functools import cache
from unicodedata import combining, decomposition, normalize

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphmill.functions.columns import joined, let, lookup, pieces

# Where Hangul stands in Unicode.
L, V, T, S, SYLLABLES = 0x1100, 0x1161, 0x11A7, 0xAC00, 11172
N_L, N_V, N_T = 19, 21, 28


@cache
def tables() -> tuple[dict[str, str], dict[str, str], str, str, str]:
    """Full decompositions; pairs that compose; the characters that may join the one before them, and those that change by themselves, as
    pattern classes; all marks with a combining class."""
    apart, pairs, marks, joining, single = {}, {}, [], {chr(V + i) for i in range(N_V)} | {chr(T + i) for i in range(1, N_T)}, []
    for code in range(sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or S <= code < S + SYLLABLES:
            continue
        c = chr(code)
        if combining(c):
            marks.append(c)
            joining.add(c)
        parts = decomposition(c)
        if parts and not parts.startswith("<"):
            apart[c] = normalize("NFD", c)
            if normalize("NFC", c) != c:
                single.append(c)
            elif " " in parts:
                pair = "".join(chr(int(x, 16)) for x in parts.split())
                pairs[pair] = c
                joining.add(pair[1])
    return apart, pairs, _class(joining), _class(single), "".join(marks)


def _class(characters) -> str:
    """A pattern class, as ranges."""
    codes = sorted(map(ord, characters))
    ranges: list[list[int]] = []
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    # What stands before the first of them, which is most of a Latin text, is told apart by one comparison.
    return rf"[\x{{{codes[0]:x}}}-\x{{10ffff}}&&[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]]"


def _character(code: Column) -> Column:
    """The character of a code below 65,536."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def _of_class(c: Column) -> Column:
    """The combining class of a character: marks are exchanged for a character that has their class as its code, beyond 0x2000."""
    marks = tables()[4]
    codes = "".join(chr(0x2000 + combining(m)) for m in marks)
    return F.when(c.rlike(f"^{_class(marks)}"), F.ascii(F.translate(c, marks, codes)) - 0x2000).otherwise(0)


def _sorted(cluster: Column) -> Column:
    """A cluster's decomposed characters (run, class, place, c), marks in canonical order: those after each starter by class, then as they stood."""
    apart = tables()[0]
    every = F.flatten(F.transform(pieces(cluster, "(?s)."), lambda c: F.when(c.rlike(_class(apart)), pieces(lookup(apart, c), "(?s).")).otherwise(F.array(c))))
    rows = F.transform(every, lambda c, i: F.struct(F.lit(0).alias("run"), _of_class(c).alias("class"), i.alias("place"), c.alias("c")))
    kind = "array<struct<run:int,class:int,place:int,c:string>>"

    def numbered(all_: Column, x: Column) -> Column:
        run = F.when(F.size(all_) == 0, 0).otherwise(F.element_at(all_, -1)["run"]) + F.when(x["class"] == 0, 1).otherwise(0)
        return F.concat(all_, F.array(F.struct(run.cast("int").alias("run"), x["class"].alias("class"), x["place"].alias("place"), x["c"].alias("c"))))

    return F.array_sort(F.aggregate(rows, F.array().cast(kind), numbered))


def _hangul(starter: Column, c: Column) -> Column:
    """What two Hangul characters compose to, or null."""
    a, b = F.ascii(starter), F.ascii(c)
    lead = (a >= L) & (a < L + N_L) & (b >= V) & (b < V + N_V)
    tail = (a >= S) & (a < S + SYLLABLES) & ((a - S) % N_T == 0) & (b > T) & (b < T + N_T)
    return F.when(lead, _character(S + ((a - L) * N_V + (b - V)) * N_T)).when(tail, _character(a + (b - T)))


def _pair(starter: Column, mark: Column) -> Column:
    """What a starter and a mark compose to, or null: each mark has a list of starters, and one of what they become."""
    become: dict[str, dict[str, str]] = {}
    for pair, new in tables()[1].items():
        become.setdefault(pair[1], {})[pair[0]] = new
    old = lookup({m: "".join(x) for m, x in become.items()}, mark, F.lit(""))
    new = lookup({m: "".join(x.values()) for m, x in become.items()}, mark, F.lit(""))
    return F.coalesce(let(F.call_function("translate", starter, old, new), lambda x: F.when(x != starter, x)), _hangul(starter, mark))


def _composed(cluster: Column) -> Column:
    kind = "struct<done:string,starter:string,tail:string,last:int>"
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("starter"), F.lit("").alias("tail"), F.lit(0).alias("last")).cast(kind)

    def step(a: Column, x: Column) -> Column:
        c, own = x["c"], x["class"]
        free = (a["starter"] != "") & ((a["tail"] == "") | (a["last"] < own))
        pair = _pair(a["starter"], c)
        both = lambda new: F.struct(a["done"].alias("done"), new.alias("starter"), a["tail"].alias("tail"), a["last"].alias("last")).cast(kind)
        new = F.struct(F.concat(a["done"], a["starter"], a["tail"]).alias("done"), c.alias("starter"), F.lit("").alias("tail"), F.lit(0).alias("last")).cast(kind)
        more = F.struct(a["done"].alias("done"), a["starter"].alias("starter"), F.concat(a["tail"], c).alias("tail"), own.alias("last")).cast(kind)
        return let(F.when(free, pair), lambda p: F.when(p.isNotNull(), both(p)).when(own == 0, new).otherwise(more))

    out = F.aggregate(_sorted(cluster), start, step)
    return let(out, lambda a: F.concat(a["done"], a["starter"], a["tail"]))


def _each(text: Column, form) -> Column:
    """A text with its clusters in a form; each different cluster is made once."""
    _, _, joining, single, _ = tables()
    changing = f"{joining}|{single}"
    every = rf"(?s)[\x{{0}}-\x{{2ff}}]+(?!{joining})|(?:(?!{joining}).)?{joining}+|."

    def put(parts: Column) -> Column:
        own = F.array_distinct(F.filter(parts, lambda p: p.rlike(changing)))
        made = F.map_from_arrays(own, F.transform(own, form))
        return let(made, lambda m: joined(F.transform(parts, lambda p: F.coalesce(F.try_element_at(m, p), p))))

    return F.when(text.rlike(changing), let(pieces(text, every), put)).otherwise(text)


def nfc(text: Column) -> Column:
    """Normal form C."""
    return _each(text, _composed)
