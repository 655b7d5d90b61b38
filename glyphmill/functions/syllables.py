"""Romanized syllables as columns: marked and keyboard forms, their parts, translation between systems, variants of pronunciation.

Everything is a Spark expression over rule tables, so a conversion runs in the JVM. Texts that repeat should be converted once each:
``translated`` plans that (distinct texts, one conversion each, join).
"""

from __future__ import annotations

from functools import cache
from itertools import permutations, product
from unicodedata import normalize

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.columns import any_of, joined, let, longest_first, lookup, pieces, restored, subs
from glyphmill.functions.systems import CHECKED, DIRECT, PIVOT, System, named

# Character classes of the two forms.
LETTERS = r"a-zA-Z²³¹À-ɏ̀-ͯḀ-ỿ⁰-ⁿ'"
TYPED = r"a-zA-Z0-9À-ɏ̀-ͯḀ-ỿ'ⁿ\-"
SPOKEN = r"A-Za-zÀ-ỿ͘ⁿ"
SUPER, PLAIN = "⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789"


@cache
def _composed() -> dict[str, str]:
    """Spellings of a letter with a combining mark, or with a tone mark and dots below or a dot above right, and their NFC form, where
    it differs."""
    marks, dots = "\u0300\u0301\u0302\u0303\u0304\u030c\u030d\u0324\u0358", "\u0324\u0358"
    found = {}
    for letter in "aeiounmAEIOUNM":
        for some in [(m,) for m in marks] + [(m, d) for m, d in product(marks, dots) if m not in dots]:
            form = normalize("NFC", letter + "".join(some))
            for order in permutations(some):
                for cut in range(len(order) + 1):
                    spelled = normalize("NFC", letter + "".join(order[:cut])) + "".join(order[cut:])
                    if spelled != normalize("NFC", spelled):
                        found[spelled] = normalize("NFC", spelled)
            found.pop(form, None)
    return found


def nfc(text: Column) -> Column:
    """Unicode normal form C for Latin letters with combining marks; texts without combining marks are left alone."""
    composed = lambda t: joined(F.transform(pieces(t, r"(?s)[^\p{M}]?\p{M}+|[^\p{M}]+?(?=[^\p{M}]\p{M}|$)"), lambda c: lookup(_composed(), c)))
    return let(text, lambda t: F.when(t.rlike(r"\p{M}"), composed(t)).otherwise(t))


def _spelled(base: Column, s: System, all_rules: bool) -> Column:
    """Marked signs as letters: every rule, or only the first that applies."""
    if all_rules:
        for sign, letters in s.spelling.items():
            base = F.replace(base, F.lit(sign), F.lit(letters))
        return base
    out = base
    for sign, letters in reversed(s.spelling.items()):
        out = F.when(F.contains(base, F.lit(sign)), F.replace(base, F.lit(sign), F.lit(letters))).otherwise(out)
    return out


def _read_marks(text: Column, s: System) -> Column:
    """A syllable with tone marks in letters and a digit: the vowels found from left to right, the longest first, give vowel and tone."""
    forms = longest_first(f for row in s.vowels.values() for f in row)
    plain = [f for f in forms if f in ("n", "m")]
    choice = "|".join(any_of([f]) + r"(?!\p{M})" + ("(?!g)" if f in plain else "") for f in forms)
    ends = text.rlike(f"(?:{any_of(s.stops.split())})$")
    free, stopped = ({k: f"{v}|{t}|{int(m)}" for k, (v, t, m) in s.readings(c).items()} for c in (False, True))
    found = F.transform(pieces(text, f"(?s){choice}|."), lambda x: F.split(F.when(ends, lookup(stopped, x, F.concat(x, F.lit("||")))).otherwise(lookup(free, x, F.concat(x, F.lit("||")))), r"\|"))

    def finish(parts: Column) -> Column:
        base = joined(F.transform(parts, lambda p: F.get(p, F.lit(0))))
        toned = F.filter(F.transform(parts, lambda p: F.struct(F.get(p, F.lit(1)).try_cast("int").alias("t"), (F.get(p, F.lit(2)) == "1").alias("m"))), lambda x: x["t"].isNotNull())
        strong = F.filter(toned, lambda x: x["m"] & (x["t"] > 1))
        tone = F.coalesce(F.try_element_at(strong, F.lit(-1))["t"], F.get(toned, F.lit(0))["t"], F.lit(1))
        single = [e for e in s.stops.split() if len(e) == 1]
        tone = F.when(~tone.isin(*CHECKED) & base.rlike(f"[{''.join(single)}]$"), F.when(tone > 1, 8).otherwise(4)).otherwise(tone)
        return F.concat(_spelled(subs(base, (r"(?U)\d", "")), s, False), tone.cast("string"))

    return let(found, finish)


def keyboard_syllable(text: Column, system: str) -> Column:
    """A marked syllable in small letters as letters and a tone digit. One that has a digit is only respelled."""
    s = named(system)

    def convert(x: Column) -> Column:
        tone = F.regexp_extract(x, r"(?U)(\d)$", 1)
        body = F.when(tone != "", F.substring(x, F.lit(1), F.length(x) - 1)).otherwise(x)
        typed = F.concat(_spelled(body, s, True), tone)
        has_digit = x.rlike(f"(?U)[\\d{SUPER}]")
        return F.when(x == "", x).when(has_digit & ~typed.rlike(r"\p{M}"), typed).otherwise(let(F.when(has_digit, typed).otherwise(x), lambda y: _read_marks(y, s)))

    return let(F.translate(nfc(text), SUPER, PLAIN) if s.superscript else nfc(text), convert)


def keyboard(text: Column, system: str) -> Column:
    """A text in marked form as typed: every syllable converted, all else kept."""
    parts = pieces(text, rf"(?s)[{LETTERS}]+\d*|[^{LETTERS}]")
    return joined(F.transform(parts, lambda p: F.when(p.rlike(rf"^[{LETTERS}]"), restored(keyboard_syllable(F.lower(p), system), p)).otherwise(p)))


def _marked_at(base: Column, vowel: Column, tone: Column, s: System) -> Column:
    """The vowel's last place in base takes the tone mark."""
    at = F.length(base) - F.instr(F.reverse(base), F.reverse(vowel)) - F.length(vowel) + 2
    return F.concat(F.substring(base, F.lit(1), at - 1), lookup(s.marked(), F.concat(vowel, tone)), F.substring(base, at + F.length(vowel), F.length(base)))


def marked_syllable(text: Column, system: str) -> Column:
    """A typed syllable with its tone mark. One without a tone digit stays."""
    s = named(system)
    order = s.priority.split()
    digit = lambda t: F.translate(t, PLAIN, SUPER) if s.superscript else t

    def convert(x: Column) -> Column:
        tone = F.regexp_extract(x, r"(\d)$", 1)
        base = F.substring(x, F.lit(1), F.length(x) - 1)
        for sign, letters in s.spelling.items():
            base = subs(base, (f"{letters}$", sign))
        return let(F.struct(base.alias("base"), tone.alias("tone")), mark)

    def mark(x: Column) -> Column:
        base, tone = x["base"], x["tone"]
        plain = F.concat(base, digit(tone))
        if not order:
            return plain
        first = F.get(F.filter(F.array(*map(F.lit, order)), lambda v: F.contains(base, v)), F.lit(0))
        out = let(first, lambda v: F.when(v.isNotNull() & tone.rlike("[1-8]"), _marked_at(base, v, tone, s)).otherwise(plain))
        consonant = base.rlike(f"^(?:{any_of(i for i in s.initials.split() if i[0] not in 'aeiou')})")
        if s.bare:
            own = lookup(s.bare_marked(), F.concat(base, tone), F.lit(None).cast("string"))
            out = F.when(~consonant & own.isNotNull(), own).otherwise(out)
        if s.stop_marks_inside:
            stem = rf"^(.*)({any_of(order)})(.*)([{''.join(s.stops.split())}])$"
            inside = F.concat(F.regexp_extract(base, stem, 1), lookup(s.marked(), F.concat(F.regexp_extract(base, stem, 2), tone)), F.regexp_extract(base, stem, 3), F.regexp_extract(base, stem, 4))
            out = F.when(tone.isin("4", "8") & base.rlike(stem), inside).otherwise(out)
        return out

    return F.when(text.rlike(r"(?s)^.+\d$"), let(text, convert)).otherwise(text)


def handwriting(text: Column, system: str) -> Column:
    """A typed text in marked form."""
    one = lambda p: restored(marked_syllable(F.lower(p), system), p, upper_with_digits=False)
    word = lambda w: F.array_join(F.transform(F.split(w, "-", -1), one), "-")
    parts = pieces(text, f"(?s)[{TYPED}]+|[^{TYPED}]")
    return nfc(joined(F.transform(parts, lambda p: F.when(p.rlike(f"^[{TYPED}]") & ~p.startswith("ⁿ"), word(p)).otherwise(p))))


def parts_of(base: Column, source: str, target: str) -> Column:
    """(initial, vowel, ending) of a syllable without tone: it is an initial alone, or has the longest ending and then the longest
    initial that fit."""
    a, b = named(source), named(target)
    initials = any_of(longest_first(a.initials.split()))
    endings = any_of(longest_first(f"{a.stops} {a.nasals} {b.stops} {b.nasals}".split()))
    whole, cut = rf"^(?:{initials})$", rf"^(.+?)({endings})$"

    def split(x: Column) -> Column:
        ending = F.regexp_extract(x, cut, 2)
        rest = F.substring(x, F.lit(1), F.length(x) - F.length(ending))
        initial = F.regexp_extract(rest, f"^(?:{initials})", 0)
        none = F.lit("")
        usual = F.struct(initial.alias("initial"), F.substring(rest, F.length(initial) + 1, F.length(rest)).alias("vowel"), ending.alias("ending"))
        return F.when(x.rlike(whole), F.struct(x.alias("initial"), none.alias("vowel"), none.alias("ending"))).otherwise(usual)

    return let(F.lower(base), split)


def _leg(typed: Column, source: str, target: str) -> Column:
    """Typed syllables of one system in the letters of another; one of the two is the pivot."""
    a, b = named(source), named(target)
    maps = a.to_pivot if b.name == PIVOT else b.from_pivot
    front, nasal = ({}, {}) if b.name == PIVOT else (b.before_front, b.nasal_first)

    def one(x: Column) -> Column:
        tone = F.regexp_extract(x, r"(\d)$", 1)
        return let(F.struct(parts_of(F.substring(x, F.lit(1), F.length(x) - F.length(tone)), source, target).alias("p"), tone.alias("tone")), put)

    def put(x: Column) -> Column:
        initial, vowel, ending = (x["p"][k] for k in ("initial", "vowel", "ending"))

        def mapped(kind: str, part: Column) -> Column:
            table = maps.get(kind, {})
            out = lookup({k: v for k, v in table.items() if not callable(v)}, part)
            for k, v in table.items():
                out = F.when(part == k, v(initial, vowel, ending)).otherwise(out) if callable(v) else out
            return out

        new = mapped("initial", initial)
        if front:
            new = F.when(vowel.rlike("^[ie]"), lookup(front, initial, new)).otherwise(new)
        first = lookup({k: v[0] for k, v in nasal.items()}, ending, F.lit(""))
        left = lookup({k: v[1] for k, v in nasal.items()}, ending)
        return F.concat(new, first, mapped("vowel", vowel), mapped("ending", left), x["tone"])

    parts = pieces(typed, rf"(?s)[{SPOKEN}]+\d?|[^{SPOKEN}]")
    return joined(F.transform(parts, lambda p: F.when(p.rlike(f"^[{SPOKEN}]"), one(p)).otherwise(p)))


def _same(typed: Column, system: str) -> Column:
    parts = pieces(typed, rf"(?s)[{SPOKEN}]+\d?|[^{SPOKEN}]")
    return joined(F.transform(parts, lambda p: F.when(p.rlike(f"^[{SPOKEN}]"), F.lower(p)).otherwise(p)))


def translate(text: Column, source: str, target: str) -> Column:
    """A text from one system's marked form to another's: by a registered direct translator, else through the pivot where neither is it."""
    a, b = named(source).name, named(target).name
    if own := DIRECT.get((a.upper(), b.upper())):
        return own(text)
    if a == b:
        return handwriting(_same(keyboard(text, a), a), a)
    if PIVOT in (a, b):
        return handwriting(_leg(keyboard(text, a), a, b), b)
    return translate(translate(text, a, PIVOT), PIVOT, b)


def translated(df: DataFrame, column: str, source: str, target: str, into: str) -> DataFrame:
    """df with a column translated: each distinct text is converted once and joined back. Spark broadcasts the table of texts if its
    size allows that, and splits hot texts otherwise."""
    known = df.select(F.col(column).alias("__text")).where("__text is not null").distinct()
    known = known.withColumn(into, translate(F.col("__text"), source, target))
    return df.join(known, df[column] == known["__text"], "left").drop("__text")


def variants(text: Column, system: str) -> Column:
    """All variants of pronunciation: each rule that fits any syllable gives its alternatives, applied to all syllables alike; the
    alternatives of several rules are combined."""
    syllable = r"[A-Za-zÀ-ỿ̀-ͯⁿ]+"
    whole = r"(?=[^A-Za-zÀ-ỿ̀-ͯⁿ]|$)"

    def applied(all_: Column, pattern: str, news: list[str]) -> Column:
        fits = F.exists(pieces(text, syllable), lambda s: s.rlike(pattern))
        at = pattern.replace("$", whole)
        spread = lambda some: F.flatten(F.transform(some, lambda t: F.array(*[F.regexp_replace(t, at, x) for x in news])))
        return let(all_, lambda some: F.when(fits, spread(some)).otherwise(some))

    out = F.array(text)
    for pattern, news in named(system).variants.items():
        out = applied(out, pattern, news)
    return F.array_distinct(out)
