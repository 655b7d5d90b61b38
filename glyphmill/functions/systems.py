"""Romanization systems as data: tone marks, initials, endings, and how syllable parts map to and from the pivot LATN_NORM."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from unicodedata import category, normalize

from pyspark.sql import Column

PIVOT = "LATN_NORM"
TONES = range(1, 9)
CHECKED = (4, 8)


def marks(table: str) -> dict[str, list[str]]:
    """Lines of a vowel and its eight marked forms."""
    return {row[0]: row[1:] for row in (line.split() for line in table.strip().splitlines())}


def digits(vowels: str) -> dict[str, list[str]]:
    return {v: [f"{v}{t}" for t in TONES] for v in vowels.split()}


@dataclass(frozen=True)
class System:
    name: str
    vowels: dict[str, list[str]]
    initials: str
    priority: str = ""
    nasals: str = "m n ng"
    stops: str = "p t k h"
    spelling: dict[str, str] = field(default_factory=dict)
    stop_marks_inside: bool = False
    bare: dict[str, list[str]] = field(default_factory=dict)
    superscript: bool = False
    # A value may be a function of the syllable's parts (initial, vowel, ending), as columns.
    to_pivot: dict[str, dict[str, str | Callable[[Column, Column, Column], Column]]] = field(default_factory=dict)
    from_pivot: dict[str, dict[str, str | Callable[[Column, Column, Column], Column]]] = field(default_factory=dict)
    before_front: dict[str, str] = field(default_factory=dict)
    nasal_first: dict[str, tuple[str, str]] = field(default_factory=dict)
    algebra: tuple[str, ...] = ()
    variants: dict[str, list[str]] = field(default_factory=dict)

    def marked(self) -> dict[str, str]:
        return {f"{v}{t}": forms[t - 1] for v, forms in self.vowels.items() for t in TONES}

    def bare_marked(self) -> dict[str, str]:
        return {f"{v}{t}": forms[t - 1] for v, forms in self.bare.items() for t in TONES}

    def readings(self, checked: bool) -> dict[str, tuple[str, int, bool]]:
        """What a marked vowel stands for: vowel, tone, and whether it bears a mark. Several tones may share a form: in a checked
        syllable the first of tones 4 and 8 is meant, in another the last that isn't 1, 4 or 8."""
        found: dict[str, list[tuple[str, int]]] = {}
        for vowel, forms in self.vowels.items():
            for tone in TONES:
                found.setdefault(forms[tone - 1], []).append((vowel, tone))
        out = {}
        for form, options in found.items():
            fit = [o for o in options if o[1] in CHECKED][:1] if checked else [o for o in options if o[1] not in (1, *CHECKED)][-1:]
            vowel, tone = (fit if len(options) > 1 and fit else options)[0]
            out[form] = (vowel, tone, normalize("NFD", form) != form or any(category(c)[0] == "M" for c in form))
        return out


# The systems' orthography.
SYSTEMS: dict[str, System] = {}


def register(system: System) -> None:
    SYSTEMS[system.name.upper()] = system


#: Direct translators, by source and target: functions of a column in marked form.
DIRECT: dict[tuple[str, str], Callable[[Column], Column]] = {}


def register_direct(source: str, target: str, translator: Callable[[Column], Column]) -> None:
    """From now on translate() uses this function from source to target, and not the way through the pivot."""
    DIRECT[named(source).name.upper(), named(target).name.upper()] = translator


def named(name: str) -> System:
    if name.upper() not in SYSTEMS:
        raise ValueError(f"unknown romanization system {name}; known: {', '.join(SYSTEMS)}")
    return SYSTEMS[name.upper()]


register(
    System(
        "POJ",
        marks("""
            a a á à a â ǎ ā a̍
            e e é è e ê ě ē e̍
            i i í ì i î ǐ ī i̍
            o o ó ò o ô ǒ ō o̍
            oo o͘ ó͘ ò͘ o͘ ô͘ ǒ͘ ō͘ o̍͘
            or o̤ ó̤ ò̤ o̤ ô̤ ǒ̤ ō̤ o̤̍
            u u ú ù u û ǔ ū u̍
            ur ṳ ṳ́ ṳ̀ ṳ ṳ̂ ṳ̌ ṳ̄ ṳ̍
            oa oa óa òa oa ôa ǒa ōa oa̍
            oe oe óe òe oe ôe ǒe ōe oe̍
            oai oai oái oài oai oâi oǎi oāi oa̍i
            oan oan oán oàn oat oân oǎn oān oa̍t
            oang oang oáng oàng oak oâng oǎng oāng oa̍k
            ui ui úi ùi ui ûi ǔi ūi ui̍
            iu iu iú iù iu iû iǔ iū iu̍
            n n ń ǹ n n̂ ň n̄ n̍
            m m ḿ m̀ m m̂ m̌ m̄ m̍
        """),
        initials="chh ch ph th kh ng p b m t n l k g h s j",
        priority="oai oan oang oa oe a oo or e o ui iu ur u i n m",
        spelling={"ⁿ": "nn", "̤": "r", "ṳ": "ur"},
        to_pivot={"vowel": {"oo": "ou", "oa": "ua", "oe": "ue"}},
        from_pivot={"vowel": {"ou": "oo", "ua": "oa", "ue": "oe"}},
        algebra=("xform/ou/oo/", "xform/ua/oa/", "xform/ue/oe/", "derive/nn//"),
    )
)
register(
    System(
        "TL",
        marks("""
            a a á à a â ǎ ā a̍
            e e é è e ê ě ē e̍
            i i í ì i î ǐ ī i̍
            o o ó ò o ô ǒ ō o̍
            oo oo óo òo oo ôo ǒo ōo o̍o
            u u ú ù u û ǔ ū u̍
            n n ń ǹ n n̂ ň n̄ n̍
            m m ḿ m̀ m m̂ m̌ m̄ m̍
        """),
        initials="tsh ts ph th kh ng p b m t n l k g h s j",
        priority="a oo e o u i n m",
        spelling={"ⁿ": "nn"},
        to_pivot={"initial": {"ts": "ch", "tsh": "chh"}},
        from_pivot={"initial": {"ch": "ts", "chh": "tsh"}},
        algebra=("derive/nn//",),
    )
)
register(
    System(
        "PUJ",
        marks("""
            a a á à a â ã ā a̍
            e e é è e ê ẽ ē e̍
            i i í ì i î ĩ ī i̍
            o o ó ò o ô õ ō o̍
            u u ú ù u û ũ ū u̍
            ur ṳ ṳ́ ṳ̀ ṳ ṳ̂ ṳ̃ ṳ̄ ṳ̍
            n n ń ǹ n n̂ ñ n̄ n̍
            m m ḿ m̀ m m̂ m̃ m̄ m̍
            ua ua úa ùa ua ûa ũa ūa u̍a
            uaⁿ uaⁿ úaⁿ ùaⁿ uaⁿ ûaⁿ ũaⁿ ūaⁿ u̍aⁿ
            uai uai uái uài uai uâi uãi uāi ua̍i
            uan uan uán uàn uan uân uãn uān ua̍n
            uang uang uáng uàng uang uâng uãng uāng ua̍ng
            ueng ueng uéng uèng ueng uêng uẽng uēng ue̍ng
        """),
        initials="tsh chh ts ch ph th kh ng p b m t n l k g h s j z",
        priority="uai uan uang uaⁿ ua ueng a o ur u e i n m",
        spelling={"ⁿ": "nn"},
        stop_marks_inside=True,
        bare=marks("""
            au au aú aù au aû aũ aū au̍
            ua ua uá uà ua uâ uã uā ua̍
            ue ue ué uè ue uê uẽ uē ue̍
            uaⁿ uaⁿ uáⁿ uàⁿ uaⁿ uâⁿ uãⁿ uāⁿ ua̍ⁿ
        """),
        to_pivot={"initial": {"ts": "ch", "tsh": "chh", "z": "j"}},
        from_pivot={"initial": {"ch": "ts", "chh": "tsh", "j": "z"}},
        before_front={"ch": "ch", "chh": "chh", "j": "j"},
        algebra=("derive/^ch/ts/", "derive/^j/z/", "derive/oinn$/ainn/", "derive/ien$/ian/", "derive/iet/iat/", "derive/([aeiu])n$/$1ng/", "derive/t$/k/", "derive/nn//"),
        variants={"ṳ": ["ṳ", "u", "i"], "oiⁿ": ["oiⁿ", "aiⁿ"], "t$": ["k"], "n$": ["ng"]},
    )
)
register(
    System(
        "BP",
        marks("""
            a ā ǎ à ā á a â á
            e ē ě è ē é e ê é
            i ī ǐ ì ī í i î í
            o ō ǒ ò ō ó o ô ó
            oo ōo ǒo òo ōo óo oo ôo óo
            u ū ǔ ù ū ú u û ú
            n n ň ǹ n ń n n̂ ń
            m m m̌ m̀ m ḿ m m̂ ḿ
        """),
        initials="bbn ggn gg bb zz ln b p m d t n l g k h z c r s",
        priority="a oo e o u i n m",
        to_pivot={
            "initial": {"b": "p", "p": "ph", "bb": "b", "bbn": "m", "ln": "n", "dd": "d", "d": "t", "t": "th", "g": "k", "k": "kh", "ggn": "ng", "gg": "g", "z": "ch", "c": "chh", "zz": "j"},
            "vowel": {"oo": "ou", "ao": "au"},
        },
        from_pivot={
            "initial": {"p": "b", "ph": "p", "b": "bb", "m": "bbn", "n": "ln", "d": "dd", "t": "d", "th": "t", "k": "g", "kh": "k", "ng": "ggn", "g": "gg", "ch": "z", "chh": "c", "j": "zz"},
            "vowel": {"ou": "oo", "au": "ao"},
        },
        nasal_first={"nn": ("n", ""), "nnh": ("n", "h")},
        algebra=("xform/ou/oo/", "xform/au/ao/", "xform/([aeiou]+)nnh$/n$1h/", "xform/([aeiou]+)nn$/n$1/"),
    )
)
register(
    System(
        "DP",
        digits("a e ê i o u n m"),
        initials="gh bh ng b p m d t n l g k h z c r s",
        stops="b d g h",
        spelling={"ⁿ": "nn"},
        superscript=True,
        to_pivot={
            "initial": {"b": "p", "p": "ph", "bh": "b", "d": "t", "t": "th", "g": "k", "k": "kh", "gh": "g", "z": "ch", "c": "chh", "r": "j"},
            "vowel": {"e": "ur", "ê": "e", "uê": "ue", "iê": "ie", "ao": "au"},
            "ending": {"b": "p", "d": "t", "g": "k"},
        },
        from_pivot={
            "initial": {"p": "b", "ph": "p", "b": "bh", "t": "d", "th": "t", "k": "g", "kh": "k", "g": "gh", "ch": "z", "chh": "c", "j": "r"},
            "vowel": {"ur": "e", "e": "ê", "ue": "uê", "ie": "iê", "au": "ao"},
            "ending": {"p": "b", "t": "d", "k": "g"},
        },
        # ian$ keeps its dollar sign, as in the published rules.
        algebra=("xform/ur/v/", "xform/au/ao/", "derive/oinn/ainn/", "derive/ien$/ian$/", "derive/ied/iad/", "derive/([aeiu])n$/$1ng/", "derive/d$/g/", "derive/nn//"),
    )
)
register(System(PIVOT, digits("a e i o u ur n m"), initials="chh ch ph th kh ng p b m t n l k g h s j", nasals="m n ng nn", stops="nnh p t k h"))
