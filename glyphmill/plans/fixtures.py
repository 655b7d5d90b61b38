"""Queries on small tables of cases: inputs go to Spark, what must come out stands in the SQL only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions import text as T
from glyphmill.functions.syllables import handwriting, keyboard, nfc, parts_of, translate, translated, variants
from glyphmill.operators import extract as X
from glyphmill.operators import lexicon as L
from glyphmill.operators import lookup as R
from glyphmill.operators import sections as S
from glyphmill.operators import validate as V
from glyphmill.operators.spelling import respelled

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _sql(v) -> str:
    if v is None:
        return "NULL"
    return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


def case(name: str, columns: str, want: list[tuple]):
    """Registers a query with the rows that it must give."""
    names = ", ".join(columns.split())
    ORACLES[name] = f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(_sql, w)) + ')' for w in want)}) AS t({names})"

    def keep(make: Callable[[SparkSession], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: make(spark).select(*columns.split())
        return make

    return keep


def column_case(name: str, function, pairs: list[tuple[str, str]]) -> None:
    """A column function: input and output of each case."""
    case(name, "given found", pairs)(lambda spark: spark.createDataFrame([(a,) for a, _ in pairs], "given string").select("given", function(F.col("given")).alias("found")))


# Typed and written forms, made up syllable by syllable from the orthographies.
PAIRS = {
    "poj": [
        ("kha1", "kha"), ("kha2", "khá"), ("kha3", "khà"), ("kha5", "khâ"), ("kha7", "khā"), ("thak4", "thak"), ("thak8", "tha̍k"), ("beh4", "beh"), ("beh8", "be̍h"), ("lok8", "lo̍k"),
        ("hoe2", "hóe"), ("hoe5", "hôe"), ("goan2", "goán"), ("goan5", "goân"), ("khoai3", "khoài"), ("koan1", "koan"), ("iau2", "iáu"), ("siu7", "siū"), ("tiu5", "tiû"), ("lun7", "lūn"),
        ("peng5", "pêng"), ("sng3", "sǹg"), ("png7", "pn̄g"), ("thinn1", "thiⁿ"), ("inn5", "îⁿ"), ("phinn7", "phīⁿ"), ("khoo3", "khò͘"), ("boo2", "bó͘"), ("hoo7", "hō͘"), ("Tai5-gi2", "Tâi-gí"),
    ],
    "puj": [
        ("kha1", "kha"), ("kha2", "khá"), ("kha6", "khã"), ("sua2", "súa"), ("sue3", "sùe"), ("hun5", "hûn"), ("tsur2", "tsṳ́"), ("hur6", "hṳ̃"), ("siang7", "siāng"), ("khiam6", "khiãm"), ("bak8", "ba̍k"),
        ("tshut4", "tshut"), ("soinn1", "soiⁿ"), ("phinn7", "phīⁿ"), ("uan2", "uán"), ("ueh8", "ue̍h"), ("ang5", "âng"), ("png7", "pn̄g"), ("tuann5", "tûaⁿ"), ("hiann1", "hiaⁿ"), ("guan2", "guán"),
    ],
    "tl": [
        ("kha2", "khá"), ("kha3", "khà"), ("kha5", "khâ"), ("kha7", "khā"), ("thak8", "tha̍k"), ("tshit4", "tshit"), ("thoo2", "thóo"), ("hue3", "huè"), ("kuai3", "kuài"), ("tsiu2", "tsiú"), ("sng3", "sǹg"),
        ("png7", "pn̄g"), ("thinn1", "thiⁿ"), ("sik8", "si̍k"), ("gua2", "guá"), ("lang5", "lâng"),
    ],
    "bp": [("ma2", "mǎ"), ("sim1", "sīm"), ("gong1", "gōng"), ("bbe3", "bbè"), ("lak4", "lāk"), ("lak8", "lák"), ("hoo2", "hǒo"), ("kao3", "kào"), ("sun2", "sǔn"), ("lim1", "līm"), ("gio2", "giǒ")],
    "dp": [("nang5", "nang⁵"), ("cêng2", "cêng²"), ("bêh8", "bêh⁸"), ("dag4", "dag⁴"), ("sim1", "sim¹"), ("ngou6", "ngou⁶")],
}
for _system, _pairs in PAIRS.items():
    column_case(f"t4_keyboard_{_system}", lambda c, s=_system: keyboard(c, s), [(b, a) for a, b in _pairs])
    column_case(f"t7_handwriting_{_system}", lambda c, s=_system: handwriting(c, s), _pairs)

SPOKEN = {
    ("poj", "bp"): [("sin", "sīn"), ("kha̍p", "káp"), ("hoe", "huē"), ("chiú", "ziǔ"), ("thâu", "táo"), ("bó", "bbǒ"), ("gû", "ggú"), ("khai", "kāi"), ("tē", "dê"), ("lâi", "lái")],
    ("poj", "puj"): [("kim", "kim"), ("goá", "gúa"), ("chúi", "tsúi"), ("thâu", "thâu"), ("hoe", "hue"), ("sêng", "sêng"), ("chhut", "tshut"), ("kha̍p", "kha̍p"), ("tē", "tē")],
    ("poj", "tl"): [("chhài", "tshài"), ("chúi", "tsúi"), ("hoe", "hue"), ("koan", "kuan"), ("chiah", "tsiah"), ("ōe", "uē"), ("góa", "guá"), ("boe", "bue"), ("chhat", "tshat")],
    ("puj", "dp"): [("kim", "gim¹"), ("tsúi", "zui²"), ("thâu", "tao⁵"), ("hue", "huê¹"), ("bak", "bhag⁴"), ("hṳ", "he¹"), ("sueh", "suêh⁴"), ("tshut", "cud⁴"), ("pit", "bid⁴")],
}
for (_a, _b), _pairs in SPOKEN.items():
    column_case(f"t10_{_a}_{_b}", lambda c, a=_a, b=_b: translate(c, a, b), _pairs)

case("t11_pivot", "code poj puj", [("ainn1", "aiⁿ", "aiⁿ"), ("ng5", "n̂g", "n̂g"), ("m7", "m̄", "m̄"), ("innh8", "i̍nnh", "inn̍h"), ("chhiu2", "chhiú", "chhiú"), ("chua3", "chòa", "tsùa")])(
    lambda spark: spark.createDataFrame([(c,) for c in ("ainn1", "ng5", "m7", "innh8", "chhiu2", "chua3")], "code string").select("code", translate(F.col("code"), "latn_norm", "poj").alias("poj"), translate(F.col("code"), "latn_norm", "puj").alias("puj"))
)
case("t8_parts", "base initial vowel ending", [("ng", "ng", "", ""), ("pang", "p", "a", "ng"), ("chhiunn", "chh", "iu", "nn"), ("a", "", "a", ""), ("sannh", "s", "a", "nnh"), ("m", "m", "", "")])(
    lambda spark: spark.createDataFrame([(c,) for c in ("ng", "pang", "chhiunn", "a", "sannh", "m")], "base string").select("base", parts_of(F.col("base"), "latn_norm", "poj").alias("p")).select("base", "p.initial", "p.vowel", "p.ending")
)
case("t14_variants", "given found", [("hṳ kut", "hṳ kuk"), ("hṳ kut", "hu kuk"), ("hṳ kut", "hi kuk"), ("poiⁿ", "poiⁿ"), ("poiⁿ", "paiⁿ"), ("lin", "ling"), ("tṳn-mit", "tṳng-mik"), ("tṳn-mit", "tung-mik"), ("tṳn-mit", "ting-mik"), ("bo", "bo")])(
    lambda spark: spark.createDataFrame([(c,) for c in ("hṳ kut", "poiⁿ", "lin", "tṳn-mit", "bo")], "given string").select("given", F.explode(variants(F.col("given"), "puj")).alias("found"))
)
column_case("p18_nfc", nfc, [("á", "á"), ("pe̍h", "pe̍h"), ("ñg", "ñg"), ("plain", "plain"), ("ṳ́", "ṳ́"), ("漢", "漢"), ("ó͘", "ó͘")])

column_case("p01_original_cases", T.original, [("x~~山~~y", "x山y"), ("~~山~~(川)", "山"), ("~~風雨~~()", "風雨"), ("++石++z", "z"), ("a++++b", "ab"), ("口[訓]", "口[訓]"), ("c[替]d", "cd")])
column_case("p02_modified_cases", lambda c: T.modified(c, "〔〕"), [("x~~山~~y", "xy"), ("~~山~~(川)", "川"), ("~~風雨~~()", "〔〕"), ("++石++z", "石z"), ("a++++b", "a〔〕b"), ("口[訓]", "口[訓]")])
column_case("p05_lower_first_cases", lambda c: T.lower_first(c, ["China", "God"]), [("House", "house"), ("China tea", "China tea"), ("A", "A"), ("USA flag", "USA flag"), ("", ""), ("already", "already"), ("God", "God")])
column_case("p06_english_key", T.english_key, [("the House of Lords", "House-of-Lords"), ("#x", ""), (":y", ""), ("--to run", "run"), ("tea — a drink", "tea"), ('big "very" dog [n.]', "big-dog"), ("a b c d e f", "b-c-d-e-f"), ("u v w x y z", ""), ("to", "to"), ("go then", "go"), ("cat means animal", "cat")])
column_case("p07_untagged", T.untagged, [("人[訓]", "人"), ("[食飯]", "食飯"), ("a[b]", "a[b]"), ("[白][x]", "x")])
column_case("p12_nasal_repair", T.repaired_nasal, [("saⁿ̌g", "sanňg"), ("ⁿ̌m", "nňm"), ("ⁿ̌k", "ⁿ̌k")])
column_case("p13_syllable_repair", T.repaired_syllables, [("ⁿ̌g-lang", "nňg-lang"), ("a/ⁿ̌g", "a/nňg"), ("xⁿ̌g", "xⁿ̌g")])
column_case("p14_annotations", T.annotations, [("[x]", "x"), ("a (b) c", "a [b] c"), ("[x]y", "[x]y")])
column_case("p15_han_only", T.han_only, [("食pn̄g飯", "食飯"), ("abc", ""), ("㐀䶵", "㐀䶵")])
column_case("p16_syllabary_han", lambda c: F.array_join(T.syllabary_han(c), "|"), [('<img src="人">大<span>小</span>中', "大|中"), ("𠀾孬", "𠀾|孬"), ("x", "")])
column_case("p17_peng_im", T.peng_im, [("ba1", "ba¹"), ("e2", "ê²"), ("vn5", "eⁿ⁵"), ("sap4", "sab⁴"), ("cut8", "cud⁸"), ("pak", "pag"), ("ien1", "iêⁿ¹")])
column_case("p19_slug", T.slug, [(" Lesson 1. Numbers. ", "Lesson_1_Numbers"), ("__a  b__", "a_b"), ("漢字 (x)", "漢字_x"), ("x" * 90, "x" * 80)])
column_case("p20_published", T.published, [("人[訓]大[音]", "人大"), ("[白]x[俗]", "x[俗]")])
column_case("p04_split_outside", lambda c: F.array_join(T.split_outside(c, ","), "|"), [("a, b", "a|b"), ("~~a,b~~(c,d), e", "~~a,b~~(c,d)|e"), (",,x", "x"), ("one", "one")])
column_case("p23_pinyin_keys", lambda c: F.array_join(T.pinyin_keys(c, {"他": "ta1", "們": "men5", "好": "hao3"}), "|"), [("他們、好", "tamen|hao"), ("x，好", "hao"), ("", "")])


@case("x3_cycled_pairs", "poj tl han", [("a", "x", "字"), ("b", "y", "字"), ("c", "x", "字"), ("tsi", "", ""), ("", "k", "")])
def _(spark):
    rows = [("a/b/c", "x/y", "字", "", "", ""), ("tsi", None, "字a", "", "", ""), (None, "k", "", "", "", ""), (None, None, "字", "", "", ""), ("食x", "k", "", "", "", "")]
    return X.word_table(spark.createDataFrame(rows, "PojUnicode string, KipUnicode string, HanLoTaibunPoj string, HanLoTaibunKip string, HoaBun string, EngBun string"), F.lit("t"))


@case("x3_word_table", "poj tl han en zh_TW source", [("chhùi", "tshuì", "喙", "mouth", "嘴巴", "words > t"), ("kóng", "kóng", "講", "", "", "words > t")])
def _(spark):
    rows = [("chhùi", "tshuì", "喙", "喙", "嘴巴", "mouth"), ("kóng", "kóng", "", "講", None, None)]
    return X.word_table(spark.createDataFrame(rows, "PojUnicode string, KipUnicode string, HanLoTaibunPoj string, HanLoTaibunKip string, HoaBun string, EngBun string"), F.lit("words > t"))


@case("x4_clippings", "puj poj han zh_TW en", [("i--nâng", "", "伊儂", "他們", "they"), ("i--nâng", "", "伊儂", "她們", "they"), ("", "lâng", "人", "", ""), ("", "lâng", "儂", "", "")])
def _(spark):
    rows = [("teochew.a", "i1--nang5", "伊儂", "他們|她們", "", "they"), ("hokkien", "lang5", "人 | 儂", None, "", None), ("other", "x1", "y", "z", "", "")]
    df = spark.createDataFrame(rows, "src string, latn_norm string, han string, zh_TW string, zh_CN string, en string")
    return X.clippings(df, F.col("src"))


@case("x5_readings", "dp han source", [("ba¹", "巴", "d > t")])
def _(spark):
    return X.readings(spark.createDataFrame([("巴", "ba1"), ("", "x1")], "text string, code string"), F.lit("d > t"))


BOOK = """# Lesson I
- **一  二** tsek, no̤ ... ... ... One ~~to~~(two)
# Words
- **Abandon, to** ká-sak; phiah-tiāu ... ... ... 棄  捒
- **„ (give up)** sĭ ... ... ... 捨
- **„** ~~x~~(pàng) sak ... ... ... 放捒  丢
not an item
- **Empty** ui ... ... ...
- **„** tò ... ... ... 倒"""


@case(
    "x1_handbook",
    "line_no part_no puj puj_orig han en en_orig source",
    [
        (1, 0, "tsek", "tsek", "一", "One two", "One to", "b > Lesson I"), (1, 1, "no̤", "no̤", "二", "One two", "One to", "b > Lesson I"),
        (3, 0, "ká-sak", "ká-sak", "棄", "Abandon, to", "Abandon, to", "b > Words"), (3, 1, "phiah-tiāu", "phiah-tiāu", "捒", "Abandon, to", "Abandon, to", "b > Words"),
        (4, 0, "sĭ", "sĭ", "捨", "Abandon, (give up)", "Abandon, (give up)", "b > Words"),
        (5, 0, "pàng sak", "x sak", "放捒", "Abandon", "Abandon", "b > Words"), (5, 1, "pàng sak", "x sak", "丢", "Abandon", "Abandon", "b > Words"),
        (8, 0, "tò", "tò", "倒", "Empty", "Empty", "b > Words"),
    ],
)
def _(spark):
    return X.handbook(X.lines_of(spark.createDataFrame([("b", BOOK)], "file string, text string")))


VOCABULARY = """# A
**Abase**, *one's self*, tsu pi; *v.t.*, pi lo̤h.
**Able**, ōi. *to do*, tsò̤ tit; hó tsò̤. See
**Abode**, see House &c.
**About**, num, *x*, kheh. *to* tó̤
plain"""


@case("x2_vocabulary", "line_no puj en source", [(1, "tsu pi", "Abase, one's self", "v > A"), (1, "pi lo̤h", "Abase, v.t.", "v > A"), (2, "ōi", "Able", "v > A"), (2, "tsò̤ tit", "Able, to do", "v > A"), (2, "hó tsò̤", "Able, to do", "v > A"), (4, "kheh", "About, num, x", "v > A"), (4, "tó̤", "About, to", "v > A")])
def _(spark):
    return X.vocabulary(X.lines_of(spark.createDataFrame([("v", VOCABULARY.replace(" See\n", "\n"))], "file string, text string")))


@case("x6_t16_syllabary", "latn_norm puj han", [("cha1", "tsa", "查"), ("cha1", "tsa", "渣"), ("a2", "á", "啞"), ("kuann1", "kuaⁿ", "官")])
def _(spark):
    text = "# T\n| **a** | x |\n|--------|---|\n| ts | \\[1\\]查<img a>渣 \\[2\\] |\n| ∅ | \\[2\\]啞 |\n| **uann** |  |\n| k | \\[1\\]官 |\nz"
    return X.syllabary(X.lines_of(spark.createDataFrame([("s", text)], "file string, text string")))


LEXICON = "seq int, latn_norm string, puj string, dp string, poj string, tl string, bp string, han string, han_variants string, en string, zh_CN string, zh_TW string, source string"
ROWS = [
    (1, "a1-bo2", "a-bó", "", "", "", "", "阿母", "亞母|亜母", "mother", "", "母親、媽", "x"),
    (2, "a1-bo2", "", "", "", "", "", "阿母[白]", "", "Mother, the", "", "", "x"),
    (3, "cui2", "", "", "", "", "", "水", "", "water", "", "水", "dieghv"),
    (4, "cui2", "", "", "", "", "", "亞母", "", "", "", "", "x"),
    (5, "a1-bo2", "", "", "", "", "", "亞母", "", "mother", "", "", "x"),
    (6, "li2,ho2", "", "", "", "", "", "你好", "", "hello", "", "好", "x"),
    (7, "", "lí", "", "", "", "", "", "", "you", "", "", "x"),
]


def _lexicon(spark):
    return L.loaded(spark.createDataFrame(ROWS, LEXICON))


@case("x7_a4_chars", "syllable char weight", [("a1", "阿", 101), ("bo2", "母", 104), ("a1", "亞", 51), ("a1", "亜", 25), ("cui2", "水", 50), ("li2", "你", 100), ("ho2", "好", 100)])
def _(spark):
    return L.first_and_more(L.char_events(_lexicon(spark)), ["syllable", "char"])


@case("k5_a6_base_dict", "text code weight", [("阿母", "a1  bo2", 101), ("亞母", "a1  bo2", 51), ("亜母", "a1  bo2", 25), ("亞母", "cui2", 100)])
def _(spark):
    return L.base_dictionary(L.entries(_lexicon(spark)))


@case("k6_char_dict", "text code weight", [("阿", "a1", 101), ("母", "bo2", 104), ("亞", "a1", 51), ("亜", "a1", 25), ("水", "cui2", 50), ("你", "li2", 100), ("好", "ho2", 100)])
def _(spark):
    return L.char_dictionary(L.first_and_more(L.char_events(_lexicon(spark)), ["syllable", "char"]))


@case("k8_a7_system_dict", "text code weight", [("a-bó", "a1 bo2", 176)])
def _(spark):
    return L.system_dictionary(L.entries(_lexicon(spark)), "PUJ")


@case("k7_a8_syllable_dict", "text code weight", [(t, c, 1) for c, t in [("ap4", "ap"), ("ap8", "a̍p"), ("li1", "li"), ("li2", "lí"), ("li3", "lì"), ("li5", "lî"), ("li6", "lǐ"), ("li7", "lī")]])
def _(spark):
    df = spark.createDataFrame([("ap4 li2",), ("k8-li5",)], "latn_norm string")
    return L.syllable_dictionary(df, "POJ")


@case("r1_k9_english", "text code weight", [("阿母 (a-bó)", "mother", 100), ("阿母 (a-bó)", "Mother", 100), ("水 (cúi)", "water", 100), ("亞母 (a-bó)", "mother", 100), ("你好 (lí,hó)", "hello", 100), ("lí", "you", 50)])
def _(spark):
    return R.english(_lexicon(spark), "PUJ")


@case("r2_k10_mandarin", "text code weight", [("母親☞阿母 (a-bó)", "muqin", 100), ("媽☞阿母 (a-bó)", "ma", 100), ("水☞水 (cúi)", "shui", 100), ("好☞你好 (lí,hó)", "hao", 100)])
def _(spark):
    return R.mandarin(_lexicon(spark), "PUJ", {"母": "mu3", "親": "qin1", "媽": "ma1", "水": "shui3", "好": "hao3"})


LETTERS = [f"derive/{c}/{c.upper()}/" for c in "abcdefghijklmnopqrstuvwxyz"]
TYPED = ["derive/ /-/", "derive/[1-8]//"]
# The rules of each system between those for hyphens and tones and those for letters.
ALGEBRA = {
    "POJ": ["xform/ou/oo/", "xform/ua/oa/", "xform/ue/oe/", "derive/nn//"],
    "TL": ["xform/^ch(?=[^h])/ts/", "xform/^chh/tsh/", "derive/nn//"],
    "PUJ": ["derive/^ch/ts/", "derive/^j/z/", "derive/oinn$/ainn/", "derive/ien$/ian/", "derive/iet/iat/", "derive/([aeiu])n$/$1ng/", "derive/t$/k/", "derive/nn//"],
    "BP": [
        "xform/^b/bb/", "xform/^d/dd/", "xform/^g/gg/", "xform/^j/zz/", "xform/^k(?=[^h])/g/", "xform/^m/bbn/", "xform/^n(?=[^g])/ln/", "xform/^p(?=[^h])/b/", "xform/^t(?=[^h])/d/", "xform/^ch(?=[^h])/z/",
        "xform/^kh/k/", "xform/^ng/ggn/", "xform/^ph/p/", "xform/^th/t/", "xform/^chh/c/", "xform/ou/oo/", "xform/au/ao/", "xform/([aeiou]+)nnh$/n$1h/", "xform/([aeiou]+)nn$/n$1/",
    ],
    "DP": [
        "xform/^b/bh/", "xform/^g/gh/", "xform/^j/r/", "xform/^k(?=[^h])/g/", "xform/^p(?=[^h])/b/", "xform/^t(?=[^h])/d/", "xform/^ch(?=[^h])/z/", "xform/^kh/k/", "xform/^ph/p/", "xform/^th/t/", "xform/^chh/c/",
        "xform/ur/v/", "xform/au/ao/", "derive/oinn/ainn/", "derive/ien$/ian$/", "derive/ied/iad/", "derive/([aeiu])n$/$1ng/", "derive/d$/g/", "derive/nn//", "xform/p$/b/", "xform/t$/d/", "xform/k$/g/",
    ],
}


@case("r3_algebra", "system n rule", [(s, i, r) for s, own in ALGEBRA.items() for i, r in enumerate(TYPED + own + LETTERS)])
def _(spark):
    return spark.createDataFrame([(s, i, r) for s in ALGEBRA for i, r in enumerate(R.algebra(s))], "system string, n int, rule string")


@case("r3_algebra_whole", "n rule", list(enumerate(["derive/ /-/", "derive/[1-8]//", "xform/^ch(?=[^h])/ts/", "xform/^chh/tsh/", "derive/nn//", "derive/a/A/", "derive/b/B/", "derive/c/C/", "derive/d/D/", "derive/e/E/", "derive/f/F/", "derive/g/G/", "derive/h/H/", "derive/i/I/", "derive/j/J/", "derive/k/K/", "derive/l/L/", "derive/m/M/", "derive/n/N/", "derive/o/O/", "derive/p/P/", "derive/q/Q/", "derive/r/R/", "derive/s/S/", "derive/t/T/", "derive/u/U/", "derive/v/V/", "derive/w/W/", "derive/x/X/", "derive/y/Y/", "derive/z/Z/"])))
def _(spark):
    return spark.createDataFrame(list(enumerate(R.algebra("TL"))), "n int, rule string")


@case("r3_r8_spellings", "spelling rank", [("cha1 bo2", 0), ("cha1-bo2", 0), ("cha bo", 0), ("cha-bo", 0), ("c", 1)])
def _(spark):
    df = spark.createDataFrame([("cia1 bo2",)], "code string")
    rules = ["xform/^ci/ch/", "derive/ /-/", "derive/[1-8]//", "abbrev/^(.).+$/$1/"]
    return respelled(df, rules)


@case("r4_ranked", "text weight", [("b", 9), ("a", 5), ("d", 5)])
def _(spark):
    df = spark.createDataFrame([("a", "li2", 5), ("b", "li5 a1", 9), ("c", "ho2", 99), ("d", "li7", 5), ("e", "li1", 1)], "text string, code string, weight int")
    return R.ranked(df, "li", ["derive/ /-/", "derive/[1-8]//"], most=3)


@case("r5_j6_candidates", "place text comment", [(1, "Lí hó", ""), (2, "你好", "lí-hó"), (3, "Li", ""), (4, "你", "lí")])
def _(spark):
    rows = [(1, "你", "li2", 3), (2, "li", "li2", 3), (3, "你好", "li2  ho2", 6), (4, "lí hó", "li2  ho2", 6)]
    table = spark.createDataFrame([("li2", "lí"), ("ho2", "hó")], "code string, text string")
    return R.candidates(spark.createDataFrame(rows, "seq int, text string, code string, span int"), table, "Li2ho2")


@case("v4_roundtrip", "row field level kind", [(1, "poj", "warning", "roundtrip"), (3, "poj", "warning", "non-latn char(s) in annotation context"), (4, "han", "error", "char"), (4, "en", "error", "char")])
def _(spark):
    rows = [("f", 1, "人", "a", "lo8"), ("f", 2, "大·", "b", "lí-hó"), ("f", 3, "", "", "li漢"), ("f", 4, "a漢", "x漢", "")]
    return V.findings(spark.createDataFrame(rows, "file string, row int, han string, en string, poj string"))


@case("w4_chapters", "part sub title name", [(1, 1, "One", "01_01_One"), (1, 2, "First", "01_02_First"), (1, 3, "Second", "01_03_Second"), (2, 1, "Two.", "02_Two")])
def _(spark):
    text = "# Book\npre\n## One\nx[訓]\n### First\na\n### Second\nb\n## Two.\nend"
    return S.chapters(X.lines_of(spark.createDataFrame([("b", text)], "file string, text string")))


@case("u1_merge_valid", "seq latn_norm han en source", [(1, "li2", "你", "house", "b"), (2, "cho1", "做", "China", "b"), (5, "a1", "啊", "", "d")])
def _(spark):
    book = spark.createDataFrame([(1, "Lí", "", "你", "House", "b > s"), (2, "", "cho", "做", "China", "b"), (3, "sk4", "", "惡", "", "b")], "seq int, puj string, poj string, han string, en string, source string")
    outer = spark.createDataFrame([(4, "123", "無", "d"), (5, "a", ":啊#", "d")], "seq int, poj string, han string, source string")
    good, _bad = L.merged(L.merged_books(book, {}, ["China"]), L.merged_external(outer, []))
    return good


@case("t10_distinct_join", "given found", [("pâng", "báng"), ("pâng", "báng"), ("kam", "gām"), (None, None)])
def _(spark):
    df = spark.createDataFrame([("pâng",), ("pâng",), ("kam",), (None,)], "given string")
    return translated(df, "given", "poj", "bp", "found")
