"""Operators over tables against plain versions: spelling rules, segmentation, variants, ranges, normal forms, conversions in SQL, split files."""

import random
import re
from dataclasses import replace
from unicodedata import normalize

import pytest
from pyspark.sql import functions as F

from glyphmill.functions import normal_form, sql, systems
from glyphmill.functions.syllables import _leg, translate
from glyphmill.functions.text import compiled_variants
from glyphmill.operators import lookup, ranges, segment, spelling, variants
from glyphmill.sources import readers


def ways(code, rules):
    found = {code}
    for rule in rules:
        verb, old, new = re.fullmatch("([a-z]+)/(.*)/(.*)/", rule).groups()
        changed = {s: re.sub(old, re.sub(r"\$(\d)", r"\\\1", new), s) for s in found}
        found = set(changed.values()) if verb == "xform" else found | set(changed.values())
    return {s for s in found if s}


@pytest.mark.parametrize("system", "POJ TL PUJ BP DP".split())
def test_whole_rule_lists(spark, system):
    codes = ["tsiah8", "png7", "chhien5", "soinn1", "ua2", "kou1", "jit8", "a1", "ien", "1"]
    rules, case = spelling.without_case(lookup.algebra(system))
    df = spark.createDataFrame([(c,) for c in codes] + [(None,), ("",)], "code string")
    got = {}
    for r in spelling.respelled(df, rules).collect():
        got.setdefault(r.code, set()).add(r.spelling)
    assert case and got == {c: w for c in codes if (w := ways(c, rules))}
    whole = {r.spelling for r in spelling.respelled(df.where("code = 'ua2'"), lookup.algebra(system)).collect()}
    assert whole == ways("ua2", lookup.algebra(system))


def test_prefixes_and_capitals(spark):
    rules = lookup.algebra("TL")
    entries = [("大", "tua7", 9), ("大人", "tua7  lang5", 7), ("食", "chiah8", 8), ("豬", "ti1", 8), ("短", "te2", 8), ("x", "", 1), ("y", None, 1)]
    df = spark.createDataFrame(entries, "text string, code string, weight int")
    index = spelling.prefix_index(df, rules, letters=6, most=6).cache()
    by_brute = {}
    for text, code, weight in entries[:5]:
        parts = code.split()
        spelled = {""}
        for s in parts:
            spelled = {a + b for a in spelled for b in ways(s, spelling.without_case(rules)[0])}
        for s in spelled:
            for k in range(1, min(6, len(s)) + 1):
                by_brute.setdefault(s[:k], set()).add((-weight, text, code))
    got = {}
    for r in spelling.best_of_prefix(index).orderBy("place").collect():
        got.setdefault(r.prefix, []).append((-r.weight, r.text, r.code))
    assert got == {p: sorted(x)[:6] for p, x in by_brute.items()}
    page = lambda typed: [r.text for r in spelling.typed_prefix(index, typed).collect()]
    assert page("t") == page("T") == ["大", "短", "豬", "食", "大人"]
    assert page("Tua") == page("TUA") == ["大", "大人"] and page("tualA") == ["大人"] and page("tua-l") == ["大人"] and page("tu-a") == page("") == []
    # A letter is a capital in all its places of a syllable or in none.
    assert spelling.fitting_parts("aA") == ["a a"] and page("ts") == ["食"]


def best(typed, codes):
    found = [(0, 0, 0, [])]
    for stop in range(1, len(typed) + 1):
        options = [(u + 1, k + 1, w, x + [1]) for u, k, w, x in [found[stop - 1]]]
        for n in range(1, stop + 1):
            if (weight := codes.get(typed[stop - n : stop])) is not None:
                u, k, w, x = found[stop - n]
                options.append((u, k + 1, w - weight, x + [n]))
        found.append(min(options))
    u, k, w, x = found[-1]
    cuts = [sum(x[:i]) for i in range(len(x) + 1)]
    return ([typed[a:b] for a, b in zip(cuts[:-1], cuts[1:])], u, k, -w)


def test_segments(spark):
    rnd = random.Random(3)
    codes = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))): rnd.randint(1, 9) for _ in range(25)}
    typed = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 18))) for _ in range(60)] + ["zzz", "a"]
    df = spark.createDataFrame([(t,) for t in typed] + [("",), (None,)], "typed string")
    known = spark.createDataFrame([*codes.items(), ("", 3), (None, 4), (next(iter(codes)), 0)], "code string, weight int")
    got = {r.typed: (r.pieces, r.unknown, r.words, r.weight) for r in segment.segmented(df, known, 4).collect()}
    assert got == {t: best(t, codes) for t in typed}
    assert segment.segmented(df, known.limit(0), 4).where("unknown <> length(typed)").count() == 0
    entries = spark.createDataFrame([("你", "li2", 1), ("你好", "li2  ho2", 2), ("好", "ho2", 3)], "text string, code string, weight int")
    spans = segment.candidate_spans(spark.createDataFrame([("li2ho2",)], "typed string"), entries).collect()
    assert sorted((r.text, r.span) for r in spans) == [("你", 3), ("你好", 6)]


def test_segments_by_few_codes_in_all_tasks(spark, monkeypatch):
    """Codes beyond the few that go to all tasks meet the runs by their bits; neither way has a row for each place of a run."""
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("abé漢") for _ in range(rnd.randint(1, n)))
    codes = {word(7): rnd.choice([1, 3, 40, 1 << 40]) for _ in range(150)}
    typed = {word(30) for _ in range(200)} | {"z", "zé" * 40}
    df, known = spark.createDataFrame([(t,) for t in typed], "typed string"), spark.createDataFrame([*codes.items()], "code string, weight bigint")
    for few in (0, 12, 100, 1000):
        monkeypatch.setattr(segment, "FEW", few)
        found = segment.segmented(df, known, 7)
        assert "Generate" not in found._jdf.queryExecution().toString()
        got = {r.typed: (r.pieces, r.unknown, r.words, r.weight) for r in found.collect()}
        assert got == {t: best(t, codes) for t in typed}


def test_variants_like_the_expression(spark):
    rnd = random.Random(4)
    table = {"伊": ["佢"], "食飯": ["吃飯", "喫飯"], "食": ["喫"], "ab": ["x"], "abcde": ["yy", "z"], "bc": [""], "飯食a": ["q"]}
    texts = ["".join(rnd.choice(["伊", "食", "飯", "ab", "abcde", "bc", "a", "無"]) for _ in range(rnd.randint(0, 7))) for _ in range(120)] + ["", None, "無" * 2500 + "伊" + "無" * 700 + "食飯"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = spark.createDataFrame([*table.items(), ("", ["no"]), (None, ["no"]), ("無無無無", None)], "key string, variants array<string>")
    got = {r.id: sorted(r.spelled) for r in variants.compiled(df, rows).collect()}
    plain = {k: [v for v in vs if v] for k, vs in table.items() if any(vs)}
    want = {r.id: sorted(r.x or []) for r in df.select("id", compiled_variants(F.coalesce("text", F.lit("")), plain).alias("x")).collect()}
    assert got == want
    assert variants.known(df, rows.select("key").limit(0)).count() == 0


def leftmost(text, keys):
    found, at = [], 0
    while at < len(text):
        n = max((n for n in range(1, 13) if len(text[at : at + n]) == n and text[at : at + n] in keys), default=0)
        found += [(at, n, text[at : at + n])] if n else []
        at += n or 1
    return found


def test_known_strings_by_stretches(spark, monkeypatch):
    """Frequent stretches are answered in all tasks, the others by a join; neither way has a row for each place of a text."""
    rnd = random.Random(9)
    for letters, few, lot in (("ab]^漢", 0, 1), ("ab-&\n", 4, 50), ("a𝒳 .", 1000, 100_000)):
        monkeypatch.setattr(variants, "FEW", few)
        monkeypatch.setattr(variants, "LOT", lot)
        keys = {"".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6))) for _ in range(40)}
        texts = ["".join(rnd.choice(letters + "xyz") for _ in range(rnd.randint(0, 60))) for _ in range(150)] + ["", None, "x", "ab" * 40_000]
        df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
        found = variants.known(df, spark.createDataFrame([(k,) for k in [*keys, "", None]], "key string"))
        assert "sequence(" not in found._jdf.queryExecution().toString()
        got = {r.id: [tuple(x) for x in r.spans] for r in found.collect()}
        assert got == {i: x for i, t in enumerate(texts) if t and (x := leftmost(t, keys))}


def test_ranges(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), i, rnd.choice([None, None, None, i]), rnd.choice([None, f"v{i}"])) for i in range(500)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "file string, n int, x int, y string").repartition(7)
    got = {(r.file, r.n): (r.x, r.y) for r in ranges.filled_down(df, "file", "n", x=F.col("x"), y=F.col("y")).collect()}
    want, last = {}, {}
    for f, n, x, y in sorted(rows, key=lambda r: r[1]):
        a, b = last.get(f, (None, None))
        last[f] = (x if x is not None else a, y if y is not None else b)
        want[f, n] = last[f]
    assert got == want
    copies = spark.createDataFrame([("k",)] * 300 + [("j",)] * 5 + [(None,)], "w string").repartition(5)
    found = ranges.numbered(copies, "w").collect()
    assert sorted(r.row for r in found) == list(range(1, 307))
    assert sorted(r.row for r in found if r.w == "j") == [2, 3, 4, 5, 6] and [r.row for r in found if r.w is None] == [1]
    assert ranges.numbered(copies.limit(0), "w").collect() == []


def test_normal_form(spark):
    rnd = random.Random(6)
    apart, pairs, _, _, marks = normal_form.tables()
    bases = [*"aeiouAOnNcsz xy", *"가각ᄀᄒ", "ᅡ", "ᅵ", "ᆨ", "Å", "क़", "ে", "া", "ṩ", *list(apart)[::41]]
    texts = ["", "plain", "́", *["".join(rnd.choice(marks if rnd.random() < 0.45 else bases) for _ in range(rnd.randint(1, 12))) for _ in range(800)]]
    texts += [normalize("NFD", "".join(rnd.choice(list(apart)) for _ in range(6))) for _ in range(200)] + [normalize("NFD", "한국어 é ǘ") * 50]
    df = spark.createDataFrame(list(enumerate([*texts, None])), "i int, x string")
    got = {r.i: r.y for r in df.select("i", normal_form.nfc(F.col("x")).alias("y")).collect()}
    assert got == {i: None if t is None else normalize("NFC", t) for i, t in enumerate([*texts, None])}


@pytest.mark.parametrize("system", "POJ TL PUJ BP DP".split())
def test_functions_in_sql(spark, system):
    words = ["tsiah8", "png7", "Chhien5", "soinn1 ua2-kou1", "jit8", "zit", "m7", "ng", "bbn", "hoe", "", "1", "x'y", "sueh4 kao3", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for name, a, b in zip(sql.define(spark, system), (system, "LATN_NORM"), ("LATN_NORM", system)):
        rows = df.select(F.expr(f"{name}(w)").alias("x"), _leg(F.col("w"), a, b).alias("y")).collect()
        assert [r.x for r in rows] == [r.y for r in rows]
    with pytest.raises(ValueError):
        sql.leg("POJ", "TL")


def test_direct_translators_and_callables(spark):
    df = spark.createDataFrame([("kha",)], "w string")
    own = replace(systems.named("TL"), name="OWN", from_pivot={"initial": {"kh": lambda i, v, e: F.concat(F.upper(i), v), "ch": "ts"}, "vowel": {"a": lambda i, v, e: F.concat(v, F.lit("a"))}})
    systems.register(own)
    try:
        assert df.select(_leg(F.lit("kha1 chu2"), "LATN_NORM", "OWN")).first()[0] == "KHaaa1 tsu2"
        assert "xform/^ch/ts/" in lookup.algebra("OWN") and not any("kh" in r for r in lookup.algebra("OWN"))
        with pytest.raises(ValueError):
            sql.leg("LATN_NORM", "OWN")
        systems.register_direct("POJ", "TL", lambda c: F.concat(F.lit("direct "), c))
        assert df.select(translate(F.col("w"), "poj", "tl")).first()[0] == "direct kha"
        assert df.select(translate(F.col("w"), "tl", "poj")).first()[0] == "kha"
    finally:
        systems.SYSTEMS.pop("OWN")
        systems.DIRECT.clear()


def test_lines_of_split_files(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text("head\n...\n\n" + "".join(f"{name}{i}\tx\n" for i in range(3000)) + "...\n", "utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = readers.file_lines(spark, str(tmp_path), F.col("line") == "...")
        assert rows.rdd.getNumPartitions() > 4
        got = sorted((r.file, r.line_no, r.line, r.first) for r in rows.collect())
        words = sorted((r.file, r.line_no, r.text) for r in readers.dictionary(spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [(f"{n}.txt", i, x, 1) for n in "ab" for i, x in enumerate(["head", "...", ""] + [f"{n}{i}\tx" for i in range(3000)] + ["..."])]
    assert got == want
    assert words == [(f, i, x.split("\t")[0]) for f, i, x, _ in want if "\t" in x]


def test_rows_of_findings_are_those_of_the_file(spark, tmp_path):
    for name in ("m", "n"):
        (tmp_path / f"{name}.csv").write_text("han,en\n" + "".join(f'{name}{i},"two\nlines"\n' for i in range(5)), "utf-8")
    rows = readers.table(spark, [str(tmp_path / "m.csv"), str(tmp_path / "n.csv")], ["han"], rows=True).collect()
    assert sorted((r.han, r.row) for r in rows) == [(f"{n}{i}", i + 2) for n in "mn" for i in range(5)]


def test_conversion_by_table_like_the_expressions(spark):
    from glyphmill.functions.syllables import handwriting, keyboard
    from glyphmill.operators import conversion

    words = ["Tâi-oân", "chhá GÓA", "pe̍h-ōe-jī", "Lí hó! (GÓA) 12", "khò͘", "kûaⁿ tsua̍h", "", "n̂g m̄ ňg", "LÍ-HÓ", "li2-ho2", "x'y-", "漢字 a", None]
    df = spark.createDataFrame([(w,) for w in words + words[:2]], "w string")
    for system in ("PUJ", "BP"):
        rows = conversion.typed(df, "w", system, "x").select("x", keyboard(F.col("w"), system).alias("y")).collect()
        assert len(rows) == len(words) + 2 and all(r.x == r.y for r in rows)
    rows = conversion.converted(df, "w", "POJ", "TL", "x").select("x", translate(F.col("w"), "POJ", "TL").alias("y")).collect()
    assert all(r.x == r.y for r in rows)
    typed = df.select(keyboard(F.col("w"), "TL").alias("w"))
    rows = conversion.written(typed, "w", "TL", "x").select("x", handwriting(F.col("w"), "TL").alias("y")).collect()
    assert all(r.x == r.y for r in rows)
