"""Files of the input engine around the dictionaries: schemas, the list of schemas, the Lua entry module, punctuation.

All of it follows from names and rules, none of it from the size of the lexicon, so it is made on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.systems import named
from glyphmill.operators.lookup import algebra

STAMP = "19700101.000000"
Choice = str | list[str]

# What punctuation keys give. Several texts are choices; COMMITTED keys commit theirs at once; PAIRED ones alternate.
FULL: dict[str, Choice] = {
    " ": "　", ",": "，", ".": "。", "<": ["《", "〈", "«", "‹"], ">": ["》", "〉", "»", "›"], "/": ["／", "÷"], "?": "？", ";": "；", ":": "：",
    "'": ["‘", "’"], '"': ["“", "”"], "\\": ["、", "＼"], "|": ["·", "｜", "§", "¦"], "`": "｀", "~": "～", "!": "！", "@": ["＠", "☯"],
    "#": ["＃", "⌘"], "%": ["％", "°", "℃"], "$": ["￥", "$", "€", "£", "¥", "¢", "¤"], "^": "……", "&": "＆", "*": ["＊", "·", "・", "×", "※", "❂"],
    "(": "（", ")": "）", "-": "－", "_": "——", "+": "＋", "=": "＝", "[": ["「", "【", "〔", "［"], "]": ["」", "】", "〕", "］"], "{": ["『", "〖", "｛"], "}": ["』", "〗", "｝"],
}
HALF: dict[str, Choice] = {
    ",": "，", ".": "。", "<": "《", ">": "》", "/": "/", "?": "？", ";": "；", ":": "：", "'": ["‘", "’"], '"': ["“", "”"], "\\": "、", "|": "|", "`": "`", "~": "~", "!": "！", "@": "@",
    "#": "#", "%": "%", "$": "¥", "^": "……", "&": "&", "*": "*", "(": "（", ")": "）", "-": "-", "_": "——", "+": "+", "=": "=", "[": "【", "]": "】", "{": "「", "}": "」",
}
COMMITTED = frozenset(" ,.?;:!^")
PAIRED = frozenset("'\"")
# Ranges and characters that YAML takes without quotes.
BARE = (range(0x3001, 0xA000), range(0xFF01, 0xFFF0))
BARE_ALSO = frozenset("—…«»×÷‹›※☯⌘❂・·")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def scalar(text: str) -> str:
    """A YAML flow scalar, quoted unless all its characters may stand bare."""
    bare = bool(text) and all(c in BARE_ALSO or any(ord(c) in r for r in BARE) for c in text)
    return text if bare else quoted(text)


def punctuation(table: dict[str, Choice], commits: frozenset[str] = COMMITTED) -> list[tuple[str, str]]:
    """(key, rule) of a punctuation table, as YAML."""
    out = []
    for key, given in table.items():
        if key in PAIRED:
            rule = f"{{ pair: [ {', '.join(map(quoted, given))} ] }}"
        elif isinstance(given, list):
            rule = f"[ {', '.join(map(scalar, given))} ]"
        else:
            rule = f"{{ commit: {scalar(given)} }}" if key in commits else scalar(given)
        out.append((quoted(key), rule))
    return out


def punctuator() -> str:
    lines = ["punctuator:"]
    for shape, rules in (("full_shape", punctuation(FULL)), ("half_shape", punctuation(HALF, frozenset()))):
        lines += [f"  {shape}:", *[f"    {key}: {rule}" for key, rule in rules]]
    return "\n".join(lines)


def _yaml(value, depth: int = 0) -> list[str]:
    """Nested dicts and lists of strings as YAML lines."""
    pad, out = "  " * depth, []
    for key, v in value.items():
        if isinstance(v, dict):
            out += [f"{pad}{key}:", *_yaml(v, depth + 1)]
        elif isinstance(v, list):
            out += [f"{pad}{key}:", *[f"{pad}  - {x}" for x in v]]
        else:
            out.append(f"{pad}{key}: {v}")
    return out


def schema_id(package: str, system: str, kind: str = "") -> str:
    return "_".join(x for x in (package, named(system).name.lower(), kind) if x)


def schema_text(system: str, package: str, mandarin: bool = False) -> str:
    """The input schema of a system: its spelling rules, reverse lookup from English and, if there is one, from Mandarin, punctuation."""
    own, low = schema_id(package, system), system.lower()
    looked = ["en", *(["zh"] if mandarin else [])]
    body = {
        "schema": {"schema_id": own, "name": system, "version": f'"{STAMP}"', "dependencies": [schema_id(package, system, k) for k in looked]},
        "engine": {
            "processors": [f"lua_processor@{low}_caps_tracker", "ascii_composer", "recognizer", "key_binder", "speller", "punctuator", "selector", "navigator", "express_editor"],
            "segmentors": ["ascii_segmentor", "matcher", "abc_segmentor", *[f"affix_segmentor@{k}_lookup" for k in looked], "punct_segmentor", "fallback_segmentor"],
            "translators": ["punct_translator", "script_translator", *[f"table_translator@{k}_lookup" for k in looked]],
            "filters": [f"lua_filter@{low}_filter", "uniquifier"],
        },
        "translator": {"dictionary": own},
        "speller": {"delimiter": '" -"', "algebra": algebra(system)},
    }
    marks = {"en": "?", "zh": "!"}
    body |= {f"{k}_lookup": {"tag": f"{k}_lookup", "dictionary": schema_id(package, system, k), "enable_completion": "true", "prefix": f'"{marks[k]}"', "suffix": "\"'\""} for k in looked}
    body["recognizer"] = {"patterns": {f"{k}_lookup": f"\"{'[?]' if k == 'en' else marks[k]}[a-z]*'?$\"" for k in looked}}
    body["key_binder"] = {"bindings": ["{ when: has_menu, accept: minus, send: Page_Up }", "{ when: has_menu, accept: equal, send: Page_Down }"]}
    return "\n".join([*_yaml(body), punctuator(), ""])


def lookup_schema_text(system: str, package: str, kind: str) -> str:
    """The schema of a reverse dictionary, kind en or zh."""
    name = f"{'English' if kind == 'en' else '普通話'}☞{system}"
    own = schema_id(package, system, kind)
    return "\n".join([*_yaml({"schema": {"schema_id": own, "name": name, "version": f'"{STAMP}"'}, "engine": {"translators": ["table_translator"]}, "translator": {"dictionary": own}}), ""])


def schema_list(systems: list[str], package: str) -> str:
    """default.custom.yaml: the schemas of a package."""
    return "\n".join(_yaml({"patch": {"schema_list": [f"schema: {schema_id(package, s)}" for s in systems]}})) + "\n"


def lua_entry(systems: list[str]) -> str:
    """rime.lua: each system's module gives its processor and its filter."""
    lines = []
    for s in (x.lower() for x in systems):
        lines += [f"local {s}_filter_mod = require('{s}_filter')", f"{s}_filter = {s}_filter_mod[2]", f"{s}_caps_tracker = {s}_filter_mod[1].processor"]
    return "\n".join(lines) + "\n"


def engine_files(systems: list[str], package: str, mandarin: bool = True) -> dict[str, str]:
    """All these files by name."""
    found = {"default.custom.yaml": schema_list(systems, package), "rime.lua": lua_entry(systems)}
    for s in systems:
        found[f"{schema_id(package, s)}.schema.yaml"] = schema_text(s, package, mandarin)
        for kind in ["en", *(["zh"] if mandarin else [])]:
            found[f"{schema_id(package, s, kind)}.schema.yaml"] = lookup_schema_text(s, package, kind)
    return found


#: Stands for a package's name in texts that are made once for all packages.
ANY = "\ue000"


def packages_files(packages: DataFrame, systems: list[str], mandarin: bool = True) -> DataFrame:
    """(package, name, text): all these files of each distinct package (package)."""
    made = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("text")) for n, t in engine_files(systems, ANY, mandarin).items()])
    own = lambda c: F.replace(c, F.lit(ANY), "package").alias(c)
    return packages.select("package").distinct().select("package", F.inline(made)).select("package", own("name"), own("text"))
