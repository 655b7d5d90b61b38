"""HTML extraction by block rules in two passes.

A page is cut into blocks at block elements; each knows its length, the share of its characters in links, the share of stop words among
its words, whether it stands in an article, in an element that holds no article text (by tag, role or hiding), and in one whose class or
id hints at that. Such a hint is overruled where the element holds most of the page's text, and much, in long blocks with stop words enough. Articles count
as a sign if they hold as much long text as there is prose beside them.

Pass 1 decides by length, stop words and links. Blocks in elements without article text and those that are mostly links are bad; in an article
headings and sentences of links stay open. A block is good that is long and has many stop words; in an article a third of both is
enough, beside one three times the length is asked. On a page without an article on which nothing is good by the full bars the lower ones are
taken. A long block with few stop words is doubted; all others stay open, the short ones above all. Pass 2 gives open blocks the label of their
nearest decided neighbour, headings that of the next one; doubted blocks, and all open ones beside an article, need a good one on both sides. Elements without article
text aren't neighbours, and in an article only its own blocks are. Where nothing is decided open blocks are bad like what stands around
them, unless nothing can be said of them: where they have no stop word of the four languages at all, or fewer than 200 characters.

Only tags that can matter are kept on a stack, and end tags close up to their start tag, so unclosed elements do no harm.

Defined cases: null or empty html gives an empty text. Comments, scripts and styles that never end reach to the end of the page.
Repeated rows get equal results. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._words import chunks
from glyphmill.llm._work import small_batches

# Element names, words of class and id, and frequent words of four languages.
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTSIDE = frozenset("aside button datalist dialog footer form head header iframe menu nav noscript object select svg template textarea title".split())
CONTAINERS = OUTSIDE | frozenset("article body div dl fieldset figure html main ol section span table td th tr ul a p".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification paywall popup promo promoted related replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
STOP_WORDS = frozenset(
    "a and are as at be by for from has he in is it its not of on or that the this to was were which with you "
    "au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous ou par pas plus pour qui que sa se ses son sur un une "
    "als am an auch auf aus bei das dem den der die ein eine einer er es für hat ich im ist mit nach nicht sie sich sind um und von vor war wie zu zum zur "
    "al como con del desde el entre era esta este ha hay lo los las más muy no para pero por se sin sobre su sus también tiene y".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(script|style)\b(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[^\W\d_]+")
SPACE = re.compile(r"\s+")

#: Characters and stop words a word of a block that is prose, characters in links of one that is none; a share of the first two that is enough in an
#: article, and a multiple of the length that is asked of blocks beside one.
LONG, FEW_STOPS, MANY_LINKS = 70, 0.15, 0.5
#: Characters of an article that are too few to judge it.
FEW_CHARS = 200
LOWER, HIGHER = 1 / 3, 3
GOOD, BAD, OPEN, DOUBTED = 1, -1, 0, 2


def _signs(tag: str, rest: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element holds no article text, by tag, role or hiding; whether a word of its class or id hints at that."""
    if tag in OUTSIDE and not (tag == "header" and in_article):
        return True, False
    if not rest or tag in ("html", "body", "main"):
        return False, False
    named = False
    for m in ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role" and value.strip() in ROLES:
            return True, False
        if (name == "hidden" or name == "aria-hidden" and value == "true") and tag != "article":
            return True, False
        if name in ("class", "id"):
            words = set(re.split(r"[^a-z]+", value))
            if tag == "article":
                named |= any(w.startswith("comment") for w in words)
            else:
                named |= not NAMES.isdisjoint(words - {"header"} if in_article else words) and not (in_article and tag == "header")
    return False, named


class _Block:
    __slots__ = ("parts", "chars", "linked", "outside", "article", "named", "heading")

    def __init__(self, outside: bool, article: bool, named: int, heading: bool):
        self.parts: list[str] = []
        self.chars = self.linked = 0
        self.outside, self.article, self.named, self.heading = outside, article, named, heading


def blocks_of(html: str) -> tuple[list[_Block], list[int]]:
    """The blocks; of each element with a hint in its class or id the next one around it. Number 0 stands for no such element."""
    found: list[_Block] = []
    around = [0]
    stack: list[tuple[str, bool, bool, int]] = []
    outside = article = heading = False
    named = links = 0
    now = _Block(False, False, 0, False)

    def close() -> _Block:
        if now.chars:
            found.append(now)
        return _Block(outside, article, named, heading)

    def text(piece: str) -> None:
        piece = SPACE.sub(" ", unescape(piece))
        if piece:
            now.parts.append(piece)
            n = len(piece) - piece.count(" ")
            now.chars += n
            now.linked += n if links else 0

    last = 0
    for m in TOKEN.finditer(html):
        if m.start() > last:
            text(html[last : m.start()])
        last = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        ends = bool(m[2])
        if tag == "a":
            links = 0 if ends else 1
        if tag in CONTAINERS and tag not in ("a", "p", "span") or (tag in ("p", "span", "a") and not ends and m[4]) or ends and any(tag == x[0] for x in stack):
            if ends:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        outside, article, named = stack[i][1:]
                        del stack[i:]
                        break
            elif not m[4].endswith("/"):
                if tag in ("p",):
                    while stack and stack[-1][0] == "p":
                        outside, article, named = stack[-1][1:]
                        stack.pop()
                stack.append((tag, outside, article, named))
                out, hint = _signs(tag, m[4], article)
                outside = outside or out
                if hint:
                    around.append(named)
                    named = len(around) - 1
                article = article or tag in ("article", "main")
        if tag in BLOCKS:
            heading = tag in HEADINGS and not ends
            now = close()
        elif now.outside != outside or now.named != named:
            now = close()
    if last < len(html):
        text(html[last:])
    close()
    return found, around


def _stops(text: str) -> float:
    words = [w.lower() for w in WORD.findall(text)]
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def _standing(blocks: list[_Block], around: list[int], linked: list[bool], dense: list[bool]) -> list[bool]:
    """Whether the hint of each element, or of one around it, stands: it is overruled where the element holds most of the page's text as prose."""
    own, total = [0] * len(around), 0
    for b, is_linked, is_dense in zip(blocks, linked, dense, strict=True):
        total += 0 if b.outside or is_linked else b.chars
        own[b.named] += b.chars if is_dense else 0
    for i in range(len(around) - 1, 0, -1):
        own[around[i]] += own[i]
    stands = [False] * len(around)
    for i in range(1, len(around)):
        stands[i] = stands[around[i]] or own[i] < HIGHER * LONG or 2 * own[i] <= total
    return stands


def _firm(length: int, stops: float, share: float) -> bool:
    """Whether a text is prose by its length and stop words, held against a share of the full bars."""
    return length >= share * LONG and stops >= share * FEW_STOPS


def _first_pass(blocks: list[_Block], texts: list[str], stops: list[float], out: list[bool], articles: list[bool]) -> list[int]:
    any_article = any(articles)

    def label(i: int, share: float) -> int:
        b, length, s = blocks[i], len(texts[i]), stops[i]
        if out[i]:
            return BAD
        if b.linked >= MANY_LINKS * b.chars:
            return OPEN if articles[i] and (b.heading or s >= FEW_STOPS) else BAD
        if articles[i]:
            return GOOD if _firm(length, s, LOWER) else OPEN
        if any_article:
            return GOOD if _firm(length, s, 1) and length >= HIGHER * LONG else OPEN
        if _firm(length, s, share):
            return GOOD
        return DOUBTED if length >= LONG and s < LOWER * FEW_STOPS else OPEN

    labels = [label(i, 1) for i in range(len(blocks))]
    if not any_article and GOOD not in labels:
        labels = [label(i, LOWER) for i in range(len(blocks))]
    return labels


def _second_pass(blocks: list[_Block], texts: list[str], stops: list[float], labels: list[int], out: list[bool], articles: list[bool]) -> list[int]:
    final, any_article = list(labels), any(articles)
    for part in (True, False):
        own = [i for i, a in enumerate(articles) if a == part and not out[i]]
        unjudged = sum(len(texts[i]) for i in own) < FEW_CHARS or not any(stops[i] for i in own)
        decided = [i for i, x in enumerate(labels) if x in (GOOD, BAD) and not out[i] and (articles[i] or not part)]
        at = 0
        for i, x in enumerate(labels):
            if x in (GOOD, BAD) or articles[i] != part:
                continue
            while at < len(decided) and decided[at] < i:
                at += 1
            before = decided[at - 1] if at else None
            after = decided[at] if at < len(decided) else None
            if any_article and not part:
                final[i] = GOOD if before is not None and after is not None and labels[before] == labels[after] == GOOD else BAD
            elif before is None and after is None:
                # What stands around is no text of an article, and so is this, unless nothing can be said of it.
                final[i] = GOOD if unjudged else BAD
            elif x == DOUBTED:
                final[i] = GOOD if before is not None and after is not None and labels[before] == labels[after] == GOOD else BAD
            elif before is None or after is None:
                final[i] = labels[after if before is None else before]
            elif blocks[i].heading:
                final[i] = labels[after]
            else:
                final[i] = labels[before if i - before <= after - i else after]
    return final


def main_text(html: str | None) -> str:
    blocks, around = blocks_of(html or "")
    texts = ["".join(b.parts).strip() for b in blocks]
    stops = [0.0 if b.outside else _stops(t) for b, t in zip(blocks, texts, strict=True)]
    long = [not b.outside and b.linked < MANY_LINKS * b.chars and len(t) >= LONG for b, t in zip(blocks, texts, strict=True)]
    linked = [b.linked >= MANY_LINKS * b.chars for b in blocks]
    dense = [x and s >= FEW_STOPS for x, s in zip(long, stops, strict=True)]
    stands = _standing(blocks, around, linked, dense)
    out = [b.outside or stands[b.named] for b in blocks]
    # Articles count if they hold as much long text as there is prose beside them.
    articles = [b.article and not x for b, x in zip(blocks, out, strict=True)]
    inside = sum(b.chars for b, a, x in zip(blocks, articles, long, strict=True) if a and x)
    beside = sum(b.chars for b, a, o, x in zip(blocks, articles, out, dense, strict=True) if not a and not o and x)
    if inside < beside:
        articles = [False] * len(blocks)
    labels = _first_pass(blocks, texts, stops, out, articles)
    final = _second_pass(blocks, texts, stops, labels, out, articles)
    return " ".join(t for t, x in zip(texts, final, strict=True) if x == GOOD and t)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "html"):
        found = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages."""
    small_batches(pages.sparkSession)
    kinds = dict(pages.dtypes)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
