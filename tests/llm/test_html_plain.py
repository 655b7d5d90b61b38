"""extract_text over all pages against plain versions: what the pages' article holds, and the two-pass rules written out block by block."""

import re
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from glyphmill.llm import html_text as H

PAGES = "/root/testdata/sf0.001/pages.parquet"


class Plain(HTMLParser):
    """Blocks of the article alone, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.off, self.blocks = 0, 0, [""]

    def handle_starttag(self, tag, attrs):
        if tag in ("article", "main"):
            self.depth += 1
        if tag in ("script", "style", "nav", "footer", "aside", "form"):
            self.off += 1
        if tag in H.BLOCKS:
            self.blocks.append("")

    def handle_endtag(self, tag):
        if tag in ("article", "main"):
            self.depth -= 1
        if tag in ("script", "style", "nav", "footer", "aside", "form"):
            self.off -= 1
        if tag in H.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.depth and not self.off:
            self.blocks[-1] += data


def f1(a, b):
    a, b = a.split(), b.split()
    if not a or not b:
        return float(a == b)
    left = list(b)
    shared = 0
    for w in a:
        if w in left:
            left.remove(w)
            shared += 1
    return 2 * shared / (len(a) + len(b))


@pytest.fixture(scope="module")
def pages():
    return pq.read_table(PAGES).column("html").to_pylist()


def test_like_the_article_of_each_page(pages):
    scores = []
    for html in pages:
        p = Plain()
        p.feed(html or "")
        want = " ".join(x for x in (re.sub(r"\s+", " ", b).strip() for b in p.blocks) if x)
        scores.append(f1(H.main_text(html), want))
    assert len(scores) == len(pages) and sum(scores) / len(scores) >= 0.99


def plain_labels(blocks, has_article):
    """(length, stop words a word, links a character, in the article, heading) of each block: the two passes, each step for itself."""

    def first(long, stops):
        out = []
        for length, s, links, inside, heading in blocks:
            if links >= 0.5:
                out.append("open" if inside and (heading or s >= 0.15) else "bad")
            elif inside:
                out.append("good" if length >= 70 / 3 and s >= 0.05 else "open")
            elif has_article:
                out.append("good" if length >= 210 and s >= 0.15 else "open")
            elif length >= long and s >= stops:
                out.append("good")
            elif length >= 70 and s < 0.05:
                out.append("doubted")
            else:
                out.append("open")
        return out

    labels = first(70, 0.15)
    if not has_article and "good" not in labels:
        labels = first(70 / 3, 0.05)
    out = []
    for i, label in enumerate(labels):
        length, s, _, inside, heading = blocks[i]
        if label in ("open", "doubted"):
            near = [j for j in range(len(blocks)) if labels[j] in ("good", "bad") and (blocks[j][3] or not inside)]
            before, after = [j for j in near if j < i][-1:], [j for j in near if j > i][:1]
            if not before and not after and (inside or not has_article):
                own = [x for x in blocks if x[3] == inside]
                label = "good" if sum(x[0] for x in own) < 200 or sum(x[1] for x in own) == 0 else "bad"
            elif label == "doubted" or has_article and not inside:
                label = "good" if [labels[j] for j in before + after] == ["good", "good"] else "bad"
            elif not before or not after or heading:
                label = labels[(after or before)[0]]
            else:
                label = labels[before[0] if i - before[0] <= after[0] - i else after[0]]
        out.append(label)
    return out


def plain_text(html):
    """By the plain rules, on a page whose elements without article text are known by their tags and whose only hint is the class of an advert."""
    blocks, _ = H.blocks_of(html)
    blocks = [b for b in blocks if not b.outside and not b.named]
    texts = ["".join(b.parts).strip() for b in blocks]
    words = [re.findall(r"[^\W\d_]+", t.lower()) for t in texts]
    figures = [(len(t), sum(x in H.STOP_WORDS for x in w) / len(w) if w else 0.0, b.linked / b.chars, b.article, b.heading) for b, t, w in zip(blocks, texts, words, strict=True)]
    inside = sum(b.chars for b, f in zip(blocks, figures, strict=True) if b.article and f[0] >= 70 and f[2] < 0.5)
    beside = sum(b.chars for b, f in zip(blocks, figures, strict=True) if not b.article and f[0] >= 70 and f[1] >= 0.15 and f[2] < 0.5)
    if inside < beside:
        figures = [(*f[:3], False, f[4]) for f in figures]
    return " ".join(t for t, x in zip(texts, plain_labels(figures, any(f[3] for f in figures)), strict=True) if x == "good" and t)


CHANGES = {
    "as it is": lambda h: h,
    "without articles": lambda h: re.sub(r"(?i)<(/?)(article|main)\b", r"<\1div", h),
    "without any sign": lambda h: re.sub(r"(?i)</?(article|main|nav|footer|header|aside)\b[^>]*>|<h\d[^>]*>|</h\d>| class=\"[^\"]*\"", "", h),
    "links in the article": lambda h: re.sub(r"(?i)<b>(.{30,90}?)[.]", r"<b><a href='/x'>\1</a>.", h),
    "articles after prose": lambda h: h.replace("<article>", "<div>The house is on the hill and it is of the kind that was built for the people of the town. <p>Short.</p></div><article>"),
}


@pytest.mark.parametrize("change", CHANGES)
def test_the_whole_rule_over_all_pages(pages, change):
    for html in pages:
        html = CHANGES[change](html or "")
        assert H.main_text(html) == plain_text(html)


def test_thresholds_decide(pages, monkeypatch):
    """Each of the thresholds, at an extreme and alone, changes a tenth of the pages or more."""
    now = [H.main_text(h) for h in pages]
    for name, value in (("LONG", 1 << 30), ("FEW_STOPS", 1.0), ("MANY_LINKS", 0.0)):
        with monkeypatch.context() as m:
            m.setattr(H, name, value)
            changed = sum(H.main_text(h) != t for h, t in zip(pages, now, strict=True))
        assert 10 * changed >= len(pages), (name, changed)


def test_without_article_tags_the_text_is_found_too():
    pages = pq.read_table(PAGES.replace("sf0.001", "sf0.1")).column("html").to_pylist()
    bare = CHANGES["without articles"]
    scores = [f1(H.main_text(bare(h)), H.main_text(h)) for h in pages]
    assert sum(scores) / len(scores) >= 0.97


def test_ties_go_to_the_block_before():
    prose = "The house is on the hill and it is of the kind that was built for the people of the town by a man from there."
    links = "<ul><li><a href='/'>a place that has a name</a></li></ul>"
    assert H.main_text(f"<div>{prose}</div><div>Between.</div>{links}") == f"{prose} Between."
    assert H.main_text(f"{links}<div>Between.</div><div>{prose}</div>") == prose
