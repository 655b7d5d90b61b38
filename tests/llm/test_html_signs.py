"""Signs of html_text.py that must not decide alone: articles, words of class and id, text in attributes."""

from glyphmill.llm.html_text import main_text

PROSE = "The house is on the hill and it is of the kind that was built for the people of the town by a man from there."
LINKS = "<ul>" + "".join(f"<li><a href='/{i}'>some place {i}</a></li>" for i in range(9)) + "</ul>"


def test_teaser_article_beside_the_text():
    html = f"<body>{LINKS}<div><h1>Title</h1><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p></div>{LINKS}<article><h3><a href='/x'>Read more</a></h3></article><p>Contact</p></body>"
    assert main_text(html) == f"Title {PROSE} Short. {PROSE}"


def test_links_in_an_article():
    html = f"<article><h1><a href='/'>Title</a></h1><p>{PROSE}</p>{LINKS}<p>{PROSE}</p><p>End.</p></article><p>Contact</p>"
    assert main_text(html) == f"Title {PROSE} {PROSE} End."


def test_other_languages_in_an_article():
    text = "Talo on kukkulalla ja se rakennettiin kaupungin asukkaille kauan ennen kuin tie tuli. " * 2
    assert main_text(f"<nav>x</nav><article><h1>Talo</h1><p>{text}</p></article><p>Contact</p><footer>y</footer>") == f"Talo {text.strip()}"


def test_text_in_attributes():
    for tag in ('div style="overflow:hidden"', "div data-hidden='false'", 'div title="class=ad hidden"', "div data-class=ad"):
        assert main_text(f"<body><{tag}><article><p>{PROSE}</p></article></div></body>") == PROSE, tag
    assert main_text(f"<body><div hidden><p>{PROSE}</p></div><div aria-hidden=true>{PROSE}</div></body>") == ""


def test_words_of_class():
    html = f"<body><div class='content with-sidebar'><h1>Title</h1><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p><p>{PROSE}</p><div class='sidebar'>Find us in the town.</div></div>{LINKS}</body>"
    assert main_text(html) == f"Title {PROSE} Short. {PROSE} {PROSE}"
    html = f"<article><div class='entry-header'><h1>Title</h1></div><p>{PROSE}</p><div class='ad'>The ad of the day.</div><p>{PROSE}</p></article><div class='comments'><p>{PROSE}</p></div>"
    assert main_text(html) == f"Title {PROSE} {PROSE}"
