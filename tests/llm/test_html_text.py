from glyphmill.llm.html_text import extract_text, main_text


def test_article_without_the_rest():
    html = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{a:b}</style><script>var t="</p>";</script></head><body class="has-sidebar">
    <header><h2>Site</h2></header><nav><ul><li><a href="/x">x</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">The ad of the day is in the house.</div>
    <div id="cookie-notice">We use the cookies of this site.</div>
    <article><header><h1>Fish &amp; chips&nbsp;&#x41;</h1></header><p><b>First   of all.<br><p>Second, with <a href='/y>z'>a link</a> in it &lt;b&gt;.</p>
    <aside>not this</aside><form><label>Name</label></form><ul><li>one</li><li>two</li></ul><div class="comments"><p>I like the fish of this place.</p></div></article>
    <section class="comment-list"><article class="comment">Me too, the fish is good.</article></section><footer>&copy; 2020 The firm of it</footer></body></html>"""
    assert main_text(html) == "Fish & chips A First of all. Second, with a link in it <b>. one two"


def test_without_article():
    prose = "The house is on the hill and it is of the kind that was built for the people of the town by a man from there."
    links = "<ul>" + "".join(f"<li><a href='/{i}'>some place {i}</a></li>" for i in range(9)) + "</ul>"
    html = f"<body>{links}<h1>Title</h1><p>{prose}</p><p>Short.</p><p>{prose}</p>{links}<p>Contact</p></body>"
    assert main_text(html) == f"Title {prose} Short. {prose}"


def test_odd_input():
    assert main_text(None) == main_text("") == main_text("<p") == main_text("<script>never ends") == ""
    assert main_text("<article><p>a < b and c<!-- open") == "a < b and c"
    assert main_text("<article>x &am &amp y &quo") == "x &am & y &quo"
    long = "<article>" + "<p>word &amp; word</p>" * 50000 + "</article>"
    assert main_text(long).count("word & word") == 50000
    assert main_text("<div " * 20000) == "" and main_text("<a '" * 2000 + "<article>ok") is not None


def test_every_row(spark):
    df = spark.createDataFrame([(1, "u", "<article>Ä<br>b</article>", 1), (1, "u", None, 2), (None, None, "", 3)], "page_id long, url string, html string, text int")
    assert sorted(map(tuple, extract_text(df).collect()), key=repr) == sorted([(1, "u", "Ä b", 3), (1, "u", "", 0), (None, None, "", 0)], key=repr)
    assert extract_text(df.limit(0)).collect() == []
