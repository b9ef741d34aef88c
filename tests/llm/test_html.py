import pytest

from nearcast.llm import html


def main_text(x):
    return html.text_of(x, None, {})


CASES = [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<html><head><title>t</title></head><body><nav><a href='/'>x</a></nav><article><h1>A&nbsp;B</h1><p>one\n two"
     "<p>three <b>four<br>five</p></article><footer>f</footer></body></html>", "A B\none two\nthree four five"),
    ("<body><header>site</header><main><article><header><h1>T</h1></header><p>x</p><aside>no</aside></article>"
     "<article class='comment'><p>reader</p></article></main>", "T\nx"),
    ("<div class='page with-sidebar'><article><p>kept</p><div class='ad'>buy</div><section id='comments'><p>c</p></section>"
     "</article><div class='sidebar'>s</div></div>", "kept"),
    ("<article><p>a<script>var t='</p>';</script>b</p><!-- c > --><style>p{}</style><form><p>q</p></form></article>", "ab"),
    ("<article><p>1 < 2 & 3 &lt; 4 &#233;&#x41;</article>", "1 < 2 & 3 < 4 éA"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
    ("<article><p>open <a href=\"x>y\">link</a> <span class='advert'>gone</span>end", "open link end"),
    ("<article><p>x</article><!-- never closed <p>y", "x"),
    ("<div role='main'><p>m</p></div><div class='cookie-notice'>ok?</div>", "m"),
    ("<body><div class='content'><p>no article tag</p></div><div role='navigation'>n</div></body>", "no article tag"),
    ("<article><p title=\"unclosed>text</p></article>", "text"),
]


@pytest.mark.parametrize("given,want", CASES)
def test_main_text(given, want):
    assert main_text(given) == want


def test_long_and_deep_pages():
    assert main_text("<article>" + "<p>x y</p>" * 30_000 + "</article>") == "\n".join(["x y"] * 30_000)
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>after") == "deep\nafter"
    assert main_text("<article><p>" + "word " * 100_000) == ("word " * 100_000).strip()
    assert main_text("<" * 2000 + "a b=\"" * 2000)


def test_simple_tree_matching():
    a = html.numbered(["", 0, [["x", 1, [["p", 2, []]]], ["y", 3, []], ["z", 4, []]]])
    top, _ = html.slots(html.parse("<div class=n><p>1</div><section><p>2</section>"))
    assert [s.key for s in top.children.values()] == ["div.n", "section"]
    b = html.Slot("")
    b.children = {"y": html.Slot("y"), "x": html.Slot("x"), "z": html.Slot("z")}
    b.children["x"].children = {"p": html.Slot("p")}
    size, pairs = html.matched(a, b)
    assert size == 4 and [p[0][0] for p in pairs] == ["", "x", "p", "z"]


def page(i, words):
    return (f"<html><body><div class='top'>Site name and slogan</div><div class='x'><div class='y'><p>{words}</p>"
            f"<p>more {i}</p></div></div><div class='z'>All rights reserved by someone</div>"
            f"<div class='q'><a href='/{i}'>read {i}</a> <a href='/'>back {i}</a></div></body></html>")


def test_template_is_induced(spark):
    rows = [(i, f"http://h{i % 2}.example/p{i}", page(i, f"article number {i} says this and that"), "x") for i in range(20)]
    rows += [(100, None, "<p>alone</p>", "x"), (101, "http://h0.example/null", None, "x"), (102, "bad url", "<p>b</p>", "x"),
             (103, "http://h0.example/other", "<article><p>an article</p></article>", "x")]
    rows += [(i, f"http://same.example/{i}", "<div class='y'><p>the same long text on every page</p></div><div class='z'>foot</div>", "x")
             for i in range(200, 206)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html.extract(df).collect()}
    assert len(got) == len(rows)
    for i in range(20):
        assert got[i] == f"article number {i} says this and that\nmore {i}"
    assert (got[100], got[101], got[102], got[103]) == ("alone", "", "b", "an article")
    assert all(got[i] == "the same long text on every page" for i in range(200, 206))
    assert html.extract(df.limit(0)).count() == 0


def texts_of(spark, pages):
    rows = [(i, f"http://one.example/{i}", h) for i, h in enumerate(pages)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    return [got[i] for i in range(len(pages))]


def test_template_inside_the_article(spark):
    notice = "<div class='x7'>same notice on every page</div>"
    pages = [f"<article><p>text number {i} has more words than the notice</p>{notice}</article>" for i in range(8)]
    pages += [f"<main><p>first {i} part of a longer text</p>{notice}</main><main><p>second {i} part</p></main>" for i in range(8)]
    got = texts_of(spark, pages)
    assert got[:8] == [f"text number {i} has more words than the notice" for i in range(8)]
    assert got[8:] == [f"first {i} part of a longer text\nsecond {i} part" for i in range(8)]
    again = ["<article><h1>Title</h1><p>the same article</p></article>"] * 5 + ["<article><h1>Other</h1><p>its own text</p></article>"]
    assert texts_of(spark, again) == ["Title\nthe same article"] * 5 + ["Other\nits own text"]


def test_main_elements():
    assert main_text("<main><p>a</p><div role='main'><p>b</p></div></main><main><article>c</article><p>d</p></main>") == "a\nb\nc"


def test_every_page_votes(spark):
    # one unlike page, null or of another layout, cannot be all of the host's frame; a banner that most pages have is template
    deep = "<section>" * 12 + "<ul><li>same menu entry</li></ul><p>own words {i}</p>" + "</section>" * 12
    body = "<div class='qx'>Bannertext</div><div class='y'><p>words of page {i}</p></div>" + deep
    foot = "<div class='z'>a long constant footer that is most of a short page, longer than all that stands above it, by far</div>"
    pages = [(body + foot).replace("{i}", str(i)) for i in range(12)] + [None, "", "<table><tr><td>unlike</table>"]
    got = texts_of(spark, pages)
    assert got == [f"words of page {i}\nown words {i}" for i in range(12)] + ["", "", "unlike"]
