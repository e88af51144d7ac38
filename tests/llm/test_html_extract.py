import html
import re

from pyspark.sql import functions as F

from tessera.llm import html_extract as h

BODY = "The first sentence of the story, which is long enough to matter. It goes on, and on.", "A second paragraph; with &quot;quotes&quot; &amp; more text, as an article has."


def plain_article(page):
    """For the fixture's template: the text between its article tags, block by block."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1|br)>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[a-z/!][^>]*>", "", s)).split()) for s in parts)
    return " ".join(t for t in texts if t)


def test_query_matches_brute_force(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = h.op1_html(spark, sf).collect()
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in got} == {k: (p.url, plain_article(p.html), len(plain_article(p.html))) for k, p in pages.items()}


def page(before="", inside=None, after=""):
    body = "".join(f"<p>{p}</p>" for p in BODY) if inside is None else inside
    return f"<html><head><title>T</title></head><body>{before}{body}{after}</body></html>"


WANT = html.unescape(" ".join(BODY))


def test_what_is_left_out():
    extras = [
        "<nav><ul><li><a href='/'>Home</a><li><a href='/b'>More, more.</a></ul></nav>",
        "<header><p>The site, its name. And a slogan, too.</p></header>",
        "<div class='cookie-notice'><p>We use cookies, as all do. Accept them, please.</p></div>",
        "<aside><p>Some text beside it, long enough. Really.</p></aside>",
        "<div id=sidebar><p>Latest: this, that, and the other. And more of it.</p></div>",
        "<form><p>Your mail, please.</p><input name=q><select><option>One.</option></select></form>",
        "<section class='comments'><h3>Comments</h3><article class='comment'><p>I read it, twice. It was good, very good, I think.</p></article></section>",
        "<div class='ad'>Buy it, now. It is cheap, very cheap, cheaper than ever before.</div>",
        "<footer>&copy; A, B. All rights.</footer>",
        "<script>var x = '<p>no, no.</p>';</script><style>p { color: red }</style><!-- <p>no, never.</p> -->",
        "<p style='display: none'>Hidden, of course.</p><div role=navigation>Up, down.</div>",
        "<ul><li><a href=1>Link one</a></li><li><a href=2>Link two</a></li></ul>",
    ]
    for extra in extras:
        for shape in (page(before=extra), page(after=extra), page(before=extra, after=extra)):
            assert h.main_text(shape) == WANT, extra
        wrapped = page(before=extra, inside="<main><article><header><h1>Title</h1><p>by X, today</p></header>" + "".join(f"<p>{p}</p>" for p in BODY) + "</article></main>", after=extra)
        assert h.main_text(wrapped) == "Title " + WANT, extra


def test_names_do_not_bar_the_article():
    text = "".join(f"<p>{p}</p>" for p in BODY)
    nav = "<nav><a href='/'>Home</a></nav><div class='sidebar'><p>Latest: this, that, and the other.</p></div>"
    comments = "<div class='comments'>" + "<article><p>I read it, twice. It was good, very good, I think, and so on.</p></article>" * 9 + "</div>"
    shapes = [
        f"<article class='post category-social'>{text}</article>",
        f"<div class='content-with-sidebar'><article>{text}</article></div>",
        f"<div class='content-with-sidebar'>{text}</div>",
        f"<div class='search-results-page'><article>{text}</article></div>",
        f"<form action='x' id='aspnetForm'><div>{nav}<div id='content'>{text}</div></div></form>",
        f"<form>{nav}<article>{text}</article></form>",
        f"<div class='popup'>{nav}<article>{text}</article></div>",
        f"<article class='post comments-open'>{text}</article>",
        f"<div id='page' class='widget'>{text}</div>",
    ]
    for shape in shapes:
        for after in ("", comments):
            assert h.main_text(page(inside=shape, after=after)) == WANT, shape
    inner = f"<article>{text}<h2 id='related-work'>Related work</h2>{text}<section id='discussion'><h2>Discussion</h2>{text}</section></article>"
    assert h.main_text(page(inside=inner)) == f"{WANT} Related work {WANT} Discussion {WANT}"
    links = "<div class='related'><h3>Related</h3><ul><li><a href='/1'>One, two.</a></li><li><a href='/2'>Three, four.</a></li></ul></div>"
    small = "<form><p>Your mail, please.</p></form>"
    assert h.main_text(page(inside=f"<article>{text}{links}{small}</article>")) == WANT


def test_white_space_references_and_bad_markup():
    text = "<article><h1>A &lt;b&gt; title</h1><p><b>One<br>two\n three&nbsp;four<p>in<i>li</i>ne &#233;&eacute; <a href='x>y'>li</a><div>x < y</div></p></article>"
    assert h.main_text(text) == "A <b> title One two three four inline éé li x < y"
    for bad in ("<", "<a", "<!--", "<script>", "</p></div>", "<p", "<a href=\"", "<!DOCTYPE", "&", "\x00"):
        h.main_text(bad)
    assert h.main_text("<p>" + "Deep, deep. " * 50_000).count("Deep") == 100_000 / 2
    assert h.main_text("<div>" * 800 + "Text, at last. More of it." + "</div>" * 800) == "Text, at last. More of it."


def test_nulls_and_extra_columns(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "v", page(), "x"), (None, "v", page(), "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.url, r.n_chars) for r in h.extract(pages).orderBy("n_chars", "url").collect()]
    assert got == [(None, 0), ("u", 0), ("v", len(WANT)), ("v", len(WANT))]
    assert h.extract(pages.where(F.lit(False))).count() == 0
