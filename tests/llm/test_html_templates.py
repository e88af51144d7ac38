"""Pages of different makes with labelled main text, and pages that must not take long."""

import time

import pytest

from tessera.llm.html_extract import main_text, unescape

P1 = "The harbour froze early that year, and nobody in the town had expected it to last. It lasted until May."
P2 = "Boats lay on the ice like toys; children walked out to them, and the fishermen, who had nothing else to do, let them climb aboard."
P3 = "When the thaw came it came at night, with a noise like distant guns, and in the morning the water was open again."
WANT = f"{P1} {P2} {P3}"
PARAS = f"<p>{P1}</p>\n<p>{P2}</p>\n<p>{P3}</p>"
MENU = "<ul class='menu'><li><a href='/'>Home</a></li><li><a href='/news'>News</a></li><li><a href='/about'>About us</a></li></ul>"
PROMO = "<p>Read our best stories, every day, for less than a coffee. Cancel at any time, no questions asked.</p>"

TEMPLATES = {
    "blog": (
        f"<body class='single post-template'><header class='site-header'><h1><a href='/'>My Blog</a></h1><p>Notes, mostly about weather.</p></header><nav>{MENU}</nav>"
        f"<main id='content'><article class='post hentry category-social'><div class='post-header'><h1>The ice</h1><p class='byline'>by Ann</p></div>{PARAS}"
        "<div class='share-buttons'><a href='#'>Tweet</a> <a href='#'>Share</a></div></article>"
        "<section id='comments' class='comments-area'><h2>3 comments</h2><ol><li><p>I remember that winter, it was terrible. My aunt lost a boat.</p></li></ol></section></main>"
        f"<aside class='widget-area'>{PROMO}</aside><footer><p>All rights reserved, 2020. Made by hand.</p></footer></body>",
        f"The ice {WANT}",
    ),
    "div_soup": (
        f"<div id='wrap'><div id='top' class='topbar'>{MENU}</div><div class='layout sidebar-right'><div class='col1'><div class='story'>{PARAS}</div></div>"
        f"<div class='col2 sidebar'><h3>Latest</h3>{PROMO}</div></div><div id='footer'>Contact us, any time. Imprint.</div></div>",
        WANT,
    ),
    "two_columns": (f"<div class='page-with-sidebar'><div class='two-column sidebar-left'>{MENU}<div>{PARAS}</div></div></div>", WANT),
    "layout_table": (f"<table><tr><td width=100>{MENU}</td><td><h2>Ice</h2>{PARAS}</td></tr><tr><td colspan=2><a href='/'>Back</a> | <a href='/up'>Up</a></td></tr></table>", f"Ice {WANT}"),
    "one_form": (f"<form id='aspnetForm'><div class='nav'>{MENU}</div><div id='ctl00_main'><h1>Ice</h1>{PARAS}</div><div class='login'><p>Your name, your word.</p></div></form>", f"Ice {WANT}"),
    "line_breaks": (f"<div class='nav'>{MENU}</div><div class='entry'>{P1}<br><br>{P2}<br><br>{P3}</div><div class='ad'>Buy ice, now. It is cheap.</div>", WANT),
    "docs": (
        f"<div class='sidenav'>{MENU}</div><div role='main'><h1>Ice</h1>{PARAS}<pre>freeze --hard\nthaw</pre><ul><li>cold</li><li>colder</li></ul><h2 id='related-work'>Notes</h2><p>{P1}</p></div>"
        "<div class='pager'><a href='/2'>Next</a></div>",
        f"Ice {WANT} freeze --hard thaw cold colder Notes {P1}",
    ),
    "science_names": (f"<div class='social-science popular-science follow-up'><div class='content-widget'><article>{PARAS}</article></div></div><div class='promo'>{PROMO}</div>", WANT),
    "many_comments": (
        f"<article>{PARAS}</article><div class='comment-list'>" + "<div class='comment'><p>Well said, all of it. I was there too, and I saw the boats, and the ice, and the guns.</p></div>" * 40 + "</div>",
        WANT,
    ),
    "notices": (f"<div class='cookie-banner'>{PROMO}</div><div class='container'><div class='row'><div class='text'>{PARAS}</div></div></div><div class='newsletter-box'>{PROMO}</div>", WANT),
    "huge_text": (f"<div id='c'><h1>Ice</h1><div class='body'>{'<br>'.join([P1, P2, P3] * 60)}</div></div><div class='sidebar'>{PROMO * 20}</div>", "Ice " + " ".join([WANT] * 60)),
    "bare": (f"{MENU}<h1>Ice</h1>{PARAS}", f"Ice {WANT}"),
    "index": ("<main>" + f"<article><h2>Ice</h2><p>{P1}</p></article>" * 4 + f"</main><aside>{PROMO}</aside>", " ".join([f"Ice {P1}"] * 4)),
    "boxes_in_article": (
        f"<article><h1>Ice</h1><p>{P1}</p><aside class='pullquote'><p>Nobody had expected it, nobody.</p></aside><p>{P2}</p><div class='related'><ul><li><a href='/a'>One, two.</a></li><li><a href='/b'>Three.</a></li></ul></div>"
        f"<div class='advert'><p>Buy ice, now. Cheap, very cheap ice.</p></div><p>{P3}</p><form><p>Your mail, please.</p></form></article>",
        f"Ice {WANT}",
    ),
}


@pytest.mark.parametrize("name", TEMPLATES)
def test_template(name):
    page, want = TEMPLATES[name]
    assert main_text(f"<!DOCTYPE html><html><head><title>x</title></head>{page}</html>") == want


def test_paths_under_the_threshold_go_inside_an_article_too():
    links = "<div class='x1'><a href='/1'>One more story</a> <a href='/2'>And one more</a></div>"
    assert main_text(f"<article>{PARAS}{links}</article>") == WANT


@pytest.mark.parametrize(
    "page",
    [
        "<div>x" * 2_000,
        "<div>x" * 100_000,
        "<a " * 350_000,
        '<a "' * 250_000 + ">",
        "<a<" * 300_000,
        "<" * 1_000_000,
        "<div>" * 5_000 + "</b>" * 50_000,
        "<i>" + "<div>" * 5_000 + "</i>" * 50_000,
        "<div>" * 5_000 + "<li></li>" * 50_000,
        "<b>" * 50_000 + "<p>" * 50_000,
        "<object>" * 100_000 + "x",
        "<div class=comments>" * 30_000 + P1,
        "&" * 1_000_000,
        "<!--" * 200_000,
    ],
    ids=range(14),
)
def test_linear_on_deep_and_malformed_pages(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 4


def test_long_references():
    assert unescape("a&#x41;&#" + "9" * 10_000 + ";&#000000000000065;&amp;&#xD800;") == "aA�A&�"
