"""The content region keeps all of a page's main text."""

import time

import numpy as np
import pytest

from weftline.llm import html_text
from weftline.llm.html_text import main_text

LEAD, BODY = "Lead of some words here. " * 4, "A sentence of the body text. " * 40
MENU = "<div class=menu>" + "".join(f"<a href={i}>m{i}</a>" for i in range(9)) + "</div>"


def _lines(page):
    return main_text(page).split("\n\n")


def test_title_and_lead_beside_a_large_body():
    page = f"<body>{MENU}<div id=content><h1>Title of it</h1><div class=lead><p>{LEAD}</p></div><div class=body><p>{BODY}</p><p>{BODY}</p></div></div></body>"
    assert _lines(page) == ["Title of it", LEAD.strip(), BODY.strip(), BODY.strip()]


def test_small_article_does_not_replace_the_body():
    page = f"<body><article><p>Teaser only.</p></article><div id=text><p>{BODY}</p><p>{BODY}</p></div></body>"
    assert _lines(page)[-2:] == [BODY.strip()] * 2
    assert _lines(f"<body><div><p>{LEAD}</p></div><article><h1>T</h1><p>{BODY}</p></article></body>") == ["T", BODY.strip()]
    two = f"<body><main><article><p>{BODY}</p></article><article><p>{BODY}</p></article></main></body>"
    assert _lines(two) == [BODY.strip()] * 2


def test_names_are_whole_tokens():
    for name in ("has-sidebar", "no-sidebar", "page has-sidebar wide"):
        assert _lines(f"<body><div class='{name}'><p>{BODY}</p></div></body>") == [BODY.strip()]
    assert _lines(f"<body><div><div class=article-header><h1>Title</h1></div><p>{BODY}</p></div></body>") == ["Title", BODY.strip()]
    for name in ("sidebar", "x sidebar", "cookie-notice", "site-footer", "nav_menu"):
        assert _lines(f"<body><div><p>{BODY}</p><div class='{name}'><p>{LEAD}</p></div></div></body>") == [BODY.strip()]


def test_page_under_one_boilerplate_name_is_not_empty():
    assert _lines(f"<body><div class=widget><p>{BODY}</p><nav>Menu</nav></div></body>") == [BODY.strip()]


def test_short_outer_lines_stay():
    assert _lines(f"<body><p>By me</p><p>{BODY}</p><p>{BODY}</p><p>{BODY}</p><p>{BODY}</p><p>{BODY}</p><p>End.</p></body>") == ["By me", *[BODY.strip()] * 5, "End."]


def test_links_beside_the_body_stay_out():
    page = f"<body><div id=page><div><a href=1>one</a><p><a href=2>two</a></p></div><div><h2>Part</h2><div><p>{BODY}</p><p>{BODY}</p></div></div></div></body>"
    assert _lines(page) == ["Part", *[BODY.strip()] * 2]
    assert _lines(f"<body><h1>Title</h1><p><a href=1>one</a></p><div><p>{BODY}</p><p>{BODY}</p></div></body>")[0] == "Title"


NAV, END = "<nav><a href=1>one</a><a href=2>two</a></nav>", "<footer>foot</footer>"
ARTICLE = f"<body>{NAV}<div class=ad>Buy it now</div><article><h1>Title</h1><p>{BODY}</p><div class=alert>Ok?</div><p>{BODY}</p></article>{END}</body>"
BARE = f"<body><div><a href=1>one</a> <a href=2>two</a></div><div id=x><h2>Part</h2><p>{BODY}</p><p>{BODY}</p></div><div class=share>Pass on</div></body>"


def test_clusters_decide(monkeypatch):
    with_clusters = [_lines(ARTICLE), _lines(BARE)]
    assert with_clusters == [["Title", BODY.strip(), BODY.strip()], ["Part", BODY.strip(), BODY.strip()]]
    monkeypatch.setattr(html_text, "high_cluster", lambda x: np.ones(len(x), bool))
    without = [_lines(ARTICLE), _lines(BARE)]
    assert "Ok?" in without[0] and "Pass on" in without[1] and "one two" in without[1]


@pytest.mark.parametrize("name", "social-science search-results related-work notices share-price alert widget".split())
def test_no_text_goes_by_its_name_alone(name):
    for inner in (f"<p>{BODY}</p>", "".join(f"<p>Sentence {i} of some length here.</p>" for i in range(12))):
        page = f"<body>{NAV}<article><h1>Title of it</h1><div class='{name}'>{inner}</div></article>{END}</body>"
        assert _lines(page) == ["Title of it", *(x.strip() for x in inner.replace("</p>", "").split("<p>")[1:])]


def test_reader_comments_and_notices_outside_go():
    page = f"<body>{NAV}<article><h1>Title</h1><p>{BODY}</p><section class='comments-area'><p>{LEAD}</p><p>{LEAD}</p></section></article><div class=notice><p>{LEAD}</p></div><div id=cookie-bar><p>{LEAD}</p></div>{END}</body>"
    assert _lines(page) == ["Title", BODY.strip()]


def test_sibling_articles_stay():
    short = "A short one, without a link to anything."
    assert _lines(f"<body>{NAV}<article><p>{BODY}</p></article><article><p>{short}</p></article></body>") == [BODY.strip(), short]
    assert _lines(f"<body>{NAV}<main><h1>T</h1><div><article><p>{BODY}</p></article></div><article><p>{BODY}</p></article></main></body>") == ["T", BODY.strip(), BODY.strip()]


def _text(n, word="word"):
    return (word + " ") * (n // (len(word) + 1))


def test_near_equal_blocks_all_stay():
    one, two = _text(336, "first"), _text(384, "other")
    assert _lines(f"<body><div><p>{one}</p></div><div><p>{two}</p></div></body>") == [one.strip(), two.strip()]
    lead = _text(120, "lead")
    for n in (120, 40):  # a much shorter one stays too: nothing but text is added up to the body
        assert _lines(f"<body><div class=lead><p>{lead[:n]}</p></div><div class=text><p>{one}</p><p>{two}</p></div></body>") == [lead[:n].strip(), one.strip(), two.strip()]
    assert _lines(f"<body><div><a href=x>Home</a> <a href=y>About us</a></div><div class=text><p>{one}</p><p>{two}</p></div></body>") == [one.strip(), two.strip()]


def test_what_is_never_shown():
    one = _text(300)
    for attr in ("style='display:none'", 'style="color:red; DISPLAY : none"', "hidden", "hidden=''", "style='visibility:hidden'"):
        assert _lines(f"<body><div {attr}><p>{_text(900, 'unseen')}</p></div><p>{one}</p></body>") == [one.strip()]
    assert _lines(f"<body><p>{one}<button>Share it</button><span style='display:none'>no</span></p></body>") == [one.strip()]
    assert _lines(f"<body><p style='xdisplay:none'>{one}</p></body>") == [one.strip()]


def test_comments_are_told_by_their_shape():
    story, comments = _text(800), "<div class=thread>" + f"<div class=msg><b>Name</b><p>{_text(600, 'reply')}</p></div>" * 5 + "</div>"
    assert _lines(f"<body><article><p>{story}</p></article>{comments}</body>") == [story.strip()]
    long = _text(4000)
    assert _lines(f"<body><div class=story><p>{story}</p><p>{long}</p></div>{comments}</body>") == [story.strip(), long.strip()]
    sections = "".join(f"<div class=sec><h2>Part {i}</h2><p>{_text(600, 'part')}</p></div>" for i in range(4))
    assert len(_lines(f"<body><div class=intro><p>{long}</p></div><div class=all>{sections}</div></body>")) == 9
    paragraphs = "".join(f"<div class=para>{_text(500, 'para')}</div>" for i in range(6))
    assert len(_lines(f"<body><div class=intro><p>{story}</p></div><div class=all>{paragraphs}</div></body>")) == 7
    assert len(_lines(f"<body><article><p>Teaser only.</p></article><div class=all>{paragraphs}</div></body>")) >= 6


def test_smoothing_decides(monkeypatch):
    """A long line among menu lines is no content; without smoothing it would draw the whole menu in."""
    menu = "<ul>" + "<li><a href=x>short item</a></li>" * 12 + f"<li>{_text(160, 'lone')}</li>" + "<li><a href=x>short item</a></li>" * 12 + "</ul>"
    body = [_text(400 + 10 * i).strip() for i in range(5)]
    page = f"<body><div id=page><div class=x>{menu}</div><div class=b>{''.join(f'<p>{b}</p>' for b in body)}</div></div></body>"
    assert _lines(page) == body
    monkeypatch.setattr(html_text, "smoothed", lambda x: x)
    assert len(_lines(page)) > 20


def test_time_and_memory_grow_with_the_page():
    pages = [lambda n: "<div>word " * 2 * n, lambda n: "<b>" * 8 * n + "<div>x</div>" * 8 * n, lambda n: "<a " * 20 * n, lambda n: "<!--" * 20 * n, lambda n: '<a b="' * 12 * n, lambda n: '<a b="' * 12 * n + ">", lambda n: "<![CDATA[" * 12 * n, lambda n: "<article>" * 2 * n + "<p>text</p>" * 2 * n, lambda n: "<" * 20 * n, lambda n: f"<article><p>{BODY}" * n]

    def seconds(page):
        best = 1e9
        for _ in range(3):
            began = time.process_time()
            main_text(page)
            best = min(best, time.process_time() - began)
        return best

    for page in pages:  # twice the page takes about twice the time, on a machine of any speed
        assert seconds(page(2000)) < 3 * seconds(page(1000)) + 0.1, page(1)[:20]
    assert len(_lines("<div>word " * 5000)) == 5000
    assert _lines(f"<body><p>{BODY}</p><!-- never closed <p>{BODY}</p><p>{BODY}</p></body>")[0] == BODY.strip()


def test_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    assert html_text.extracted(spark.createDataFrame([], schema)).collect() == []
    big = 2**53 + 1
    rows = [(big, "u", ARTICLE, "x", "y"), (None, None, None, None, None), (big, "u", ARTICLE, "x", "y"), (2, "v", f"<article><p>{BODY * 2000}</p></article>", None, None)]
    got = html_text.extracted(spark.createDataFrame(rows, schema).coalesce(1)).collect()
    assert [(r.page_id, r.n_chars) for r in got] == [(r[0], len(main_text(r[2]))) for r in rows] and got[3].n_chars > 1_000_000
    assert got[0].__fields__ == ["page_id", "url", "text", "n_chars"]
