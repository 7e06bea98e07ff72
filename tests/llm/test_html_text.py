import re
from html import unescape

import pytest

from cardwatch.llm.html_text import extract, main_text, measure, read

PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<header class="site"><h1>Site</h1></header><nav><a href=x>Home</a> <a href=y>More</a></nav>
<div id="cookie-notice">We use cookies on this page, please accept them all now.</div>
<div class="layout"><div class="post"><h2>The  head</h2><p>First <b>bold</b> text, which is long enough to count &amp; more of it.
<p>Second &lt;para&gt; with an <a href=z>inner link</a> in it and some words.</p><ul><li>one<li>two</ul></div>
<div class="sidebar">Other posts that are long enough to look like text of the article itself.</div></div>
<section class="comments"><p>Reader says that this is a long comment on the article, really long.</p></section>
<form>Name <input></form><footer>Imprint</footer><script>var x = "<p>no</p>";</script></body></html>"""


def test_article_only():
    assert main_text(PAGE) == ("The head\nFirst bold text, which is long enough to count & more of it.\n"
                               "Second <para> with an inner link in it and some words.\none\ntwo")


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain", "plain"), ("a < b", "a < b"), ("<p>a<p>b", "a\nb"), ("<p title='a>b'>x</p>", "x"), ("<!-- <p>x --> y", "y"),
    ("<script>x", ""), ("<div", ""), ("<p>a<br>b</p>", "a b"), ("<p>a&nbsp;&nbsp; b&copy;</p>", "a b©"), ("</p></div>x", "x"), ("<P>A</P><DIV CLASS='Ad'>no</DIV>", "A"),
    ("<article><h1>H</h1></article><footer>f", "H"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<div>" * 3000 + "deep", "deep"), ("<p>&#x41;&#66;&unknown;</p>", "AB&unknown;"),
])
def test_markup(html, text):
    assert main_text(html) == text


def test_links_thin_a_node():
    root = read("<div><p>some plain words in a row here</p><p><a href=x>some linked words in a row</a></p></div>")
    measure(root)
    plain, linked = root.kids[0].kids
    assert plain.density > linked.density


def test_whole_table(spark, sf_small):
    """The pages' article element, read by pattern."""
    from cardwatch.llm.queries import op10_html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    rows = op10_html(spark, sf_small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_odd_rows(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "u", "", "y"), (2, "u", "<p>" + "w " * 200_000 + "</p>", None)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract(table).collect()
    assert sorted(len(r.text) for r in out) == [0, 0, 0, 399_999]
    assert extract(table.where("page_id = 99")).collect() == []


@pytest.mark.parametrize(("html", "text"), [
    ('<body><p class="notice">Please note<p>Article text here.</body>', "Article text here."),
    ('<ul><li class="share">Share<li>First point<li>Second point</ul>', "First point\nSecond point"),
    ('<article>a<form>b<form>c</form>d</article>', "ad"),
    ('<html><head><meta charset=x><title>T</title><body><p>x', "x"),
    ('<head><title>T</title><p>x', "x"),
    ('<head><meta charset=x>\nx', "x"),
    ('<article><a class="ad"><div>Buy<a href=x>it</a></div>rest</article>', "rest"),
    ('<article>a<button>b<button>c</button>d</article>', "ad"),
    ('<article><div class="ad">Buy</article> more text', "more text"),
    ('<div><article>Kept <div class="ad">Buy</article></div><p>x</p>', "Kept\nx"),
    ('<article>One <svg class="i" viewBox="0 0 1 1"/> two</article>', "One two"),
    ('<article>One <svg><title/><path d="M0"/><g><circle></svg> two</article>', "One two"),
    ('<article>One <svg><path d="M0"><p>two</p></article>', "One\ntwo"),
    ('<article><table><tr><td class="ad">Buy<td>cell<tr class="ad"><td>x<tr><td>next</table>end</article>', "cell\nnext\nend"),
    ('<article><dl><dt class="ad">Buy<dd>kept</dl>end</article>', "kept\nend"),
    ('<article><span>a<div class="ad">b</span>c</div>d</article>', "ad"),
    ('<article><div>a<table><tr><td class="ad">b</div>c</td></tr></table>d</div>e</article>', "a\nd\ne"),
    ('<article><nav><ul><li>x<li>y</ul></nav>kept</article>', "kept"),
])
def test_left_out_elements_end_as_others_do(html, text):
    assert main_text(html) == text


ARTICLE = "<p>The first paragraph of the article is about the sea and its ships.</p><p>The second one goes on about the harbour and the lights.</p>"
TEXT = "The first paragraph of the article is about the sea and its ships.\nThe second one goes on about the harbour and the lights."


@pytest.mark.parametrize("wrapper", ['class="content with-sidebar"', 'class="has-banner"', 'class="post no-comments"', 'class="entry-content ad-free"',
                                     'class="elementor-widget-container"', 'class="elementor-element elementor-widget"', 'id="post-with-related"', 'class="widget"', 'class="promo"'])
def test_wrappers_of_the_article_stay(wrapper):
    assert main_text(f"<body><div {wrapper}>{ARTICLE}</div></body>") == TEXT
    assert main_text(f"<body><nav>Menu</nav><div {wrapper}><article>{ARTICLE}<div class='ad'>Buy</div></article></div></body>") == TEXT
    assert main_text(f"<body><main><h1>Head</h1><div {wrapper}>{ARTICLE}</div></main></body>") == "Head\n" + TEXT


@pytest.mark.parametrize("part", [
    '<div class="box ad">Buy</div>', '<div id="cookie-notice">We set cookies.</div>', '<div class="site_sidebar">Other</div>', '<div class="ad-300x250">Buy</div>',
    f'<div id="comments"><ol><li class="comment"><article>{ARTICLE * 3}</article></ol></div>', f'<section class="related">{ARTICLE * 3}</section>',
    f'<section class="related"><article>{ARTICLE}</article><article>{ARTICLE}</article></section>'])
def test_named_parts_are_left_out(part):
    assert main_text(f"<body><main><article>{ARTICLE}</article>{part}</main></body>") == TEXT


@pytest.mark.parametrize("name", [
    "comment-list", "comments-list", "commentList", "ad-slot", "advert-box", "adSlot", "AD", "ad1", "cookie-bar", "newsletter-signup", "footer-links", "site-footer-inner",
    "share_buttons", "related-posts", "post-comments-area", "col-3 cookieBanner", "promo--wide", "main-nav-list"])
def test_listed_words_count_in_any_part(name):
    """Names of adverts, comments and the like as sites write them."""
    other = "<p>Buy the best lamp of all lamps today.</p>"
    assert main_text(f'<body><main><article>{ARTICLE}<div class="{name}">{other}</div></article></main></body>') == TEXT
    assert main_text(f'<body><div class="post">{ARTICLE}</div><div id="{name}">{other}</div></body>') == TEXT


@pytest.mark.parametrize("name", ["with-sidebar", "no-comments", "has-ad-free", "comments-free", "no-ads", "shadow", "advance", "header-adjust", "menus", "navy", "leads-form"])
def test_words_that_only_look_listed(name):
    assert main_text(f'<body><main><article>{ARTICLE}<div class="{name}"><p>Kept.</p></div></article></main></body>') == TEXT + "\nKept."


@pytest.mark.parametrize("html", ['<div class="notice"><p>Short text only.</p></div>', '<body><div class="cookie-bar"><p>Short text only.</p></div></body>',
                                  '<div id="comments"><div class="ad">Short text only.</div></div>'])
def test_short_page_in_a_named_element(html):
    """A page keeps its text whatever its length if nothing else has any."""
    assert main_text(html) == "Short text only."


def test_deep_markup_in_time():
    import time

    n = 8000
    deep = ["<b>" * n + "x" + "</i>" * n, "<i>" * n + "<div>" * n + "x" + "</i>" * n, "<b>" * n + "<p>x</p>" * n, "<div>" * n + "</span>" * n + "x",
            "<a><div>" * n + "x", "<div class='ad'>" * n + "x", "<ul><li>" * n + "x", "<svg><g>" * n + "x"]
    start = time.process_time()
    for html in deep:
        main_text(html)
    assert time.process_time() - start < 8  # under a second each


def test_comments_longer_than_the_article():
    assert main_text(f'<body><div><h1>Head</h1>{ARTICLE}</div><div id="comments">{ARTICLE * 5}</div></body>') == "Head\n" + TEXT


def test_nested_names_are_read_in_time():
    assert main_text('<div class="ad">' * 3000 + "w " * 200).split() == ["w"] * 200


LONG = "a long line of bare text that tells of ships and harbours " * 5
BARE = " ".join(LONG.split())
BOX = f"<div><p>{'u' * 100}</p><p>{'v' * 100}</p></div>"
BOXED = "u" * 100 + "\n" + "v" * 100


@pytest.mark.parametrize(("html", "text"), [
    (f"<body>{LONG}<br><br>{LONG}{BOX}</body>", f"{BARE} {BARE}\n{BOXED}"),
    (f"<body>{BOX}{LONG}<br><br>{LONG}</body>", f"{BOXED}\n{BARE} {BARE}"),
    (f"<body>{LONG}{BOX}<i>{LONG}</i> {LONG}</body>", f"{BARE}\n{BOXED}\n{BARE} {BARE}"),
    (f"<body>{f'{LONG}<b>x</b><i>y</i><b>z</b><br><br>' * 3}<div>{BOX * 3}</div></body>", " ".join([f"{BARE} xyz"] * 3) + "\n" + "\n".join([BOXED] * 3)),
    (f"<body><font>{LONG}<br><br>{LONG}</font>{BOX}</body>", f"{BARE} {BARE}\n{BOXED}"),
    (f"<body><span><b>one</b><b>two</b></span> {LONG}</body>", f"onetwo {BARE}"),
    (f"<body><table><tr><td>{LONG}<br><br>{LONG}<td>{LONG}</table></body>", f"{BARE} {BARE}\n{BARE}"),
    (f"<body><div>{LONG}<br/>\n<br/>{LONG}</div>{BOX}</body>", f"{BARE} {BARE}\n{BOXED}"),
    ("<article>a<br><br>b<p>c</p>d <i>e</i></article>", "a b\nc\nd e"),
])
def test_bare_text_between_blocks(html, text):
    assert main_text(html) == text
