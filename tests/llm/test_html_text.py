import html
import re

from pyspark.sql import functions as F

from tracewell.llm import html_text

TREE = html_text.train()


def text(page):
    return html_text.main_text(page, TREE)[0]


def test_the_tree_knows_its_labels():
    assert all(html_text.judge(TREE, x) == bool(y) for x, y in html_text.LABELLED)


def test_pages_equal_a_cut_of_their_article(spark):
    """These pages have one flat article of headings and paragraphs, which two patterns can cut out."""
    folder = "/root/testdata/sf0.01"
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.op6_html_text(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        article = r["html"].split("<article>")[1].split("</article>")[0]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(p for p in parts if p)
        assert got[r["page_id"]] == (want, len(want))


def test_what_is_no_main_text():
    page = """<!doctype html><html><head><title>T</title><style>p>a{}</style><script>if (a<b) document.write("</p>")</script></head>
    <body class=home><header><h1>Site</h1><p>Best site</p></header><nav><ul><li><a href=/>Home<li><a href=/x>X</a></ul></nav>
    <div class="cookie-notice">We use cookies. <button>OK</button></div>
    <main><article><h2>Fish &amp chips &lt;3</h2><p>First   para&shy;graph with <a href="a>b">a link</a><br>and a line.
    <p>Short.<aside>Related: cod</aside><ul><li>One thing</li><li>Another <b>thing</b></ul>
    <div class="ad">Buy!</div><form><label>Mail</label><input name=m><textarea>x</textarea></form>
    <blockquote>&ldquo;Quoted&rdquo; &#8212; 5 &#x3c; 6 &notit; a < b</blockquote><!-- no <p>comment</p> -->
    <noscript>Enable</noscript><p hidden>unseen</p><p style="display: none">unseen</p><p>Last one.</p></article>
    <section id="comments"><article><p>I liked this very much, thanks for it all.</p></article></section></main>
    <aside class=sidebar><p>Long side text that nobody needs to read at all, ever.</p></aside>
    <footer>&copy; Us</footer></body></html>"""
    assert text(page).split("\n") == [
        "Fish & chips <3", "First para\xadgraph with a link and a line.", "Short.", "One thing", "Another thing",
        "“Quoted” — 5 < 6 ¬it; a < b", "Last one.",
    ]


def test_pages_without_an_article():
    page = "<ul><li><a>Home</a><li><a>News</a><li><a>Mail</a></ul><h1>Head</h1><div>" + "word " * 30 + "</div><p>" + "more " * 25 + "</p><div><a>Next</a></div>"
    assert text(page) == "Head\n" + ("word " * 30).strip() + "\n" + ("more " * 25).strip()
    assert text("just text") == "just text"


def test_odd_rows(spark):
    pages = [
        None, "", "<", "<p", "<!--", "<!-- x", "<script>", "<p>a<p>b</p></p></div>", "</p></nav>x", "<b>" * 3000 + "deep", "<p>" + "x " * 50000,
        "<article><p>&#0;&#xffffffff;&bogus;    z</article>", "<a" + " b='" * 2000, "<p>same</p>", "<p>same</p>",
    ]
    rows = [(None if i == 4 else i, f"u{i}", p, "clash") for i, p in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["url"]: r for r in html_text.extract(table).collect()}
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert [got[f"u{i}"]["text"] for i in (0, 1, 2, 5, 6, 7, 8, 9, 13, 14)] == ["", "", "<", "", "", "a\nb", "x", "deep", "same", "same"]
    assert got["u11"]["text"] == "��&bogus; z"
    assert html_text.extract(table.limit(0)).count() == 0
    assert html_text.extract(table.withColumn("n_chars", F.lit("x"))).columns == ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"]


LONG = " ".join(["Whole articles have many words."] * 12)


def test_a_head_ends_where_the_body_begins():
    assert text(f"<html><head><title>T</title><meta charset=x><body><p>{LONG}</p></body></html>") == LONG
    assert text(f"<head><title>T</title><p>{LONG}</p>") == LONG
    assert text(f"<head><title>T</title><noscript><p>No</p></noscript><script>x</script>{LONG}") == LONG
    assert text(f"<head><noscript><style>x</style><body><article><p>{LONG}</p></article>") == LONG


def test_wrappers_do_not_hide_the_article():
    side = "<div class=sidebar><article><p>Another story, in a few words.</p></article></div>"
    for wrapper in ("form id=aspnetForm", "div class='has-sidebar'", "div class=no-sidebar", "div id='content-sidebar-wrap'", "div role=form"):
        end = wrapper.split()[0]
        assert text(f"<body><{wrapper}><nav><a>Home</a></nav><article><p>{LONG}</p></article>{side}</{end}></body>").split("\n") == [LONG]
        assert text(f"<body><main><h1>Title</h1><{wrapper}><article><p>{LONG}</p></article></{end}></main></body>") == f"Title\n{LONG}"
    assert text(f"<body><form><ul><li><a>Home</a><li><a>News</a></ul><div>{LONG}</div><div>{LONG}</div></form></body>") == f"{LONG}\n{LONG}"
    comments = f"<div id=comments><article><p>{LONG} {LONG}</p></article></div><aside><article><p>{LONG} {LONG}</p></article></aside>"
    asking = "<form><p>Your address</p><p>We will not give your address to anybody else, and you can leave the list at any time.</p></form>"
    assert text(f"<div class=no-sidebar><article><p>{LONG}</p>{asking}</article>{comments}</div>") == LONG


WRAPPERS = (
    "class='search-results'", "class='ad-free'", "class='login-page'", "class='page-footer-fixed has-menu'", "class='widget-area'",
    "class='content alert'", "class=share", "class='related-content'", "id=page class='site search'", "class='comments'", "role=dialog", "class='ads no-ads'",
)


def test_a_wrapper_of_any_name_loses_no_page():
    menu, foot = "<nav><ul><li><a>Home</a><li><a>News</a></ul></nav>", "<footer><p>All rights are ours, whatever you may think of it.</p></footer>"
    for wrapper in WRAPPERS:
        body = f"<h1>The title</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p>"
        want = ["The title", LONG, "Short one.", LONG]
        assert text(f"<body><div {wrapper}>{menu}{body}{foot}</div></body>").split("\n") == want, wrapper
        assert text(f"<body>{menu}<div {wrapper}>{body}</div>{foot}</body>").split("\n") == want, wrapper
        assert text(f"<body>{menu}<div {wrapper}><article>{body}</article></div>{foot}</body>").split("\n") == want, wrapper
        assert text(f"<body>{menu}<div {wrapper}><div class=site-menu>{body}</div></div>{foot}</body>").split("\n") == want, wrapper


def test_named_elements_beside_the_text_go():
    asides = ("class=ad", "class='ad-container'", "id=cookie-notice", "class='newsletter box'", "class='sidebar-left'", "class='promo 2'", "class='site-footer'")
    for aside in asides:
        box = f"<div {aside}><p>Get our paper every morning before all others, for the price of a cup of tea and no more.</p></div>"
        assert text(f"<body><p>{LONG}</p>{box}<p>{LONG}</p></body>") == f"{LONG}\n{LONG}", aside
        assert text(f"<body><article><p>{LONG}</p>{box}<p>{LONG}</p></article></body>") == f"{LONG}\n{LONG}", aside
    comments = f"<div id=comments><p>{LONG}</p></div>"
    assert text(f"<body><p>{LONG} {LONG}</p>{comments}</body>") == f"{LONG} {LONG}"


def test_an_article_keeps_its_links():
    links = "<ul><li><a href=a>One thing</a><li><a href=b>Another thing</a><li><a href=c>A third</a></ul><p><a>Only a link</a></p><p><a>And one more</a></p>"
    want = f"{LONG}\nOne thing\nAnother thing\nA third\nOnly a link\nAnd one more\n{LONG}"
    assert text(f"<article><p>{LONG}</p>{links}<p>{LONG}</p></article>") == want
    assert text(f"<article><p>{LONG}</p><section class='alert-design'><p>About alerts.</p></section></article>") == f"{LONG}\nAbout alerts."


def test_pages_without_an_article_equal_the_cut(spark):
    """The pages of the table with their article tags gone, and in wrappers: long paragraphs stay, menus and the like go."""
    import random

    rng = random.Random(3)
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(120).collect():
        article = r["html"].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        want = [p for p in parts if len(p.split()) >= html_text.LONG_BLOCK]
        for wrapper in ("div", f"div {rng.choice(WRAPPERS)}"):
            got = text(r["html"].replace("<article>", f"<{wrapper}>").replace("</article>", "</div>")).split("\n")
            assert [p for p in got if p in want] == want, wrapper
            assert set(got) <= set(parts), wrapper
