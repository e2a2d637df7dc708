from __future__ import annotations

from allotment.llm.html import extract, main_text

SENTENCE = "This is a paragraph that has many of the words that are in the language and it goes on for a while."


def test_article_without_furniture():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="<p>no</p>";</script></head><body>
    <header>Site name</header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="ad">{SENTENCE}</div>
    <div id="cookieNotice"><p>{SENTENCE}</p></div>
    <article><header><h1>The &eacute;&nbsp;title</h1></header><p>Short.</p><p><b>{SENTENCE}<br><p>A &lt;b&gt;
      and   <i>x</i>y</p><table><tr><td>one</td><td>two</td></tr></table><form><p>{SENTENCE}</p></form>
    <p title="a > b">Tail <a href="#">link</a></p><section id="comments"><div class="comment"><p>{SENTENCE}</p></div></section></article>
    <aside>{SENTENCE}</aside><footer>&copy; x</footer><noscript>{SENTENCE}</noscript></body></html>"""
    assert main_text(page) == f"The é title\nShort.\n{SENTENCE}\nA <b> and xy\none two\nTail link"


def test_page_without_an_article():
    page = f"""<body><div class="menu"><a>Home</a> <a>News</a></div><h1>Title</h1><p>{SENTENCE}</p><p>Short in between.</p><p>{SENTENCE}</p>
    <ul><li><a href=x>Read more of this</a></li></ul><div class=footer>All rights</div></body>"""
    assert main_text(page) == f"Title\n{SENTENCE}\nShort in between.\n{SENTENCE}"


def test_only_short_blocks_and_open_elements():
    assert main_text("<body><nav><a>x</a><article><h1>A</h1><p>b<p>c<div class='ad'>buy</div></article> out") == "A\nb\nc"
    assert main_text("just a short text") == "just a short text"
    assert main_text("a < b &amp;amp; c <") == "a < b &amp; c <"


def test_class_names_that_only_look_like_furniture():
    for name in ("post category-cookies", "post tag-navy", "comments-open sidebar", "nav"):
        assert main_text(f'<body><article class="{name}"><p>{SENTENCE}</p></article></body>') == SENTENCE
    assert main_text(f'<div class="layout has-sidebar"><h1>T</h1><p>{SENTENCE}</p><p>{SENTENCE}</p></div>') == f"T\n{SENTENCE}\n{SENTENCE}"
    assert main_text(f'<div class="sidebar"><p>{SENTENCE}</p><p>{SENTENCE}</p></div><p>x</p>') == f"{SENTENCE}\n{SENTENCE}\nx"
    for name in ("commentary", "side-effects", "tags"):
        assert main_text(f'<article><p>{SENTENCE}</p><section id="{name}"><p>Inner text.</p></section></article>') == f"{SENTENCE}\nInner text."
    for name in ("comments", "comment-list", "cookieNotice", "main-menu", "breadcrumbs", "newsletter-form", "x sidebar"):
        assert main_text(f'<article><p>{SENTENCE}</p><div class="{name}"><p>Inner text.</p></div></article>') == SENTENCE
        assert main_text(f'<p>{SENTENCE}</p><p>{SENTENCE}</p><div id="{name}"><p>{SENTENCE}</p></div>') == f"{SENTENCE}\n{SENTENCE}"
    assert main_text(f'<article><p>{SENTENCE}</p><article class="comment"><p>{SENTENCE}</p></article></article>') == SENTENCE


def test_optional_tags():
    assert main_text(f"<html><head><title>T</title><meta charset=x><p>{SENTENCE}</p><p>Tail.</p>") == f"{SENTENCE}\nTail."
    assert main_text(f"<title>T</title><div><p>{SENTENCE}</p></div>") == SENTENCE
    assert main_text(f"<head><script>var x</script><article><p>{SENTENCE}</p></article>") == SENTENCE


def test_short_linked_blocks_of_an_article():
    assert main_text(f'<article><h2><a href="#m">Methods</a></h2><p>{SENTENCE}</p></article>') == f"Methods\n{SENTENCE}"
    assert main_text(f'<article><p>{SENTENCE}</p><p><a href="x">See the data</a></p><p>{SENTENCE}</p></article>') == f"{SENTENCE}\nSee the data\n{SENTENCE}"
    assert main_text(f'<article><p>{SENTENCE}</p><ul><li><a href="x">One</a><li><a href="y">Two</a></ul></article>') == SENTENCE


def test_other_scripts_and_languages():
    chinese = "這是一個很長的段落，裡面沒有任何列出的停用詞，但它仍然是文章的一部分，應該保留下來。" * 3
    polish = "Wczoraj wieczorem deszcz padał bez przerwy, więc zostaliśmy w domu i czytaliśmy stare książki. " * 3
    assert main_text(f"<body><p>{SENTENCE}</p><p>{chinese}</p></body>") == f"{SENTENCE}\n{chinese}"
    assert main_text(f"<body><p>{chinese}</p></body>") == chinese
    assert main_text(f"<body><p>{polish}</p><p>{polish}</p></body>") == f"{polish.strip()}\n{polish.strip()}"


def test_broken_and_long_pages():
    for page in (None, "", "<p", "<!-- never closed", "<script>x", "<style", "<nav>only a menu</nav>"):
        assert main_text(page) == ""
    assert main_text("<p>" + "<b>" * 50000 + "x") == "x"
    for piece in ('<div class="', "<", "<a ", "<p '", "<!--", "&", "<article>"):
        main_text(piece * 20000)
    assert main_text(f"<article><p>{SENTENCE * 5000}</p></article>") == SENTENCE * 5000


def test_rows(spark):
    rows = [(1, "u", f"<article><p>{SENTENCE}</p><p>🙂</p></article>", 5), (1, "u", None, 5), (None, None, "", None)]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")).collect()
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in out] == [
        (1, "u", f"{SENTENCE}\n🙂", len(SENTENCE) + 2), (1, "u", "", 0), (None, None, "", 0)
    ]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_given_pages(spark):
    """Over the given pages: what stands in the article element, block by block."""
    import re
    from html import unescape

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert texts[r.page_id] == "\n".join(p for p in parts if p)
