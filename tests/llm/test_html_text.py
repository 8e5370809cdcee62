import html as markup
import random

import numpy as np
import pytest

from contestlab.llm.html_text import content_cluster, html_text, main_text, smoothed

P = "Some long text of the article that says a lot of things and goes on for a while. "


def page(r: random.Random, blocks: list[str], article: bool = True) -> str:
    """A page with everything around the given blocks that is not main text, with or without an article element."""
    word = lambda: r.choice(["news", "über", "naïve", "a", "sports & more", "x"]) + str(r.randrange(50))
    prose = lambda: " ".join(word() for _ in range(r.randrange(5, 60)))
    menu = "".join(f'<li><a href="/{i}">{markup.escape(word())}</a></li>' for i in range(r.randrange(3, 12)))
    body = "".join(f"<p>{b}" + r.choice(["</p>", "", "</p>\n"]) for b in blocks)
    main = f"<article>{body}</article>" if article else f'<div class="content"><div>{body}</div></div>'
    return (
        f"<!DOCTYPE html><html><head><title>{word()}</title><style>p{{margin:0}}</style><script>var t = '</p>';</script></head><body>"
        f"<header><a href='/'>{word()}</a></header><nav><ul>{menu}</ul></nav><!-- ad --><div class='ad'>{markup.escape(prose())}</div>"
        f"<div class='cookie-notice'>{markup.escape(prose())}</div>{main}<aside>{markup.escape(prose())}</aside><div id='sidebar'>{markup.escape(prose())}</div>"
        f"<section class='comments'><div>{markup.escape(prose())}</div></section><form><label>{word()}</label><input></form>"
        f"<footer>&copy; {word()}</footer>" + r.choice(["</body></html>", ""])
    )


@pytest.mark.parametrize("article", [True, False])
def test_generated_pages(article):
    """The text of every block of the article comes back whole, and nothing else, whatever stands around it."""
    r = random.Random(5 + article)
    for _ in range(200):
        plain = [" ".join(r.choice(["é", "the", "a<b", "x&y", "word"]) + str(r.randrange(99)) for _ in range(r.choice([1, 3, 40, 200]))) for _ in range(r.randrange(1, 20))]
        if not article:
            plain.append(P * 12)
        blocks = [markup.escape(t).replace(" ", r.choice([" ", "  ", "\n", "&#32;"])) for t in plain]
        assert main_text(page(r, blocks, article)) == " ".join(plain).strip()


def test_structures():
    assert main_text(f'<body class="has-sidebar"><div class="wrap"><h1>Title &amp; more</h1><div><p>{P}</p><p>Short.<ul><li>One<li>Two</ul></div></div></body>') == f"Title & more {P}Short. One Two"
    assert main_text(f"<main><article><p>{P}<p>end<b>bold</b>er<br>x</article><article class='comment'>{P * 9}</article></main>") == f"{P}endbolder x"
    assert main_text(f"<article><h1>A&nbsp;B</h1><div hidden>no</div><p>{P}</p><div class='share'>Share</div><blockquote>q</blockquote></article>") == f"A B {P}q"
    assert main_text(f"<div><ul><li><a href='/'>Home</a><li><a href='/x'>X</a></ul><p>{P}</p></div>") == P.strip()


def test_awkward_markup():
    assert main_text(None) == main_text("") == main_text("<p></p> ") == main_text("<script>var a = '<p>x</p>'") == ""
    assert main_text("plain & text") == "plain & text"
    assert main_text("<p>a<!-- without an end") == "a"
    assert main_text("<p>&lt;b&gt; &#65; &am &unknown;</p></div></b>") == "<b> A &am &unknown;"
    deep = "<div>" * 3000 + P + "</div>" * 3000
    assert main_text(deep) == P.strip()
    assert len(main_text(f"<article>{'<p>' + P * 2000}</article>")) == len(P) * 2000 - 1


def test_ratios():
    flat = smoothed(np.ones(50))
    assert np.allclose(flat, 1)
    ratios = np.array([1.0] * 20 + [200.0] * 10 + [1.0] * 20)
    assert content_cluster(ratios)[20:30].all() and not content_cluster(ratios)[:12].any()


def test_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars long, lang int"
    data = [(1, "u", f"<article><p>é {P}</article>", "x", 9, 1), (1, "u", f"<article><p>é {P}</article>", "x", 9, 1), (2, None, None, None, None, None), (None, "v", "", "", 0, 0)]
    got = html_text(spark.createDataFrame(data, schema).repartition(3))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(1, "u", f"é {P}".strip(), len(P) + 1)] * 2 + [(2, None, "", 0), (None, "v", "", 0)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert html_text(spark.createDataFrame([], schema)).count() == 0


def test_query_against_the_article_element(spark):
    """Every page of the given table has its text in one article element: it comes back whole."""
    import re

    from contestlab.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op13_html_text"](spark, sf).collect()
    assert len(rows) == len(html) > 0
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", html[r.page_id], re.S).group(1)
        want = " ".join(markup.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inner))).split())
        assert (r.text, r.n_chars) == (want, len(want))
