import html
import re

import pytest

from predia.llm import html_extraction as X
from predia.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def tree(spark):
    return X.fit_tree(spark)


@pytest.fixture(scope="module")
def texts(spark, tree):
    def read(*pages):
        rows = spark.createDataFrame([(i, f"u{i}", page) for i, page in enumerate(pages)], PAGES)
        return [r["text"] for r in sorted(X.extract(rows, tree).collect(), key=lambda r: r["page_id"])]

    return read


def article_of(page):
    """The text between the tags of the article, cut at paragraphs and headings, by plain patterns."""
    page = page[page.index("<article>"):]
    page = re.split("</article>|<footer>", page)[0]
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", part)).split()) for part in re.split("</?(?:p|h1)>", page)]
    return "\n".join(part for part in parts if part)


def test_every_page_against_plain_patterns(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op13_html_extraction"](spark, folder).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r["text"] == article_of(pages[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_the_tree_knows_its_table_and_pages_it_has_not_seen(spark, tree, texts):
    rows = X.labelled_blocks(spark).collect()
    assert len(rows) < 200
    assert all(X.decide(tree, r["features"]) == (r["label"] == 1) for r in rows)
    long, short = "words of the article " * 12, "A few words."
    page = f"""<html><body class="has-sidebar"><header><a href="/">Home</a><h2>Site</h2></header>
        <ul class="main-menu"><li><a href=/a>One</a><li><a href=/b>Two</a></ul>
        <div id="cookie-consent"><p>{long}</p><button>Yes</button></div>
        <form action="/s"><label>Search</label><select><option>Notes</select><textarea>x</textarea></form>
        <article class="post tag-privacy"><header><h1>Title &amp; more</h1></header><p>{short}<p>{long}
        <a href="/x">with a link</a></p><div class="advert">Buy {long}</div><table><tr><td>cell<td>other</table>
        <ul><li>point</ul><section class="user-comments"><article class=comment>{long}</article></section></article>
        <div class="sidebar"><p>{long}</p></div><div>Read on</div><footer><p>{long}</p></footer></body></html>"""
    one_line = long.strip()
    assert texts(page)[0].split("\n") == ["Title & more", short, one_line + " with a link", "cell", "other", "point"]
    plain = f"<body><a href=/>Home</a><div class=header>{long}</div><h1>Head</h1><p>{long}</p><p>{long}</p>" \
            f"<div class=comments><p>{long}</p></div><div class=footer>{long}</div>"
    assert texts(plain)[0].split("\n") == ["Head", one_line, one_line]


def test_markup(texts):
    def inside(markup):
        return texts(f"<nav>menu</nav><article><h1>T</h1>{markup}</article><footer>end</footer>")[0].split("\n")[1:]

    assert inside("<p>a<b>b</b> c&nbsp;&eacute;&#x41;&lt;b&gt;\n\t d</p>") == ["ab c éA<b> d"]
    assert inside("x<br>y<p>z") == ["x y", "z"]
    assert inside('<p title="a>b" data-x=it\'s>one</p><p>it\'s 1 < 2</p>') == ["one", "it's 1 < 2"]
    assert inside("<!-- <p>no</p> --><script>'<p>no</p>'</script><style>p{}</style><noscript>no</noscript>yes") == ["yes"]
    assert inside("<p>a</b></i></div>b<p>c") == ["a", "b", "c"]
    assert inside("&amp;lt; &#0; &unknown;") == ["&lt; � &unknown;"]
    assert inside("<p><a name=here>An anchor that is no link and never closed, in a long line of words<p>next") == [
        "An anchor that is no link and never closed, in a long line of words", "next"]
    assert texts("<article><p>cut off in a ta<b cla")[0] == "cut off in a ta"
    assert texts("<article><p>cut <!-- off")[0] == "cut"


def test_edges(spark, tree, texts):
    long = "word " * 300_000
    assert texts(None, "", "no markup", "<p", f"<article><p>{long}</p></article>", "<p>" * 50_000 + "</i>" * 50_000)[
        :2] == ["", ""]
    assert texts(f"<nav>x</nav><article><p>{long}</p></article>")[0] == long.strip()
    rows = [(1, "u", "<article><p>Some text</p></article>")] * 2 + [(None, None, None)]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'own' AS text", "'own' AS kept", "1 AS n_chars")
    found = sorted(X.extract(pages, tree).collect(), key=repr)
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in found] == [(1, "Some text", 9)] * 2 + [(None, "", 0)]
    assert X.extract(pages.where("false"), tree).count() == 0
    blocks = X.page_blocks(pages, tree).collect()
    assert [(b["position"], b["text"], b["kept"]) for b in blocks] == [(0, "Some text", True)] * 2
