"""Operator 11: planted pages with known main texts, broken markup, and the linear scan against all runs."""

import html
import random
import re

import duckdb
import pytest

from paygrid.llm import content as C

PARAGRAPHS = ["The first paragraph has a <a href='/x'>link</a> and <b>bold</b>text &amp; more.", "Short one.",
              "Line one<br>line two,\n   with   white&nbsp;space.", "List follows:", "Caf&eacute; &#8212; the end &copy 2020."]
TEXTS = ["The first paragraph has a link and boldtext & more.", "Short one.", "Line one line two, with white space.", "List follows:",
         "Café — the end © 2020."]
BODY = "<h1>Heading</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS) + "<ul><li>one item</li><li><a href='#'>two items</a></li></ul>"
WANT = "\n".join(["Heading", *TEXTS, "one item", "two items"])
NAV = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>Other things to see</a></li></ul></nav>"
FOOT = "<footer><p>&copy; somebody, all rights reserved and so on and on</p></footer>"
HEAD = "<!DOCTYPE html><html><head><title>A title</title><style>p{a:b}</style><script>if (a < b) document.write('</p><article>x')</script></head>"
COMMENTS = "<div id='comments'><h2>Comments</h2>" + "<article class='comment'><p>I think that this is a great text, thanks for it.</p></article>" * 9 + "</div>"

PLANTED = {
    "article": f"{HEAD}<body>{NAV}<article>{BODY}</article>{FOOT}</body></html>",
    "main": f"{HEAD}<body><header><p>The site's name and its motto</p></header>{NAV}<main>{BODY}</main>{FOOT}",
    "plain div": f"{HEAD}<body>{NAV}<div class='ad'>Buy this now, it is good and cheap</div><div id='content'>{BODY}</div>{FOOT}</body></html>",
    "flat": f"{HEAD}<body>{NAV}{BODY}{FOOT}</body></html>",
    "sidebar": f"{HEAD}<body class='with-sidebar'><div class='content-sidebar-wrap'><article>{BODY}</article><aside><p>About the author, who writes.</p></aside></div>",
    "inside": f"<body><article>{BODY[:BODY.index('<p>Short')]}<div class='advert-slot'>Buy now</div><aside>See also this</aside>"
              f"<form><label>Mail</label><input><button>Send</button></form><!-- a > b -->{BODY[BODY.index('<p>Short'):]}</article>",
    "comments": f"<body>{NAV}<article>{BODY}</article>{COMMENTS}{FOOT}",
    "comments inside": f"<body>{NAV}<article>{BODY}{COMMENTS}</article>{FOOT}",
    "cookie notice": f"<body><div class='cookie-notice'><p>We use cookies, and you agree with that.</p><button>Yes</button></div><article>{BODY}</article>",
    "roles": f"<body><div role='navigation'>Go to many places from here</div><div role=main><div class=post>{BODY}</div></div><div role='contentinfo'>Imprint</div>",
    "own header": f"<body>{NAV}<article><header><h1>Heading</h1><p>By somebody</p></header>{BODY[16:]}</article>",
    "whole-page form": f"<body><form id='aspnet'>{NAV}<article>{BODY}</article></form>",
    "upper case": f"<BODY><NAV>Menu items</NAV><ARTICLE>{BODY}</ARTICLE><FOOTER>Imprint</FOOTER>",
    "unclosed": f"{HEAD}<body>{NAV}<article>{BODY.replace('</p>', '').replace('</li>', '')}</article>{FOOT}",
    "cut off": f"{HEAD}<body>{NAV}<article>{BODY}<p class='x",
    "silent": f"<body><noscript>Turn it on</noscript><template><p>x y z</p></template><article>{BODY}<script>var a = 1 < 2;</script><svg><text>t</text></svg></article>",
}


def weights(pages):
    total: dict = {}
    for page in pages:
        for (kind, name, inside), n in (C.counts(page) or {}).items():
            total.setdefault((kind, name), [0, 0])[not inside] += n
    return C.weights(total)


LEARNED = weights(PLANTED.values())


@pytest.mark.parametrize("name", PLANTED)
@pytest.mark.parametrize("table", [C.weights({}), LEARNED], ids=["prior", "learned"])
def test_planted_pages(name, table):
    assert C.main_text(PLANTED[name], table) == WANT


def test_comments_inside_labelled_articles_are_not_learned_as_content():
    table = weights([PLANTED["comments inside"]] * 50)
    assert table["word", ".comments"] < 0 and C.main_text(PLANTED["comments inside"], table) == WANT


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("   ", ""), ("<p></p><div><br></div>", ""), ("<nav>Only a menu here</nav>", ""), ("just text, no markup", "just text, no markup"),
    ("<!-- never closed <article><p>some text</p>", ""), ("<p>a < b and c <d", "a < b and c"), ("<p>some words &lt;b&gt; &unknown; here</p>", "some words <b> &unknown; here"),
    ("<p>some words<table><tr><td>cell one<td>cell two</table>", "some words\ncell one\ncell two"), ("<p title=\"a > b\">some words</p>", "some words"),
    ("<p title=\"never closed>some words</p><p>and more words</p>", "some words\nand more words"), ("<article>" * 50 + "deep words" + "</article>" * 50, "deep words"),
])
def test_broken_and_small_pages(page, want):
    assert C.main_text(page, LEARNED) == want


def test_long_broken_pages_take_linear_time():
    for piece in ("<a ", "<", "<a href=\"", "<p>", "<!--", "</p", "&", "<b>x "):
        C.main_text(piece * 20_000, LEARNED)


def test_scan_finds_the_best_of_all_runs():
    rng = random.Random(6)
    for _ in range(300):
        scores = [rng.randint(-4, 3) for _ in range(rng.randrange(12))]
        best = max((sum(scores[i:j]) for i in range(len(scores) + 1) for j in range(i, len(scores) + 1)), default=0)
        a, b = C.best_run(scores)
        assert sum(scores[a:b]) == max(best, 0)


def test_query_on_a_table(spark, tmp_path):
    rows = [(1, "u", PLANTED["article"], "t", 3), (None, None, PLANTED["flat"], None, None), (2, "v", None, None, None), (1, "u", PLANTED["article"], "t", 3)]
    schema = "page_id long, url string, html string, text string, n_chars int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((tuple(r) for r in C.op11_main_text(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, "u", WANT, len(WANT)), (None, None, WANT, len(WANT)), (2, "v", "", 0), (1, "u", WANT, len(WANT))], key=str)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert C.extract(pages, C.learn(pages)).collect() == []


def test_given_pages_against_their_article_element(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.page_id: r.text for r in C.op11_main_text(spark, folder).collect()}
    for page_id, page in duckdb.sql(f"SELECT page_id, html FROM '{folder}/pages.parquet'").fetchall():
        inner = page.split("<article>")[1].split("</article>")[0]
        parts = [re.sub("<[^>]*>", " ", x) for x in re.split("</?(?:p|h1)>", inner.replace("<b>", "").replace("</b>", ""))]
        lines = [" ".join(html.unescape(x).split()) for x in parts]
        assert got[page_id] == "\n".join(x for x in lines if x)
