"""Page text by hand-made pages and the given ones."""

import html
import re

import numpy as np
import pytest

from voltide.llm import page_text
from voltide.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
<script>var a = "</p><article>";</script></head>
<body class="has-sidebar"><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="ad">Buy now</div><div id="cookie-notice">We use cookies</div>
<article><h1>Title &amp; more</h1><p>First   <b>bold</b>
text&nbsp;here.<p>Second<br>line</p><form><input value="x">Sign up</form>
<div class="share">Share</div><ul><li>one</li><li>two</li></ul><!-- <p>gone</p> -->
<section class="comments"><article class="comment"><p>Nice!</p></article></section>
<table><tr><td>c1</td></tr></table><pre>  a
  b </pre></article><aside>Related</aside><footer>&copy; 2020</footer></body></html>"""


def test_markup_decides():
    assert page_text.texts_of([PAGE]) == [
        "Title & more\n\nFirst bold text here.\n\nSecond line\n\none\n\ntwo\n\nc1\n\na b"
    ]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), ("plain words", "plain words"), ("<p>a < b & c &lt;d&gt;", "a < b & c <d>"),
        ("<main><p>x</p></main><p>y</p>", "x"), ("<article><p>x<nav>m</nav>y</article>", "x\n\ny"),
        ("<p title='a>b'>q</p><br", "q"), ("<script>never ends", ""), ("<!-- open <p>x", ""),
        ("<article><p>cut off", "cut off"), ("<div class=ads>a</div><div class=body>b</div>", "b"),
    ],
)
def test_odd_pages(page, text):
    assert page_text.texts_of([page]) == [text]


def test_repeated_runs_go_and_unique_runs_stay():
    menu = "Home News Sport Weather Travel Money Culture Future Video About us"
    foot = "All rights reserved by the owners of this site since the year nineteen ninety"
    own = [" ".join(f"word{k}x{i}" for i in range(30)) for k in range(6)]
    pages = [f"<div>{menu}</div><p>{t}</p><div>{foot}</div>" for t in own]
    assert page_text.texts_of([*pages, pages[0]]) == [*own, own[0]]


def test_runs_are_counted_over_the_whole_host(spark):
    """The result does not depend on shards, and a run on pages of different shards is found."""
    menu = "Home News Sport Weather Travel Money Culture Future Video About us"
    own = [" ".join(f"word{k}x{i}" for i in range(30)) for k in range(45)]
    shared = " ".join(f"quoted{i}" for i in range(20))
    rows = [(k, f"http://h/{k}", f"<div>{menu}</div><p>{t}</p>") for k, t in enumerate(own)]
    rows += [(100 + k, f"http://h/q{k}", f"<p>{shared}</p><p>{own[k]} and more of it</p>") for k in range(2)]
    rows += [(200, "http://h/0", rows[0][2]), (300, "http://other/", f"<div>{menu}</div>")]
    rows += [(301, "http://h/m", "<article><p>an article</p></article><div>" + menu + "</div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    want = dict(enumerate(own)) | {200: own[0], 300: menu, 301: "an article"}
    # two of the host's 48 pages quote the same: fewer than a tenth
    want |= {100 + k: f"{shared}\n\n{own[k]} and more of it" for k in range(2)}
    for shard in (1, 3, 256):
        got = {r["page_id"]: r["text"] for r in page_text.extract_text(df, shard=shard).collect()}
        assert got == want, shard


def marked_host():
    """A host whose articles share a notice; nine copies and a near copy of one article among them."""
    notice = "Sign up for our daily letter and never miss a story of this site again"
    menu = "Home News Sport Weather Travel Money Culture Future Video About us"
    own = [[" ".join(f"p{k}x{j}w{i}" for i in range(15)) for j in range(6)] for k in range(8)]
    page = lambda blocks, more: f"<div>{menu}</div><article>{''.join(f'<p>{b}</p>' for b in blocks)}</article><p>{more}</p>"
    pages = [page([*o[:3], notice, *o[3:]], f"see also {k}") for k, o in enumerate(own)]
    texts = ["\n\n".join(o) for o in own]
    copied = [" ".join(f"c{j}w{i}" for i in range(30)) for j in range(12)]
    pages += [page(copied, f"advert number {k}") for k in range(9)]
    near = [*copied[:11], "another end " + copied[11]]
    pages += [page(near, "advert"), page([*near, "a new last line"], "advert")]
    texts += ["\n\n".join(copied)] * 9 + ["\n\n".join(near), "\n\n".join([*near, "a new last line"])]
    return pages, texts


def test_repeated_runs_inside_marked_articles_go():
    """What different articles share goes, copies of an article stay."""
    pages, texts = marked_host()
    assert page_text.texts_of(pages) == texts
    # two articles that quote the same are not enough
    quote = " ".join(f"quoted{i}" for i in range(20))
    two = [f"<article><p>{quote}</p><p>own words of number {k} and some more of them</p></article>" for k in range(2)]
    assert all(t.startswith(quote) for t in page_text.texts_of(two))


def test_marked_articles_over_shards(spark, monkeypatch):
    """Neither shards nor what arrays leave out show in the result."""
    pages, texts = marked_host()
    # 46 different pages: the bar is five; some arrays have one page of a notice and leave it out
    for k in range(35):
        own = " ".join(f"z{k}w{i}" for i in range(120))
        five = [j for j in range(7) if k % 7 == j]
        four = [j for j in range(7) if k % 7 == (j + 1) % 7 and k < 28]
        notes = [" ".join(f"{w}x{j}x{i}" for i in range(12)) for w, js in (("five", five), ("four", four)) for j in js]
        pages.append(f"<article><p>{own}</p>{''.join(f'<p>{n}</p>' for n in notes)}</article>")
        texts.append("\n\n".join([own, *[n for n in notes if n.startswith("four")]]))
    assert page_text.texts_of(pages) == texts
    rows = [(k, f"http://h/{k}", p) for k, p in enumerate(pages)]
    rows += [(100 + k, f"http://g/{k}", p) for k, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    again, counts = [], page_text._counts
    monkeypatch.setattr(page_text, "_counts", lambda *a: again.append(a[-1]) or counts(*a))
    for shard in (7, 30, 256):
        again.clear()
        got = {r["page_id"]: r["text"] for r in page_text.extract_text(df, shard=shard).collect()}
        assert got == dict(enumerate(texts)) | {100 + k: t for k, t in enumerate(texts)}, shard
        assert len(again) == 1 + (shard == 30)


def test_copies_of_an_article_stay():
    pages = ["<article><p>" + "same words again and again here now then</p></article>"] * 5
    assert len(set(page_text.texts_of(pages))) == 1
    assert page_text.texts_of(pages)[0].startswith("same words")


def test_suffix_array_order():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 3, 400)
    for run in (1, 3, 8):
        order, rank = page_text.suffix_ranks(tokens, run)
        keys = [tuple(tokens[i : i + run]) for i in order]
        assert keys == sorted(keys)
        assert len(set(rank)) == len(set(keys))


def test_query_gives_the_articles(spark, sf):
    got = {r["page_id"]: r for r in QUERIES["op10_host_suffix_array"](spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", row["html"], re.S)[1]
        blocks = [
            " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub("</?b>", "", x))).split())
            for x in re.split(r"</?(?:p|h1)>", inner)
        ]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[row["page_id"]]["text"], got[row["page_id"]]["n_chars"]) == (want, len(want))
        assert got[row["page_id"]]["url"] == row["url"]


def test_nulls_repeats_shards_and_empty_table(spark):
    rows = [(1, None, None), (None, "http://h/1", PAGE), (2, "http://h/1", PAGE), (2, "http://h/1", PAGE)]
    rows += [(10 + k, "http://h/x", f"<article><p>page {k}</p></article>") for k in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host")
    got = page_text.extract_text(df, shard=2).collect()
    assert len(got) == len(rows)
    texts = {r["page_id"]: r["text"] for r in got}
    assert texts[1] == "" and texts[13] == "page 3" and texts[2] == texts[None] != ""
    assert page_text.extract_text(df.where("false")).collect() == []
