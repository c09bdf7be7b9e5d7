"""Main text of pages: planted templates, hostile markup, and the test pages against their own article element."""

import html
import random
import re
import time

import numpy as np
import pytest

from mooclens.llm.html_text import LINKED, TAGS, WORD, Page, extract_text, learn_weights, text_digest, weights_of

SF = "/root/testdata/sf0.01"
RNG = random.Random(3)
WORDS = ["".join(RNG.choice("abcdefgé") for _ in range(RNG.randint(2, 9))) for _ in range(300)]


def words(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def weights(spark):
    return learn_weights(spark.read.parquet(f"{SF}/pages.parquet"))


def plain(source):
    """The text of the one article of a test page, by patterns alone."""
    m = re.search(r"<article>(.*?)</article>", source, re.S)
    blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", m[1])]
    return "\n".join(b for b in blocks if b)


def test_test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r["page_id"]: (r["url"], plain(r["html"])) for r in pages.collect()}
    rows = text_digest(pages).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in rows} == want and len(rows) == len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_words_score_above_zero_and_tags_below(weights):
    assert all((v > 0) == (k in (WORD, LINKED)) for k, v in weights.items()) and len(weights) == 2 * len(TAGS) + 2


def template(kind, blocks):
    """A page of another make, and what is not its article."""
    article = "".join(f"<p>{b}</p>" if i % 3 else f"<h2>{b}</h2>" for i, b in enumerate(blocks))
    noise = [f"<header><h1>{words(3)}</h1></header>", f"<nav><ul>{''.join(f'<li><a href=/x>{words(1)}</a>' for _ in range(9))}</ul></nav>",
             f"<aside>{words(20)}</aside>", f"<div class='cookie-notice'>{words(15)}</div>", f"<form><label>{words(4)}</label><input><button>{words(1)}</button></form>",
             f"<script>var a = '<p>{words(5)}</p>';</script>", f"<style>p {{}} /* {words(2)} */</style>", f"<!-- <p>{words(4)}</p> -->"]
    RNG.shuffle(noise)
    after = f"<section id='comments'><article><p>{words(30)}</p></article></section><div class=sidebar>{words(12)}</div><footer>{words(9)}</footer>"
    ad = f"<div class='ad-box'><div>{words(6)}</div></div>"
    cut = [m.end() for m in re.finditer(r"</(?:p|h2)>", article)]
    mid = cut[len(cut) // 2]
    article = article[:mid] + ad + article[mid:]
    if kind == "article":
        body = f"<article>{article}</article>"
    elif kind == "main":
        body = f"<div id=wrap class='has-sidebar'><main>{article}</main></div>"
    else:
        body = f"<div class=content>{article}</div>"
    return f"<html><head><title>{words(4)}</title></head><body>{''.join(noise)}{body}{after}</body></html>"


@pytest.mark.parametrize("kind", ["article", "main", "div"])
def test_planted_templates(weights, kind):
    for _ in range(20):
        blocks = [words(RNG.randint(8, 60)) for _ in range(RNG.randint(3, 9))]
        assert Page(template(kind, blocks)).text(weights) == "\n".join(blocks)


def test_region_is_the_maximum_subsequence(weights):
    """The linear scan against all stretches."""
    for _ in range(60):
        source = "".join(RNG.choice([f"<p>{words(RNG.randint(1, 9))}</p>", "<div>", "</div>", f"<a href=x>{words(2)}</a>", "<hr>", "<ul><li>x</ul>"]) for _ in range(RNG.randint(1, 25)))
        page = Page(source)
        seq = list(page.tokens())
        score = [weights[k] * n for k, n, _, _ in seq]
        page.content, page.boxes = [], []
        first, end = page.region(weights)
        if not any(k in (WORD, LINKED) for k, *_ in seq):
            assert first == end
            continue
        best = max(sum(score[i:j]) for i in range(len(seq)) for j in range(i + 1, len(seq) + 1))
        assert np.isclose(sum(s for s, (_, _, a, b) in zip(score, seq) if a >= first and b <= end), best)


def test_markup_details(weights):
    def of(source):
        return Page(f"<article>{source}</article>").text(weights)
    assert of("<p>a&nbsp;b &lt;i&gt; x&amp;y<br>c<b>d</b>\n\t e") == "a b <i> x&y cd e"
    assert of("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>tail") == "one\ntwo\na\nb\nc\ntail"
    assert of("<p title='a>b'>q</p><img alt=\"<p>no</p>\"><p>r") == "q\nr"
    assert of("<p>x<p class=advert>n<b>q<p>y") == "x\ny"
    assert of("<header><h1>Title</h1></header><p>text") == "Title\ntext"


def test_odd_pages(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (3, "u", " \n ", "x"), (4, "u", "<p>cut <scr", "x"), (5, "u", "no markup at all", "x"),
            (6, "u", "<nav>only <a>menu</a></nav>", "x"), (6, "u", "<nav>only <a>menu</a></nav>", "x"), (None, "u", "<p>a</p><!-- open", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string")
    got = sorted([(r["page_id"], r["text"]) for r in text_digest(pages).collect()], key=str)
    assert got == sorted([(1, ""), (2, ""), (3, ""), (4, "cut"), (5, "no markup at all"), (6, ""), (6, ""), (None, "a")], key=str)
    assert extract_text(pages).filter("row.main_text = 'x'").count() == 8
    assert text_digest(pages.limit(0)).collect() == []


@pytest.mark.parametrize("piece", ["<b>", "<p><b>", "<a ", "<!--", "</p>", "<div class=ad>", '<a x="', "<li>a", "<ul><li>", "&", "<script>", "<table><tr><td><p>", "<nav><article>"])
def test_long_hostile_pages_take_linear_time(piece):
    even = weights_of({})
    began = time.time()
    Page(piece * 40_000).text(even)
    assert time.time() - began < 8
