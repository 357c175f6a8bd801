from __future__ import annotations

import html
import random
import re
import time

import numpy as np
import pytest

from pedalflow.llm import pages, trees


def article_of(page: str) -> str:
    """The article of the given pages, whose markup names it."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    inside = re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", inside)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", inside)).split())


def whole(page: str) -> str:
    parsed = pages.parse(page)
    return pages.text_of(parsed, [True] * len(parsed.parent))


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<p>a<p>b", "a b"),
        ("<p>a <b>b</b>c<br>d</p>e", "a bc d"),
        ("<div>x<script>if(a<b){'</p>'}</script>y</div>", "x y"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"),
        ("<p>5 < 6 &amp;lt; &nbsp; z &eacute;&#233;</p>", "5 < 6 &lt; z éé"),
        ("<div><p>Hello <b>w</b>orld", "Hello world"),
        ('<div><a href="a>b">z</a><p title="q>">w</div>', "z w"),
        ("<div><textarea><p>no</textarea>yes<!-- <p>no --></div>", "yes"),
        ("<div>a</span></p></div><!-- open", "a"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<DIV>A<STYLE>p{}</Style>B</dIv>", "A B"),
        ("<p>a<div>b</div>c", "a b"),
        ("<div>x <", "x <"),
        ("<p title=don't>text one</p><p title=can't>text two</p>", "text one text two"),
        ("<p>one</p><!--><p>two</p><!---><p>three</p><!-- x --!><p>four</p>", "one two three four"),
        ("<div>a</ div>b</>c<!doctype x>d<?pi ?>e</div>", "abcde"),
        ("<p a=\"x>y\" b='>' c = \"'\" d=e\"f>one</p>", "one"),
        ("<div><p a=>one</p><p =x>two</p><br/>three<p/>four", "one two three four"),
        ("<p>one</p><p title=\"never closed>two</p><p>three</p>", "one"),
        ("<p>one</p><a b <p c", "one"),
        ("<p>1 <2 <3> a<b</p>", "1 <2 <3> a"),
        ("<div>x<!-- <!-- --> y <!-- a -- b --> z", "x y z"),
    ],
)
def test_parsing(page, text):
    assert whole(page) == text


def test_decoding_is_the_best_consistent_choice():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randrange(2, 9)
        parent = [-1] + [rng.randrange(i) for i in range(1, n)]
        odds = np.array([0.0] + [rng.choice([-3.0, -2.0, -1.0, 0.5, 1.0, 2.5]) for _ in range(1, n)])
        page = pages.Page(parent, [], [], [], [], [], [], [], [], [])
        keep = pages.kept_nodes(page, odds)
        best = max(
            sum(odds[i] for i in range(1, n) if chosen >> i & 1)
            for chosen in range(1, 1 << n, 2)
            if all(chosen >> parent[i] & 1 for i in range(1, n) if chosen >> i & 1)
        )
        assert sum(odds[i] for i in range(1, n) if keep[i]) == pytest.approx(best)
        assert all(keep[parent[i]] for i in range(1, n) if keep[i])


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 6)).astype(np.float32)
    y = ((x[:, 1] > 0.5) ^ (x[:, 4] > 0.3)).astype(int)
    forest = trees.fit(x[:2000], y[:2000])
    assert ((forest.margins(x[2000:]) > 0) == y[2000:]).mean() > 0.95
    constant = trees.fit(np.ones((20, 2), np.float32), np.ones(20))
    assert (constant.margins(np.ones((3, 2), np.float32)) > 0).all()


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def forest(given):
    return pages.learn(given)


def test_main_texts_of_the_given_pages(given, forest):
    got = {r.page_id: r for r in pages.extract(given, forest).collect()}
    for page in given.collect():
        r = got[page.page_id]
        assert r.text == article_of(page.html) and r.n_chars == len(r.text) and r.url == page.url


def test_other_markup_for_the_same_parts(given, forest):
    """Pages rearranged with another seed than in training, from pages beyond the sample."""
    rng = random.Random(99)
    right = total = 0
    for page in given.orderBy("page_id").limit(100).collect():
        content = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        around = " ".join(re.sub(r"<[^>]*>", " ", page.html).split())
        parsed = pages.parse(pages.rearranged(content, around, rng))
        truth = pages.node_labels(parsed).astype(bool).tolist()
        odds = forest.margins(pages.features([parsed]))
        kept = set(pages.text_of(parsed, pages.kept_nodes(parsed, odds)).split())
        wanted = set(pages.text_of(parsed, truth).split())
        right += len(kept & wanted)
        total += len(kept | wanted)
    assert right / total > 0.9


def test_awkward_rows(spark, given, forest):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "plain"), (3, "u", "plain"), (None, None, "<article><p>x"), (5, "v", "<div>" * 3000 + "deep")]
    rows.append((6, "w", "<article>" + "<p>long words here.</p>" * 40_000 + "</article>"))
    odd = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for name in ("text", "n_chars", "node", "id"):
        odd = odd.withColumn(name, odd["url"])
    got = pages.extract(odd, forest).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[1].text == by_id[2].text == "" and by_id[1].n_chars == 0 and by_id[1].url is None
    assert by_id[None].text == "x"
    assert by_id[6].text == " ".join(["long words here."] * 40_000)
    none = odd.filter("false")
    assert pages.extract(none, pages.learn(none)).collect() == []


@pytest.mark.parametrize(
    "page, text",
    [
        ("plain", "plain"),
        ("a<br>b <b>c</b>d <a href=x>e</a>", "a b cd e"),
        ("<title>no</title>\n<p>a</p> b", "a b"),
        ("<html><head><title>no</title><meta name=x>a <p>b", "a b"),
        ("<html><head><style>no{}</style></head><i>a</i><p>b</p></html>c", "a b c"),
        ("<body><p>a</p></body>b <i>c</i><div>d</div></html> e", "a b c d e"),
        ("<article>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math>, <object data=o>a</object> <canvas><p>b</p></canvas></article>", "If x=1, a b"),
        ("<p><math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable></math>", "1 2"),
    ],
)
def test_bodies_that_no_tag_opens_and_parts_of_the_text(page, text):
    parsed = pages.parse(page, implied_body=True)
    assert pages.text_of(parsed, [True] * len(parsed.parent)) == text
    assert not any(node == 0 and t.strip() for node, t in parsed.pieces)


def test_main_texts_without_a_body_tag(spark, given, forest):
    prose = "The river rose in the night, and by morning the lower road was gone. People came out to look."
    cases = [
        (prose, prose),
        (f"{prose}<br>{prose}", f"{prose} {prose}"),
        (f"<b>{prose}</b> {prose} <i>{prose}</i>", f"{prose} {prose} {prose}"),
        (f"<html><body></body>{prose}</html>", prose),
        (f"<article><p>{prose}</p><p>If <math><mi>x</mi></math> {prose}</p></article>", f"{prose} If x {prose}"),
    ]
    for page in given.orderBy("page_id").limit(50).collect():
        cases.append((re.sub(r"</?(?:html|head|body)\b[^>]*>", "", page.html), article_of(page.html)))
    rows = spark.createDataFrame([(i, "u", page) for i, (page, _) in enumerate(cases)], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(rows, forest).collect()}
    assert [got[i] for i in range(len(cases))] == [text for _, text in cases]


@pytest.mark.parametrize(
    "page",
    ["<a b " * 80_000, "<!-" * 130_000, "<" * 400_000, "</" * 200_000, "<a b='" * 60_000, "<a b=c\" " * 50_000, "<!-- x" * 60_000, "<p>&" * 100_000,
     "<div>" * 20_000 + "x" + "</div>" * 20_000, "<b>" * 40_000 + "</i>" * 40_000, "<p>" * 100_000, "<li>" * 100_000, "<ul><li>" * 10_000],
    ids=lambda page: page[:9],
)
def test_odd_pages_cost_their_length(page):
    begun = time.process_time()
    parsed = pages.parse(page, implied_body=True)
    pages.features([parsed])
    assert time.process_time() - begun < 6
