import itertools
import random
import re

import numpy as np
import pandas as pd
import pytest

from contrail.llm import html_cut
from contrail.llm.html_cut import INITIAL, blocks_of, labelled, main_text, minimum_cut

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>x";</script></head>
<body class=page><header><div>Site name</div></header><nav><ul><li><a href="/a">A</a><li><a href='/b>c'>B</a></ul></nav>
<!-- <p>hidden</p> --><div class="ad-box">Buy this now, it is the best thing you will ever own.</div>
<article><header><h1>Title &amp; more</h1></header><p>First   paragraph<br>goes&nbsp;on with <b>bold <a href=x>link</a> text.
<p>One.</p><div class="promo">Subscribe to our letter today and get news.</div><ul><li>Item one is here.<li>Item two is here.</ul>
<form><label>Mail</label><input name=m></form><noscript>Enable it</noscript><p>Last &#233;&lt;b&gt; one.</p>
<section id="comments"><h3>Comments</h3><p>I think this is a great article, thank you.</p></section></article>
<aside class="sidebar"><p>Related things that you may like to read.</p></aside><footer>&copy; 2024 Someone</footer></body></html>"""


def test_page():
    assert main_text(PAGE, INITIAL).split("\n") == [
        "Title & more", "First paragraph goes on with bold link text.", "One.", "Item one is here.",
        "Item two is here.", "Last é<b> one."]


def test_page_without_hints_uses_the_text():
    page = "<div><ul><li><a href=1>Home</a><li><a href=2>News</a></ul>" + "".join(
        f"<p>This is paragraph {i} with enough words to be read as content.</p>" for i in range(4)) + "</div>"
    assert main_text(page, INITIAL).count("\n") == 3 and "Home" not in main_text(page, INITIAL)


@pytest.mark.parametrize("page", ["<", "<p", "<p>a", "</p>a<b", "a<script>x", "<!-- x", "<a href='", "&amp", "<p/>x<br/>",
                                  "<td>x</table></tr>", "<p><p><p>", "\x00<p>퟿</p>"])
def test_broken_pages(page):
    blocks_of(page)


def cost(labels, costs, edges):
    cut = sum(-c if x and c < 0 else c if not x and c > 0 else 0 for x, c in zip(labels, costs))
    return cut + sum(c for i, e in enumerate(edges) for j, c in e.items() if i < j and labels[i] != labels[j])


def test_least_cost_of_all_labellings():
    rng = random.Random(8)
    for _ in range(150):
        n = rng.randint(1, 8)
        costs = [rng.randint(-6, 6) / 2 for _ in range(n)]
        edges = [{} for _ in range(n)]
        for a, b in itertools.combinations(range(n), 2):
            if rng.random() < 0.5:
                edges[a][b] = edges[b][a] = rng.randint(1, 5) / 2
        least = min(cost(x, costs, edges) for x in itertools.product([True, False], repeat=n))
        assert cost(labelled(costs, edges), costs, edges) == pytest.approx(least)
        assert cost(minimum_cut(costs, edges), costs, edges) == pytest.approx(least)


PAGES = "page_id long, url string, html string, text string, x string, m string"


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "u", PAGE), (3, None, PAGE), (3, None, PAGE),
            (4, "v", "<article>" + "<p>Long text here.</p>" * 20_000 + "</article>")]
    pages = spark.createDataFrame([(*r, "clash", "y", "z") for r in rows], PAGES)
    got = html_cut.extract(pages).collect()
    assert got[0].text == got[1].text == "" and got[0].n_chars == 0
    assert got[2].text == got[3].text == got[4].text and got[2].n_chars == len(got[2].text) > 50
    assert got[5].text == "\n".join(["Long text here."] * 20_000)
    assert html_cut.extract(pages.limit(0)).collect() == []


def test_formulas_labels_and_fallback_text_are_kept():
    page = """<article><p>The area is <math><mi>A</mi><mo>=</mo><mi>b</mi><mi>h</mi></math> for every triangle.
<p>A drawing <svg viewBox="0 0 9 9"><style>.t{}</style><path d="M0"/><text>The base of it.</text><text>The height of it.</text></svg>
<object data="x"><p>The object is told here in words.</p></object>
<video src="v">The film is told here in words.</video><audio src="a">So is the tune.</audio><canvas>And the plot.</canvas>
<script>var no;</script><template><p>Not this.</p></template></article>"""
    assert main_text(page, INITIAL).split("\n") == [
        "The area is A=bh for every triangle.", "A drawing", "The base of it.", "The height of it.",
        "The object is told here in words.",
        "The film is told here in words.So is the tune.And the plot."]


def neutral(page):
    """The same page with names and elements that say nothing."""
    return re.sub(r"<(/?)(nav|article|footer)\b", r"<\1div", page.replace(' class="ad"', ""))


def broken_up(page):
    """Articles of several sections, every third paragraph cut down to its first word."""
    count = itertools.count(1)

    def paragraph(m):
        n = next(count)
        body = m[1].split(" ")[0] if n % 3 == 0 else m[1]
        return ("</section><section>" if n % 4 == 0 else "") + f"<p>{body}</p>"

    page = page.replace("<article>", "<article><section>").replace("</article>", "</section></article>")
    return re.sub(r"<p>([^<]*)</p>", paragraph, page)


def f1(kept, truth):
    return 2 * sum(k and t for k, t in zip(kept, truth)) / (sum(kept) + sum(truth))


@pytest.mark.parametrize("change", [lambda p: p, broken_up], ids=["as is", "broken up"])
def test_cut_without_names_beats_the_sign_of_the_costs(change):
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").sort_values("page_id")["html"].tolist()
    halves = [html_cut.learned([html_cut.examples(p) for p in pages[1 - k::2]]) for k in (0, 1)]
    truth, cut, sign, flow = [], [], [], 0
    for k, model in enumerate(halves):
        for page in map(change, pages[k::2]):
            truth += [html_cut.declared(b) > 0 for b in blocks_of(page)]
            blocks = blocks_of(neutral(page))
            cut += html_cut.labels_of(blocks, model)
            costs = html_cut.costs_of(blocks, model)
            sign += [c > 0 for c in costs]
            flow += html_cut.settle(costs, [b.edges for b in blocks]).count(None)
    assert f1(cut, truth) >= 0.95 and f1(cut, truth) > f1(sign, truth) + 0.005
    # the edges change labels, and the maximum flow decides some
    assert cut != sign and flow > 0


def test_roles_are_learned_within_their_bounds():
    assert html_cut.role_weights(np.zeros(6)) == (-html_cut.LEAST_HINT, 0.0)
    # every second boilerplate block taken for content: the least weight; none: more
    assert html_cut.role_weights(np.array([100, 0, 0, 100, 0, 100.0]))[0] == -html_cut.LEAST_HINT
    assert html_cut.role_weights(np.array([900, 0, 0, 1, 0, 900.0]))[0] < -html_cut.LEAST_HINT


def test_edges_fall_with_the_distance():
    agree, differ = np.array([0, 900, 5, 40, 0, 0.0]), np.array([0, 0, 5, 0, 9, 0.0])
    found = html_cut.edges_of(agree, differ)
    assert found[0] == found[1] == html_cut.MOST_EDGE and found[2] == found[3] == found[4] == 0
    blocks = blocks_of("<div><p>a</p><p>b</p></div><section><p>c</p></section>")
    assert list(html_cut.pairs(blocks)) == [(0, 1, 2), (1, 2, 4)]


@pytest.mark.parametrize("page, text", [
    ('<article><p class="x>Hi there, you.</p><p>And more.</p></article>', "Hi there, you.\nAnd more."),
    ("<article><p class=it's>Hi there, you.</p></article>", "Hi there, you.")])
def test_unclosed_quotes_are_markup(page, text):
    assert main_text(page, INITIAL) == text


def test_repeated_ids_train_once(spark):
    rows = [(1, "u", PAGE)] * 3000 + [(1, "u", PAGE + "x")] + [(2, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = html_cut.train(pages)
    few = html_cut.train(pages.distinct())
    assert model.edges == few.edges and model.weights.tolist() == few.weights.tolist()
    assert model[2:] == few[2:] and html_cut.train(pages.limit(0)) is INITIAL
