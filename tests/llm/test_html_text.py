"""The block labeller: parsing, the network against plain loops, and pages of several layouts."""

import html
import math
import os
import random
import re

import numpy as np
import pytest

from tremora.llm import html_text as H

DDL = "page_id bigint, url string, html string, text string, n_chars int"
SMALL = "/root/testdata/sf0.01"


def test_blocks_of_broken_and_odd_pages():
    def got(page):
        return [(b.path, b.text) for b in H.blocks(page)]
    assert got("") == got("<!-- x") == got("<script>var a='</p>';") == got("<p> &nbsp; </p>") == []
    assert got("<p>a < b &amp; c<br>d</p>e") == [(("p",), "a < b & c d"), ((), "e")]
    assert got("<script>'<p>x</p>'</script><STYLE>y</STYLE ><p>z<!-- <p>q -->!") == [(("p",), "z !"
                                                                                      .replace(" ", ""))]
    assert got('<div class="x>y" id=mainText>t</div>') == [
        (("div", ".x", ".y", ".main", ".text"), "t")]
    assert got("<p data=it's>don't<p>two") == [(("p",), "don't"), (("p",), "two")]
    assert got("<ul><li>a<li>b <b>c</ul>d") == [(("ul", "li"), "a"), (("ul", "li"), "b c"), ((), "d")]
    assert got("x<title>no</title>yes") == [((), "x"), ((), "yes")]
    assert got("&lt;p&gt;&#233;&eacute;") == [((), "<p>éé")]
    assert got("<p><b>one<br><p>two</b> end</p>") == [(("p",), "one"), (("p",), "two end")]
    assert got("</p></div>a</a><td>b") == [((), "a"), (("td",), "b")]
    linked = H.blocks("<li><a href=x>abc</a> de</li>")[0]
    assert (linked.text, linked.linked) == ("abc de", 3)


def test_deep_and_long_pages_stay_cheap():
    deep = H.blocks("<div class=a>t" * 20_000)
    assert len(deep) == 20_000 and len(deep[-1].path) <= 4 * H.DEPTH
    assert len(H.blocks("</x>" * 50_000 + "<p>" * 50_000 + "t")) == 1


def plain_scores(model, page):
    """A page's probabilities by the formulas of an LSTM, a number at a time."""
    size = model.recurrence[0].shape[0]
    total = [float(model.bias[0])] * len(page)
    for way in range(2):
        h, c = [0.0] * size, [0.0] * size
        steps = range(len(page)) if way == 0 else range(len(page) - 1, -1, -1)
        for t in steps:
            z = [sum(float(a) * float(w) for a, w in zip(page[t], model.inputs[way][:, k]))
                 + sum(a * float(w) for a, w in zip(h, model.recurrence[way][:, k]))
                 + float(model.shift[way][k]) for k in range(4 * size)]
            i, f, o = ([1 / (1 + math.exp(-x)) for x in z[n * size:(n + 1) * size]]
                       for n in range(3))
            g = [math.tanh(x) for x in z[3 * size:]]
            c = [a * b + d * e for a, b, d, e in zip(f, c, i, g)]
            h = [a * math.tanh(b) for a, b in zip(o, c)]
            total[t] += sum(a * float(w) for a, w in zip(h, model.out[way * size:, 0]))
    return [1 / (1 + math.exp(-x)) for x in total]


def small_model(seed=3):
    return H.new_labeller(hidden=3, seed=seed)


def a_page(r, count):
    return [H.Block(tuple(r.choices(["html", "body", "div", ".side", "p", "li"], k=r.randint(1, 5))),
                    " ".join(r.choices(["alpha", "beta,", "gamma."], k=r.randint(1, 9))), 2)
            for _ in range(count)]


def test_the_network_equals_plain_loops():
    r, model, tool = random.Random(1), small_model(), H.Vectors()
    pages = [a_page(r, n) for n in (4, 1, 0, 7, 2)]
    gates = H.Gates(model, tool)
    for most in (1, 8, 10_000):  # however pages are put side by side
        got = H.labels_of(pages, model, gates, most)
        for page, row in zip(pages, got):
            assert np.allclose(row, plain_scores(model, tool.of(page)), atol=1e-5)


def test_gradients_equal_differences():
    r, model, tool = random.Random(2), small_model(), H.Vectors()
    pages = [tool.of(a_page(r, n)) for n in (3, 5)]
    labels = [np.array([r.randint(0, 1) for _ in p], np.float32) for p in pages]
    found = H._gradients(model, pages, labels)

    def loss():
        out = 0.0
        for page, marks in zip(pages, labels):
            for p, y in zip(plain_scores(model, page), marks):
                out -= math.log(p if y else 1 - p)
        return out / sum(map(len, pages))
    for weight, gradient in zip(model.arrays(), found):
        for at in {tuple(r.randrange(n) for n in weight.shape) for _ in range(3)}:
            was = weight[at]
            weight[at] = was + 1e-2
            above = loss()
            weight[at] = was - 1e-2
            below = loss()
            weight[at] = was
            assert abs((above - below) / 2e-2 - gradient[at]) < 2e-3


def site_page(r, number):
    def prose(n):
        return " ".join(r.choice(["river", "stone", "walk", "morning", "letter", "garden"])
                        for _ in range(n)).capitalize() + "."
    body = "".join(f"<p>{prose(r.randint(3, 40))}</p>" for _ in range(r.randint(2, 9)))
    return (f"<html><head><title>t</title></head><body><nav><ul><li><a href=/>home</a><li><a>"
            f"news</a></ul></nav><div class='ad'>{prose(6)}</div><article><h1>{prose(4)}</h1>{body}"
            f"</article><footer>&copy; site {number}</footer></body></html>")


OTHER = """<html><body><header><a href=/>Site</a><nav><ul><li><a>Home</a><li><a>About</a></ul></nav>
</header><div id="cookie-consent"><p>We use cookies to improve your visit, please accept.</p></div>
<div class="layout"><aside class="sidebar"><h3>Popular</h3><ul><li><a>One thing</a></li></ul></aside>
<div class="post"><h1>The title &amp; more</h1><p>First paragraph of the article,
with several words in it.</p><div class="ad">Buy now, cheap and good.</div><p>Second one is here.</p>
<blockquote>Quoted text here, long enough.</blockquote></div><section class="comments"><div class=
"comment"><p>I liked this article a lot, thank you for writing it.</p></div></section><form><label>
Name</label><button>Send</button></form></div><footer><p>Copyright by all of us.</p></footer>"""


def test_pages_of_other_layouts_than_those_learned_from(spark):
    r = random.Random(5)
    rows = [(k, "u", site_page(r, k), "x", 1) for k in range(80)]
    extra = [(900, "v", OTHER, "x", 1), (901, None, None, None, None), (902, "w", "", "", 0),
             (None, "z", rows[0][2], "x", 1), (0, "u", rows[0][2], "x", 1)]
    table = spark.createDataFrame(rows + extra, DDL)
    model = H.fit(table)
    got = H.extract(table.repartition(3), model).collect()
    assert len(got) == 85 and all(g.n_chars == len(g.text) for g in got)
    by_id = {g.page_id: g.text for g in got}
    assert by_id[900].split("\n") == [
        "The title & more", "First paragraph of the article, with several words in it.",
        "Second one is here.", "Quoted text here, long enough."]
    assert by_id[901] == by_id[902] == "" and by_id[None] == by_id[0]
    for k, _, page, *_ in rows:
        want = re.findall(r"<(?:h1|p)>(.*?)</(?:h1|p)>", page)
        assert by_id[k].split("\n") == want
    again = H.fit(table.repartition(5))
    assert all((a == b).all() for a, b in zip(model.arrays(), again.arrays()))
    assert H.extract(table.limit(0), H.fit(table.limit(0))).count() == 0


def test_a_very_long_page_is_read_whole(spark):
    r = random.Random(6)
    rows = [(k, "u", site_page(r, k), "x", 1) for k in range(40)]
    long_page = ("<html><body><nav><ul><li><a>home</a></ul></nav><article>"
                 + "".join(f"<p>paragraph number {k} of a long page.</p>" for k in range(30_000))
                 + "</article><footer>end</footer>")
    table = spark.createDataFrame(rows + [(99, "u", long_page, "x", 1)], DDL)
    got = H.extract(table, H.fit(table)).where("page_id = 99").first()
    assert got.text.split("\n") == [f"paragraph number {k} of a long page." for k in range(30_000)]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the generated tables are not here")
def test_held_out_pages_of_the_table_against_their_markup(spark):
    """The labeller, fitted on a part, against what the pages' own markup says of the others."""
    table = spark.read.parquet(f"{SMALL}/pages.parquet")
    model = H.fit(table.where("page_id % 2 = 0"))
    got = {g.page_id: g.text for g in H.extract(table, model).collect()}
    held = table.where("page_id % 2 = 1").collect()
    for row in held:
        article = row.html.split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:h1|p)>", re.sub(r"<br>|</?b>", " ", article))
        want = [" ".join(html.unescape(p).split()) for p in parts]
        assert got[row.page_id] == "\n".join(w for w in want if w)
    assert len(held) > 50
