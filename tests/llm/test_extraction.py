"""The block labeller: parsing by hand cases, the network beside a plain one, held-out pages."""

import re
from html import unescape

import numpy as np
import pytest

from calltext.llm import extraction, recurrent
from calltext.llm.layouts import Layouts
from calltext.llm.markup import blocks, features


def _texts(html):
    return [b.text for b in blocks(html)]


@pytest.mark.parametrize("html, wanted", [
    ("", []),
    ("plain  text\n here", ["plain text here"]),
    ("<p>a<p>b<br>c</p>d", ["a", "b c", "d"]),
    ("<p><b>bold <i>it</b>alic", ["bold italic"]),
    ("<ul><li>a<li>b</ul>", ["a", "b"]),
    ("a &amp; b &lt;p&gt; &eacute; &#228; &nbsp; x &am", ["a & b <p> é ä x &am"]),
    ("1 < 2 and 3 > 2 <p>x", ["1 < 2 and 3 > 2", "x"]),
    ("<script>var t='</p>';</script>a<style>p{}</style><title>t</title>b", ["ab"]),
    ("a<!-- <p> c --><!-- open", ["a"]),
    ("a<p title='x > y'>b<div", ["a", "b"]),
    ('a<p title="open>b</p>c', ["a", "b", "c"]),
    ("</div></p>a</nothing>", ["a"]),
    ("<select><option>a</select><textarea>b</textarea><button>c</button>d", ["d"]),
    ("<SCRIPT>x</SCRIPT ><P>y", ["y"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
])
def test_blocks(html, wanted):
    assert _texts(html) == wanted


@pytest.mark.parametrize("piece", ["<div>", "<a ", "<p class=\"", "<!-- ", "</div>", "<b>x", "<", "&amp;",
                                   "<script>", "<li>x"])
def test_long_and_broken_pages_take_linear_time(piece):
    found = blocks(piece * 60_000 + "end>")
    assert len(features(found)) == len(found)


def _slow(w, sequence):
    """Each step on its own, as the formulas have it."""
    hidden = w["fh"].shape[0]
    sides = []
    for way, steps in (("f", sequence), ("b", sequence[::-1])):
        h, c, out = np.zeros(hidden), np.zeros(hidden), []
        for x in steps:
            z = x @ w[way + "x"] + h @ w[way + "h"] + w[way + "0"]
            i, f, o = (1 / (1 + np.exp(-z[k * hidden:(k + 1) * hidden])) for k in range(3))
            c = f * c + i * np.tanh(z[3 * hidden:])
            h = o * np.tanh(c)
            out.append(h)
        sides.append(out if way == "f" else out[::-1])
    both = np.concatenate(sides, axis=1)
    return 1 / (1 + np.exp(-(both @ w["o"] + w["o0"])))


def test_scores_beside_the_formulas():
    rng = np.random.default_rng(3)
    w = recurrent.start(5, 4, 2)
    sequences = [rng.normal(size=(n, 5)).astype(np.float32) for n in (1, 7, 3, 7, 2, 30)]
    for limit in (1, 20, 1000):
        for got, s in zip(recurrent.scores(w, sequences, limit), sequences):
            assert np.allclose(got, _slow(w, s), atol=1e-5)
    assert [len(s) for s in recurrent.scores(w, [sequences[0][:0], sequences[1]])] == [0, 7]


def test_gradient_beside_differences():
    rng = np.random.default_rng(4)
    w = {k: v.astype(np.float64) for k, v in recurrent.start(3, 2, 5).items()}
    there, back, real = recurrent.padded([rng.normal(size=(n, 3)).astype(np.float32) for n in (4, 2, 1)])
    truth = rng.random(real.shape) < 0.5
    _, grad = recurrent.loss(w, there, back, real, truth)
    for name in w:
        for at in list(np.ndindex(w[name].shape))[::3]:
            values = []
            for step in (1e-3, -1e-3):
                moved = {k: v.copy() for k, v in w.items()}
                moved[name][at] += step
                values.append(recurrent.loss(moved, there, back, real, truth)[0])
            assert abs((values[0] - values[1]) / 2e-3 - grad[name][at]) < 2e-3, (name, at)


def _article(html):
    inside = re.search(r"<article>(.*)</article>", html, re.S)[1]
    parts = (" ".join(unescape(p).split()) for p in re.split(r"</?(?:p|h1|b|br)>", inside))
    return "\n".join(p for p in parts if p)


@pytest.fixture(scope="module")
def learnt(spark):
    return extraction.fitted(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def test_given_pages(spark, learnt):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = extraction.main_texts(pages, learnt, "html", "page_id").collect()
    wanted = {r.page_id: _article(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in got} == wanted
    assert all(r.n_chars == len(r.text) for r in got)


def test_held_out_layouts(learnt):
    source = Layouts([f"Word{i} and so on it goes." for i in range(50)], seed=99)
    right = total = 0
    for _ in range(150):
        html, labels = source.page()
        found = blocks(html)
        assert len(found) == len(labels)
        if found:
            chances = recurrent.scores(learnt, [features(found)])[0]
            right += ((chances > 0.5) == np.array(labels)).sum()
            total += len(labels)
    assert right / total > 0.97


def test_edges(spark, learnt):
    page = "<nav><a href=x>Home</a></nav><article><h1>T</h1><p>Text here.</p></article><footer>c</footer>"
    rows = [(1, None, page), (1, "u", page), (2, "u", None), (None, "u", ""), (3, "u", "<script>"),
            (4, "u", "<article>" + "<p>Some words.</p>" * 20_000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id long, text string, html string")
    got = extraction.main_texts(pages.withColumnRenamed("text", "__html_"), learnt, "html", "page_id")
    texts = sorted(((r.page_id, r.text) for r in got.collect()), key=str)
    assert texts[:2] == [(1, "T\nText here.")] * 2
    assert [t for t in texts if t[0] in (2, None, 3)] == [(2, ""), (3, ""), (None, "")]
    assert next(t for k, t in texts if k == 4).count("Some words.") == 20_000
    assert extraction.main_texts(pages.limit(0), learnt, "html", "page_id").collect() == []
    assert extraction.fitted(pages.limit(0)).keys() == learnt.keys()
