"""HTML blocks, the recurrent labeller's gradients and its results on held-out layouts."""

from __future__ import annotations

import numpy as np
import pytest

from sensorweave.llm import htmltext

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var a="</p><p>no</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><article><h1>The &amp; title</h1><p><b>First   para<i>graph</i>
&eacute;&#233;&#x41;<br>next line<p>Second &lt;b&gt; &amp;amp; more<aside>Ad here</aside>
<ul><li>one<li>two</ul><form><label>Mail</label><button>Go</button></form></article>
<section id="comments"><p>Nice post</p></section><footer>&copy; me</footer>"""
WANT = "The & title First paragraph ééA next line Second <b> &amp; more one two"


@pytest.fixture(scope="module")
def labeller(corpus):
    rows = [
        (i, "u", f"<html><body><nav><a>menu {i}</a></nav><div class=ad>buy {i}</div><article><h1>head {i}</h1><p>body text number {i} " + "word " * 30 + "</p></article><footer>foot</footer>")
        for i in range(60)
    ]
    return htmltext.fit(corpus.createDataFrame(rows, "page_id long, url string, html string"))


def test_blocks():
    got = htmltext.blocks(PAGE)
    texts = [b.text for b in got]
    assert "no" not in " ".join(texts) and "T" not in texts and texts[0] == "Site"
    assert " ".join(b.text for b in got if htmltext.distant_label(b.path)) == WANT
    assert [b.linked for b in got if b.text in ("Home", "News")] == [4, 4]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, []),
        ("", []),
        ("plain", ["plain"]),
        ("a<b", ["a<b"]),
        ("<p>a<!-- open <p>b", ["a"]),
        ("<script>x", []),
        ("<p>a</p></p></div>b", ["a", "b"]),
        ("<div title='a>b'>c</div>", ["c"]),
        ("x&nosuch;&nbsp;y", ["x&nosuch; y"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("<noscript><p>no</p></noscript>yes", ["yes"]),
        ("ab<wbr>cd <b>e</b>f", ["abcd ef"]),
        ("<p>a<br/>b<hr>c", ["a", "b", "c"]),
        ("<![CDATA[1 < 2]]>", ["1 < 2"]),
    ],
)
def test_markup_edges(page, want):
    assert [b.text for b in htmltext.blocks(page)] == want


def test_long_pages_take_linear_steps():
    page = "<div>" * 300 + "<p>x" * 20000 + "<a href='" + "q" * 100000
    assert len(htmltext.blocks(page)) >= 20000


def test_gradients():
    """Analytic gradients against differences."""
    draw = np.random.default_rng(0)
    model = htmltext.Labeller.fresh(0)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    x = (draw.random((3, 5, htmltext.DIMS)) < 0.02).astype(float)
    sizes, labels = np.array([5, 3, 1]), (draw.random((3, 5)) < 0.5).astype(float)
    mask = np.arange(5)[None] < sizes[:, None]

    def loss():
        z = model.logits(x, sizes)[0]
        return (np.where(mask, np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - labels * z, 0)).sum() / mask.sum()

    grad = model.gradients(x, sizes, labels)
    for name in model.NAMES:
        for _ in range(6):
            at = tuple(draw.integers(0, n) for n in model.w[name].shape)
            if name in ("xf", "xb"):
                at = (int(np.flatnonzero(x.any(axis=(0, 1)))[0]), at[1])
            keep = model.w[name][at]
            model.w[name][at] = keep + 1e-4
            up = loss()
            model.w[name][at] = keep - 1e-4
            down = loss()
            model.w[name][at] = keep
            assert grad[name][at] == pytest.approx((up - down) / 2e-4, abs=2e-5)


def test_padding_does_not_matter(labeller):
    pages = [htmltext.blocks(PAGE), htmltext.blocks("<p>a</p>"), [], htmltext.blocks("<p>a" * 500)]
    together = labeller.label(htmltext.vectors(pages))
    for page, mask in zip(pages, together):
        assert np.array_equal(labeller.label(htmltext.vectors([page]))[0], mask)


def test_held_out_layouts(labeller):
    real = [htmltext.blocks(PAGE.replace("Second", f"Second {i}")) for i in range(20)]
    made = htmltext.laid_out(real, 200, seed=12345)
    masks = labeller.label(htmltext.vectors([p for p, _ in made]))
    right = np.mean(np.concatenate([m == (y > 0) for m, (_, y) in zip(masks, made)]))
    assert right > 0.97


def test_extract(corpus, labeller):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<article><p>" + "long " * 100000 + "</p></article>")]
    frame = corpus.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS _html", "3 AS n_chars")
    got = htmltext.extract(frame, labeller).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 5 and by[1].text == WANT and by[2].text == by[None].text == "" and by[2].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in got) and by[3].n_chars == 499999
    empty = frame.limit(0)
    assert htmltext.extract(empty, htmltext.fit(empty)).count() == 0
