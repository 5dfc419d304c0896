import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlake.llm import html_text
from helpers import prose, read


def texts(page):
    return [leaf.text for leaf in html_text.leaves(page)]


def test_leaves_of_broken_markup():
    assert texts("<p>a <b>b<br><p>c&amp;d\n  e") == ["a b", "c&d e"]
    assert texts("x<script>var t='</p>';</script>y<!-- no --><style>p{}</style>z") == ["xyz"]
    assert texts('<a title="a > b" href=x>link</a> on') == ["link on"]
    assert texts("<ul><li>one<li>two</ul>three") == ["one", "two", "three"]
    assert texts("1 < 2 <p>&lt;b&gt;&#233;&nbsp;x</p>") == ["1 < 2", "<b>é x"]
    assert texts("") == texts("<div></div>") == texts("<script>x") == texts("<!-- ") == []
    assert texts("</p></div>end</b>") == ["end"]
    paths = {leaf.text: leaf.path for leaf in html_text.leaves('<div class="siteHeader top"><a>h</a></div><main id=content><p>t</p></main>')}
    assert paths == {"h": ("div", ".site", ".header", ".top", "a"), "t": ("main", ".content", "p")}
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert texts(deep) == ["x"]


def test_no_text_is_lost_around_silent_elements():
    assert texts('<article><p>One</p><p>two <svg class="i"/> three</p><p>four</p><p>five</p></article>') == ["One", "two three", "four", "five"]
    assert texts("<article><p>One</p><object data=x><p>two</p></article><p>three") == ["One", "two", "three"]
    assert texts("<p>one</p><iframe src=x><p>two</p>") == ["one", "two"]
    assert texts("<style-guide><p>One</p></style-guide><button-group><p>two</p></button-group><p>rest") == ["One", "two", "rest"]
    assert texts("<div>a <object>b<object>c</object>d</object> e</div><p>f <BUTTON>g<p>h</p></BUTTON > i") == ["a e", "f i"]
    assert texts('<p>a <svg><title>t</title><path d="m"/></svg> b</p><noscript>c</noscript>d</svg>e') == ["a b", "de"]
    assert texts("<div><object>a</div><div>b</div><object>c</object>d") == ["a", "b", "d"]
    assert texts("a<script>b</scripts>c</script >d<textarea>e") == ["ad"]
    deep = "<object>" * 3000 + "x" + "</object>" * 3000 + "y"
    assert texts(deep) == ["y"]


def test_formulas_are_text_of_their_line():
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn><mspace/></mrow><annotation>x=2</annotation></semantics></math>"
    assert texts(f"<article><p>where {formula} holds</p><p>next</p></article>") == ["where x=2 holds", "next"]
    assert texts("<p>a <math/> b</p><p>c</p>") == ["a b", "c"]


def page(k):
    """A page in one of several layouts, and its main text."""
    body = [prose(10 * k + j, 8 + (k * 7 + j * 13) % 60).capitalize() + "." for j in range(3 + k % 6)]
    blocks = "".join(f"<p>{t} &amp; so on</p>" for t in body)
    main = "\n".join(f"{t} & so on" for t in body)
    menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in prose(k, 5).split())
    layouts = [
        f"<nav><ul>{menu}</ul></nav><article>{blocks}</article><footer>&copy; {prose(k, 6)}</footer>",
        f'<header><h2>{prose(k, 3)}</h2></header><main>{blocks}</main><aside><p>{prose(k + 1, 12)}</p></aside>'
        f'<div class="comments"><div class="comment"><p>{prose(k + 2, 40)}.</p></div></div>',
        f'<div class="cookie-notice"><p>{prose(k, 14)}</p></div><article>{blocks}</article>'
        f'<form><label>{prose(k, 2)}</label><input></form><div class="advert">{prose(k + 3, 10)}</div>',
        f'<div class="sidebar"><ul>{menu}</ul></div><main><article>{blocks}</article></main><section class="comments"><p>{prose(k, 30)}</p></section><footer><p>{prose(k, 5)}</p></footer>',
    ]
    return f"<html><head><title>{prose(k, 4)}</title></head><body>{layouts[k % 4]}<script>track({k})</script></body></html>", main


def test_main_text_of_unseen_layouts(spark, small_dir):
    net = html_text.fit(read(spark, small_dir, "pages"))
    pages = [page(k) for k in range(80)]
    frame = spark.createDataFrame([(k, f"http://x/{k}", html, 1) for k, (html, _) in enumerate(pages)], "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in html_text.extract(frame, net).collect()}
    exact = [got[k].text == main for k, (_, main) in enumerate(pages)]
    assert np.mean(exact) > 0.8
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_same_text_as_by_the_pages_own_marks(spark, small_dir):
    pages = read(spark, small_dir, "pages")
    got = {r.page_id: r.text for r in html_text.extract(pages, html_text.fit(pages)).collect()}
    expected = {}
    for r in pages.collect():
        found = html_text.leaves(r.html)
        expected[r.page_id] = "\n".join(leaf.text for leaf in found if "article" in leaf.path)
    assert np.mean([got[k] == expected[k] for k in expected]) > 0.95


def test_long_pages_teach_as_well(spark, small_dir):
    pages = read(spark, small_dir, "pages").select("page_id", "url", "html")
    long = pages.withColumn("html", F.concat("html", F.lit("<!--" + "x" * 61_000 + "-->")))
    got = {r.page_id: r.text for r in html_text.extract(long, html_text.fit(long)).collect()}
    marked = {r.page_id: "\n".join(x.text for x in html_text.leaves(r.html) if "article" in x.path) for r in pages.collect()}
    assert np.mean([got[k] == marked[k] for k in marked]) > 0.95


def test_copies_of_a_page_are_one_of_the_sample(spark):
    pages = spark.createDataFrame([(k, None, page(0)[0]) for k in range(300)] + [(1000 + k, None, page(k)[0]) for k in range(1, 9)], "page_id long, url string, html string")
    net = html_text.fit(pages, sample=9, epochs=1)
    again = html_text.fit(pages.dropDuplicates(["html"]).repartition(3), sample=9, epochs=1)
    assert all(np.array_equal(net.values[k], again.values[k]) for k in net.values)


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = html_text.Labeller(path_dim=3, word_dim=2, hidden=3).start()
    net.values = {k: v.astype(np.float64) for k, v in net.values.items()}
    lengths = np.array([4, 2])
    x = rng.normal(size=(2, 4, 3 + 2 + html_text._SIZES))
    mask = (np.arange(4) < lengths[:, None]).astype(float)
    x *= mask[:, :, None]
    y = (rng.random((2, 4)) < 0.5).astype(float)

    def loss():
        z, _ = net.run(x, lengths)
        return float((mask * (np.logaddexp(0, z) - y * z)).sum())

    z, memory = net.run(x, lengths)
    grads, to_input = net.slopes(x, lengths, mask * (1 / (1 + np.exp(-z)) - y), memory)
    for name in ("fin", "bin", "fown", "bown", "fbias", "bbias", "out"):
        value = net.values[name]
        for at in [tuple(rng.integers(n) for n in value.shape) for _ in range(4)]:
            value[at] += 1e-4
            high = loss()
            value[at] -= 2e-4
            low = loss()
            value[at] += 1e-4
            assert (high - low) / 2e-4 == pytest.approx(grads[name][at], rel=2e-2, abs=2e-3), (name, at)
    x[0, 1, 2] += 1e-4
    high = loss()
    x[0, 1, 2] -= 2e-4
    assert (high - loss()) / 2e-4 == pytest.approx(to_input[0, 1, 2], rel=2e-2, abs=2e-3)


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>" + "word " * 50_000), (3, "u", "<article><p>A b.</p></article>"), (3, "u", "<article><p>A b.</p></article>"), (4, "u", "\x00<\n>&#0;&bogus;")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    net = html_text.fit(pages)
    got = html_text.extract(pages, net).collect()
    assert len(got) == len(rows) and {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert len({r.text for r in got if r.page_id == 3}) == 1
    none = pages.limit(0)
    assert html_text.extract(none, html_text.fit(none)).count() == 0
