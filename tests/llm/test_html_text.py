"""Blocks of odd markup, the network's gradients, and text against the article's markup."""

import html
import re

import numpy as np
import pytest

from tests.llm.conftest import SF, table
from vistra.llm import html_text as h


def blocks(page):
    return [(b.path[-1], b.text) for b in h.parse_blocks(page)]


def test_blocks_of_odd_markup():
    assert blocks("") == []
    assert [b.text for b in h.parse_blocks("plain &amp; text")] == ["plain & text"]
    assert blocks("<div><p>one<p>two <b>bold<i>x</b> y</p>z</div>") == [("p", "one"), ("p", "two boldx y"), ("div", "z")]
    assert blocks("<div><p>a<br>b&nbsp; c\n d</div>") == [("p", "a b c d")]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == [("li", t) for t in "abcd"]
    assert blocks('<body><script>var t="</p>";if(a<b)</script><p>x &lt;b&gt; &#233;&eacute;<!-- <p>no --></p><style>p{}</style>') == [("p", "x <b> éé")]
    assert blocks("<p>open <script>never closed") == [("p", "open")]
    assert blocks('<div title="a > b">t</div></div></p><p>u') == [("div", "t"), ("p", "u")]


def test_no_element_takes_the_rest_of_the_page():
    for head in ("<head><title>x</title><body>", "<head><meta charset=u><title>x</title><style>a{}</style>", "<HEAD><script>1</script>", "<head><title>x</title></head><body>", "<head>"):
        assert [b.text for b in h.parse_blocks(f"<html>{head}<article><p>one<p>two</article>")] == ["one", "two"], head
    assert [b.text for b in h.parse_blocks("<head><title>x</title>words<p>y")] == ["words", "y"]
    for tag in ("<svg/>", '<svg class="i" />', "<canvas>", "<iframe src=x>", "<template>", "<noscript>", "<object data=x>", "<svg>", "<math/>"):
        text = " ".join(b.text for b in h.parse_blocks(f"<article><p>one {tag}</p><p>two</p></article><p>three"))
        assert text == "one two three", tag
    # an end tag further on belongs to its own element
    assert " ".join(b.text for b in h.parse_blocks("<p>one<canvas><p>two<canvas>no</canvas><p>three")) == "one two three"
    assert " ".join(b.text for b in h.parse_blocks("<p>one<svg><svg><text>no</text></svg>no</svg><p>two<svg/><p>three<svg>no</svg>")) == "one two three"
    assert blocks("<head><noscript><p>no</noscript><body><p>a<iframe>no</iframe>") == [("p", "a")]
    formula = "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>"
    assert blocks(f"<p>so {formula} and <object data=y><param name=z>shown</object> end") == [("p", "so x=1 and shown end")]
    assert blocks("<script>if(a<b) // don't\n</script><p>it's</p><p>b") == [("p", "it's"), ("p", "b")]
    h.parse_blocks("<canvas>" * 20_000 + "<svg>" * 20_000)


def test_unclosed_inline_elements_end_with_their_block():
    paths = [b.path for b in h.parse_blocks("<article><p><b>a.<br><p>b</p></article><footer>c")]
    assert paths == [("article", "p", "b"), ("article", "p"), ("footer",)]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    pages = [[h.Block(("div", "nav", "p")[: rng.integers(1, 4)], f"word{rng.integers(5)} a b", 1) for _ in range(n)] for n in (3, 1, 5)]
    model, features = h.new_model(1), h.Features(pages)
    labels = rng.integers(-1, 2, features.mask.shape)
    _, grads = h.gradients(model, features, labels)
    for name, grad in grads.items():
        for at in map(tuple, np.argwhere(np.abs(grad) > 1e-4)[:4]):
            old = model[name][at]
            model[name][at] = old + 1e-5
            up, _ = h.gradients(model, features, labels)
            model[name][at] = old - 1e-5
            down, _ = h.gradients(model, features, labels)
            model[name][at] = old
            assert grad[at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-8), name


def test_padding_changes_nothing():
    pages = [h.parse_blocks("<p>a</p><div>b</div>"), h.parse_blocks("<p>a</p>" * 9)]
    model = h.new_model(2)
    for page, p in zip(pages, h.predict(model, pages)):
        assert p == pytest.approx(h.predict(model, [page])[0])


def test_features_read_all_words_of_a_block():
    block = h.Block(("p",), "a " * 1500 + "end", 0)
    at, slot = h.Features([[block]]).words
    assert len(at) == 1501 and slot[-1] == h._slot("end", h.WORD_SLOTS)


def test_training_sees_all_parts_of_long_pages(spark, monkeypatch):
    page = [h.Block(("p",), f"t{i}", 0) for i in range(400)]
    seen, rng = set(), np.random.default_rng(1)
    for _ in range(60):
        (blocks,), (labels,), (places,) = h.vary([page], rng)
        assert len(blocks) == len(labels) == len(places) <= h.FIT_BLOCKS + 9
        own = [(int(b.text[1:]), x) for b, x in zip(blocks, places) if b.path == ("p",)]
        assert all(abs(x - i / 400) < 0.03 for i, x in own)
        seen |= {i for i, _ in own}
    assert min(seen) < 20 and max(seen) > 380
    monkeypatch.setattr(h, "train", lambda pages: pages)
    long = spark.createDataFrame([("<p>" + "a " * 600_000 + "</p><footer>end</footer>",)], "html string")
    assert [b.text for b in h.fit_labeller(long)[0]][1:] == ["end"]


def article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)>", "\n", inner.replace("<br>", " ")))
    lines = (" ".join(html.unescape(x).split()) for x in inner.split("\n"))
    return "\n".join(x for x in lines if x)


def test_op5_on_pages(spark):
    pages = table("pages", "/root/testdata/sf0.01")
    rows = {r.page_id: r for r in h.op5_html_text(spark, "/root/testdata/sf0.01").collect()}
    assert len(rows) == len(pages)
    for i, url, page in zip(pages.page_id, pages.url, pages.html):
        assert (rows[i].url, rows[i].text, rows[i].n_chars) == (url, article(page), len(article(page)))


def test_parts_of_a_page_that_training_pages_lack(spark):
    page = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><div class="menu"><ul><li>Home<li>News</ul></div>
    <div class="cookie-notice">We use cookies on this site.</div><aside><p>Some other long text to read here. Yes, it is so.</p></aside>
    <main><h1>Title &amp; more</h1><p>First line<br>second <a href=x>link</a> end.<p>Second &lt;para&gt;.<div class="ad">Buy this now.</div>
    <ul><li>An item of a list in it.</ul><form><label>Your name</label><button>Go</button></form></main>
    <section id="comments"><p>Nice article, thanks a lot for it.</p></section><footer>2020</footer></body></html>"""
    model = h.fit_labeller(spark.read.parquet(f"{SF}/pages.parquet"))
    df = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "x"), (None, "v", "", "x"), (1, "u", page, "x")], "page_id bigint, url string, html string, text string")
    rows = h.extract_text(df, model).collect()
    assert [r.text for r in rows if r.page_id == 1] == ["Title & more\nFirst line second link end.\nSecond <para>.\nAn item of a list in it."] * 2
    assert [r.n_chars for r in rows if r.page_id != 1] == [0, 0]
    assert h.extract_text(df.limit(0), model).count() == 0
    assert set(h.fit_labeller(df.limit(0))) == set(model)


def _pattern_tokens(page):
    """All markup by one pattern, quadratic on broken pages."""
    import re

    pattern = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>", re.S)
    return [(m.start(), m.end(), bool(m[1]), (m[2] or "").lower(), m[3] or "") for m in pattern.finditer(page)]


def test_markup_equals_the_pattern_on_broken_pages():
    import random

    from vistra.llm.html_text import Markup

    rng = random.Random(1)
    bits = ["<", ">", '"', "'", "a", "<p", "</p", "<!--", "-->", "<!", "<?", " x=", "/", " ", "text", "<a href='q'>", "=\"v\""]
    for _ in range(20_000):
        page = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        markup, at, got = Markup(page), 0, []
        while t := markup.next(at):
            got.append((t.start, t.end, t.closing, t.name, t.attributes))
            at = t.end
        assert got == _pattern_tokens(page), page


@pytest.mark.parametrize("page", ["<a " * 330_000, '<a "' * 250_000, '<a "' * 250_000 + ">", "<p>" + "<a '\"" * 200_000 + "></p>x", "<!x" * 330_000, "<div>x" * 170_000, "<b>" * 170_000 + "</i>" * 80_000, "<head>" + "<title>" * 140_000, "<svg><a 'x" * 100_000])
def test_a_megabyte_of_broken_markup_takes_linear_time(page):
    import time

    t0 = time.process_time()
    h.parse_blocks(page)
    assert time.process_time() - t0 < 6  # about 1 s; the pattern takes hours


def test_labeller_is_the_same_whatever_files_hold_the_pages(spark):
    from tests.llm.conftest import SF

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    one, many = (h.fit_labeller(df, 20) for df in (pages.coalesce(1), pages.repartition(7)))
    assert all((one[k] == many[k]).all() for k in one)
