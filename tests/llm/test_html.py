import re

import numpy as np
import pytest

from tabularium.llm import html


def test_blocks():
    page = """<head><title>t</title></head><style>p{x}</style><script>var a="</p><p>no";</script><!-- no <p> -->
    <div class='Main-Body'>loose &amp; <b>bold</b>\n text<br>on<p>one<p>two &eacute;<ul><li><a href="x>y">link</a><li>b</ul></div> stray</p> tail"""
    got = html.blocks(page)
    assert [t for t, _, _ in got] == ["loose & bold text on", "one", "two é", "link", "b", "stray", "tail"]
    assert got[0][1] == ("div", "main", "body") and got[1][1] == ("div", "main", "body", "p") and got[3][2] == 1.0
    assert html.blocks("") == [] == html.blocks("<p>  </p><script>x") and html.blocks("a < b")[0][0] == "a < b"


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>T</title><body><article><p>one</article>", ["one"]),
    ("<html><head><title>T</title><meta charset=utf-8><link rel=x><p>one<p>two", ["one", "two"]),
    ("<head><title>T<meta charset=utf-8></head><body><p>one", ["one"]),
    ("<head><title>T <b>bold</b> < U</title></head><p>one", ["one"]),
    ("<p>one <svg width='1' /> two</p><p>three</p>", ["one two", "three"]),
    ("<p>one <svg><title>t</title><text>no</text></svg> two<p>three", ["one two", "three"]),
    ("<svg><foreignObject><div>no</div></foreignObject></svg><p>one", ["one"]),
    ("<div><svg><path d='M0'><p>one</p></div>", ["one"]),
    ("<form><select><option>no<option>no</form><p>one", ["one"]),
    ("<select><option>no</option></select><p>one", ["one"]),
    ("<head-line>one</head-line><svg-icon>two</svg-icon><style-note>three</style-note>", ["one", "two", "three"]),
    ("<script>no</script ><style>no</style\n><p>one", ["one"]),
])
def test_open_and_custom_tags(page, want):
    assert [t for t, _, _ in html.blocks(page)] == want


def test_article_of_a_page_without_end_of_head(spark):
    body = "<article><h1>Title of it</h1><p>Some text that is read by many.</p></article><footer>© x</footer>"
    pages = spark.createDataFrame([(k, "u", f"<html><head><title>T</title>{end}<body>{body}") for k, end in enumerate(["</head>", ""])], "page_id long, url string, html string")
    texts = [r.text for r in html.extract_main(pages).collect()]
    assert texts[0] == texts[1] and texts[0].startswith("Title of it")


def test_gradients_match_differences():
    inputs, labels = html.training_set(3, 5)
    x, mask = html.pad(inputs)
    y = np.zeros(mask.shape)
    for j, one in enumerate(labels):
        y[: len(one), j] = one
    model = html.Labeller(1)

    def loss():
        s = np.clip(model.scores(x, mask)[0], 1e-12, 1 - 1e-12)
        return -((y * np.log(s) + (1 - y) * np.log(1 - s)) * mask).sum() / mask.sum()

    g = model.gradients(x, mask, y)
    rng = np.random.default_rng(1)
    for name, values in model.p.items():
        at = tuple(rng.integers(0, n) for n in values.shape)
        before = values[at]
        values[at] = before + 1e-5
        up = loss()
        values[at] = before - 1e-5
        down = loss()
        values[at] = before
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-6


def test_held_out_accuracy():
    inputs, labels = html.training_set(150, 99)
    found = html.trained().label(inputs)
    right = np.concatenate([f == l.astype(bool) for f, l in zip(found, labels)])
    assert right.mean() > 0.95


@pytest.mark.parametrize("n", [1, 2, 3, 12, 200, 2_000, 20_000])
def test_no_paragraph_of_a_plain_article_is_lost(n):
    model = html.trained()
    for title in ("", "<h1>Title of it</h1>"):
        for footer in ("", "<footer>© x</footer>"):
            found = html.blocks(f"<article>{title}{'<p>Words of a long text here.</p>' * n}</article>{footer}")
            assert list(model.label([html.vectors(found)])[0]) == [True] * (n + bool(title)) + [False] * bool(footer)


def test_held_out_accuracy_of_long_pages():
    inputs, labels = html.training_set(20, 97, 400)
    right = np.concatenate([f == l.astype(bool) for f, l in zip(html.trained().label(inputs), labels)])
    assert max(map(len, labels)) > 300 and right.mean() > 0.98


def test_given_pages(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    rows = html.extract_main(pages.selectExpr("*", "1 as text", "2 as n_chars")).collect()
    source = {r.page_id: r.html for r in pages.collect()}
    right = 0
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        right += r.text == "\n\n".join(t for t, _, _ in html.blocks(inner)) and r.n_chars == len(r.text)
    assert len(rows) == len(source) and right >= 0.97 * len(rows)


def test_nulls_repeats_long_and_empty(spark):
    long = "<article>" + "<p>Words of a long text here.</p>" * 20_000 + "</article><footer>© x</footer>"
    page = "<nav><ul><li><a>Home</a></li></ul></nav><article><h1>Title of it</h1><p>Some text that is read by many.</p></article>"
    rows = [(1, None, None), (2, "u", ""), (None, "u", page), (None, "u", page), (3, "v", long), (4, "w", "<p>"), (5, "w", "<<<>>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html.extract_main(pages).collect()
    assert len(got) == 7 and [r.text for r in got if r.page_id in (1, 2, 4)] == ["", "", ""]
    assert [r.text for r in got if r.page_id is None] == ["Title of it\n\nSome text that is read by many."] * 2
    assert [r.text.count("long text") >= 19_990 for r in got if r.page_id == 3] == [True]
    assert html.extract_main(pages.limit(0)).count() == 0
