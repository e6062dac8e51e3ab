import html as H
import random
import re
from itertools import product

import numpy as np
import pytest

from reviewlens.llm import boost, dom
from reviewlens.llm import main_text as mt

PAGE = "page_id long, url string, html string"


def article(page):
    """The known article of the given pages: their landmark, cut at its paragraphs."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [" ".join(H.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(x for x in blocks if x)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in mt.extract(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article(r.html) and got[r.page_id].n_chars == len(article(r.html)) and got[r.page_id].url == r.url


@pytest.fixture(scope="module")
def model(spark):
    return mt.train(mt.sample_pages(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")))


PROSE = "The river runs past the old mill, and in spring it rises over the fields. Nobody minds, as it brings good soil."


@pytest.mark.parametrize(
    "around",
    [
        '<div class="cookie-notice"><p>{p}</p><button>OK</button></div>',
        '<div id="comments"><div class="comment"><p>{p}</p></div><div class="comment"><p>{p}</p></div></div>',
        "<form><p>{p}</p><input name=q></form>",
        '<aside class="sidebar"><h3>More</h3><p>{p}</p></aside>',
        '<div class="ad"><p>{p}</p></div>',
        "<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>",
        '<footer>&copy; {p}</footer><script>document.write("<p>{p}</p>")</script><style>p {{}}</style>',
    ],
)
@pytest.mark.parametrize("box", ["<article>{}</article>", "<main>{}</main>", '<div class="post-content">{}</div>'])
def test_other_layouts(model, around, box):
    extra = around.format(p=PROSE.replace("river", "sea"))
    paras = [PROSE.replace("mill", w) for w in ("barn", "church", "inn")]
    body = box.format("<h1>The river</h1>" + "".join(f"<p>{x}</p>" for x in paras))
    for page in (f"<html><body>{extra}{body}</body></html>", f"<html><body>{body}{extra}</body></html>"):
        (text,) = mt.extract_batch([page], model)
        assert text == "\n\n".join(["The river", *paras])


def test_page_without_landmarks_in_sample_or_table(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "just text"), (3, None, "just text"), (None, "v", "<p>a &lt; b &amp; c\n\n d</p>"), (5, "w", "<" * 3000), (6, "w", "<div>" * 3000 + "deep" + "</div>" * 10)]
    df = spark.createDataFrame(rows, PAGE).selectExpr("*", "1 AS text", "2 AS n_chars")
    got = mt.extract(df, layouts=60).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert len({r.text for r in got if r.page_id == 3}) == 1


def test_empty(spark):
    assert mt.extract(spark.createDataFrame([], PAGE), layouts=20).collect() == []


def outline(node):
    return [x if isinstance(x, str) else (x.tag, outline(x)) for x in node.items]


@pytest.mark.parametrize(
    "page, tree",
    [
        ("<p>a<p>b", [("p", ["a"]), ("p", ["b"])]),
        ("<p><b>a<br><p>b</p>", [("p", [("b", ["a", ("br", [])])]), ("p", ["b"])]),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", [("ul", [("li", ["a", ("ul", [("li", ["b"])])]), ("li", ["c"])])]),
        ("<script>if (a<b) '</p>'</script>x", [("script", ["if (a<b) '</p>'"]), "x"]),
        ("a<!-- <p> -->b<!doctype html>c", ["a", "b", "c"]),
        ("1 < 2 &amp;&lt; &#233;", ["1 ", "<", " 2 &< é"]),
        ("<a href='x>y'>z</a></div>w", [("a", ["z"]), "w"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", [("table", [("tr", [("td", ["a"]), ("td", ["b"])]), ("tr", [("td", ["c"])])])]),
        ("<script>never closed", [("script", ["never closed"])]),
    ],
)
def test_broken_markup(page, tree):
    assert outline(dom.parse(page)) == tree


def test_decoding_is_the_best_consistent_choice():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(2, 9)
        parents = [-1] + [rng.randrange(k) for k in range(1, n)]
        logits = np.array([rng.uniform(-3, 3) for _ in range(n)])
        p = 1 / (1 + np.exp(-logits))

        def score(c):
            return sum(np.log(p[k] if c[k] else 1 - p[k]) for k in range(n))

        allowed = [c for c in product([True, False], repeat=n) if c[0] and all(not c[k] or c[parents[k]] for k in range(1, n))]
        got = mt.decode(logits, parents)
        assert tuple(got) in allowed and abs(score(got) - max(map(score, allowed))) < 1e-9


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] > -0.1)).astype(float)
    m = boost.fit(x[:2000], y[:2000])
    assert ((m.logits(x[2000:]) > 0) == y[2000:]).mean() > 0.95
    one = boost.fit(x[:50], np.ones(50))
    assert (one.logits(x) > 0).all() and not one.trees
