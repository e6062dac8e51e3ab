import pytest

from reviewlens.llm import dom
from reviewlens.llm import main_text as mt


def texts(page):
    return [b.text for b in mt.blocks_of(dom.parse(page)) if b.text]


@pytest.mark.parametrize(
    "page, want",
    [
        ('<p>one</p><svg width="3"/><p>two</p>', ["one", "two"]),
        ("<p>one <math/> more</p><p>two</p>", ["one more", "two"]),
        ("<svg/><p>one</p><svg><title>t</title><path d='x'/><text>drawn</text></svg><p>two</p>", ["one", "two"]),
        ("<svg><title/><style/><g></g></svg><p>two</p>", ["two"]),
        ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p></article>", ["so x=1 holds"]),
        ("<p>one</p><noscript><p>off</p></noscript><template><div>later</template><p>two</p>", ["one", "two"]),
        ("<div><noscript><p>one</p></div><p>two</p>", ["one", "two"]),
        ("<template><p>one</p><p>two</p>", ["one", "two"]),
        ("<noscript/><p>one</p>", ["one"]),
        ("<p>a<template><div>b</div></template>c</p>", ["ac"]),
        ("<p>one</p><script>x < 1</script><p>two</p>", ["one", "two"]),
    ],
)
def test_elements_that_are_no_raw_text(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("piece", ["<a ", "<div>", "<div>x", "<", "<a \"", "<a<a", "<ul><li>", "<p><b>", "</ \"", "<svg>", "<!-- ", "<td>", "<i '>"])
def test_broken_pages_take_time_in_proportion(piece):
    """One megabyte of each, three times as long as an eighth of it and more at most in proportion (with room for noise)."""
    import time

    took = []
    for size in (125_000, 1_000_000):
        begun = time.time()
        mt.blocks_of(dom.parse(piece * (size // len(piece)) + ">"))
        took.append(time.time() - begun)
    assert took[1] < 8 * 4 * max(took[0], 0.05) and took[1] < 20
