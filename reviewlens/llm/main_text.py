"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the hierarchy.

Every block of a page (element with block layout, or run of text beside such elements) gets features: densities of its
subtree, words of its class and id and of those above it, depth, place among its siblings. Boosted trees give each the
log-odds that it belongs to the article or holds it. Decoding picks the most likely set of blocks in which nothing below an
excluded block is kept; the log-likelihoods of both choices are added up from the leaves, so single blocks that look wrong
are outvoted by their surroundings.

The model is trained for each run on a bounded sample: ``SAMPLE`` pages, labelled where they have the landmarks of HTML, and
``LAYOUTS`` page layouts drawn from a seed and filled with text of the sampled pages.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.llm.boost import Boost, fit
from reviewlens.llm.common import map_batches
from reviewlens.llm.dom import BLOCK, RAW, Node, parse

#: Sampled pages, the most characters of a sampled page that come to the driver, and drawn layouts.
SAMPLE, SAMPLE_CHARS, LAYOUTS = 300, 60_000, 500
WORDS = {
    "content": "article content post entry story main body text blog prose longform".split(),
    "frame": "nav navbar navigation menu breadcrumb breadcrumbs header masthead logo footer foot copyright legal sidebar aside rail widget toolbar pagination".split(),
    "promo": "ad ads advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice gdpr popup modal alert related recommended share social".split(),
    "reader": "comment comments commentlist reply replies respond discussion disqus reviews feedback".split(),
    "form": "form login signup subscribe subscription newsletter search register contact".split(),
}
_WORD_GROUP = {w: k for k, ws in enumerate(WORDS.values()) for w in ws}
TAGS = {
    "article": ["article"], "main": ["main"], "nav": ["nav", "menu"], "header": ["header"], "footer": ["footer", "address"], "aside": ["aside", "dialog"],
    "form": ["form", "fieldset", "select", "search"], "p": ["p", "pre", "blockquote"], "heading": ["h1", "h2", "h3", "h4", "h5", "h6", "hgroup"],
    "list": ["ul", "ol", "li", "dl", "dt", "dd"], "table": ["table", "tbody", "thead", "tfoot", "tr", "td", "th"], "box": ["div", "section"],
    "head": ["head"], "run": ["#run"], "top": ["#page", "html", "body"],
}
_TAG_GROUP = {t: k for k, ts in enumerate(TAGS.values()) for t in ts}
LANDMARKS = {"article", "main"}
NEVER = {"nav", "header", "footer", "aside", "form", "head", "dialog", "menu", "fieldset", "search"}
#: Inline elements whose text is not prose.
SILENT = RAW | {"button", "select", "input", "head", "svg", "noscript", "template", "annotation", "annotation-xml"}
NAMES = [
    *[f"is_{t}" for t in TAGS], *[f"own_{w}" for w in WORDS], *[f"above_{w}" for w in WORDS], "depth", "chars", "share", "link_share", "tags_per_char",
    "blocks", "chars_per_block", "stops", "place", "siblings", "sibling_chars", "form_controls", "paragraph_share", "above_never", "above_landmark",
]


@dataclass(slots=True)
class Block:
    tag: str
    parent: int
    depth: int
    node: Node
    text: str = ""
    link_chars: int = 0
    tags: int = 0
    controls: int = 0
    children: int = 0
    index: int = 0


def blocks_of(root: Node) -> list[Block]:
    """The blocks of a page in page order; a block without blocks in it holds its text, in others each run is a block."""
    out = [Block("#page", -1, 0, root)]
    runs: dict[int, list[tuple[str, bool]]] = {0: []}

    def flush(at: int, leaving: bool) -> None:
        run = runs[at]
        text = " ".join("".join(t for t, _ in run).split())
        if text:
            target = at
            if out[at].children or not leaving:
                target = len(out)
                out.append(Block("#run", at, out[at].depth + 1, out[at].node, index=out[at].children))
                out[at].children += 1
            out[target].text = text
            out[target].link_chars = sum(len(t) for t, link in run if link)
        run.clear()

    stack = [(iter(root.items), 0, False, True)]
    while stack:
        items, at, link, own = stack[-1]
        item = next(items, None)
        if item is None:
            stack.pop()
            if own:
                flush(at, True)
                del runs[at]
            continue
        if isinstance(item, str):
            runs[at].append((item, link))
            continue
        out[at].tags += 1
        if item.tag in SILENT and item.tag != "head":
            out[at].controls += item.tag in ("button", "select", "input", "textarea")
        elif item.tag in BLOCK:
            flush(at, False)
            runs[len(out)] = []
            out.append(Block(item.tag, at, out[at].depth + 1, item, index=out[at].children))
            out[at].children += 1
            stack.append((iter(item.items), len(out) - 1, link, True))
        elif item.tag in ("input",):
            out[at].controls += 1
        elif item.tag in ("br", "wbr", "hr"):
            runs[at].append((" ", link))
        else:
            stack.append((iter(item.items), at, link or item.tag == "a", False))
    return out


def _name_counts(node: Node) -> list[int]:
    counts = [0] * len(WORDS)
    if node.attrs:
        names = " ".join(node.attrs.get(a, "") for a in ("class", "id", "role", "itemprop"))
        if not names.isspace():
            for w in set(re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", names).lower())):
                if w in _WORD_GROUP:
                    counts[_WORD_GROUP[w]] += 1
    return counts


def features(blocks: list[Block]) -> np.ndarray:
    n, words, tags = len(blocks), len(WORDS), len(TAGS)
    x = np.zeros((n, len(NAMES)), np.float32)
    sums = np.zeros((n, 7))  # chars, link chars, tags, blocks with text, stops, controls, chars in paragraphs
    parents = [b.parent for b in blocks]
    above = np.zeros((n, words + 2))
    rows = []
    for i, b in enumerate(blocks):
        text = b.text
        chars = len(text)
        rows.append((chars, b.link_chars, b.tags, 1 if chars else 0, text.count(".") + text.count(","), b.controls, chars if b.tag in ("p", "#run", "pre", "blockquote") else 0))
        k = _TAG_GROUP.get(b.tag)
        if k is not None:
            x[i, k] = 1
        own = _name_counts(b.node) if b.tag != "#run" else None
        if own is not None:
            x[i, tags : tags + words] = own
        if i:
            above[i] = above[b.parent]
        if own is not None:
            above[i, :words] += own
            above[i, words] += b.tag in NEVER
            above[i, words + 1] += b.tag in LANDMARKS
    sums[:] = rows
    own_sums = sums.tolist()
    for i in range(n - 1, 0, -1):
        p, a = own_sums[parents[i]], own_sums[i]
        for k in range(7):
            p[k] += a[k]
    sums = np.array(own_sums)
    chars = sums[:, 0]
    parent = np.array([max(p, 0) for p in parents])
    children = np.array([b.children for b in blocks])
    siblings = children[parent]
    at = tags + words
    x[:, at : at + words] = above[:, :words] - x[:, tags : tags + words]
    at += words
    some = np.maximum(chars, 1)
    index = np.array([b.index for b in blocks])
    depth = np.array([b.depth for b in blocks])
    cols = [
        depth, np.log1p(chars), chars / some[0], sums[:, 1] / some, sums[:, 2] / some, np.log1p(sums[:, 3]), chars / np.maximum(sums[:, 3], 1),
        sums[:, 4] / some, index / np.maximum(siblings, 1), siblings, np.log1p(chars[parent] / np.maximum(siblings, 1)), sums[:, 5], sums[:, 6] / some,
        above[:, words], above[:, words + 1],
    ]
    x[:, at:] = np.stack(cols, axis=1)
    return x


def decode(logits: np.ndarray, parents: list[int]) -> np.ndarray:
    """The most likely choice in which a block is kept only if all blocks above it are. The page itself is always open."""
    keep = -np.logaddexp(0, -logits)  # log p
    drop = -np.logaddexp(0, logits)
    total_keep, total_drop = keep.tolist(), drop.tolist()
    for i in range(len(parents) - 1, 0, -1):
        p = parents[i]
        total_drop[p] += total_drop[i]
        total_keep[p] += max(total_keep[i], total_drop[i])
    kept = np.zeros(len(parents), bool)
    kept[0] = True
    for i in range(1, len(parents)):
        kept[i] = kept[parents[i]] and total_keep[i] >= total_drop[i]
    return kept


def extract_batch(pages: list[str], model: Boost) -> list[str]:
    """Main text of each page: its kept blocks in page order, joined by two line feeds."""
    trees = [blocks_of(parse(p)) for p in pages]
    if not trees:
        return []
    logits = model.logits(np.concatenate([features(t) for t in trees]))
    out, at = [], 0
    for t in trees:
        kept = decode(logits[at : at + len(t)], [b.parent for b in t])
        at += len(t)
        out.append("\n\n".join(b.text for b, k in zip(t, kept) if k and b.text))
    return out


# Training


def landmark_labels(blocks: list[Block]) -> np.ndarray | None:
    """1 for blocks of the article and those that hold it, by the landmarks of HTML; None where a page has none."""
    inside = np.zeros(len(blocks), bool)
    for i, b in enumerate(blocks):
        if i:
            up = inside[b.parent]
            names = _name_counts(b.node) if b.tag != "#run" else [0] * len(WORDS)
            out = b.tag in NEVER or sum(names[1:]) > names[0]
            inside[i] = (up or b.tag in LANDMARKS or b.node.attrs.get("itemprop") == "articleBody") and not out
    if not inside.any():
        return None
    return _with_holders(blocks, inside)


def _with_holders(blocks: list[Block], inside: np.ndarray) -> np.ndarray:
    y = inside.copy()
    for i in range(len(blocks) - 1, 0, -1):
        if y[i]:
            y[blocks[i].parent] = True
    y[0] = True
    return y.astype(float)


def _links(rng: random.Random, words: list[str]) -> str:
    return "<ul>" + "".join(f'<li><a href="/{k}">{rng.choice(words)}</a></li>' for k in range(rng.randint(3, 9))) + "</ul>"


def draw_layout(rng: random.Random, prose: list[str]) -> str:
    """A page with a random layout. Parts that belong to the article carry y="1", parts that do not y="0"."""
    words = [w for w in rng.choice(prose).split()[:40] if "<" not in w] or ["home"]
    short = lambda k=8: " ".join(rng.choice(words) for _ in range(rng.randint(1, k)))
    para = lambda: rng.choice(prose)
    w = lambda g: rng.choice(WORDS[g])
    comment = lambda: f'<div class="{w("reader")}"><b>{short(2)}</b><p>{para()}</p></div>'
    frame = [
        lambda: f"<nav>{_links(rng, words)}</nav>",
        lambda: f'<div class="{rng.choice(["nav", "menu", "navbar", "main-menu", "breadcrumb"])}">{_links(rng, words)}</div>',
        lambda: f"<header>{rng.choice([f'<a href=/>{short(2)}</a>', f'<h1>{short(3)}</h1>', _links(rng, words)])}</header>",
        lambda: f'<div id="{rng.choice(["header", "masthead", "site-header"])}"><h1>{short(3)}</h1><p>{short()}</p></div>',
        lambda: f"<footer>&copy; {short(4)} {rng.choice([short(20), para()])}</footer>",
        lambda: f'<div class="{rng.choice(["footer", "site-footer", "copyright"])}"><p>{short(20)}</p>{_links(rng, words)}</div>',
        lambda: f'<aside>{rng.choice([f"<h3>{short(3)}</h3>" + _links(rng, words), f"<p>{para()}</p>"])}</aside>',
        lambda: f'<div class="{rng.choice(["sidebar", "widget", "right-rail"])}"><h3>{short(3)}</h3>{rng.choice([_links(rng, words), f"<p>{para()}</p>"])}</div>',
        lambda: f'<div class="{w("promo")}">{rng.choice([short(20), f"<p>{para()}</p>", f"<a href=/x>{short()}</a>"])}</div>',
        lambda: f'<div id="{rng.choice(["cookie-notice", "cookie-banner", "consent", "gdpr-notice", "notice"])}"><p>{rng.choice([short(20), para()])}</p><button>OK</button></div>',
        lambda: f'<form action="/s"><label>{short(3)}</label><input name="q"><p>{short(12)}</p><button>{short(1)}</button></form>',
        lambda: f'<div class="{w("form")}"><p>{short(12)}</p><input name="e"></div>',
        lambda: f'<section id="comments"><h2>{short(2)}</h2>' + "".join(comment() for _ in range(rng.randint(1, 5))) + "</section>",
        lambda: f'<div class="{w("reader")}"><h3>{short(2)}</h3>' + "".join(comment() for _ in range(rng.randint(1, 5))) + "</div>",
        lambda: f'<ol class="{rng.choice(["commentlist", "comments", "replies"])}">' + "".join(f"<li><p>{para()}</p></li>" for _ in range(rng.randint(1, 5))) + "</ol>",
        lambda: f"<script>var x = '{short()}';</script>",
    ]
    off = lambda part: f'<div y="0">{part}</div>' if rng.random() < 0.2 else re.sub(r"^<(\w+)", r'<\1 y="0"', part)
    inner = [f"<h1>{short(9)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 9])):
        kind = rng.random()
        if kind < 0.75:
            inner.append(f"<p>{para()}</p>" if rng.random() < 0.85 else f"<p><b>{para()}<br>")
        elif kind < 0.82:
            inner.append(f"<h2>{short(6)}</h2>")
        elif kind < 0.88:
            inner.append("<ul>" + "".join(f"<li>{para() if rng.random() < 0.5 else short(12)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif kind < 0.92:
            inner.append(f"<blockquote><p>{para()}</p></blockquote>")
        elif kind < 0.96:
            inner.append(f"<div>{para()}</div>")
        else:
            inner.append("<table><tr><td>" + "</td><td>".join(short(4) for _ in range(3)) + "</td></tr></table>")
    if rng.random() < 0.35:  # something foreign inside the article
        inner.insert(rng.randint(1, len(inner)), off(rng.choice(frame)()))
    start, end = rng.choice([
        ("<article", "</article>"), ("<article", "</article>"), ("<article", "</article>"), ("<main", "</main>"), ('<div class="post-content"', "</div>"), ('<div id="content"', "</div>"),
        ('<section class="entry"', "</section>"), ('<div class="story-body"', "</div>"), ("<div", "</div>"), ('<div role="main"', "</div>"), ('<div class="c1"', "</div>"),
    ])
    core = f'{start} y="1">{"".join(inner)}{end}'
    for _ in range(rng.choice([0, 0, 1, 2])):
        core = f'<div class="{rng.choice(["wrap", "container", "row", "page", "col"])}">{core}{off(rng.choice(frame)()) if rng.random() < 0.3 else ""}</div>'
    before = [off(rng.choice(frame)()) for _ in range(rng.randint(0, 4))]
    after = [off(rng.choice(frame)()) for _ in range(rng.randint(0, 4))]
    return f"<html><head><title>{short(6)}</title></head><body>{''.join(before)}{core}{''.join(after)}</body></html>"


def drawn_labels(blocks: list[Block]) -> np.ndarray:
    inside = np.zeros(len(blocks), bool)
    for i, b in enumerate(blocks):
        if i:
            mark = b.node.attrs.get("y") if b.tag != "#run" else None
            inside[i] = inside[b.parent] if mark is None else mark == "1"
    return _with_holders(blocks, inside)


def train(pages: list[str], layouts: int = LAYOUTS, seed: int = 7) -> Boost:
    """A model from sampled pages and drawn layouts. Without any page the layouts are filled with a stand-in sentence."""
    trees = [blocks_of(parse(p)) for p in pages]
    prose = sorted({b.text for t in trees for b in t if len(b.text) >= 80 and b.link_chars == 0})
    if len(prose) < 5:
        prose = [" ".join(["stand in for a line of text,"] * k) + "." for k in (3, 6, 9, 14, 20)]
    prose = [p.replace("&", "&amp;").replace("<", "&lt;") for p in prose]
    xs, ys = [], []
    for t in trees:
        y = landmark_labels(t)
        if y is not None:
            xs.append(features(t))
            ys.append(y)
    rng = random.Random(seed)
    for _ in range(layouts):
        t = blocks_of(parse(draw_layout(rng, prose)))
        xs.append(features(t))
        ys.append(drawn_labels(t))
    return fit(np.concatenate(xs), np.concatenate(ys))


def sample_pages(pages: DataFrame, sample: int = SAMPLE) -> list[str]:
    """At most ``sample`` pages of at most SAMPLE_CHARS characters, in hash order of their ids; larger ones are passed over.

    Keys are drawn first, so that tasks send keys to the driver and not pages; a key that several rows share counts once.
    """
    key = F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary"))
    usable = pages.filter(F.col("html").isNotNull() & (F.char_length("html") <= SAMPLE_CHARS)).select(key.alias("k"), "html")
    drawn = [r.k for r in usable.select("k").orderBy("k").limit(sample).collect()]
    found = usable.filter(F.col("k").isin(drawn)).groupBy("k").agg(F.min("html").alias("html")) if drawn else usable.limit(0)
    return [r.html for r in found.orderBy("k").collect()]


def extract(pages: DataFrame, sample: int = SAMPLE, layouts: int = LAYOUTS) -> DataFrame:
    """page_id, url, text, n_chars for every page.

    Null and empty pages and pages without an article give the empty text. Equal pages give equal texts. Other columns are
    not read; an empty table gives an empty result.
    """
    model = train(sample_pages(pages, sample), layouts)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = extract_batch([h or "" for h in batch.column(2).to_pylist()], model)
        sizes = pa.array([len(t) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    kinds = [pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return map_batches(pages.select("page_id", "url", "html"), run, T.StructType(kinds))
