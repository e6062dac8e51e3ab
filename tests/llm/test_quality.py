import math
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlens.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_stats(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k : k + 3])].append(k)
    hit = {k + d for at in windows.values() if len(at) > 1 for k in at for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x1c #é|", max_size=60))
def test_statistics(text):
    assert q.text_stats(text.encode()) == slow_stats(text)


def slow_limits(rows, fence, min_docs):
    """The rule over plain lists of bucketed values."""

    def bucket(v):
        return 0 if v <= q.LEAST else math.ceil(math.log(v / q.LEAST) / math.log(q.GROWTH))

    def end(b):
        return 0.0 if b <= 0 else q.LEAST * q.GROWTH**b

    def quantile(values, at):
        return end(sorted(map(bucket, values))[math.ceil(len(values) * at) - 1])

    def rate(rs, m):
        size, parts = q.UNITS[m]
        unit = parts / max(quantile([r[size] for r in rs], 0.5), 1.0)
        values = sorted(bucket(r[m]) for r in rs)
        for k in range(len(values) - 1):
            low, high = max(end(values[k]), unit), end(values[k + 1] - 1)
            if values[k] < values[k + 1] and 2 * (k + 1) >= len(values) and high >= q.GAP * low:
                return math.sqrt(low * high)
        return end(values[-1])

    def length(rs):
        v = [r["word_length"] for r in rs]
        return quantile(v, 0.5), max(fence * (quantile(v, 0.5) - quantile(v, 0.25)), q.MARGIN)

    own, lang = defaultdict(list), defaultdict(list)
    for r in rows:
        own[r["lang"], r["source"]].append(r)
        lang[r["lang"]].append(r)
    out = {}
    for key, rs in own.items():
        wide = lang[key[0]]
        use = rs if len(rs) >= min_docs else wide if len(wide) >= min_docs else rows
        for m in q.UNITS:
            out[key, m] = max(rate(rs, m), rate(wide, m)) if min_docs <= len(rs) < q.ENOUGH else rate(use, m)
        mid, reach = length(use)
        out[key, "word_length"] = mid + (max(reach, length(wide)[1]) if len(rs) >= min_docs else reach)
    return out


def test_verdicts_against_brute_force(docs):
    rows = []
    for n in range(220):
        words = [f"w{(n * 31 + k * 17) % 97}x{k % (5 + n % 40)}" for k in range(45 + n % 30)]
        if n % 11 == 0:
            words = [w + "###" for w in words]
        if n % 13 == 0:
            words = words[:10] * 8
        text = " ".join(words) if n % 17 else "\n".join(["same line here"] * 20 + words)
        rows.append((n, text, ["en", "de", None][n % 7 % 3], "hot" if n % 3 else f"s{n % 5}"))
    rows += [(500, None, "en", "hot"), (501, "", None, None), (502, "x" * 400_000, "xx", "one"), rows[0], (None, rows[1][1], "en", "hot")]
    df = docs(rows, kept="?", n_words=-1)
    got = q.judge(df.repartition(5)).collect()
    assert len(got) == len(rows)
    stats = []
    for i, t, lang, source in rows:
        w, c, s, d, r = slow_stats(t)
        lines = sum(1 for x in (t or "").split("\n") if WORD.search(x))
        stats.append({"id": i, "lang": lang, "source": source, "st": (w, c, s, d, r), "n_words": w, "n_lines": lines, "symbol_rate": s / w if w else 0.0, "dup_line_rate": d / lines if lines else 0.0,
                      "repeat_rate": r / w if w else 0.0, "word_length": c / w if w else 0.0})
    limit = slow_limits(stats, q.FENCE, q.MIN_DOCS)
    groups = {(r.lang, r.source): r for r in q.limits(q.document_stats(df, ["doc_id", "lang", "source"])).collect()}
    assert groups.keys() == {k for k, _ in limit}
    for (key, m), value in limit.items():
        assert math.isclose(groups[key][f"max_{m}"], value, rel_tol=1e-9, abs_tol=1e-12), (key, m)
    want = []
    for s in stats:
        w, _, _, _, r = s["st"]
        base = w < 50 or 100 * r > 50 * w
        kept = not base and all(s[m] <= limit[(s["lang"], s["source"]), m] for m in q.MEASURES)
        want.append((str(s["id"]), s["st"], base, kept))
    assert sorted((str(r.doc_id), tuple(r[c] for c in q.STATS), r.base_failed, r.kept) for r in got) == sorted(want)
    assert any(k for *_, k in want) and any(not k and not b for *_, b, k in want)
    kept = q.keep_good(df)
    assert kept.columns == df.columns and kept.count() == sum(k for *_, k in want)


def test_sketches_merge(docs):
    rows = [(n, "a " * (60 + n % 50), "en", "s") for n in range(90)]
    stats = q.document_stats(docs(rows), ["doc_id", "lang", "source"])
    parts = [q.sketches(stats.filter(f"doc_id % 3 = {k}"), ["lang", "source"]) for k in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "source", "measure", "bucket").sum("n")
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, q.sketches(stats, ["lang", "source"]).collect()))


def test_empty(docs):
    assert q.judge(docs([])).collect() == [] and q.keep_good(docs([])).collect() == []
