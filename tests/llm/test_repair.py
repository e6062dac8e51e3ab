import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from reviewlens.llm import repair

FORM = re.compile(r"(s?(ua)+)?")


def all_repairs(rows):
    """Every way to edit the rows (initial, fault), with at most two inserts in a gap: (cost, edits, kept rows)."""
    gaps = [[], ["u"], ["a"], ["u", "a"], ["a", "u"]]

    def each(k):
        for gap in gaps:
            start = (3 * len(gap), "I" * len(gap), [(r, None) for r in gap])
            if k == len(rows):
                yield start
                continue
            initial, fault = rows[k]
            more = 3 if fault == "truncated" else 0
            ways = [(4, "D", [])]
            if fault not in ("blank", "duplicate"):
                ways += [(more, "K", [(initial, k)]), (3 + more, "R", [("u", k)]), (3 + more, "R", [("a", k)])]
            for cost, edit, kept in ways:
                for rest in each(k + 1):
                    yield (start[0] + cost + rest[0], start[1] + edit + rest[1], start[2] + kept + rest[2])

    return [x for x in each(0) if FORM.fullmatch("".join(r if r in ("s", "u", "a") else "?" for r, _ in x[2]))]


def slow_row(rows):
    """The cheapest edits of a conversation of any length, one row after the other, strings compared whole."""
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best = {0: (0, "")}

    def gap(best):
        for _ in range(2):
            new = dict(best)
            for p, (c, t) in best.items():
                for r in "ua":
                    if r in step[p]:
                        q = step[p][r]
                        new[q] = min(new.get(q, (9e9, "")), (c + 3, t + "I"))
            best = new
        return best

    for initial, fault in rows:
        new = {}
        for p, (c, t) in gap(best).items():
            ways = [(p, c + 4, "D")]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if initial in step[p]:
                    ways.append((step[p][initial], c + more, "K"))
                ways += [(step[p][r], c + 3 + more, "R") for r in "ua" if r in step[p]]
            for q, cost, e in ways:
                new[q] = min(new.get(q, (9e9, "")), (cost, t + e))
        best = new
    best = gap(best)
    return min(best[p] for p in (0, 3) if p in best)


def symbols(rows):
    return "".join("x" if f in ("blank", "duplicate") else (i if i in ("s", "u", "a") else "o").upper() if f else i if i in ("s", "u", "a") else "o" for i, f in rows)


def test_small_conversations_against_all_edits():
    rng, grammar = random.Random(1), repair.Grammar()
    kinds = [(i, f) for i in ("s", "u", "a", "t", "") for f in ("", "truncated")] + [("u", "blank"), ("a", "duplicate")]
    cases = [[], *[[k] for k in kinds], *map(list, itertools.product(kinds, repeat=2))] + [[rng.choice(kinds) for _ in range(3)] for _ in range(150)] + [[rng.choice(kinds) for _ in range(4)] for _ in range(12)]
    found = grammar.evaluate([symbols(c) for c in cases])
    for rows in cases:
        cost, edits, kept = min(all_repairs(rows), key=lambda x: x[:2])
        assert repair.cheapest(found[symbols(rows)]) == (cost, edits)
        assert slow_row(rows) == (cost, edits)
        names = [(i or "", f"t{k}") for k, (i, _) in enumerate(rows)]
        full = {"u": "user", "a": "assistant"}
        want = [f"{full[r] if k is None or rows[k][0] != r or edits_of(edits, k) == 'R' else names[k][0]}:{'' if k is None else names[k][1]}" for r, k in kept]
        assert repair.apply(names, edits)[0] == want


def edits_of(edits, k):
    return [e for e in edits if e != "I"][k]


def test_long_sequences_and_ties():
    rng, grammar = random.Random(2), repair.Grammar(limit=40)
    kinds = [(i, f) for i in "suat" for f in ("", "truncated")] + [("u", "blank")]
    for n in (50, 400, 400, 3000):
        some = [rng.choice(kinds) for _ in range(9)]
        rows = [rng.choice(kinds) if rng.random() < 0.3 else some[k % 9] for k in range(n)]
        for piece in (7, 100, 4096):
            assert repair.cheapest(grammar.evaluate([symbols(rows)], piece)[symbols(rows)]) == slow_row(rows)


def test_grammar_expands_to_its_sequences():
    rng = random.Random(3)
    rules = {}

    def rule(pair):
        rules.setdefault(100 + len(rules), pair)
        return 99 + len(rules)

    def expand(v):
        return [v] if v < 100 else expand(rules[v][0]) + expand(rules[v][1])

    seqs = [[rng.randrange(3) for _ in range(rng.randrange(40))] for _ in range(60)] + [[1] * 33, [], [2]]
    packed = repair.re_pair(seqs, rule)
    assert [[x for v in p for x in expand(v)] for p in packed] == seqs
    assert sum(map(len, packed)) < 0.5 * sum(map(len, seqs))
    pairs = Counter(p for s in packed for p in set(zip(s, s[1:])) if p[0] != p[1])
    assert max(pairs.values(), default=1) == 1


def test_ropes_compare_like_strings():
    rng = random.Random(4)
    pool = [repair.Rope(c) for c in "DIKR"]
    for _ in range(300):
        pool.append(rng.choice(pool) + rng.choice(pool[-40:]))
        a, b = rng.choice(pool), rng.choice(pool)
        assert repair.comes_first(a, b) == (str(a) < str(b)) and len(str(a)) == a.length
        pool = [p for p in pool if p.length < 5000]


SPACES = " \t\n\x0b\x0c\r"


def brute(rows):
    """Every conversation's result from its rows (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        mine = convs.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        mine += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = set()
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in mine:
            last = text.rstrip(SPACES)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, _, _ in mine if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = slow_row([(r[:1], f) for (_, r, _), f in zip(mine, faults)])
        text, at, k = [], "", 0
        for e in audit:
            if e == "I":
                at = "a" if at == "u" else "u"
                text.append({"u": "user:", "a": "assistant:"}[at])
                continue
            _, role, words = mine[k]
            k += 1
            if e == "R":
                at = "a" if at == "u" else "u"
                role = {"u": "user", "a": "assistant"}[at]
            if e != "D":
                at = role[0]
                text.append(f"{role}:{words}")
        n = Counter(faults)
        out.add((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return out


def some_rows():
    rng = random.Random(6)
    rows = []
    for conv in range(60):
        n = rng.randrange(1, 12)
        rows += [(conv, t + (t > 4) * 3, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(["Yes.", "No", "What?  \n", "", " \t", None, "Ünd so.", f"Text {t}!", "end.\x0b"])) for t in range(n)]
    rows += [(100, t, ["user", "assistant"][t % 2], f"Turn {t}" + "." * (t % 5 > 0)) for t in range(500)]
    rows += [(None, t, "user", "Without id.") for t in range(9)] + [(200, None, "user", "No turn."), (200, None, "user", "No turn."), (200, None, None, None), (200, 3, "assistant", "x" * 100_000)]
    rows += [(300, 1, "user", "Same."), (300, 1, "user", "Same."), (300, 1, "assistant", "Same.")]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"segment_rows": 3, "segment_bytes": 200}])
def test_against_brute_force(spark, sizes):
    rows = some_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS gone", "'s' AS segment", "0 AS kind", "2 AS cost")
    got = [tuple(r) for r in repair.repair_damaged(df.repartition(5), **sizes).collect()]
    want = brute(rows)
    assert len(got) == len(want) and set(got) == want


def test_nothing_left_and_nothing_there(spark):
    drop = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(drop, 0, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair.repair_damaged(df).collect()] == [(drop, 0, 0, 0, 0, 0, 0, "", empty)]
    assert repair.repair_damaged(df.limit(0)).count() == 0
