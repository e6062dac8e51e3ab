"""Conversation structure repair: a dynamic program over grammar-compressed sequences of roles and faults.

Every row of a conversation is one symbol: its role's initial and whether it must go or costs extra. What a stretch of rows
can do is a min-plus matrix over the four places of the target form ``(s?(ua)+)?``: for every place before and after it, the
least cost and the edits that reach it, the ASCII-least of the cheapest. Matrices multiply, so a stretch can be cut anywhere.

The sequences of many conversations are compressed together by Re-Pair: the most frequent pair of neighbouring symbols
becomes a rule, again and again. Each rule's matrix is computed once, from those of its two parts, and shared by all
conversations. Edits are ropes: the concatenation of two parts refers to them, and two ropes are compared by their digests
down to the first part that differs.

A conversation that fits one segment is repaired where its rows arrive. A longer one is cut into segments that are repaired
in tasks of their own; only its symbols and edits, one character a row, ever meet in one task.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import written

SPACES = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Places in the target form: nothing yet, after the system row, after a user row, after an assistant row.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = PLACES = range(4)
ENDS = (START, AFTER_ASSISTANT)
TO_USER = (START, AFTER_SYSTEM, AFTER_ASSISTANT)
#: Rows and bytes of text of one segment.
SEGMENT_ROWS, SEGMENT_BYTES = 4096, 4 << 20

# -- ropes ---------------------------------------------------------------------------------

_MOD, _BASE, _LEAF = (1 << 61) - 1, 1_000_003, 32


class Rope:
    """A string as a tree of shared parts; short ones are held as they are."""

    __slots__ = ("length", "digest", "power", "text", "left", "right")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.length, self.digest, self.power = len(text), 0, pow(_BASE, len(text), _MOD)
            for c in text:
                self.digest = (self.digest * _BASE + ord(c)) % _MOD
        else:
            self.length = left.length + right.length
            self.digest = (left.digest * right.power + right.digest) % _MOD
            self.power = left.power * right.power % _MOD

    def __add__(self, other: Rope) -> Rope:
        if not self.length or not other.length:
            return self if not other.length else other
        if self.length + other.length <= _LEAF:
            return Rope(self.text + other.text, self, other)
        return Rope(None, self, other)

    def leaves(self) -> Iterator[str]:
        todo = [self]
        while todo:
            rope = todo.pop()
            if rope.text is not None:
                yield rope.text
            else:
                todo += [rope.right, rope.left]

    def __str__(self) -> str:
        return "".join(self.leaves())


EMPTY = Rope("")


def comes_first(a: Rope, b: Rope) -> bool:
    """Whether ``a`` is ASCII-less than ``b``. Parts of equal digest and length are stepped over, others are opened."""
    x, y = [a], [b]
    while x and y:
        p, q = x.pop(), y.pop()
        if p is q or (p.length == q.length and p.digest == q.digest):
            continue
        if p.text is not None and q.text is not None:
            n = min(p.length, q.length)
            if p.text[:n] != q.text[:n]:
                return p.text[:n] < q.text[:n]
            if p.length > n:
                x.append(Rope(p.text[n:]))
            if q.length > n:
                y.append(Rope(q.text[n:]))
        elif q.text is not None or (p.text is None and p.length >= q.length):
            x += [p.right, p.left]
            y.append(q)
        else:
            x.append(p)
            y += [q.right, q.left]
    return bool(y)


# -- min-plus matrices ---------------------------------------------------------------------

Matrix = list  # rows of {place after: (cost, edits)}


def _better(entry: dict, place: int, cost: int, rope: Rope) -> None:
    old = entry.get(place)
    if old is None or cost < old[0] or (cost == old[0] and comes_first(rope, old[1])):
        entry[place] = (cost, rope)


def times(a: Matrix, b: Matrix) -> Matrix:
    out = []
    for row in a:
        entry: dict = {}
        for mid, (cost, rope) in row.items():
            for end, (more, rest) in b[mid].items():
                old = entry.get(end)
                if old is None or cost + more <= old[0]:
                    _better(entry, end, cost + more, rope + rest)
        out.append(entry)
    return out


def _inserts() -> Matrix:
    """Any inserts in one gap. More than two lead nowhere that fewer do not."""
    one = [{p: (0, EMPTY)} for p in PLACES]
    for p in TO_USER:
        one[p][AFTER_USER] = (INSERT, Rope("I"))
    one[AFTER_USER][AFTER_ASSISTANT] = (INSERT, Rope("I"))
    return times(one, one)


def _row(symbol: str) -> Matrix:
    """Edits of one row. ``x`` must go; a capital letter is a truncated row; ``o`` is any other role."""
    out = [{p: (DELETE, Rope("D"))} for p in PLACES]
    if symbol == "x":
        return out
    extra, role = TRUNCATED if symbol.isupper() else 0, symbol.lower()
    for p in TO_USER:
        _better(out[p], AFTER_USER, extra + REROLE, Rope("R"))
    _better(out[AFTER_USER], AFTER_ASSISTANT, extra + REROLE, Rope("R"))
    if role == "s":
        _better(out[START], AFTER_SYSTEM, extra, Rope("K"))
    if role == "u":
        for p in TO_USER:
            _better(out[p], AFTER_USER, extra, Rope("K"))
    if role == "a":
        _better(out[AFTER_USER], AFTER_ASSISTANT, extra, Rope("K"))
    return out


GAP = _inserts()
SYMBOLS = "xsuaoSUAO"
#: Inserts stand before the row they precede; those after the last row are added at the end.
TERMINALS = [times(GAP, _row(s)) for s in SYMBOLS]
NUMBER = {s: k for k, s in enumerate(SYMBOLS)}


# -- grammar -------------------------------------------------------------------------------


def re_pair(sequences: list[list[int]], rule_of) -> list[list[int]]:
    """Replace the most frequent pair of neighbours by ``rule_of(pair)`` until no pair occurs twice.

    Neighbours are linked lists over one array and each pair knows its places, so a replacement touches its surroundings only.
    A heap of counts gives the next pair; a count that has fallen since is put back with its new value.
    """
    value, before, after = [], [], []
    for seq in sequences:
        for k, v in enumerate(seq):
            at = len(value)
            value.append(v)
            before.append(at - 1 if k else -1)
            after.append(at + 1 if k + 1 < len(seq) else -1)
    heads, at = [], 0
    for seq in sequences:
        heads.append(at if seq else -1)
        at += len(seq)
    places: dict[tuple[int, int], set[int]] = defaultdict(set)

    def add(k: int) -> None:
        """Note the pair that begins at ``k``; of three equal neighbours only the first two are one."""
        pair = (value[k], value[after[k]])
        if pair[0] == pair[1] and (before[k] in places[pair] or after[k] in places[pair]):
            return
        places[pair].add(k)

    for k in range(len(value)):
        if after[k] >= 0:
            add(k)
    heap = [(-len(p), pair) for pair, p in places.items() if len(p) > 1]
    heapq.heapify(heap)
    while heap:
        count, pair = heapq.heappop(heap)
        here = places.get(pair, ())
        if len(here) < 2:
            continue
        if len(here) != -count:
            heapq.heappush(heap, (-len(here), pair))
            continue
        rule, touched = rule_of(pair), set()
        for k in sorted(here):
            n = after[k]
            if k not in places[pair] or n < 0 or (value[k], value[n]) != pair:
                continue
            for left in (before[k], k, n):
                if left >= 0 and after[left] >= 0:
                    places[(value[left], value[after[left]])].discard(left)
            value[k], after[k] = rule, after[n]
            if after[n] >= 0:
                before[after[n]] = k
            value[n] = -1
            for left in (before[k], k):
                if left >= 0 and after[left] >= 0:
                    add(left)
                    touched.add((value[left], value[after[left]]))
        places.pop(pair, None)
        for p in touched:
            if len(places[p]) > 1:
                heapq.heappush(heap, (-len(places[p]), p))
    out = []
    for k in heads:
        seq = []
        while k >= 0:
            seq.append(value[k])
            k = after[k]
        out.append(seq)
    return out


class Grammar:
    """Rules and matrices that all conversations of a task share. It starts anew beyond ``limit`` rules or results."""

    def __init__(self, limit: int = 50_000):
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.matrices = list(TERMINALS)
        self.rules: dict[tuple[int, int], int] = {}
        self.known: dict[str, Matrix] = {}

    def rule(self, pair: tuple[int, int]) -> int:
        if pair not in self.rules:
            self.rules[pair] = len(self.matrices)
            self.matrices.append(times(self.matrices[pair[0]], self.matrices[pair[1]]))
        return self.rules[pair]

    def evaluate(self, sequences: Iterable[str], piece: int = SEGMENT_ROWS) -> dict[str, Matrix]:
        """Matrix of every different sequence, inserts at its very end not included."""
        asked = set(sequences)
        if len(self.rules) > self.limit or len(self.known) > self.limit:
            self._clear()
        new = sorted(asked - self.known.keys())
        pieces = sorted({s[k : k + piece] for s in new for k in range(0, len(s), piece)})
        compressed = dict(zip(pieces, re_pair([[NUMBER[c] for c in p] for p in pieces], self.rule)))
        found = {s: self.known[s] for s in asked if s in self.known}
        for s in new:
            out = [{p: (0, EMPTY)} for p in PLACES]
            for k in range(0, len(s), piece):
                for symbol in compressed[s[k : k + piece]]:
                    out = times(out, self.matrices[symbol])
            found[s] = out
            if len(s) <= piece:
                self.known[s] = out
        return found


def cheapest(matrix: Matrix) -> tuple[int, str]:
    """Least cost and ASCII-least edits from the start of a conversation to an allowed end."""
    row = times([matrix[START]], GAP)[0]
    entry: dict = {}
    for end in ENDS:
        if end in row:
            _better(entry, START, *row[end])
    cost, rope = entry[START]
    return cost, str(rope)


# -- applying edits ------------------------------------------------------------------------


def apply(rows: Iterable[tuple[str, str]], edits: str, place: int = START) -> tuple[list[str], int]:
    """Repaired ``role:text`` of rows (role, text), and the place reached. Edits of several stretches follow each other."""
    out, at, rows = [], place, iter(rows)
    for edit in edits:
        if edit == "D":
            next(rows)
            continue
        if edit == "K":
            role, text = next(rows)
            at = AFTER_SYSTEM if role[:1] == "s" else AFTER_USER if role[:1] == "u" else AFTER_ASSISTANT
        else:
            text = next(rows)[1] if edit == "R" else ""
            role, at = ("assistant", AFTER_ASSISTANT) if at == AFTER_USER else ("user", AFTER_USER)
        out.append(f"{role}:{text}")
    return out, at


def split_edits(edits: str, sizes: list[int]) -> list[str]:
    """The part of each segment of so many rows: inserts belong to the row after them, the last ones to the last segment."""
    out, at = [], 0
    for k, size in enumerate(sizes):
        begin, rows = at, 0
        if k == len(sizes) - 1:
            at = len(edits)
        while rows < size and at < len(edits):
            rows += edits[at] != "I"
            at += 1
        out.append(edits[begin:at])
    return out


# -- rows ----------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and gone: rows after the damage that a CRC of ``conv_id:turn`` decides (nulls: one space)."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    # A dropped row stays as a mark of its conversation.
    gone = F.col("kind") == 0
    changed = rows.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"), F.when(~gone, role).alias("role"), F.when(~gone, text).alias("text"), gone.alias("gone"), "kind")
    copies = F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1))
    return changed.select("conv_id", "turn", "role", "text", "gone", F.explode(F.array_repeat(F.lit(1), copies)).alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``: blank, duplicate, truncated or empty, the first that holds. Needs conv_id, turn, role, text and gone."""
    ends = F.rtrim(F.col("text"), F.lit(SPACES))
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    again = F.row_number().over(same) > 1
    whole = F.right(ends, F.lit(1)).isin(".", "!", "?")
    return rows.withColumn("fault", F.when(F.col("gone"), "gone").when(ends == "", "blank").when(again, "duplicate").when(~whole, "truncated").otherwise(""))


_OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_SEGMENT = (
    "segment int, n_rows long, symbols string, turns long, first_turn long, last_turn long, first_role string, last_role string, "
    "roles array<string>, texts array<string>"
)
LEGAL = ("su", "ua", "au")
_NAMES = [field.split()[0] for field in _OUT.split(", ")]


class _Segment:
    """Rows of one conversation in their order, and what adds up over segments."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.roles, self.texts, self.symbols, self.bytes = conv_id, [], [], [], 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.turns: list[int] = []  # different ones; rows come by turn
        self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if self.roles:
            self.illegal += self.roles[-1][:1] + role[:1] not in LEGAL
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)
        if fault:
            self.faults[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        self.symbols.append("x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)


def _finished(segments: list[_Segment], grammar: Grammar) -> Iterator[tuple]:
    words = ["".join(s.symbols) for s in segments]
    matrices = grammar.evaluate(words)
    for s, word in zip(segments, words):
        cost, audit = cheapest(matrices[word])
        text = "\n".join(apply(zip(s.roles, s.texts), audit)[0])
        gaps = s.turns[-1] - s.turns[0] + 1 - len(s.turns) if s.turns else 0
        yield (s.conv_id, gaps, *s.faults.values(), s.illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row for every conv_id.

    ``rows``: conv_id, turn, role, text, gone; rows that are gone only name their conversation. Rows are taken by turn (nulls
    first), then role and text; the rows without a conv_id are one conversation. A role is judged by its first character, an
    empty one is none of the allowed. Empty texts are blank, texts of any length are taken whole. Null roles and texts are
    for the caller to replace. Other columns are ignored; an empty table gives an empty result.

    Rows move once: the window that finds duplicates is satisfied with the partitions by conversation.
    """
    moved = with_faults(rows.select("conv_id", "turn", "role", "text", "gone").repartition("conv_id"))
    ordered = moved.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("gone").desc(), F.col("turn").asc_nulls_first(), "role", "text")
    schema = f"{_OUT}, {_SEGMENT}"
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.int32(), pa.int64(), pa.string()] + [pa.int64()] * 3 + [pa.string()] * 2 + [pa.list_(pa.string())] * 2

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        wide = [r + (None,) * (len(kinds) - len(r)) for r in done]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*wide), kinds)], names)

    def part_of(s: _Segment, number: int) -> tuple:
        ends = (s.turns[0], s.turns[-1]) if s.turns else (None, None)
        roles = (s.roles[0][:1], s.roles[-1][:1]) if s.roles else (None, None)
        return (s.conv_id, None, *s.faults.values(), s.illegal, None, None, None, number, len(s.roles), "".join(s.symbols), len(s.turns), *ends, *roles, s.roles, s.texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, now, number, whole, held = Grammar(), None, 0, [], 0
        for batch in batches:
            for conv_id, turn, role, text, gone, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or now.conv_id != conv_id:
                    if now is not None and number:
                        yield batch_of([part_of(now, number)])
                    elif now is not None:
                        whole.append(now)
                        held += now.bytes + 200 * len(now.roles)
                    now, number = _Segment(conv_id), 0
                    if held >= segment_bytes:
                        yield batch_of(list(_finished(whole, grammar)))
                        whole, held = [], 0
                elif len(now.roles) >= segment_rows or now.bytes >= segment_bytes:
                    yield batch_of([part_of(now, number)])
                    now, number = _Segment(conv_id), number + 1
                if not gone:
                    now.add(turn, role, text, fault)
        if now is not None and number:
            yield batch_of([part_of(now, number)])
        elif now is not None:
            whole.append(now)
        if whole:
            yield batch_of(list(_finished(whole, grammar)))

    found = written(ordered.mapInArrow(run, schema), "repair")
    short, long = found.filter("segment IS NULL").select(*_NAMES), found.filter("segment IS NOT NULL")
    return short if long.isEmpty() else short.unionByName(_long(long))


def _long(parts: DataFrame) -> DataFrame:
    """Conversations of several segments: their symbols meet first, then each segment's text with its share of the edits."""
    light = parts.drop("roles", "texts", "gaps", "cost", "audit", "repaired_sha256").repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "segment")
    schema = _OUT + ", segment int, edits string"

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, group = Grammar(), []

        def close() -> Iterator[pa.RecordBatch]:
            word = "".join(r["symbols"] for r in group)
            cost, audit = cheapest(grammar.evaluate([word])[word])
            turned = [r for r in group if r["first_turn"] is not None]
            turns = sum(r["turns"] for r in turned) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(turned, turned[1:]))
            gaps = turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - turns if turned else 0
            illegal = sum(r["illegal"] for r in group) + sum(a["last_role"] + b["first_role"] not in LEGAL for a, b in zip(group, group[1:]))
            sums = [sum(r[k] for r in group) for k in ("blank", "duplicate", "truncated")]
            shares = split_edits(audit, [r["n_rows"] for r in group])
            for k, r in enumerate(group):
                head = (r["conv_id"], gaps, *sums, illegal, cost, audit, None) if k == 0 else (r["conv_id"], *[None] * 8)
                row = [*head, r["segment"], shares[k]]
                kinds = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], [*_NAMES, "segment", "edits"])

        for batch in batches:
            for r in batch.to_pylist():
                if group and group[0]["conv_id"] != r["conv_id"]:
                    yield from close()
                    group = []
                group.append(r)
        if group:
            yield from close()

    decided = written(light.mapInArrow(decide, schema), "repair-long")
    texts = parts.select("conv_id", "segment", "roles", "texts")
    keys = F.col("t.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("t.segment") == F.col("e.segment"))
    both = texts.alias("t").join(decided.select("conv_id", "segment", "edits").alias("e"), keys).select("t.conv_id", "t.segment", "roles", "texts", "edits")
    ready = both.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "segment")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A digest goes through a conversation's segments in order and holds one of them at a time."""
        now, at, sha, begun = None, START, hashlib.sha256(), False
        out = lambda: pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([sha.hexdigest()], pa.string())], ["conv_id", "sha"])
        for batch in batches:
            for conv_id, _, roles, texts, edits in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or now[0] != conv_id:
                    if now is not None:
                        yield out()
                    now, at, sha, begun = (conv_id,), START, hashlib.sha256(), False
                rows, at = apply(zip(roles, texts), edits, at)
                for row in rows:
                    sha.update(("\n" + row if begun else row).encode())
                    begun = True
        if now is not None:
            yield out()

    hashed = ready.mapInArrow(digest, "conv_id long, sha string")
    first = decided.filter("segment = 0").alias("d")
    joined = first.join(hashed.alias("h"), F.col("d.conv_id").eqNullSafe(F.col("h.conv_id")))
    return joined.select(*[F.col("h.sha").alias(c) if c == "repaired_sha256" else F.col(f"d.{c}") for c in _NAMES])


def repair_damaged(conversations: DataFrame, **sizes: int) -> DataFrame:
    """Damage, classify and repair ``conversations`` (conv_id, turn, role, text); see ``repair``."""
    return repair(damaged(conversations), **sizes)
