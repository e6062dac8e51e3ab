"""Byte-level BPE encoding by backtracking, and decoding with an offset table.

A text is split at special tokens and then into pieces by the tokenizer's pattern. A piece is covered from left to right with
the longest vocabulary token that starts at each place (found by an Aho-Corasick automaton in one pass over the piece). Two
neighbouring tokens are allowed if merging their joined bytes gives these two tokens back; a table keeps the answer for each
pair. Where a pair is not allowed the next shorter token is tried, and where none is left the encoder steps back and never
visits that place again. The result is what applying all merges by rank would give, in time linear in the piece.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.llm.common import map_batches

#: Fixed by the byte-level format: how a text is cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of the caches for pieces and pairs, and the longest piece that is cached. They save time only.
PIECE_CACHE, PAIR_CACHE, CACHED_BYTES = 400_000, 1_000_000, 32


def byte_letters() -> dict[str, int]:
    """Fixed by the byte-level format: vocabulary files show printable bytes as themselves and the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """Token bytes by id, merge ranks and special tokens, read from a tokenizer file."""

    tokens: list[bytes]
    ranks: dict[tuple[int, int], tuple[int, int]]
    special: dict[str, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        ids = {as_bytes(s): i for s, i in spec["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for b, i in ids.items():
            tokens[i] = b
        for s, i in special.items():
            tokens[i] = s.encode()
        ranks = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = (as_bytes(x) for x in (merge if isinstance(merge, list) else merge.split(" ")))
            ranks[ids[a], ids[b]] = (rank, ids[a + b])
        return cls(tokens, ranks, special)


@dataclass
class Encoder:
    vocabulary: Vocabulary
    pieces: dict[str, tuple[int, ...]] = field(default_factory=dict)
    pairs: dict[tuple[int, int], bool] = field(default_factory=dict)

    @cached_property
    def pattern(self) -> regex.Pattern:
        return regex.compile(PATTERN)

    @cached_property
    def special_pattern(self) -> regex.Pattern | None:
        names = sorted(self.vocabulary.special, key=len, reverse=True)
        return regex.compile("|".join(map(regex.escape, names))) if names else None

    @cached_property
    def ids(self) -> dict[bytes, int]:
        special = set(self.vocabulary.special.values())
        return {b: i for i, b in enumerate(self.vocabulary.tokens) if b and i not in special}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds every token in a piece; bytes are given as the characters of the same number."""
        auto = ahocorasick.Automaton()
        for b, i in self.ids.items():
            auto.add_word(b.decode("latin-1"), (len(b), i))
        auto.make_automaton()
        return auto

    @cached_property
    def shorter(self) -> list[int]:
        """For each token the longest other token that it starts with, or -1."""
        out = [-1] * len(self.vocabulary.tokens)
        for b, i in self.ids.items():
            out[i] = next((self.ids[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.ids), -1)
        return out

    def merged(self, tokens: list[int]) -> list[int]:
        """Apply merges by rank until none is left. Only used on the bytes of single tokens."""
        ranks = self.vocabulary.ranks
        while len(tokens) > 1:
            found = min(((r[0], k, r[1]) for k in range(len(tokens) - 1) if (r := ranks.get((tokens[k], tokens[k + 1])))), default=None)
            if found is None:
                break
            _, k, new = found
            tokens = [*tokens[:k], new, *tokens[k + 2 :]]
        return tokens

    @cached_property
    def edges(self) -> tuple[list[list[tuple[int, int]]], list[list[tuple[int, int]]]]:
        """For each token its parts along the left edge and along the right edge, each with the rank at which it is merged on."""
        never = len(self.vocabulary.ranks)
        made = {new: (a, b, rank) for (a, b), (rank, new) in self.vocabulary.ranks.items()}
        out: tuple[list, list] = ([], [])
        for token in range(len(self.vocabulary.tokens)):
            for side, edge in enumerate(out):
                part, until, parts = token, never, []
                while True:
                    parts.append((part, until))
                    if part not in made:
                        break
                    until, part = made[part][2], made[part][side]
                edge.append(parts)
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the joined bytes of two tokens gives exactly these two.

        A merge across the border needs a part at the right edge of ``a`` and one at the left edge of ``b``, and it happens if
        its rank comes before both parts are merged on. At equal ranks the place further left goes first. This holds because a
        token's rank is above the ranks of its parts, as merges are learnt in that order.
        """
        known = self.pairs.get((a, b))
        if known is None:
            ranks, left, right = self.vocabulary.ranks, *self.edges
            known = not any(
                (r := ranks.get((x, y))) is not None and r[0] < x_until and r[0] <= y_until for x, x_until in right[a] for y, y_until in left[b]
            )
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ids.get(piece)
        if whole is not None and self.reachable(whole):
            return [whole]
        size = len(piece)
        longest = [-1] * size
        best = [0] * size
        for end, (length, token) in self.automaton.iter(piece.decode("latin-1")):
            start = end - length + 1
            if length > best[start]:
                best[start], longest[start] = length, token
        lengths, shorter = self.vocabulary.tokens, self.shorter
        out: list[int] = []
        dead = bytearray(size + 1)  # places from which the rest cannot be covered
        at, token = 0, longest[0] if size else -1
        while at < size:
            while token >= 0:
                end = at + len(lengths[token])
                if not dead[end] and self.reachable(token) and (not out or self.compatible(out[-1], token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < size else -1
            else:
                if not out:
                    raise ValueError("the vocabulary does not cover all bytes")
                dead[at] = 1
                last = out.pop()
                at -= len(lengths[last])
                token = shorter[last]
        return out

    @cached_property
    def _alone(self) -> list[int]:
        return [-1] * len(self.vocabulary.tokens)

    def reachable(self, token: int) -> bool:
        """Whether merging a token's own bytes gives the token; a vocabulary may hold some for which it does not."""
        known = self._alone[token]
        if known < 0:
            b = self.vocabulary.tokens[token]
            known = self._alone[token] = int(self.merged([self.ids[b[k : k + 1]] for k in range(len(b))]) == [token])
        return bool(known)

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a text; strings of special tokens become those tokens."""
        out: list[int] = []
        at = 0
        for m in self.special_pattern.finditer(text) if self.special_pattern else ():
            self._encode_plain(text[at : m.start()], out)
            out.append(self.vocabulary.special[m.group()])
            at = m.end()
        self._encode_plain(text[at:] if at else text, out)
        return np.array(out, np.uint32)

    def _encode_plain(self, text: str, out: list[int]) -> None:
        cache, extend = self.pieces, out.extend
        for piece in self.pattern.findall(text):
            ids = cache.get(piece)
            if ids is None:
                ids = tuple(self.encode_piece(piece.encode("utf-8")))
                if len(piece) <= CACHED_BYTES:
                    if len(cache) >= PIECE_CACHE:
                        cache.clear()
                    cache[piece] = ids
            extend(ids)


class Decoder:
    """All tokens' bytes in one buffer; a token is the slice between two offsets."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.buffer = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in vocabulary.tokens])]).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        starts, sizes = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        index = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        return self.buffer[index].tobytes()


_LOADED: dict[str, tuple[Encoder, Decoder]] = {}


def loaded(path: str) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of a tokenizer file, built once in each Python worker. The file is installed on every machine."""
    if path not in _LOADED:
        v = Vocabulary.read(path)
        _LOADED[path] = (Encoder(v), Decoder(v))
    return _LOADED[path]


def _digests(batch: pa.RecordBatch, path: str) -> tuple[list[np.ndarray], list[str], list[str]]:
    encoder, decoder = loaded(path)
    ids = [encoder.encode(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
    back = [hashlib.sha256(decoder.decode(i).decode("utf-8", "replace").encode("utf-8")).hexdigest() for i in ids]
    return ids, [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids], back


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: encoded, then decoded from the ids.

    Null and empty texts have no tokens. Repeated rows are encoded each. Other columns are not read; an empty table gives an
    empty result.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, sha, back = _digests(batch, path)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kinds = [docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")]]
    return map_batches(docs.select("doc_id", "text"), run, T.StructType(kinds))


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """The columns of ``docs`` followed by token_ids (array of int), n_tokens, ids_sha256 and decoded_sha256.

    Columns of ``docs`` with one of these names are replaced.
    """
    added = ["token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    rest = [c for c in docs.columns if c not in added]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, sha, back = _digests(batch, path)
        ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
        flat = np.concatenate([*ids, np.array([], np.uint32)]).astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        cols = [*batch.columns[:-1], tokens, pa.array(np.diff(ends).astype(np.int64)), pa.array(sha, pa.string()), pa.array(back, pa.string())]
        return pa.RecordBatch.from_arrays(cols, [*rest, *added])

    kinds = [docs.schema[c] for c in rest] + [
        T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ]
    return map_batches(docs.select(*[F.col(f"`{c}`") for c in rest], F.col("text").alias("__text")), run, T.StructType(kinds))
