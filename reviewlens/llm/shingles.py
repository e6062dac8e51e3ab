"""Word shingles of many texts at once, as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Bytes of text that are hashed in one go, and the longest word that is hashed with the others.
BLOCK, LONG_WORD = 1 << 20, 1024
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_BASE, _STEP, _ONE = (np.uint64(int(x) | 1) for x in _rng.integers(0, 1 << 63, 3, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(LONG_WORD + 1, _BASE, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_block(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a block that does not cut a word."""
    solid = ~_SPACE[data]
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    within = np.arange(sizes.sum()) - np.repeat(first, sizes)
    values = _BYTE[data[solid]] * _POWERS[np.minimum(within, LONG_WORD)]
    hashes = mix(np.add.reduceat(values, first) + sizes.astype(np.uint64))
    for k in np.flatnonzero(sizes > LONG_WORD):
        hashes[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes())
    return starts, hashes


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word, A-Z lower-cased, block by block so that a long text needs little more than itself."""
    data = np.frombuffer(text.lower(), np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            gaps = np.flatnonzero(_SPACE[data[end : end + BLOCK]])
            end = end + int(gaps[0]) if len(gaps) else min(end + BLOCK, len(data))
        s, h = _hash_block(data[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    return np.concatenate([*starts, np.zeros(0, np.int64)]), np.concatenate([*hashes, np.zeros(0, np.uint64)])


def shingle_sets(texts: list[bytes], size: int = 2) -> list[np.ndarray]:
    """For each text its distinct shingles of ``size`` words; a text with fewer words has its whole sequence as the only one."""
    joined = b"\n".join(texts)
    starts, words = word_hashes(joined)
    bounds = np.cumsum([0, *[len(t) + 1 for t in texts]])
    cuts = np.searchsorted(starts, bounds)
    with np.errstate(over="ignore"):
        shingle = words.copy() if size == 1 else words[: max(0, len(words) - size + 1)].copy()
        for k in range(1, size):
            shingle = mix(shingle * _STEP + words[k : k + len(shingle)])
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            n = b - a
            if n >= size:
                out.append(np.unique(shingle[a : b - size + 1]))
            elif n:
                whole = _ONE * np.uint64(n)
                for w in words[a:b]:
                    whole = mix(np.array([whole * _STEP + w], np.uint64))[0]
                out.append(np.array([whole], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
