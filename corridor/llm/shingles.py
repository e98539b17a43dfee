"""Vectorised hashing of words and word shingles over UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20            # bytes hashed at a time; long texts are cut between words
_SPAN = 1 << 16            # offsets within a word repeat their multiplier after this many bytes

_rng = np.random.default_rng(20240229)
_CHAR = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.cumprod(np.full(_SPAN, _rng.integers(1, 2**62, dtype=np.uint64) * np.uint64(2) + np.uint64(1)))
_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two rounds of xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pieces(raw: bytes) -> Iterator[bytes]:
    """``raw`` (separators are spaces) in pieces of about CHUNK bytes, cut at spaces."""
    at = 0
    while len(raw) - at > CHUNK:
        cut = raw.rfind(b" ", at, at + CHUNK)
        cut = raw.find(b" ", at + CHUNK) if cut < 0 else cut
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut + 1
    yield raw[at:] if at else raw


def word_hashes(raw: bytes, kinds: np.ndarray | None = None, fold: np.ndarray | None = None,
                edges: list[np.ndarray] | None = None) -> np.ndarray:
    """64-bit hashes of the words of ``raw``, in order; separators are spaces.

    With ``kinds`` (a class per byte value) a word also ends where the class
    changes; ``fold`` maps bytes before hashing; ``edges`` gets the first and the last
    byte of every word, as rows of two.
    """
    out = []
    for piece in _pieces(raw):
        b = np.frombuffer(piece, np.uint8)
        at = np.flatnonzero(b != 32)
        if not len(at):
            continue
        b = b[at]
        new = np.empty(len(b), bool)
        new[0] = True
        np.not_equal(at[1:], at[:-1] + 1, out=new[1:])
        if kinds is not None:
            k = kinds[b]
            new[1:] |= k[1:] != k[:-1]
        starts = np.flatnonzero(new)
        lengths = np.diff(np.append(starts, len(b)))
        if edges is not None:
            edges.append(np.stack([b[starts], b[starts + lengths - 1]], axis=1))
        b = b if fold is None else fold[b]
        offset = (np.arange(len(b)) - np.repeat(starts, lengths)) & (_SPAN - 1)
        out.append(mix(np.add.reduceat(_CHAR[b] * _POWER[offset], starts) + lengths.astype(np.uint64)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; of the whole sequence if it is shorter; none of none."""
    if not len(words):
        return words
    k = min(n, len(words))
    total = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        total += words[i:len(words) - k + 1 + i] * _STEP[i]
    return mix(total)
