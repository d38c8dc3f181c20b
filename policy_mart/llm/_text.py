"""Vectorised text work inside Python tasks: code points, word hashes, shingles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

#: Texts are taken together up to so many characters; a longer one is taken alone, whole.
CHUNK_CHARS = 1 << 18

_PRIME = np.uint64(0x100000001B3)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: Sequence[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of `texts` of about `limit` characters."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if held and held + n > limit:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(texts):
        yield first, len(texts)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


@lru_cache(1)
def _alphanumeric() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def is_letter(codes: np.ndarray) -> np.ndarray:
    return _letters()[codes]


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
    up, down = np.full(n, _PRIME), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def joined(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of lower-cased texts, each followed by a line feed, and where each text starts."""
    lowered = [(t or "").lower() for t in texts]
    starts = np.zeros(len(lowered) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in lowered], out=starts[1:])
    return code_points("\n".join(lowered) + "\n"), starts


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of lower-cased texts, in order, and the index of each word's text.

    A word is a maximal run of letters and digits.
    """
    codes, starts = joined(texts)
    inside = _alphanumeric()[codes]
    edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    size = 1 << max(16, int(len(codes)).bit_length())
    up, down = _powers(size)
    # The hash of a word is the difference of two prefix sums, moved back to position 0.
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _ODD * up[: len(codes)], out=sums[1:])
    hashes = (sums[end] - sums[first]) * down[first]
    return mix64(hashes ^ (end - first).astype(np.uint64)), np.searchsorted(starts, first, side="right") - 1


def shingles(texts: Sequence[str | None], width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of `width` words of each text: (hash, index of the text, count).

    Ordered by text. A text of fewer words has one shingle, of all its words; one without words has none.
    """
    words, owner = word_hashes(texts)
    n = np.bincount(owner, minlength=len(texts))
    total = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        factor = np.uint64((int(_ODD) * (2 * k + 3) | 1) & (2**64 - 1))
        total += mix64(words[k : k + len(total)] + np.uint64(k)) * factor
    whole = owner[: len(total)] == owner[width - 1 :] if len(total) else np.zeros(0, bool)
    hashes, owners = mix64(total[whole]), owner[: len(total)][whole]
    begin = np.cumsum(n) - n
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        own = [
            mix64(np.bitwise_xor.reduce(mix64(words[b : b + k] + np.arange(k, dtype=np.uint64) * _ODD), keepdims=True))
            for b, k in zip(begin[short], n[short], strict=True)
        ]
        hashes, owners = np.concatenate([hashes, *own]), np.concatenate([owners, short])
    # One key per text and shingle, so that a single sort finds the distinct ones.
    keys = hashes ^ mix64(owners.astype(np.uint64) * _ODD + np.uint64(1))
    _, at, count = np.unique(keys, return_index=True, return_counts=True)
    order = np.argsort(owners[at], kind="stable")
    return hashes[at][order], owners[at][order], count[order]
