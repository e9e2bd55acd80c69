"""Five-word shingle sets as sorted 64-bit hashes, computed with numpy over the bytes of a text."""

from __future__ import annotations

import numpy as np

WORDS = 5
_P, _Q, _LENGTH = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}
_U = np.uint64


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i < n at least, kept and grown as longer texts come."""
    if name not in _powers or len(_powers[name]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        table = np.full(size, base, _U)
        table[0] = 1
        _powers[name] = np.cumprod(table, dtype=_U)
    return _powers[name]


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing steps of a 64-bit hash."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word: A-Z lower-cased, words split at space and 0x09 to 0x0D."""
    b = np.frombuffer(text.lower(), np.uint8)  # bytes.lower() touches A-Z only
    if not len(b):
        return np.empty(0, _U)
    inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.diff(inside, prepend=False, append=False).nonzero()[0]
    starts, ends = edge[0::2], edge[1::2]
    values = np.where(inside, b.astype(_U) + _U(1), _U(0)) * _power_table("up", _P, len(b))[: len(b)]
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    return mix((sums[ends] - sums[starts]) * _power_table("down", _P_INVERSE, len(b))[starts])


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of all five-word shingles; of the whole sequence when there are fewer words."""
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(WORDS, len(w))
    n = len(w) - k + 1
    h = np.full(n, (k * _LENGTH) & 0xFFFFFFFFFFFFFFFF, _U)
    for i in range(k):
        h = h * _U(_Q) + w[i : i + n]
    return np.unique(mix(h))
