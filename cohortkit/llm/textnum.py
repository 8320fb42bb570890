"""Vectorised text measurements in numpy: tokens and their hashes.

A token is a run of bytes that are not ASCII white space (space, tab, line
feed, vertical tab, form feed, carriage return).  Token hashes are 64-bit
polynomial hashes over a seeded byte table, taken for all tokens of a buffer
at once from prefix sums, then mixed.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C13)            # odd, so it has an inverse modulo 2**64
_INVERSE = U64(pow(0x9E3779B97F4A7C13, -1, 1 << 64))
_BYTE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = []
        for b in (_BASE, _INVERSE):
            p = np.full(size, b, U64)
            p[0] = 1
            _powers.append(np.cumprod(p, dtype=U64))
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all 64 output bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of value[i] * base**i, one longer than ``values``."""
    p, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * p[:len(values)], dtype=U64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of the values behind ``prefix``."""
    _, inv = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inv[starts])


def token_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens of a byte buffer."""
    solid = np.empty(len(buf) + 2, np.int8)
    solid[0] = solid[-1] = 0
    np.logical_not(WHITE[buf], out=solid[1:-1].view(bool))
    edge = np.diff(solid)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def token_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(_BYTE[buf]), starts, ends)


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a line feed after each text, and the texts' starts
    (one more than texts: the last is the buffer's length)."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), at
