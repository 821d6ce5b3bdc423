"""Hashes of byte windows and content-chosen anchors, for whole batches of texts."""

from __future__ import annotations

import numpy as np

from hexloom.llm.textvec import BYTE, mix

_U = np.uint64
GRAM = 32  # bytes of the anchor digit


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring hashes, order kept."""
    with np.errstate(over="ignore"):
        x = a * _U(0x9FB21C651E98DF25)
        x ^= x >> _U(32)
        x += b
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(29)
    return x


def doubled(data: np.ndarray, top: int) -> dict[int, np.ndarray]:
    """{1, 2, 4 .. top: hash of the bytes of that length from each position on}."""
    out, n = {1: BYTE[data]}, 1
    while n < top:
        h = out[n]
        out[2 * n] = _pair(h[: max(len(h) - n, 0)], h[n:])
        n *= 2
    return out


def of_length(table: dict[int, np.ndarray], at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Hashes of the windows ``[at, at + length)``, 128 bytes or longer, from a table up to 128.

    Blocks of 128 bytes laid from the start, the last one ending at the window's end.
    """
    h = table[128]
    length = np.broadcast_to(np.asarray(length, np.int64), at.shape)
    with np.errstate(over="ignore"):
        x = length.astype(_U) * _U(0xC2B2AE3D27D4EB4F)
        last = at + length - 128
        for step in range(0, int(length.max(initial=128)) - 127 + 127, 128):
            x = mix(x + h[np.minimum(at + step, last)])
    return mix(x * _U(0x9FB21C651E98DF25) + h[last])


def runs(data: np.ndarray, offsets: np.ndarray, width: int, table: dict[int, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows of ``width`` bytes that share their anchor.

    The anchor of a window is its leftmost GRAM-byte string of least hash, so that equal
    windows have equal anchors at equal places. Returns text number, first and last
    window start (in ``data``), anchor place, and the anchor's hash. ``data`` is shorter than 2**24.
    """
    none = np.zeros(0, np.int64)
    m = width - GRAM + 1
    gram = table[GRAM]
    n_win = len(data) - width + 1
    if n_win <= 0:
        return none, none, none, none, none.astype(_U)
    key = mix(gram) & ~_U(0xFFFFFF)
    key |= np.arange(len(key), dtype=_U)
    least, step = key, 1
    while 2 * step <= m:
        least = np.minimum(least[: len(least) - step], least[step:])
        step *= 2
    if m > step:
        least = np.minimum(least[: len(least) - (m - step)], least[m - step :])
    anchor = (least[:n_win] & _U(0xFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n_win]
    inside = np.arange(n_win) + width <= offsets[doc + 1]
    first = inside.copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
    lo = np.flatnonzero(first)
    final = inside.copy()
    final[:-1] &= first[1:] | ~inside[1:]
    hi = np.flatnonzero(final)
    return doc[lo], lo, hi, anchor[lo], mix(gram[anchor[lo]] + _U(0x2545F4914F6CDD1D))
