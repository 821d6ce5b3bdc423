"""Vectorised text kernels: words, hashes and windows of whole batches of texts.

All functions work on the UTF-8 bytes of many texts laid end to end. White space
is the ASCII set 0x20, 0x09-0x0D, so working on bytes equals working on code points.
"""

from __future__ import annotations

import ctypes
import functools
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, and one less than it is 4 x odd


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    byte = rng.integers(1, 2**63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
    white = np.zeros(256, bool)
    white[[32, 9, 10, 11, 12, 13]] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return byte, white, lower


BYTE, WHITE, LOWER = _tables()


def process_cache() -> dict:
    """Objects that outlive one task of a Python worker (functions are pickled by value)."""
    return sys.modules.setdefault("_hexloom_process_cache", types.ModuleType("_hexloom_process_cache")).__dict__


def give_back() -> None:
    """Returns the freed parts of the process's heap to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(*keeps: str):
    """For a task's function of batches: a worker outlives its tasks, so memory must not pile up in it.

    The task first drops what other operators keep in the process (all but the kinds
    ``keeps``), and gives freed memory back when it ends.
    """

    def of(run):
        @functools.wraps(run)
        def task(batches):
            kept = process_cache()
            for key in [k for k in kept if isinstance(k, tuple) and k[0] not in keeps]:
                del kept[key]
            try:
                yield from run(batches)
            finally:
                give_back()

        return task

    return of


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    kept = process_cache()
    if kept.get("powers_n", 0) < n:
        n = max(n, BLOCK + (1 << 17))
        inv = pow(_BASE, -1, 2**64)
        with np.errstate(over="ignore"):
            up, down = np.full(n, _BASE, _U), np.full(n, inv, _U)
            up[0] = down[0] = 1
            kept.update(powers_n=n, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    return kept["up"], kept["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with good avalanche, in place on a copy."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(32))
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(32)
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(32)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes; a longer row is a run of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def _pieces(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Pieces of about ``size`` bytes that end before white space or at the end."""
    lo, n = 0, len(data)
    while lo < n:
        hi = lo + size
        while hi < n:
            at = np.flatnonzero(WHITE[data[hi : hi + 65536]])
            if len(at):
                hi += int(at[0])
                break
            hi += 65536
        hi = min(hi, n)
        yield lo, hi
        lo = hi


class Words:
    """Words of a run of texts: byte ``start`` and ``end``, text number ``doc``, 64-bit ``hash``.

    ``per_doc``: offsets of each text's words in these arrays.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        data = LOWER[data] if lower else data
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        starts, ends, hashes = [], [], []
        for lo, hi in _pieces(data, BLOCK):
            part = data[lo:hi]
            black = ~WHITE[part]
            cut = edge[lo : hi + 1].copy()
            cut[0] = cut[-1] = True
            st = black & (cut[:-1] | np.concatenate([[True], ~black[:-1]]))
            en = black & (cut[1:] | np.concatenate([~black[1:], [True]]))
            s, e = np.flatnonzero(st), np.flatnonzero(en) + 1
            up, down = powers(hi - lo + 1)
            with np.errstate(over="ignore"):
                total = np.zeros(hi - lo + 1, _U)
                np.cumsum(BYTE[part] * up[: hi - lo], out=total[1:])
                h = (total[e] - total[s]) * down[s]
                h += (e - s).astype(_U) * _U(0xA24BAED4963EE407)
            starts.append(s + lo)
            ends.append(e + lo)
            hashes.append(mix(h))
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        self.data, self.offsets = data, offsets
        self.start, self.end, self.hash = join(starts, np.int64), join(ends, np.int64), join(hashes, _U)
        self.per_doc = np.searchsorted(self.start, offsets, "left")
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.per_doc))

    def shingles(self, k: int, seed: int = 0, short_whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(text number, hash) of each run of ``k`` words of one text, in order.

        A text of 1 to k-1 words has its whole sequence as the only shingle if ``short_whole``.
        """
        n = len(self.hash)
        count = np.diff(self.per_doc)
        with np.errstate(over="ignore"):
            h = np.full(max(n - k + 1, 0), _U(seed * 2 + 1) * _U(0x9E3779B97F4A7C15), _U)
            for j in range(k):
                h = mix(h * _U(0xFF51AFD7ED558CCD) + self.hash[j : j + len(h)])
        if len(h):
            same = self.doc[: len(h)] == self.doc[k - 1 :]
            doc, h = self.doc[: len(h)][same], h[same]
        else:
            doc = np.zeros(0, np.int64)
        if short_whole and (short := np.flatnonzero((count > 0) & (count < k))).size:
            extra = np.zeros(len(short), _U)
            with np.errstate(over="ignore"):
                for i, d in enumerate(short):
                    x = np.full(1, _U(seed * 2 + 1) * _U(0x9E3779B97F4A7C15), _U)
                    for w in self.hash[self.per_doc[d] : self.per_doc[d + 1]]:
                        x = mix(x * _U(0xFF51AFD7ED558CCD) + w)
                    extra[i] = mix(x + _U(int(count[d])))[0]
            doc, h = np.concatenate([doc, short]), np.concatenate([h, extra])
            order = np.argsort(doc, kind="stable")
            doc, h = doc[order], h[order]
        return doc, h


def distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, hash) pairs in ascending order, with their counts."""
    if not len(h):
        return doc, h, np.zeros(0, np.int64)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def text_rows(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of runs of about ``size`` bytes from Arrow batches."""
    for batch in batches:
        data, offsets = flat(batch.column(column))
        for lo, hi in row_blocks(offsets, size):
            yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


class KeyIndex:
    """Places and sizes kept under 64-bit keys, in sorted runs each at least twice as long as the next."""

    def __init__(self) -> None:
        self.runs, self.kept = [], 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and size of each key; size -1: not kept."""
        start, size = np.zeros(len(keys), np.int64), np.full(len(keys), -1, np.int64)
        for k, st, sz in self.runs:
            at = np.minimum(np.searchsorted(k, keys), len(k) - 1)
            hit = k[at] == keys
            start[hit], size[hit] = st[at[hit]], sz[at[hit]]
        return start, size

    def keep(self, keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        run = [keys, starts.astype(np.int32), sizes.astype(np.int32)]
        while True:
            by = np.argsort(run[0], kind="stable")
            run = [x[by] for x in run]
            if not self.runs or len(self.runs[-1][0]) > 2 * len(run[0]):
                break
            run = [np.concatenate(x) for x in zip(self.runs.pop(), run, strict=True)]
        self.runs.append(tuple(run))
        self.kept += len(keys)
