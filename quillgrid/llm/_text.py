"""Whole-batch tokenising in numpy: words, 64-bit word hashes, shingles and per-document reductions.

A word is a run of bytes other than 0x20 and 0x09-0x0D after A-Z are lower-cased. All functions work on the
concatenated UTF-8 bytes of a batch, so their cost is a few nanoseconds a byte and they never loop over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_rng = np.random.default_rng(20240607)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_BYTE = _rng.integers(1, 2**63, 256, dtype=U64) | U64(1)
_BYTE[SEPARATOR] = 0
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_SHINGLE = _rng.integers(1, 2**63, 16, dtype=U64) | U64(1)
_power = np.multiply.accumulate(np.full(1 << 16, _BASE, U64))
WINDOW = 1 << 19


def powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        _power = np.multiply.accumulate(np.full(1 << int(n).bit_length(), _BASE, U64))
    return _power


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls as empty, and the offsets of its rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


class Words:
    """The words of a batch: hash, start and end byte of each, and off, the first word of each document."""

    __slots__ = ("hash", "start", "end", "off", "data", "doc_off")

    def __init__(self, col: pa.Array):
        self.data, self.doc_off = buffers(col)
        data, offs, n, at = self.data, self.doc_off, len(self.data), 0
        parts = []
        while at < n:
            end = min(n, at + WINDOW)
            while end < n:  # a window ends where no word is cut
                k = np.searchsorted(offs, end, "right") - 1
                seps = np.flatnonzero(SEPARATOR[data[max(at, end - 4096) : end]])
                if offs[k] > at and (not len(seps) or offs[k] >= end - 4096):
                    end = int(offs[k])
                    break
                if len(seps):
                    end = int(max(at, end - 4096) + seps[-1] + 1)
                    break
                end = min(n, end + WINDOW)
            parts.append(self._window(at, end))
            at = end
        if parts:
            self.hash, self.start, self.end = (np.concatenate(x) for x in zip(*parts, strict=True))
        else:
            self.hash, self.start, self.end = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.off = np.searchsorted(self.start, offs)

    def _window(self, a: int, b: int):
        x = LOWER[self.data[a:b]]
        word = ~SEPARATOR[x]
        heads = self.doc_off[np.searchsorted(self.doc_off, a) : np.searchsorted(self.doc_off, b)] - a
        before = np.zeros(b - a, bool)
        before[1:] = word[:-1]
        before[heads] = False
        start = np.flatnonzero(word & ~before)
        if not len(start):
            return np.zeros(0, U64), start, start
        after = np.zeros(b - a, bool)
        after[:-1] = word[1:]
        after[heads[heads > 0] - 1] = False
        end = np.flatnonzero(word & ~after) + 1
        spans = np.diff(np.append(start, b - a))
        place = np.arange(start[0], b - a) - np.repeat(start, spans)
        held = _BYTE[x[start[0] :]]
        held *= powers(int(spans.max()) + 1)[place]
        h = np.add.reduceat(held, start - start[0])
        return mix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93)), start + a, end + a

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.off)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), self.counts)

    def prefixes(self, k: int) -> np.ndarray:
        """The hash of the first k bytes of each word longer than that; 0 for the others."""
        out = np.zeros(len(self.hash), U64)
        at = np.flatnonzero(self.end - self.start > k)
        total = np.full(len(at), U64(k))
        for j in range(k):
            total += _BYTE[LOWER[self.data[self.start[at] + j]]] * powers(k + 1)[j + 1]
        out[at] = mix(total)
        return out

    def shingles(self, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k-word shingles and their offsets by document; a shorter document is one shingle, an empty one has none."""
        h, n = self.hash, self.counts
        many = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
        off = np.concatenate([[0], np.cumsum(many)])
        if not off[-1]:
            return np.zeros(0, U64), off
        pad = np.concatenate([h, np.zeros(k, U64)])
        full = np.zeros(len(h), U64)
        for j in range(k):
            full += pad[j : j + len(h)] * _SHINGLE[j]
        first = np.repeat(self.off[:-1], many) + (np.arange(off[-1]) - np.repeat(off[:-1], many))
        out = full[first]
        for d in np.flatnonzero((n > 0) & (n < k)):
            w = h[self.off[d] : self.off[d + 1]]
            out[off[d]] = (w * _SHINGLE[: len(w)]).sum(dtype=U64) + U64(len(w))
        return mix(out), off


def sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The sum of each document's values; off as in Words."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[off[1:]] - total[off[:-1]]


def pieces(batch: pa.RecordBatch, column: str, size: int = 1 << 20):
    """The batch in slices of at most size bytes of text, or of one row."""
    col = batch.column(column)
    _, offs = buffers(col)
    at = 0
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
