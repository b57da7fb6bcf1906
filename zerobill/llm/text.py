"""Vectorised words, word hashes and shingle sets over Arrow string columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which on
UTF-8 is the same as ``[^\\x20\\x09-\\x0D]+`` on characters. Words, shingles
and sets are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
_TABLES: dict[str, np.ndarray] = {}


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit finaliser; a bijection for each salt."""
    z = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _tables() -> dict[str, np.ndarray]:
    if not _TABLES:
        sep = np.zeros(256, bool)
        sep[[0x20, *range(0x09, 0x0E)]] = True
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        _TABLES.update(
            sep=sep,
            lower=lower,
            byte=mix(np.arange(256, dtype=np.uint64), 11) | np.uint64(1),
            power=mix(np.arange(1 << 16, dtype=np.uint64), 12) | np.uint64(1),
        )
    return _TABLES


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Document ranges of at most ``limit`` bytes, or one longer document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words(NamedTuple):
    buf: np.ndarray  # the bytes, lower-cased where asked for
    starts: np.ndarray  # of each word in buf
    ends: np.ndarray
    docs: np.ndarray  # word offsets of the documents, one more than documents
    bounds: np.ndarray  # byte offsets of the documents in buf


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    t = _tables()
    lo, hi = int(offsets[0]), int(offsets[-1])
    buf, bounds = data[lo:hi], offsets - lo
    if lower:
        buf = t["lower"][buf]
    word = ~t["sep"][buf]
    cuts = bounds[:-1][bounds[:-1] < len(buf)]
    start = word.copy()
    start[1:] &= ~word[:-1]
    start[cuts] = word[cuts]
    end = word.copy()
    end[:-1] &= ~word[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    end[last] = word[last]
    starts = np.flatnonzero(start)
    return Words(buf, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, bounds), bounds)


def hash_words(w: Words) -> np.ndarray:
    if not len(w.starts):
        return np.zeros(0, np.uint64)
    t = _tables()
    lens = w.ends - w.starts
    first = np.cumsum(lens) - lens
    total = int(lens.sum())
    at = np.arange(total) - np.repeat(first, lens)
    body = w.buf[~t["sep"][w.buf]]
    value = t["byte"][body] * t["power"][at & 0xFFFF]
    return mix(np.add.reduceat(value, first) + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 13)


def _trimmed(w: Words) -> Words:
    """Words without ASCII marks at their ends; what is marks alone stays."""
    mark = np.zeros(256, bool)
    mark[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
    starts, ends = w.starts.copy(), w.ends.copy()
    for edge, step, at in ((ends, -1, -1), (starts, 1, 0)):
        go = np.flatnonzero(mark[w.buf[edge + at]] & (ends - starts > 1))
        while len(go):
            edge[go] += step
            go = go[mark[w.buf[edge[go] + at]] & (ends[go] - starts[go] > 1)]
    return Words(w.buf, starts, ends, w.docs, w.bounds)


def bare_hashes(w: Words) -> np.ndarray:
    """Hashes of the words without ASCII marks at their ends."""
    t = _trimmed(w)
    keep = np.zeros(len(t.buf) + 1, np.int8)
    keep[t.starts] += 1
    keep[t.ends] -= 1
    return hash_words(t._replace(buf=np.where(np.cumsum(keep[:-1], dtype=np.int8) > 0, t.buf, np.uint8(0x20))))


def shingle_sets(h: np.ndarray, docs: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document: ``k`` words each, the
    whole sequence as one where there are fewer, empty without words."""
    s = np.zeros(0, np.uint64)
    if len(h) >= k:
        s = h[: len(h) - k + 1].copy()
        for i in range(1, k):
            s = mix(s, 20 + i) + h[i : len(h) - k + 1 + i]
        s = mix(s, 29)
    for a, b in zip(docs[:-1].tolist(), docs[1:].tolist()):
        if b - a >= k:
            u = np.sort(s[a : b - k + 1])
            yield u[np.concatenate(([True], u[1:] != u[:-1]))]
        elif b > a:
            x = np.uint64(b - a)
            for v in h[a:b]:
                x = mix(np.array([x], np.uint64), 30)[0] ^ v
            yield mix(np.array([x], np.uint64), 31)
        else:
            yield s[:0]
