"""Ids of texts by way of their distinct words, for tokenizers that never look across a word's edge.

The words of a run of texts are numbered in Arrow, so that each distinct word
is encoded once a run, and the texts' ids are gathered from the words' ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words whose ids are gathered at once.
GATHER_WORDS = 1 << 18


class Encoded(NamedTuple):
    ids: np.ndarray
    start: np.ndarray  # of each word in ids
    size: np.ndarray

    @classmethod
    def of(cls, each: list[bytes], dtype: np.dtype) -> Encoded:
        size = np.fromiter(map(len, each), np.int64, len(each)) // dtype.itemsize
        return cls(np.frombuffer(b"".join(each), dtype), np.cumsum(size) - size, size)

    @classmethod
    def chain(cls, parts: list[Encoded], dtype: np.dtype) -> Encoded:
        if not parts:
            return cls.of([], dtype)
        before = np.cumsum([0, *(len(p.ids) for p in parts[:-1])])
        return cls(
            np.concatenate([p.ids for p in parts]),
            np.concatenate([p.start + n for p, n in zip(parts, before.tolist())]),
            np.concatenate([p.size for p in parts]),
        )

    def at(self, place: np.ndarray | slice) -> Encoded:
        return Encoded(self.ids, self.start[place], self.size[place])

    def gathered(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words one after the other, and where each word's end."""
        length = self.size[which]
        until = np.cumsum(length)
        out = np.empty(int(until[-1]) if len(until) else 0, self.ids.dtype)
        for a in range(0, len(which), GATHER_WORDS):
            own, n, stop = (x[a : a + GATHER_WORDS] for x in (which, length, until))
            at = int(stop[0] - n[0])
            place = np.repeat(self.start[own] - (stop - n - at), n)
            place += np.arange(len(place))
            out[at : at + len(place)] = self.ids[place]
        return out, until

    def packed(self, which: np.ndarray) -> Encoded:
        """These words alone, one after the other."""
        ids, until = self.gathered(which)
        size = self.size[which]
        return Encoded(ids, until - size, size)


def text_ids(lists: pa.ListArray, encode: Callable[[pa.Array], Encoded], end: np.ndarray, first: Encoded | None = None) -> list[np.ndarray]:
    """One array of ids for each list of words: those ``encode`` gives for its
    words, and the end id. Where ``first`` is given, it holds the ids of each
    list's first word."""
    if not len(lists):
        return []
    words = lists.flatten()
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    given = np.zeros(len(words), bool)
    if first is not None:
        given[np.concatenate(([0], ends[:-1]))] = True
        words = words.filter(pa.array(~given))
    coded = words.dictionary_encode()
    each, which = encode(coded.dictionary), coded.indices.to_numpy()
    if first is not None:
        which, rest = np.empty(len(given), np.int64), which
        which[~given] = rest
        which[given] = np.arange(len(each.size), len(each.size) + len(first.size))
        each = Encoded.chain([each, first], end.dtype)
    which = np.insert(which, ends, len(each.size))
    ids, until = Encoded.chain([each, Encoded(end, np.zeros(1, np.int64), np.ones(1, np.int64))], end.dtype).gathered(which)
    return np.split(ids, until[ends + np.arange(len(ends))][:-1])


def places(kind: np.ndarray) -> np.ndarray:
    """Where each item stands once they are in the order of their kinds."""
    return np.argsort(np.argsort(kind, kind="stable"), kind="stable")


def joined(words: pa.Array, by: str) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), by)[0].as_py()


def text_runs(column: pa.Array, rows: int = 1 << 14, chars: int = 1 << 23) -> Iterator[list[str | None]]:
    """Runs of texts of bounded length, or one longer text."""
    held: list[str | None] = []
    size = 0
    for t in column:
        text = t.as_py()
        if held and (len(held) >= rows or size + len(text or "") > chars):
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text or "")
    if held:
        yield held
