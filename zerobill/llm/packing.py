"""Operator 11: best-fit decreasing packing into fixed token windows.

Texts are encoded with a public byte-level tokenizer and an end id follows
each document. A document longer than a window is first cut into full windows,
which need no partner; its rest, and every shorter document, is one piece.
Pieces are placed longest first, each into the open window whose remaining
capacity is the smallest that still holds it: a segment tree over the
capacities 0..window finds that capacity in a logarithmic number of steps.

Nothing but a few loose windows crosses the network. A task encodes and packs
what it reads, ``buffer_ids`` at a time, so its memory does not depend on the
partition; windows that end up less than ``1 - slack`` full are taken apart
again, and the pieces of all tasks' loose windows are packed in a second
round, dealt over as many tasks as their ids ask for. Each round's windows are
written to the shared folder; a lost executor repeats its tasks only.

Output of ``packed_windows``: one row a window with its ids and the pieces it
holds; ``pieces`` lists them with their ids.

Defined cases: null and empty texts hold the end id alone; a null id is carried
as null; repeated rows are separate documents; a text of any length becomes
full windows and one rest; an empty table gives no windows; other columns are
never read.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.llm.common import staged, table, typed
from zerobill.llm.word_ids import Encoded, joined, places, text_ids, text_runs

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
WINDOW = 2048
#: Windows emptier than this share are taken apart and packed again with those of other tasks.
SLACK = 1 / 128
#: Ids that a task holds before it packs them.
BUFFER_IDS = 1 << 24
#: Fixed value: how the byte-level splitter cuts a text, in a form that does not step back.
SPLITTING = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_SPACES = "[" + "".join(f"\\x{{{c:x}}}" for c in range(1 << 16) if chr(c).isspace()) + "]"
#: A space beside other white space: not every space of such a text begins a token.
_MIXED_SPACES = f" {_SPACES}|{_SPACES} "
_ODD_WORD = f"^$|^{_SPACES}|{_SPACES}$| "
#: A space between other characters always begins a token.
_CUT = re.compile(r"(?<=\S) (?=\S)")

WINDOW_TYPE = (
    "window bigint, ids binary, "
    "pieces array<struct<doc_id:bigint,start:bigint,length:int,doc_tokens:bigint,offset:int>>"
)


class TextEncoder:
    """Ids of texts as little-endian arrays, as the tokenizer file gives them.

    The library reads the file. Where it describes a byte-level BPE with the
    usual splitting and whose merges are numbered in their own order, the ids
    are ranks, and the same ranks drive a several times faster encoder, which
    meets each distinct word of a run of texts once: texts are cut at spaces between other characters,
    where a token always begins. The first text of every task is held against
    the library's ids. Any other tokenizer, and any text that holds a special
    token's string, takes the library's own way over the whole text.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in config.get("added_tokens", [])]
        top = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        self.dtype = np.dtype("<u2" if top <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype)
        ranks = _ranks(config)
        self.ranked = None
        if ranks:
            import tiktoken

            self.ranked = tiktoken.Encoding("file", pat_str=SPLITTING, mergeable_ranks=ranks, special_tokens={})
            self.spaced = np.zeros(top, bool)
            self.spaced[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.checked = False

    def _library(self, text: str) -> np.ndarray:
        return np.array([*self.tokenizer.encode(text, add_special_tokens=False).ids, *self.end.tolist()], self.dtype)

    def _fast(self, text: str) -> np.ndarray:
        return self.ranked.encode_to_numpy(text, disallowed_special=()).astype(self.dtype)

    def _words(self, words: pa.Array) -> Encoded:
        """Ids of each word with a space before it. Words without a space or
        outer white space are encoded as one text, where a token that begins
        with a space begins each of them."""
        odd = pc.match_substring_regex(words, _ODD_WORD)
        plain = words.filter(pc.invert(odd))
        ids = self._fast(" " + joined(plain, " ")) if len(plain) else np.zeros(0, self.dtype)
        start = np.flatnonzero(self.spaced[ids])
        rest = Encoded.of([self._fast(" " + w).tobytes() for w in words.filter(odd).to_pylist()], self.dtype)
        together = Encoded(ids, start, np.diff(start, append=len(ids)))
        return Encoded.chain([together, rest], self.dtype).at(places(odd.to_numpy(zero_copy_only=False)))

    def _by_word(self, texts: list[str]) -> list[np.ndarray]:
        column = pa.array(texts, pa.string())
        mixed = pc.match_substring_regex(column, _MIXED_SPACES)
        cut = [_CUT.split(t) for t in column.filter(mixed).to_pylist()]
        lists = pa.concat_arrays([pc.split_pattern(column.filter(pc.invert(mixed)), " "), pa.array(cut, pa.list_(pa.string()))])
        first = Encoded.of([self._fast(w).tobytes() for w in pc.list_element(lists, 0).to_pylist()], self.dtype) if len(lists) else None
        found = text_ids(lists, self._words, self.end, first)
        return [found[i] for i in places(mixed.to_numpy(zero_copy_only=False)).tolist()]

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        texts = [t or "" for t in texts]
        whole = [self.ranked is None or any(s in t for s in self.special) for t in texts]
        if not self.checked and (t := next((t for t, w in zip(texts, whole) if t and not w), None)):
            self.checked = True
            if not np.array_equal(self._by_word([t])[0], self._library(t)):
                self.ranked, whole = None, [True] * len(texts)
        rest = iter(self._by_word([t for t, w in zip(texts, whole) if not w]))
        return [self._library(t) if w else next(rest) for t, w in zip(texts, whole)]

    def __call__(self, text: str | None) -> np.ndarray:
        return self.batch([text])[0]


def _ranks(config: dict) -> dict[bytes, int] | None:
    """Bytes of each token with its id, if the ids of merged tokens rise in the order of the merges."""
    split, model = config.get("pre_tokenizer") or {}, config["model"]
    plain = (
        config.get("normalizer") is None
        and (split.get("type"), split.get("use_regex"), split.get("add_prefix_space")) == ("ByteLevel", True, False)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if not plain:
        return None
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(b) if b in visible else chr(0x100 + hidden.index(b)): b for b in range(256)}
    vocab = model["vocab"]
    merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    singles = [vocab.get(c) for c in byte]
    if None in singles or None in merged or merged != sorted(set(merged)) or max(singles) > min(merged, default=max(singles)):
        return None
    if len(vocab) != len(merged) + len(byte):
        return None
    return {bytes(byte[c] for c in token): i for token, i in vocab.items()}


class CapacityTree:
    """Segment tree over the remaining capacities 0..top: how many open windows each has."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, change: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += change
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open window has."""
        at = least + self.leaves
        if self.count[at]:
            return least
        while at > 1:
            # a left child's sibling holds the next larger capacities
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, window: int) -> list[list[int]]:
    """Windows as lists of piece numbers; equal lengths keep their order."""
    tree = CapacityTree(window)
    waiting: list[list[int]] = [[] for _ in range(window + 1)]
    windows: list[list[int]] = []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[piece])
        room = tree.tightest(size)
        if room is None:
            number, room = len(windows), window
            windows.append([])
        else:
            number = waiting[room].pop()
            tree.add(room, -1)
        windows[number].append(piece)
        if room > size:
            waiting[room - size].append(number)
            tree.add(room - size, 1)
    return windows


class _Open:
    """Pieces that wait for a window."""

    def __init__(self) -> None:
        self.meta: list[tuple] = []
        self.ids: list[np.ndarray] = []
        self.held = 0

    def add(self, meta: tuple, ids: np.ndarray) -> None:
        self.meta.append(meta)
        self.ids.append(ids)
        self.held += len(ids)

    def packed(self, window: int) -> Iterator[tuple[bytes, list[dict]]]:
        lengths = np.array([len(i) for i in self.ids], np.int64)
        for members in best_fit_decreasing(lengths, window):
            at, pieces = 0, []
            for m in members:
                doc_id, start, doc_tokens = self.meta[m]
                pieces.append({"doc_id": doc_id, "start": start, "length": len(self.ids[m]), "doc_tokens": doc_tokens, "offset": at})
                at += len(self.ids[m])
            yield b"".join(self.ids[m].tobytes() for m in members), pieces


def _windows(rows: list[tuple[int, bytes, list[dict]]]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()), ("offset", pa.int32())]))
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], kind)], ["window", "ids", "pieces"])


def _numbered(found: Iterator[tuple[bytes, list[dict]]], first: int, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Windows numbered within their round and task: 40 bits of place, the round above them."""
    from pyspark import TaskContext

    number, held = first + (TaskContext.get().partitionId() << 36), []
    for ids, pieces in found:
        held.append((number, ids, pieces))
        number += 1
        if len(held) == rows:
            yield _windows(held)
            held = []
    if held:
        yield _windows(held)


def packed_windows(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    window: int = WINDOW,
    slack: float = SLACK,
    buffer_ids: int = BUFFER_IDS,
) -> DataFrame:
    """(window, ids, pieces) of every window; ids are two bytes each where the
    vocabulary allows it and four otherwise (``id_bytes``)."""
    import public_tokenizers

    path = tokenizer or public_tokenizers.path(TOKENIZER)
    dtype = np.dtype(f"<u{id_bytes(path, end_id)}")
    least = int(window * (1 - slack))

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[bytes, list[dict]]]:
            encode, waiting = TextEncoder(path, end_id), _Open()
            for batch in batches:
                names = batch.column("doc_id").to_pylist()
                texts = itertools.chain.from_iterable(map(encode.batch, text_runs(batch.column("text"))))
                for doc_id, ids in zip(names, texts):
                    n = len(ids)
                    for at in range(0, n - window + 1, window):
                        yield ids[at : at + window].tobytes(), [{"doc_id": doc_id, "start": at, "length": window, "doc_tokens": n, "offset": 0}]
                    if rest := n % window:
                        waiting.add((doc_id, n - rest, n), ids[n - rest :].copy())
                    if waiting.held >= buffer_ids:
                        yield from waiting.packed(window)
                        waiting = _Open()
            yield from waiting.packed(window)

        yield from _numbered(found(), 0)

    def second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[bytes, list[dict]]]:
            waiting = _Open()
            for batch in batches:
                for r in batch.to_pylist():
                    ids = np.frombuffer(r["ids"], dtype)
                    for p in r["pieces"]:
                        waiting.add((p["doc_id"], p["start"], p["doc_tokens"]), ids[p["offset"] : p["offset"] + p["length"]])
                    if waiting.held >= buffer_ids:
                        yield from waiting.packed(window)
                        waiting = _Open()
            yield from waiting.packed(window)

        yield from _numbered(found(), 1 << 62)

    first = staged(spark, typed(docs, "doc_id", "text").mapInArrow(first_round, WINDOW_TYPE), "packed", "zstd")
    full = F.octet_length("ids") >= least * dtype.itemsize
    loose = first.where(~full)
    held = loose.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    tasks = max(1, -(-held // (buffer_ids * dtype.itemsize)))
    again = loose.repartition(tasks, F.xxhash64("window")).mapInArrow(second_round, WINDOW_TYPE)
    return first.where(full).unionAll(staged(spark, again, "packed-loose", "zstd"))


def id_bytes(tokenizer: str, end_id: int = END_ID) -> int:
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4


def pieces(windows: DataFrame, width: int = 2) -> DataFrame:
    """One row a piece: (doc_id, start, length, doc_tokens, sequence_id, offset, ids),
    ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("pieces").flatten()
            each = batch.column("pieces").value_lengths().to_numpy(zero_copy_only=False)
            fields = {n: flat.field(n) for n in ("doc_id", "start", "length", "doc_tokens", "offset")}
            at, length = (fields[n].to_numpy(zero_copy_only=False) for n in ("offset", "length"))
            ids, k = [], 0
            for raw, n in zip(batch.column("ids"), each.tolist()):
                own = np.frombuffer(raw.as_buffer(), f"<u{width}").astype("<u4")
                ids += [own[at[i] : at[i] + length[i]].tobytes() for i in range(k, k + n)]
                k += n
            wide = [fields[n].cast(pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens")]
            number = pa.array(np.repeat(batch.column("window").to_numpy(), each), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*wide, number, fields["offset"].cast(pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    kind = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    return windows.select("window", "ids", "pieces").mapInArrow(run, kind)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces(packed_windows(spark, table(spark, sf_dir, "documents")))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
