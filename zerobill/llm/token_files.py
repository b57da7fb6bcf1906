"""Operator 6: token files with frequency-ranked ids in a byte-aligned code.

Texts are encoded with a public tokenizer, an end id follows each document,
and ids are replaced by their rank in the corpus (most frequent first). A
rank takes one or two bytes (three or four beyond 65,536); two bits of a
separate control stream give its length, four ranks to a control byte, so a
reader looks up a control byte in a table instead of testing bits.

A token file is a folder of blocks in ascending document order, committed by
Spark's own writer, so that a lost executor leaves no half file:

====== ======= ===========================================================
column type    content
====== ======= ===========================================================
part   int     number of the sorted partition; blocks follow (part, block)
block  int     number of the block in its partition
before bigint  ids of the partition's blocks before
n      bigint  ids of the block
docs   binary  little-endian int64 ids of the block's documents
known  binary  one byte a document: 0 where the id is null
ends   binary  little-endian int64 running token counts of the block
ctrl   binary  control bytes, two bits a rank, the first in the low bits
data   binary  the ranks' bytes, little endian
====== ======= ===========================================================

Beside it, ``ranks`` holds the id of each rank.

White space never lies inside a token of a tokenizer that splits on it and
marks the ends of words, so a text is encoded word by word and equal words
of a run of texts only once.

Defined cases: null and empty texts hold the end id alone; null ids come
first; rows of one id are ordered by text; a text of any length is one
document of one block; an empty table gives an empty folder and no rows.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.llm.common import staged, table, typed
from zerobill.llm.word_ids import Encoded, joined, places, text_ids, text_runs
from zerobill.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BLOCK_TOKENS = 1 << 18
#: Words that the tokenizer's model meets in one text.
MODEL_WORDS = 2048
#: Words whose ids a worker keeps; beyond, those of the last run remain.
KEPT_WORDS = 1 << 19


def _byte_kinds() -> bytes:
    """1: an ASCII mark or control character; 2: a byte of what lower case, NFC or white space may treat in different ways; 0: the rest.

    Up to U+023F lower case is one for one in any library and NFC changes
    nothing; four control characters are white space to some only.
    """
    marks = {*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80), *range(0x09), *range(0x0E, 0x1C)}
    return bytes(1 if b in marks else 2 if 0x1C <= b <= 0x1F or b >= 0xC9 else 0 for b in range(256))


def _byte_letters() -> dict[int, str]:
    """Byte-level letters: a visible Latin-1 character stands for its own byte, the rest follow from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)}


#: The byte-level letter of a line feed, which no word holds.
BREAK = _byte_letters()[0x0A]
#: Lower-case letters that NFC and lower case leave alone in any library, and ASCII marks.
_LETTERS = "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x240) if chr(c).isalpha() and chr(c).islower() and chr(c) == chr(c).lower()) + "]+"
_LETTERED = f"^{_LETTERS}$"
#: A word with a run of marks behind it: two tokens of their own to the splitter.
_MARKED = f"^(?P<word>{_LETTERS})(?P<marks>[!-/:-@\\[-`{{-~]+)$"
#: A full stop or comma beside a character between U+0080 and U+00FF that may be no letter.
_BESIDE = re.compile("[.,][\x80-\xbf\xd7\xf7]|[\x80-\xbf\xd7\xf7][.,]")

#: The settings of a tokenizer file under which texts may be encoded word by word as below.
WORD_SETTINGS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def id_type(vocabulary: int, end_id: int) -> np.dtype:
    return np.dtype("<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4")


class WordEncoder:
    """Ids of a text as a little-endian array, through the distinct words of a run of texts.

    A word of lower-case letters is one token to the splitter and goes to the
    tokenizer's model at once, many in one text that is cut between them; any
    other word takes the whole way. This holds for files with
    ``WORD_SETTINGS``; with any other file, and in a text that holds a special
    token's string, the library encodes the whole text.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        self.by_word = all(config.get(k) == v for k, v in WORD_SETTINGS.items()) and config["model"].get("end_of_word_suffix") == "</w>"
        self.special = [t["content"] for t in config.get("added_tokens", [])]
        self.letters = _byte_letters()
        self.kinds = _byte_kinds()
        self.dtype = id_type(self.tokenizer.get_vocab_size(), end_id)
        self.top = max(self.tokenizer.get_vocab_size(), end_id + 1)
        self.end, self.end_id = np.array([end_id], self.dtype), end_id
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(BREAK)
        # outlives the task where Spark reuses its Python worker
        module = sys.modules.setdefault("zerobill_word_cache", types.ModuleType("zerobill_word_cache"))
        self.kept = module.__dict__.setdefault("words", {}).setdefault((path, str(self.dtype)), {})
        self.last = np.zeros(self.top, bool)
        self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def _model_ids(self, words: pa.Array) -> Encoded:
        found = []
        for a in range(0, len(words), MODEL_WORDS):
            some = joined(words.slice(a, MODEL_WORDS), "\n").encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.model.encode(some, add_special_tokens=False).ids, self.dtype)
            until = np.flatnonzero(self.last[ids]) + 1
            size = np.diff(until, prepend=0)
            # a letter that the vocabulary lacks hides a word's end
            whole = len(size) == min(MODEL_WORDS, len(words) - a)
            found.append(Encoded(ids, until - size, size) if whole else self._whole(some.split(BREAK), self.model))
        return Encoded.chain(found, self.dtype)

    def _modelled(self, words: pa.Array) -> Encoded:
        """Ids of distinct words of lower-case letters; those that the worker keeps are not encoded again."""
        kept, ids = self.kept.get("words", (words.slice(0, 0), Encoded.of([], self.dtype)))
        at = pc.index_in(words, value_set=kept)
        unseen = words.filter(pc.is_null(at))
        ids = Encoded.chain([ids, self._model_ids(unseen)], self.dtype)
        place = pc.fill_null(at, -1).to_numpy().copy()
        place[place < 0] = np.arange(len(kept), len(kept) + len(unseen))
        if len(kept) + len(unseen) <= KEPT_WORDS:
            self.kept["words"] = pa.concat_arrays([kept, unseen]), ids
        else:
            self.kept["words"] = words, ids.packed(place)
        return ids.at(place)

    def _whole(self, texts: list[str], tokenizer) -> Encoded:
        return Encoded.of([np.array(tokenizer.encode(t, add_special_tokens=False).ids, self.dtype).tobytes() for t in texts], self.dtype)

    def _words(self, words: pa.Array) -> Encoded:
        """Ids of distinct words."""
        lettered = pc.match_substring_regex(words, _LETTERED)
        parts = pc.extract_regex(words, _MARKED)
        marked = pc.is_valid(parts)
        parts = parts.filter(marked)
        plain = words.filter(lettered)
        units = pa.concat_arrays([plain, parts.field("word")]).dictionary_encode()
        marks = parts.field("marks").dictionary_encode()
        each = Encoded.chain([self._modelled(units.dictionary), self._whole(marks.dictionary.to_pylist(), self.tokenizer)], self.dtype)
        at = units.indices.to_numpy()
        pairs = np.stack((at[len(plain) :], marks.indices.to_numpy() + len(units.dictionary)), 1)
        both = each.packed(pairs.ravel())
        other = pc.invert(pc.or_(lettered, marked))
        found = [each.at(at[: len(plain)]), Encoded(both.ids, both.start[::2], both.size[::2] + both.size[1::2]), self._whole(words.filter(other).to_pylist(), self.tokenizer)]
        kind = marked.to_numpy(zero_copy_only=False) + 2 * other.to_numpy(zero_copy_only=False)
        return Encoded.chain(found, self.dtype).at(places(kind))

    def _by_word(self, texts: list[str | None]) -> list[np.ndarray]:
        simple, other, late = [], [], []
        for t in texts:
            text = t or ""
            raw = text.encode()
            kinds = raw.translate(self.kinds)
            # lower case makes two characters of this letter, the second no letter
            late.append(b"\2" in kinds or "\u0130" in text)
            if late[-1]:
                # Some white space is enough of a boundary; the rest stays inside a word for the library to handle.
                other.append(text.replace("\n", " "))
                continue
            text = text.lower()
            # a full stop or comma is a token of its own unless it stands in a run of marks
            symbols = b"\xc2" in raw or "\xd7" in text or "\xf7" in text
            if b"\1\1" not in kinds and not (symbols and _BESIDE.search(text)):
                text = text.replace(".", " . ").replace(",", " , ")
            # what white space there is beyond ASCII in such a text
            simple.append(text if text.isascii() else text.replace("\x85", " ").replace("\xa0", " "))
        lists = pa.concat_arrays([pc.ascii_split_whitespace(pa.array(simple, pa.string())), pc.split_pattern(pa.array(other, pa.string()), " ")])
        found = text_ids(lists, self._words, self.end)
        return [found[i] for i in places(np.array(late)).tolist()]

    def _library(self, text: str) -> np.ndarray:
        return np.array([*self.tokenizer.encode(text, add_special_tokens=False).ids, self.end_id], self.dtype)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        whole = [not self.by_word or any(s in t for s in self.special) for t in (t or "" for t in texts)]
        rest = iter(self._by_word([t for t, w in zip(texts, whole) if not w]))
        return [self._library(t or "") if w else next(rest) for t, w in zip(texts, whole)]


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 16- or 32-bit numbers."""
    width = ranks.dtype.itemsize
    extra = (ranks > 0xFF).astype(np.uint8)
    if width > 2:
        extra += (ranks > 0xFFFF).astype(np.uint8) + (ranks > 0xFFFFFF)
    quads = np.zeros((-(-len(ranks) // 4), 4), np.uint8)
    quads.ravel()[: len(ranks)] = extra
    ctrl = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    raw = ranks.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return ctrl.tobytes(), raw[np.arange(width, dtype=np.uint8) <= extra[:, None]].tobytes()


def _lengths() -> np.ndarray:
    """For each control byte the lengths of its four numbers."""
    b = np.arange(256)[:, None]
    return ((b >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def unpack(ctrl: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers again: lengths by table lookup, bytes by their places."""
    lengths = _lengths()[np.frombuffer(ctrl, np.uint8)].ravel()[:n]
    width = 2 if lengths.max(initial=1) <= 2 else 4
    raw = np.zeros((n, width), np.uint8)
    raw[np.arange(width, dtype=np.uint8) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return raw.view(f"<u{width}").ravel()


_BLOCK = "part int, block int, before bigint, n bigint, docs binary, known binary, ends binary, ctrl binary, data binary"


def _encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Each document's plain ids, and one row a task with the counts of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(tokenizer, end_id)
        total = np.zeros(encode.top, "<i8")
        columns = ["doc_id", "tie", "ids", "counts"]
        for batch in batches:
            at = 0
            for texts in text_runs(batch.column("text")):
                got = encode(texts)
                total += np.bincount(np.concatenate(got), minlength=len(total))
                n = len(got)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, n) for c in ("doc_id", "tie")] + [pa.array([i.tobytes() for i in got], pa.binary()), pa.nulls(n, pa.binary())], columns
                )
                at += n
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())], columns)

    rows = typed(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64("text").alias("tie"))
    return rows.mapInArrow(run, "doc_id bigint, tie bigint, ids binary, counts binary")


def frequency_ranks(counts: DataFrame) -> np.ndarray:
    """Ids by falling frequency over all documents, ties by id.

    ``counts`` holds an array of the vocabulary's size for each task; their
    sum is at most one row for each id of the vocabulary, a fixed bound.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column("counts"):
                n = np.frombuffer(own.as_py(), "<i8")
                ids = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n[ids], pa.int64())], ["id", "n"])

    summed = counts.mapInArrow(listed, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return summed.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)


def write_token_files(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes ``path``/blocks and ``path``/ranks. Texts are encoded where they
    are read and their plain ids staged; only those, two bytes each, are
    sorted, and become blocks of ranks in the task that sorts them."""
    plain = staged(spark, _encoded(docs, tokenizer, end_id), "token-ids")
    order = frequency_ranks(plain.where(F.col("counts").isNotNull()).select("counts"))
    spark.createDataFrame(pd.DataFrame({"rank": np.arange(len(order)), "id": order}), "rank bigint, id bigint").write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(order.max(initial=0)) + 1, id_type(len(order), 0))
    rank_of[order] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(rank_of)  # at most the vocabulary
    from tokenizers import Tokenizer

    dtype = id_type(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, before, held = TaskContext.get().partitionId(), 0, 0, 0
        names: list[int | None] = []
        each: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            ends = np.cumsum([len(r) for r in each]).astype("<i8")
            known = np.array([i is not None for i in names], np.uint8)
            ctrl, data = pack(shared.value[np.concatenate(each)])
            values = [part, block, before, held, np.array([i or 0 for i in names], "<i8").tobytes(), known.tobytes(), ends.tobytes(), ctrl, data]
            kinds = [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], [c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            for name, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                got = np.frombuffer(ids.as_py(), dtype)
                if held and held + len(got) > BLOCK_TOKENS:
                    yield row()
                    before, block = before + held, block + 1
                    names, each, held = [], [], 0
                names.append(name)
                each.append(got)
                held += len(got)
        if names:
            yield row()

    rows = plain.where(F.col("counts").isNull()).select("doc_id", "tie", "ids")
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    ordered.mapInArrow(run, _BLOCK).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a token folder.

    One number a sorted partition reaches the driver; blocks are decoded where
    they are read.
    """
    order = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()["id"].to_numpy(np.uint32)
    blocks = spark.read.parquet(f"{path}/blocks")
    per_part = blocks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").toPandas()
    base = dict(zip(per_part["part"], np.concatenate(([0], np.cumsum(per_part["n"].to_numpy(np.int64))))[:-1].tolist()))
    id_of = spark.sparkContext.broadcast((order, base))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, base = id_of.value
        for batch in batches:
            for r in batch.to_pylist():
                ends = np.frombuffer(r["ends"], "<i8")
                ids = order[unpack(r["ctrl"], r["data"], int(ends[-1]))].astype("<u4")
                starts = np.concatenate(([0], ends[:-1]))
                known = np.frombuffer(r["known"], np.uint8) == 0
                each = [ids[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
                cols = [
                    pa.array(np.frombuffer(r["docs"], "<i8"), mask=known),
                    pa.array(starts + base[r["part"]] + r["before"], pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array(each, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes ``docs`` to a new folder on shared storage and reads it back."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_token_files(spark, docs, path, tokenizer or public_tokenizers.path(TOKENIZER), end_id)
    return read_token_files(spark, path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_files(spark, table(spark, sf_dir, "documents"))
    # the digest of the decoded ids, as the file's reader sees them
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
