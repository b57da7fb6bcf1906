"""Operator 3: exact n-gram Jaccard join and its connected components.

A document's set holds the 64-bit hashes of its distinct ``k``-word shingles
(:func:`zerobill.llm.text.shingle_sets`). Two documents link when
``den * |A and B| >= num * |A or B|``.

1. *Keys.* With d = K(n) = n * (den - num) // num, sets that link differ in at
   most d hashes, and their sizes by a factor den / num at most. Sizes fall in
   bands of doubling width. A band cuts the hash range into more than d equal
   parts; linked sets then agree on all but d parts, so among the d + 1 parts
   of each with the smallest digests one is common (the prefix rule). Sets
   near a band's lower end also enter the band below. A set with too many
   empty parts for this bound enters one key of its band instead. No link is
   lost, and texts that share a passage but little else have no common key.
2. *Hubs.* Sets meet under their keys only, and keys borne by the same sets are
   one meeting. Every set of a meeting is first held against its smallest and
   its largest: hashed bitmap signatures of two to four bits a hash bound the
   overlap from above by bit counts. The pairs that pass are closed; a meeting
   that lies in one of their components is done, however large it is.
3. *Bounds.* The sets of a meeting that is left are dealt to tiles by size band
   and hash, and a tile meets itself and those of its own and the next band,
   with signatures. Nothing but pairs that pass is closed, so texts that share
   a key and little else form no chains. The components are the clusters of the
   next step; only signatures are shuffled for all this.
4. *Intersections.* Clusters are dealt to tiles in the same way, now with their
   sets: what the bounds let through is decided by intersecting the sorted
   arrays.
5. *Components* of the links, labelled with the smallest doc_id.

In tiles pairs already connected are skipped, so a pair of tiles returns a
forest, never all pairs. Tiles of many small meetings share a task's frame.

Equal sets are one node throughout, named by a 64-bit digest; they are merged
per batch before keys are dealt, so a group of copies of any size costs a row
a batch. Keys travel packed, a row per batch and bucket.

Defined cases: null or empty texts, and texts without words, have the empty
set and are linked with nothing; a null id is ignored when a component's
smallest id is taken, and a component of null ids alone has id null; repeated
rows are repeated in the result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerobill.llm.common import fresh_task, release, staged, table, typed
from zerobill.llm.components import components
from zerobill.llm.text import hash_words, mix, shingle_sets, slices, split_words, utf8

#: Members of one side of a pair of tiles of sets, and of signatures.
TILE, SIGNATURE_TILE = 256, 1024
KEY_BYTES = 5


def _differ(n: int, num: int, den: int) -> int:
    """Most hashes by which a set of size n and one that links with it can differ."""
    return n * (den - num) // num


def _band(n: np.ndarray) -> np.ndarray:
    return np.frexp(n.astype(np.float64))[1] - 1  # floor(log2(n))


def _parts(band: int, num: int, den: int) -> int:
    most = _differ((2 << band) - 1, num, den)
    return most + 2 + most // 20


def _node(u: np.ndarray) -> int:
    """Digest of a set, a positive 63-bit number."""
    h = mix(np.array([mix(u, 61).sum(), np.uint64(len(u)), np.bitwise_xor.reduce(mix(u, 62))], np.uint64), 63)
    return int(mix(h[:1] + (h[1:2] << np.uint64(1)) + h[2:3], 64)[0] >> np.uint64(1))


def _set_keys(u: np.ndarray, num: int, den: int) -> np.ndarray:
    """64-bit keys of a sorted, non-empty set."""
    n = len(u)
    own = n.bit_length() - 1
    out = []
    for band in (own, own - 1):
        if band < 0 or (band != own and -(-n * num // den) >= 1 << own):
            continue
        m = _parts(band, num, den)
        d = min(_differ(n, num, den), _differ((2 << band) - 1, num, den))
        part = ((u >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        digest = np.add.reduceat(mix(u, 70), first) + part[first] * np.uint64(0x9E3779B97F4A7C15)
        digest = mix(digest, 100 + band)
        out.append(np.partition(digest, d)[: d + 1] if d + 1 < len(digest) else digest)
        if m - d - (m - len(first)) < 1:
            out.append(mix(np.array([band], np.uint64), 71))
    return np.concatenate(out)


_KINDS = "doc_id bigint, n bigint, node bigint, place bigint, sig binary, bucket int, nodes binary, keys binary"


def _sets_and_keys(k: int, num: int, den: int, buckets: int):
    """Rows of two kinds: one per document; one per batch and bucket with packed keys."""

    def pack(nodes: list[int], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not nodes:
            return
        owner = np.repeat(np.arange(len(nodes), dtype=np.uint32), [len(x) for x in keys])
        key = np.concatenate(keys)
        bucket = (key % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        owner, key, bucket = owner[order], key[order] // np.uint64(buckets), bucket[order]
        first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        ends = np.append(first[1:], len(bucket))
        names = np.array(nodes, np.int64)
        out: dict[str, list] = {c: [] for c in ("bucket", "nodes", "keys")}
        for a, b in zip(first.tolist(), ends.tolist()):
            used, local = np.unique(owner[a:b], return_inverse=True)
            short = key[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
            out["bucket"].append(int(bucket[a]))
            out["nodes"].append(names[used].tobytes())
            out["keys"].append(np.concatenate((short, local.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]), axis=1).tobytes())
        size = len(out["bucket"])
        none = pa.nulls(size, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.nulls(size, pa.binary()), pa.array(out["bucket"], pa.int32()), pa.array(out["nodes"], pa.binary()), pa.array(out["keys"], pa.binary())],
            ["doc_id", "n", "node", "place", "sig", "bucket", "nodes", "keys"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        nodes: list[int] = []
        keys: list[np.ndarray] = []
        seen: set[int] = set()
        held = 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in slices(offsets):
                w = split_words(data, offsets[i : j + 1], lower=True)
                n, node = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
                sig: list[bytes | None] = [None] * (j - i)
                for at, u in enumerate(shingle_sets(hash_words(w), w.docs, k)):
                    if not len(u):
                        continue
                    n[at], node[at], sig[at] = len(u), (name := _node(u)), _signature(u)
                    if name not in seen:
                        seen.add(name)
                        nodes.append(name)
                        keys.append(_set_keys(u, num, den))
                        held += len(keys[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(n), pa.array(node, mask=n == 0), batch.column("place").slice(i, j - i)]
                    + [pa.array(sig, pa.binary()), pa.nulls(j - i, pa.int32()), pa.nulls(j - i, pa.binary()), pa.nulls(j - i, pa.binary())],
                    ["doc_id", "n", "node", "place", "sig", "bucket", "nodes", "keys"],
                )
                if held > 1_000_000 or len(nodes) >= 1 << 23:
                    yield from pack(nodes, keys)
                    nodes, keys, seen, held = [], [], set(), 0
        yield from pack(nodes, keys)

    return run


def _key_meetings(frame: pd.DataFrame) -> pd.DataFrame:
    """Of each key of a bucket that several nodes bear: the pairs (a, b) of its
    smallest and of its largest node with the others, meeting 0, and where these
    are not all its pairs a row (node, node, meeting) of each node. Keys of the
    same nodes are one meeting."""
    fresh_task()
    key, node = [], []
    for names, packed in zip(frame["nodes"], frame["keys"]):
        raw = np.frombuffer(packed, np.uint8).reshape(-1, KEY_BYTES + 3)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :KEY_BYTES] = raw[:, :KEY_BYTES]
        key.append(wide.view("<u8").ravel().copy())
        wide[:, 3:] = 0
        wide[:, :3] = raw[:, KEY_BYTES:]
        node.append(np.frombuffer(names, np.int64)[wide.view("<u8").ravel().astype(np.int64)])
    key, node = np.concatenate(key), np.concatenate(node)
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))  # a node's batches repeat its keys
    key, node = key[new], node[new]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    name = mix(np.add.reduceat(mix(node.view(np.uint64), 81), starts) + sizes.astype(np.uint64), 82).view(np.int64)
    many = np.flatnonzero(sizes > 1)
    name, once = np.unique(name[many], return_index=True)
    starts, sizes = starts[many[once]], sizes[many[once]]
    if not len(name):
        return pd.DataFrame(columns=["a", "b", "meeting"], dtype=np.int64)
    member = node[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
    low, high = np.repeat(node[starts], sizes), np.repeat(node[starts + sizes - 1], sizes)
    edges = np.concatenate((np.stack((low, member), axis=1), np.stack((member, high), axis=1)))
    edges = np.unique(edges[edges[:, 0] != edges[:, 1]], axis=0)
    wide = np.repeat(sizes > 3, sizes)
    rest = np.stack((member[wide], member[wide], np.repeat(name, sizes)[wide]), axis=1)
    out = np.concatenate((np.column_stack((edges, np.zeros(len(edges), np.int64))), rest))
    return pd.DataFrame(out, columns=["a", "b", "meeting"])


def _signature(u: np.ndarray) -> bytes:
    """Bitmap of the hashes of a set, of a power of two of bits: at least 64, two to four a hash."""
    bits = 64 << max(0, (2 * len(u) - 1).bit_length() - 6)
    out = np.zeros(bits, bool)
    out[(u >> np.uint64(20)) % np.uint64(bits)] = True
    return np.packbits(out).tobytes()


def _near(n: np.ndarray, sigs: list[bytes], side: np.ndarray, num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, partners after i) of each member, ``n`` ascending: pairs between
    side 1 and side 2, and inside side 0, whose bound allows a link.

    Of a and b, at least max(a's bits outside b's) hashes are not common: an
    overlap is at most n minus that. Longer bitmaps are folded to the shorter.
    """
    width = np.array([len(s) for s in sigs], np.int64)
    for w in np.unique(width).tolist():
        low, high = np.searchsorted(width, w, "left"), np.searchsorted(width, w, "right")
        top = int(np.searchsorted(n, n[high - 1] * den // num, "right"))
        bitmap = np.stack([np.bitwise_or.reduce(np.frombuffer(s, np.uint64).reshape(-1, w // 8), axis=0) for s in sigs[low:top]])
        bits = np.bitwise_count(bitmap).sum(axis=1, dtype=np.int64)
        for i in range(low, high):
            j = int(np.searchsorted(n, n[i] * den // num, "right"))  # n[i] <= n[j] <= n[i] * den / num
            if j <= i + 1:
                continue
            at = slice(i + 1 - low, j - low)
            both = np.bitwise_count(bitmap[i - low] & bitmap[at]).sum(axis=1, dtype=np.int64)
            bound = np.minimum(n[i] - bits[i - low] + both, n[i + 1 : j] - bits[at] + both)
            allowed = den * bound >= num * (n[i] + n[i + 1 : j] - bound)
            allowed &= (side[i] == 0) | (side[i + 1 : j] != side[i])
            yield i, np.flatnonzero(allowed) + i + 1


def _may_link(n: tuple[int, int], sigs: tuple[bytes, bytes], num: int, den: int) -> bool:
    """Whether the bound of one pair allows a link."""
    width = min(map(len, sigs)) // 8
    x, y = (np.bitwise_or.reduce(np.frombuffer(s, np.uint64).reshape(-1, width), axis=0) for s in sigs)
    bound = min(n[0] - int(np.bitwise_count(x & ~y).sum()), n[1] - int(np.bitwise_count(y & ~x).sum()))
    return den * bound >= num * (n[0] + n[1] - bound)


def _hub_links(num: int, den: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            ok = [_may_link((n1, n2), (s1, s2), num, den) for n1, n2, s1, s2 in zip(f["n1"].tolist(), f["n2"].tolist(), f["sig1"], f["sig2"])]
            yield f.loc[ok, ["a", "b"]]

    return run


def bounded_links(node: np.ndarray, n: np.ndarray, sigs: list[bytes], side: np.ndarray, label: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A forest of the pairs of members of a pair of tiles that the bounds let
    through; members of one label are connected already."""
    order = np.argsort(n, kind="stable")
    n, node, side = n[order], node[order], side[order]
    label = np.unique(label, return_inverse=True)[1][order]
    links = []
    for i, near in _near(n, [sigs[x] for x in order], side, num, den):
        near = near[label[near] != label[i]]
        joined, first = np.unique(label[near], return_index=True)
        for old, x in zip(joined.tolist(), near[first].tolist()):
            label[label == old] = label[i]
            links.append((int(node[i]), int(node[x])))
    return links


def tile_links(node: np.ndarray, sets: list[np.ndarray], side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect the members of a pair of tiles: between side 1 and
    side 2, and inside side 0 where a tile meets itself.

    Every pair whose bound allows a link is intersected exactly, unless earlier
    links already connect it.
    """
    n = np.array([len(u) for u in sets], np.int64)
    order = np.argsort(n, kind="stable")
    n, node, side = n[order], node[order], side[order]
    sets = [sets[i] for i in order]
    parent = list(range(len(n)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i, near in _near(n, [_signature(u) for u in sets], side, num, den):
        for x in near.tolist():
            a, b = root(i), root(x)
            if a == b:
                continue
            both = np.concatenate((sets[i], sets[x]))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            if den * common >= num * (len(both) - common):
                parent[b] = a
                links.append((int(node[i]), int(node[x])))
    return links


def _pairs_of_tiles(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    if len(frame) >= TILE:
        fresh_task()
    frame = frame.drop_duplicates(["cluster", "t1", "t2", "node", "side"])
    for at in frame.groupby(["cluster", "t1", "t2"], sort=False).indices.values():
        yield frame.iloc[at]


def _bounded_edges(num: int, den: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for f in _pairs_of_tiles(frame):
            node, n, side, label = (f[c].to_numpy(np.int64) for c in ("node", "n", "side", "label"))
            links += bounded_links(node, n, f["sig"].tolist(), side, label, num, den)
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return run


def _tile_edges(num: int, den: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for f in _pairs_of_tiles(frame):
            sets = [np.frombuffer(b, np.uint64) for b in f["hashes"]]
            links += tile_links(f["node"].to_numpy(np.int64), sets, f["side"].to_numpy(np.int64), num, den)
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return run


def _set_bytes(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_task()
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in slices(offsets):
                w = split_words(data, offsets[i : j + 1], lower=True)
                packed = [u.tobytes() for u in shingle_sets(hash_words(w), w.docs, k)]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, j - i) for c in ("node", "cluster", "pairs")] + [pa.array(packed, pa.binary())], ["node", "cluster", "pairs", "hashes"])

    return run


_PAIRS = "array<struct<t1:string,t2:string,side:int>>"


def _dealt(members: DataFrame, num: int, den: int, tile: int) -> DataFrame:
    """Members (node, n, cluster and more) with ``pairs``: the pairs of tiles they meet in.

    A size band is one factor den / num wide, so links lie within a band or
    between neighbours. A cluster of one tile is compared whole.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(den / num)))).cast("int")
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("all"))
    per_band = members.withColumn("band", band).groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("in_band"))
    stats = per_band.join(sizes, "cluster").where(F.col("all") > tile)
    tiles_of = F.ceil(F.col("in_band") / tile).cast("int")
    plan = stats.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("band", tiles_of))).alias("tiles"))
    m = members.withColumn("band", band).join(plan, "cluster", "left")
    own = F.coalesce(F.element_at("tiles", F.col("band")), F.lit(1))
    at = F.pmod(F.xxhash64("node"), own).cast("int")

    def name(b, i):
        return F.concat_ws(".", b, i)

    def others(b):
        """Numbers of the tiles of band b, empty where there are none."""
        count = F.coalesce(F.element_at("tiles", b), F.lit(0))
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    me = name(F.col("band"), F.col("at"))
    pair = lambda t1, t2, side: F.struct(t1.alias("t1"), t2.alias("t2"), side.cast("int").alias("side"))
    within = F.transform(
        others(F.col("band")),
        lambda i: F.when(i == F.col("at"), pair(me, me, F.lit(0)))
        .when(i < F.col("at"), pair(name(F.col("band"), i), me, F.lit(2)))
        .otherwise(pair(me, name(F.col("band"), i), F.lit(1))),
    )
    up = F.transform(others(F.col("band") + 1), lambda i: pair(me, name(F.col("band") + 1, i), F.lit(1)))
    down = F.transform(others(F.col("band") - 1), lambda i: pair(name(F.col("band") - 1, i), me, F.lit(2)))
    whole = F.array(pair(F.lit(""), F.lit(""), F.lit(0)))
    return (
        m.withColumn("at", at)
        .withColumn("pairs", F.when(F.col("tiles").isNull(), whole).otherwise(F.concat(within, up, down)).cast(_PAIRS))
        .select(*members.columns, "pairs")
    )


def _met(members: DataFrame, frames: int, *payload: str):
    """A row for each member and pair of tiles, (cluster, t1, t2, side, node) and
    the payload, grouped into frames: a pair of tiles each, or a share of the
    clusters that are one tile."""
    frame = F.when(F.col("t1") == "", F.pmod(F.xxhash64("cluster"), F.lit(frames))).otherwise(F.xxhash64("cluster", "t1", "t2"))
    rows = members.withColumn("p", F.explode("pairs")).select("cluster", "p.t1", "p.t2", "p.side", "node", *payload)
    return rows.withColumn("frame", frame).groupBy("frame")


def _candidates(spark: SparkSession, rows: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(node, label): clusters closed over the pairs under a common key whose bound allows a link."""
    keyed = rows.where(F.col("bucket").isNotNull()).select("bucket", "nodes", "keys")
    met = staged(spark, keyed.groupBy("bucket").applyInPandas(_key_meetings, "a bigint, b bigint, meeting bigint"), "jaccard-met")
    hubs = met.where(F.col("meeting") == 0).select("a", "b").distinct()
    wanted = hubs.select(F.col("a").alias("node")).unionAll(hubs.select(F.col("b").alias("node"))).distinct()
    # sort-merge joins at any size: the side that is wanted grows with the corpus
    signed = rows.where(F.col("bucket").isNull()).select("place", "sig").join(nodes.join(wanted, "node").hint("merge"), "place")
    signed = staged(spark, signed.groupBy("node").agg(F.first("n").alias("n"), F.first("sig").alias("sig")), "jaccard-signed")

    sized = signed.select("node", "n")
    pairs = hubs.join(sized.toDF("a", "n1"), "a").join(sized.toDF("b", "n2"), "b").where(den * F.least("n1", "n2") >= num * F.greatest("n1", "n2"))
    pairs = pairs.join(signed.select(F.col("node").alias("a"), F.col("sig").alias("sig1")).hint("merge"), "a")
    pairs = pairs.join(signed.select(F.col("node").alias("b"), F.col("sig").alias("sig2")).hint("merge"), "b")
    closed = staged(spark, components(spark, pairs.mapInPandas(_hub_links(num, den), "a bigint, b bigint")), "jaccard-hubs")

    members = met.where(F.col("meeting") != 0).select(F.col("meeting").alias("cluster"), F.col("a").alias("node")).distinct()
    members = staged(spark, members.join(closed, "node", "left").select("cluster", "node", F.coalesce("label", "node").alias("label")), "jaccard-members")
    spans = members.groupBy("cluster").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("cluster")
    left = staged(spark, members.join(spans, "cluster", "left_semi").join(sized, "node").select("node", "n", "cluster", "label"), "jaccard-left")
    dealt = _dealt(left, num, den, SIGNATURE_TILE).join(signed.select("node", "sig").hint("merge"), "node")
    near = _met(dealt, 1 + left.count() // SIGNATURE_TILE, "n", "label", "sig").applyInPandas(_bounded_edges(num, den), "a bigint, b bigint")
    return staged(spark, components(spark, near.unionAll(closed.select("node", "label"))), "jaccard-closer").select("node", F.col("label").alias("cluster"))


def _grouped(spark: SparkSession, docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, node, place), node null for the empty set, and of each
    node the component's smallest id and the place of the row that bears it."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # names a row by its content: an id may be null or repeated
    source = typed(docs, "doc_id", "text").withColumn("place", F.xxhash64("doc_id", "text"))
    rows = staged(spark, source.select("doc_id", "place", "text").mapInArrow(_sets_and_keys(k, num, den, buckets), _KINDS), "jaccard-sets")
    sets = staged(spark, rows.where(F.col("bucket").isNull()).select("doc_id", "n", "node", "place"), "jaccard-rows")
    # One row of each node stands for it.
    nodes = staged(
        spark,
        sets.where(F.col("node").isNotNull()).groupBy("node", "n").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "place")).alias("low")),
        "jaccard-nodes",
    )
    at = nodes.select("node", "n", F.col("low.place").alias("place"))
    closer = _candidates(spark, rows, at, num, den)
    release(spark, rows)  # keys and signatures have done their work

    wanted = staged(spark, at.join(closer, "node"), "jaccard-wanted")
    texts = source.select("place", "text").join(_dealt(wanted, num, den, TILE).hint("merge"), "place").select("node", "cluster", "pairs", "text")
    members = texts.mapInArrow(_set_bytes(k), f"node bigint, cluster bigint, pairs {_PAIRS}, hashes binary")
    links = _met(members, 1 + wanted.count() // TILE, "hashes").applyInPandas(_tile_edges(num, den), "a bigint, b bigint")
    groups = components(spark, links).select("node", "label")
    release(spark)

    ids = nodes.join(groups, "node", "left").select("node", "low", F.coalesce("label", "node").alias("label"))
    lowest = ids.groupBy("label").agg(F.min("low").alias("low"))
    named = ids.select("node", "label").join(lowest, "label").select("node", F.col("low.doc_id").alias("component_id"), F.col("low.place").alias("place"))
    named = staged(spark, named, "jaccard-names")
    release(spark)
    return sets, named


def join_documents(spark: SparkSession, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document, links being
    ``den * common >= num * union`` over distinct ``k``-word shingles."""
    sets, named = _grouped(spark, docs, k, num, den)
    out = sets.join(named.drop("place"), "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The rows of ``docs`` that bear the smallest id of their component, one
    row each; rows without words all stay. Columns unchanged."""
    _, named = _grouped(spark, docs, k, num, den)
    # the row travels whole, so that no column of its own can clash
    rows = docs.select(
        F.struct("*").alias("row"),
        F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).alias("place"),
        F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("worded"),
    )
    winners = named.select("place").distinct()
    kept = rows.where("worded").join(winners, "place", "left_semi").dropDuplicates(["place"])
    return kept.select("row.*").unionAll(rows.where("not worded").select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(spark, table(spark, sf_dir, "documents"), k=3, num=90, den=100)
