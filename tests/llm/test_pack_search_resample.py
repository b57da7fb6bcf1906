"""Packing, ranked search and importance resampling against brute force, DuckDB and edge rows."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from zerobill.llm import importance, lexical_search, packing

SMALL = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path(packing.TOKENIZER)


def small(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def oracle(sql, **tables):
    con = duckdb.connect()
    for name, (schema, rows) in tables.items():
        con.execute(f"CREATE TABLE {name} ({schema})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return [tuple(r) for r in con.execute(sql).fetchall()]


def plain(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


@pytest.fixture(scope="module")
def benchmark_edges(spark):
    rows = [(1, "The QUICK brown fox"), (1, "the quick brown fox"), (2, None), (3, ""), (4, " .,"), (None, "word été"), (5, "nowhere-at-all xyzzy"), (6, "one two line xx")]
    return spark.createDataFrame([(*r, 3) for r in rows], "item_id bigint, text string, score int")


# -- packing ---------------------------------------------------------------


def naive_tightest(capacities, least):
    fit = [c for c in capacities if c >= least]
    return min(fit) if fit else None


def test_capacity_tree_finds_the_tightest():
    random.seed(1)
    for top in (1, 2, 7, 64, 100):
        tree, held = packing.CapacityTree(top), []
        for _ in range(400):
            if held and random.random() < 0.4:
                gone = held.pop(random.randrange(len(held)))
                tree.add(gone, -1)
            else:
                held.append(random.randint(0, top))
                tree.add(held[-1], 1)
            least = random.randint(0, top)
            assert tree.tightest(least) == naive_tightest(held, least)


def test_best_fit_decreasing_against_a_plain_scan():
    random.seed(2)
    for window in (8, 100):
        lengths = np.array([random.randint(1, window) for _ in range(300)])
        room, want, changed = [], [], {}
        for piece in np.argsort(-lengths, kind="stable").tolist():
            fit = [(room[w], w) for w in range(len(room)) if room[w] >= lengths[piece]]
            if fit:
                # of equally tight windows the one that reached that room last
                best = min(r for r, _ in fit)
                w = max((w for r, w in fit if r == best), key=lambda w: changed[w])
            else:
                w = len(room)
                room.append(window)
                want.append([])
            want[w].append(piece)
            room[w] -= lengths[piece]
            changed[w] = sum(map(len, want))
        assert packing.best_fit_decreasing(lengths, window) == want


def check_pieces(docs, got, window):
    tok = Tokenizer.from_file(TOKENIZER)
    want = sorted((str(d), tuple(tok.encode(t or "", add_special_tokens=False).ids + [1])) for d, t in docs)
    # each document's pieces follow each other; repeated rows are told apart by walking their starts
    by_doc = {}
    for r in got:
        by_doc.setdefault((str(r["doc_id"]), r["doc_tokens"]), []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    found = []
    for (d, n), parts in by_doc.items():
        copies = sum(1 for s, _ in parts if s == 0)
        heads = [[p for p in parts if p[0] == 0][i][1] for i in range(copies)]
        rest = sorted(p for p in parts if p[0])
        texts = [t for name, t in want if name == d and len(t) == n]
        assert len(texts) == copies
        if copies == 1:
            flat = [i for _, ids in sorted(parts) for i in ids]
            assert [s for s, _ in sorted(parts)] == list(np.cumsum([0, *[len(i) for _, i in sorted(parts)]])[:-1])
            found.append((d, tuple(flat)))
        else:
            assert sorted(map(tuple, heads)) == sorted(t[: len(heads[0])] for t in texts) and len(rest) % copies == 0
            found += [(d, t) for t in texts]
    assert sorted(found) == want
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert r["length"] * 4 == len(r["ids"]) and 0 < r["length"] <= window
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    return windows


@pytest.mark.parametrize("window,buffer_ids", [(2048, 1 << 24), (64, 500)])
def test_packing_keeps_every_id(spark, edge_docs, no_docs, window, buffer_ids):
    for docs in (edge_docs, small(spark, "documents").repartition(3, "doc_id")):
        found = packing.pieces(packing.packed_windows(spark, docs, window=window, buffer_ids=buffer_ids))
        got = [r.asDict() for r in found.collect()]
        windows = check_pieces(plain(docs, "doc_id", "text"), got, window)
        ids = sum(r["length"] for r in got)
        assert len(windows) <= ids / window * 1.02 + 6
    assert packing.pieces(packing.packed_windows(spark, no_docs)).count() == 0


def test_loose_windows_of_tasks_are_packed_together(spark):
    """200 tasks of one short text each would leave 200 windows nearly empty."""
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('word ', id) AS text").repartition(200)
    found = packing.pieces(packing.packed_windows(spark, docs))
    assert found.select("sequence_id").distinct().count() <= -(-found.selectExpr("sum(length)").first()[0] // packing.WINDOW) + 1


def test_encoder_equals_the_library():
    encode, tok = packing.TextEncoder(TOKENIZER, 1), Tokenizer.from_file(TOKENIZER)
    assert encode.ranked is not None
    random.seed(5)
    letters = " " * 6 + "\n\t\r\x0b\x1c\x1f\x85\xa0　 ab'sdtlvermZ09.,-_!²½ªéßñ漢🙂́\x00<|>"
    texts = ["", "<|endoftext|>", "a  <|endoftext|> b", "x" * 5000, "é" * 3000]
    texts += ["".join(random.choices(letters, k=random.randint(0, 14))) for _ in range(5000)]
    for t in texts:
        assert encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids + [1]


def test_encoder_batches_equal_the_library():
    encode, tok = packing.TextEncoder(TOKENIZER, 1), Tokenizer.from_file(TOKENIZER)
    random.seed(6)
    words = ["", "a", "it's", "'s", "b\n", "\nc", "d.\ne", "é", "漢", "\x1c", "\xa0f", "12", "<|endoftext|>", "\u3000", "x" * 100]
    texts = [None, "", " ", "\n", " a", "a ", "a\n", " a  b ", "a \n b", "a\n b"] + [" ".join(random.choices(words, k=random.randint(0, 9))) for _ in range(3000)]
    got = encode.batch(texts)
    assert [g.tolist() for g in got] == [tok.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert encode.batch([]) == [] and encode.ranked is not None


def test_encoder_meets_a_word_once_a_run():
    encode, seen = packing.TextEncoder(TOKENIZER, 1), []
    encode("start")
    fast = encode._fast
    encode._fast = lambda text: seen.append(len(text)) or fast(text)
    texts = ["some words that come back " * 50] * 40
    assert [len(i) for i in encode.batch(texts)] == [len(fast(t)) + 1 for t in texts]
    assert sum(seen) < 1000 < sum(map(len, texts))


def test_encoder_takes_the_library_for_another_kind_of_file():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode, tok = packing.TextEncoder(path, 1), Tokenizer.from_file(path)
    assert encode.ranked is None
    assert encode("Some Words, here").tolist() == tok.encode("Some Words, here", add_special_tokens=False).ids + [1]


def test_packing_query_columns(spark):
    got = packing.query(spark, SMALL)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    text = {r["doc_id"]: r["text"] for r in small(spark, "documents").collect()}
    tok = Tokenizer.from_file(TOKENIZER)
    for r in got.limit(50).collect():
        ids = np.array(tok.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids + [1], "<u4")
        assert r["doc_tokens"] == len(ids) and zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]


# -- ranked search -----------------------------------------------------------


def search_oracle(docs, items):
    return oracle(lexical_search.ORACLE_SQL, documents=("doc_id BIGINT, text VARCHAR", docs), benchmark=("item_id BIGINT, text VARCHAR", items))


@pytest.mark.parametrize("postings", [lexical_search.BLOCK_POSTINGS, 60])
def test_search_against_sql(spark, edge_docs, benchmark_edges, monkeypatch, postings):
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", postings)
    for docs, items in ((edge_docs, benchmark_edges), (small(spark, "documents"), small(spark, "benchmark"))):
        got = plain(lexical_search.search(spark, docs, items), "item_id", "rank", "doc_id", "score")
        want = search_oracle(plain(docs, "doc_id", "text"), plain(items, "item_id", "text"))
        assert ordered(got) == ordered(want)


def test_search_in_several_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "QUERY_ROWS", 17)
    docs, items = small(spark, "documents"), small(spark, "benchmark")
    got = plain(lexical_search.search(spark, docs, items), "item_id", "rank", "doc_id", "score")
    assert ordered(got) == ordered(search_oracle(plain(docs, "doc_id", "text"), plain(items, "item_id", "text")))


def test_search_on_empty_tables(spark, edge_docs, no_docs, benchmark_edges):
    assert lexical_search.search(spark, no_docs, benchmark_edges).count() == 0
    assert lexical_search.search(spark, edge_docs, benchmark_edges.limit(0)).count() == 0
    assert lexical_search.search(spark, no_docs, benchmark_edges).dtypes == lexical_search.search(spark, edge_docs, benchmark_edges).dtypes


def test_ties_beyond_the_kth_go_to_the_smaller_id(spark):
    docs = spark.range(500).selectExpr("999 - id AS doc_id", "concat('same words', if(id % 2 = 0, '', ' more')) AS text")
    items = spark.createDataFrame([(1, "same words")], "item_id bigint, text string")
    got = ordered(plain(lexical_search.search(spark, docs, items), "item_id", "rank", "doc_id", "score"))
    assert got == ordered(search_oracle(plain(docs, "doc_id", "text"), [(1, "same words")]))


def test_best_positions_stop_early():
    """Two lists of 20,000 documents with the winners on top of both: few are scored."""
    n, rng = 20_000, np.random.default_rng(3)
    tf = np.sort(rng.integers(1, 1000, n))[::-1]
    block = lexical_search.ImpactBlock(
        {
            "doc_ids": np.arange(n).astype("<i8").tobytes(), "known": np.ones(n, np.uint8).tobytes(),
            "sizes": np.full(n, 1000, "<i8").tobytes(), "ends": (np.arange(1, n + 1) * 2).astype("<i8").tobytes(),
            "terms": np.tile(np.array([0, 1], "<u4"), n).tobytes(), "counts": np.repeat(tf, 2).astype("<u4").tobytes(),
        },
        np.array([500, 900]), n, 1000 * n,
    )
    best = lexical_search.Best(10)
    scored = lexical_search.best_positions(block, np.array([0, 1]), best)
    assert scored < 2000
    total = np.zeros(n, np.int64)
    np.add.at(total, block.doc, block.impact)
    order = np.lexsort((np.arange(n), -total))[:10]
    assert best.doc_id.tolist() == order.tolist() and best.score.tolist() == total[order].tolist()


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_term_runs_cut_no_term(most):
    raw = "Ab, cd-EF été 12ß\x00x  tail".encode()
    assert [t for run in lexical_search.term_runs(raw, most) for t in run] == [b"ab", b"cd", b"ef", "été".encode(), "12ß".encode(), b"x", b"tail"]


# -- importance resampling -----------------------------------------------------


def resample_oracle(docs, items):
    return oracle(importance.ORACLE_SQL, documents=("doc_id BIGINT, text VARCHAR", docs), benchmark=("text VARCHAR", items))


def test_resampling_against_sql(spark, edge_docs, benchmark_edges):
    for docs, items in ((edge_docs, benchmark_edges), (small(spark, "documents"), small(spark, "benchmark")), (edge_docs, benchmark_edges.limit(0))):
        got = plain(importance.resample(spark, docs, items), "doc_id", "n_features", "weight", "score", "rank")
        want = resample_oracle(plain(docs, "doc_id", "text"), plain(items, "text"))
        assert ordered(r[:4] for r in got) == ordered(r[:4] for r in want)
        drawn = [r for r in got if r[4] is not None]
        assert sorted(r[4] for r in drawn) == list(range(1, len(drawn) + 1))
        # equal rows may swap places
        assert ordered((r[0], r[3], r[4]) for r in drawn) == ordered((r[0], r[3], r[4]) for r in want if r[4] is not None)


def test_resampling_an_empty_table(spark, no_docs, benchmark_edges):
    assert importance.resample(spark, no_docs, benchmark_edges).count() == 0


def test_pairs_across_runs_of_a_text(monkeypatch):
    words = [f"w{i}" for i in range(50)]
    raw = " ".join(words).encode()
    want = sorted(zlib.crc32(f.encode()) % 97 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    monkeypatch.setattr(importance, "term_runs", lambda raw: lexical_search.term_runs(raw, 9))
    found = list(importance.feature_runs(raw, 97))
    assert len(found) > 5 and sum(n for n, _ in found) == 50
    assert sorted(np.concatenate([b for _, b in found]).tolist()) == want


def test_cutoff_key_against_sorting(spark):
    random.seed(9)
    rows = [(random.choice([0, 0, 0, 5, -3, random.randint(-50, 50)]), random.randint(0, 40), i) for i in range(3000)]
    keys = spark.createDataFrame(rows, "a bigint, b bigint, c bigint").repartition(5, "c")
    rows.sort()
    for k in (1, 2, 750, 1500, 2999, 3000):
        assert importance.kth_key(spark, keys, k) == rows[k - 1]
    with pytest.raises(ValueError):
        importance.kth_key(spark, keys, 3001)
