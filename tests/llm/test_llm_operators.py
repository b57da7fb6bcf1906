"""Every operator on edge rows and empty tables, and against brute force on sf0.001 / sf0.01."""

import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest

from zerobill.llm import (
    components, decontaminate, html_extract, jaccard, maxent, mixing, quality_cnn, quality_rules, queries, sharding, token_files, toxicity,
)

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def documents(spark, where=SMALL):
    return spark.read.parquet(f"{where}/documents.parquet")


def rows(df):
    return [r.asDict() for r in df.collect()]


def brute_components(docs, k, num, den):
    sets = []
    for _, t in docs:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and min(len(a), len(b)) * den >= num * max(len(a), len(b)) and den * len(a & b) >= num * len(a | b):
            parent[root(j)] = root(i)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, len(sets[i]), low.get(root(i))) for i, (d, _) in enumerate(docs)), key=str)


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
def test_jaccard_against_all_pairs(spark, edge_docs, no_docs, k, num):
    for docs in (edge_docs, documents(spark)):
        got = sorted(map(tuple, jaccard.join_documents(spark, docs, k, num, 100).collect()), key=str)
        assert got == brute_components([tuple(r) for r in docs.select("doc_id", "text").collect()], k, num, 100)
    assert jaccard.join_documents(spark, no_docs, k, num, 100).count() == 0


def test_jaccard_large_cluster_is_tiled(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for d in range(120):
        w = list(base)
        for i in rng.integers(0, 60, rng.integers(0, 4)):
            w[i] = f"e{d}x{i}"
        docs.append((d, " ".join(w[: 60 - int(rng.integers(0, 5))])))
    monkeypatch.setattr(jaccard, "TILE", 16)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = sorted(map(tuple, jaccard.join_documents(spark, df, 3, 80, 100).collect()), key=str)
    assert got == brute_components(docs, 3, 80, 100)


def test_jaccard_meetings_are_not_chained(spark, monkeypatch):
    """Texts that drift apart share keys all along; only pairs whose bound allows it are closed."""
    rng = np.random.default_rng(2)
    docs, w = [], [f"w{i}" for i in range(80)]
    for d in range(240):
        for i in rng.integers(0, 80, int(rng.integers(1, 5))):
            w[i] = f"e{d}x{i}"
        docs.append((d, " ".join(w)))
    monkeypatch.setattr(jaccard, "TILE", 8)
    monkeypatch.setattr(jaccard, "SIGNATURE_TILE", 8)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    for num in (80, 90):
        got = sorted(map(tuple, jaccard.join_documents(spark, df, 3, num, 100).collect()), key=str)
        assert got == brute_components(docs, 3, num, 100)
        assert len({c for _, _, c in got}) > 1


def test_jaccard_bound_of_a_pair_is_the_tiles():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 300))).astype(np.uint64))
        b = np.unique(np.concatenate((a[: int(rng.integers(0, len(a) + 1))], rng.integers(0, 1 << 63, int(rng.integers(0, 40))).astype(np.uint64))))
        if not len(b):
            continue
        x, y = sorted((a, b), key=len)
        n, sigs = np.array([len(x), len(y)]), [jaccard._signature(x), jaccard._signature(y)]
        tiles = any(len(near) for _, near in jaccard._near(n, sigs, np.zeros(2, np.int64), 80, 100))
        one = jaccard._may_link((len(x), len(y)), (sigs[0], sigs[1]), 80, 100)
        assert one == tiles
        common = len(np.intersect1d(x, y))
        assert one or 100 * common < 80 * (len(x) + len(y) - common)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 100)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in components.components(spark, edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}


def test_decontamination_finds_whole_items_only(spark, no_docs):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    item, text = items[0]
    filler = "some other words that stand here alone " * 40
    docs = [(1, filler + text + " " + filler), (2, filler), (3, None), (None, text.upper()), (4, " ".join(text.split()[:6])), (5, ""), (1, filler + text + " " + filler)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = decontaminate.contaminated(spark, df, bench)
    assert sorted(((r["doc_id"], r["item_id"]) for r in got.collect()), key=str) == sorted([(1, item), (1, item), (None, item)], key=str)
    assert sorted(r["doc_id"] for r in decontaminate.contaminated(spark, df, bench, keep=True).collect()) == [2, 3, 4, 5]
    assert decontaminate.contaminated(spark, no_docs, bench).count() == 0
    assert decontaminate.contaminated(spark, df, bench.limit(0)).count() == 0


def test_decontamination_with_null_items_and_many_slices(spark, monkeypatch):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()][:12]
    bench = spark.createDataFrame([(None if i == 0 else d, t) for i, (d, t) in enumerate(items)], "item_id bigint, text string")
    df = spark.createDataFrame([(i, f"before {t} behind") for i, (_, t) in enumerate(items)] + [(99, "nothing of it")], "doc_id bigint, text string")
    want = sorted(((i, None if i == 0 else d) for i, (d, _) in enumerate(items)), key=str)
    for size in (4096, 1):
        monkeypatch.setattr(decontaminate, "SLICE_ITEMS", size)
        got = decontaminate.contaminated(spark, df, bench).select("doc_id", "item_id").collect()
        assert set(want) <= set(map(tuple, got))
        assert [r["doc_id"] for r in decontaminate.contaminated(spark, df, bench, keep=True).collect()] == [99]


def test_decontamination_against_brute_force(spark):
    bench = [tuple(r) for r in spark.read.parquet(f"{MID}/benchmark.parquet").select("item_id", "text").collect()]
    want = set()
    for d, t in [tuple(r) for r in documents(spark, MID).select("doc_id", "text").collect()]:
        words = re.findall(r"\w+", t.lower())
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        for item, text in bench:
            own = re.findall(r"\w+", text.lower())
            mine = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
            if mine and len(mine & grams) > 0.5 * len(mine):
                want.add((d, item))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.query(spark, MID).collect()}
    assert got == want


def test_block_max_wand_equals_scoring_all(spark):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    index = next(decontaminate._indexes(bench))
    for block in range(index.blocks):
        terms = sorted({t for t, b in index.lists if b == block})
        score = Counter()
        for t in terms:
            for i, w in index.lists[t, block]:
                score[i] += w
        assert {i for i, _ in index.wand(terms, block)} == {i for i, s in score.items() if s >= index.need[i] - 1e-9}


def test_token_files_round_trip(spark, edge_docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    for docs in (edge_docs, documents(spark)):
        want, start = [], 0
        for d, text in sorted(map(tuple, docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0)):
            ids = t.encode(text or "", add_special_tokens=False).ids + [1]
            want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        got = sorted(token_files.token_files(spark, docs).selectExpr("doc_id", "start", "n_tokens", "crc32(ids) c").collect(), key=lambda r: r["start"])
        for r in got:
            assert r["start"] == start
            start += r["n_tokens"]
        assert sorted(((r["doc_id"], r["n_tokens"], r["c"]) for r in got), key=str) == sorted(want, key=str)
    assert token_files.token_files(spark, no_docs).count() == 0


def test_word_encoder_equals_the_library():
    import public_tokenizers

    e = token_files.WordEncoder(public_tokenizers.path(token_files.TOKENIZER), 1)
    for text in ["don't. it's", "l'été, où?", "ΑΣ. İ é", "a\x85b\xa0c\x1cd", "<|endoftext|>, x", "A,B.c!? 12.5", "", "ªb ²c µ"]:
        assert e([text])[0].tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_word_encoder_runs_equal_the_library():
    import public_tokenizers

    e, r = token_files.WordEncoder(public_tokenizers.path(token_files.TOKENIZER), 1), random.Random(6)
    words = ["", "a", "It's", "b,", "c.", "°,", "«d».", "é,", "É", "İ,", "§.", "×,", "\x00,", "\x7f.", "\x85", "\xa0e", "\x1c", "ɀ", "漢,", "\n", "12.5", "f!?", "<|endoftext|>", "x" * 99]
    texts = [None, "", " ", "\n", ","] + [" ".join(r.choices(words, k=r.randint(1, 6))) for _ in range(3000)]
    for _ in range(2):  # new words, then kept ones
        assert [i.tolist() for i in e(texts)] == [e.tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert e([]) == []


def test_model_meets_a_word_once(monkeypatch):
    import public_tokenizers

    e, met = token_files.WordEncoder(public_tokenizers.path(token_files.TOKENIZER), 1), []

    class Model:
        def encode(self, text, real=e.model, **kw):
            met.extend(text.split(token_files.BREAK))
            return real.encode(text, **kw)

    monkeypatch.setattr(e, "model", Model())
    monkeypatch.setattr(e, "kept", {})
    monkeypatch.setattr(token_files, "MODEL_WORDS", 2)
    monkeypatch.setattr(token_files, "KEPT_WORDS", 5)
    for texts in (["alpha beta, gamma", "beta; alpha delta!"] * 9, ["delta epsilon"], ["zeta eta theta delta"], ["alpha zeta"]):
        assert [i.tolist() for i in e(texts)] == [e.tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    # eight words are more than are kept: those of the third run remain
    assert sorted(met) == sorted("alpha beta gamma delta epsilon zeta eta theta alpha".split())


@pytest.mark.parametrize("ranks", [[], [0], [255, 256, 65535], [65536, 1, 1 << 24, (1 << 32) - 1, 7]])
def test_pack_round_trip(ranks):
    x = np.array(ranks, np.uint32)
    assert token_files.unpack(*token_files.pack(x), len(x)).tolist() == ranks


def base_counts(t):
    w = WORD.findall(t or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    marked = {i + o for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for o in range(3)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(marked)


def test_quality_rules_counts_and_verdict(spark, edge_docs, edge_labels, no_docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for docs in (edge_docs, documents(spark)):
        trees = quality_rules.train(docs, edge_labels)
        got = sorted((tuple(r[n] for n in ("doc_id", *names)) for r in rows(quality_rules.score_documents(docs, trees))), key=str)
        assert got == sorted(((d, *base_counts(t)) for d, t in docs.select("doc_id", "text").collect()), key=str)
    assert quality_rules.score_documents(no_docs, trees).count() == 0
    x = np.random.default_rng(0).random((400, 2))
    m = quality_rules.fit_trees(x, (x[:, 0] + 0.3 * np.random.default_rng(1).random(400) < 0.6).astype(float), monotone=(-1, 0))
    line = np.stack([np.linspace(0, 1, 200), np.full(200, 0.5)], axis=1)
    assert (np.diff(m.score(line)) <= 1e-12).all()


def held_out_rates(spark, df, label, column):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    got = [(labels[r["doc_id"]], r[column]) for r in df.collect() if r["doc_id"] in labels and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    return np.mean([bool(a) == bool(b) for a, b in got])


def test_quality_rules_held_out(spark):
    kept = quality_rules.query(spark, MID).where("not base_failed")
    assert held_out_rates(spark, kept, "quality", "kept") > 0.95


def test_byte_network(spark, edge_docs, edge_labels, no_docs):
    assert held_out_rates(spark, quality_cnn.query(spark, MID), "quality", "predicted") > 0.95
    net = quality_cnn.fit(edge_docs, edge_labels)
    got = rows(quality_cnn.score_documents(edge_docs, net))
    assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality_cnn.score_documents(no_docs, net).count() == 0
    assert quality_cnn.fit(edge_docs, edge_labels.limit(0)).constant == 0.5
    assert quality_cnn.keep_good(edge_docs, net, 0.0).columns == edge_docs.columns


def test_toxicity(spark, edge_docs, edge_labels, no_docs):
    assert held_out_rates(spark, toxicity.query(spark, MID), "toxic", "predicted") > 0.9
    model = toxicity.fit(spark, edge_docs, edge_labels)
    got = rows(toxicity.score_documents(spark, edge_docs, model))
    assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_documents(spark, no_docs, model).count() == 0


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(2)
    v = (rng.random((500, 30)) * (rng.random((500, 30)) < 0.15)).astype(np.float32)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    index = toxicity.BlockMaxIndex(v, rng.integers(0, 2, 500).astype(float), np.arange(500))
    q = v[:50]
    sim, _ = index.nearest(q, 9)
    want = -np.sort(-(q @ index.vectors.T), axis=1)[:, :9]
    np.testing.assert_allclose(np.maximum(sim, 0), np.maximum(want, 0), atol=1e-5)


def test_toxicity_splits_words_once_and_multiplies_many_texts_together(monkeypatch):
    """Each text's words are split and hashed once; the full lists are read once for 1,024 texts. Cosines as from plain counts."""
    texts = [f"both w{i % 40} W{i % 7}, w{i % 7} new{i % 3}" if i % 5 else ("" if i % 2 else f"new{i} newer") for i in range(1500)]
    terms = {w: toxicity.bare_hashes(toxicity.split_words(*toxicity.utf8(toxicity.pa.array([w])), lower=True))[0] for w in ["both", *(f"w{j}" for j in range(40))]}
    order = np.argsort(np.array([*terms.values()], np.uint64))
    at = {[*terms][k]: place for place, k in enumerate(order)}
    weights, other = np.linspace(0.5, 2, 41), 0.7

    def vector(text):
        counts = {}
        for w in text.lower().replace(",", "").split():
            counts[w] = counts.get(w, 0) + 1
        v, rest = np.zeros(41), 0.0
        for w, c in counts.items():
            if w in at:
                v[at[w]] = (1 + math.log(c)) * weights[at[w]]
            else:
                rest += ((1 + math.log(c)) * other) ** 2
        return v / math.sqrt((v**2).sum() + rest) if v.any() else v

    vectors = np.array([vector(t) for t in texts])
    some = np.flatnonzero(vectors.any(axis=1))[:300]
    hashes = np.sort(np.array([*terms.values()], np.uint64))
    model = toxicity.NearestExamples(hashes, weights, other, toxicity.Vectors.of(vectors[some]), (some % 2).astype(float), some)
    calls = {"split": 0, "product": 0}

    class Counted(np.ndarray):
        def __array_ufunc__(self, ufunc, method, *inputs, **kw):
            calls["product"] += ufunc is np.matmul
            return getattr(ufunc, method)(*(np.asarray(x) for x in inputs), **kw)

    def split(*args, whole=toxicity.split_words, **kw):
        calls["split"] += 1
        return whole(*args, **kw)

    model.index.lists = model.index.lists._replace(full=model.index.lists.full.view(Counted))
    monkeypatch.setattr(toxicity, "split_words", split)
    _, sim, near = model.score(*toxicity.utf8(toxicity.pa.array(texts)), (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    assert calls == {"split": 1, "product": 2}
    want = (vectors @ vectors[some].T).max(axis=1)
    np.testing.assert_allclose(np.nan_to_num(sim), want, atol=1e-5)
    assert ((near >= 0) == (want > 0)).all()


def test_places_of_hashes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 1000):
        terms = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        terms = np.unique(np.concatenate((terms, terms[: n // 2] + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)[:n])))  # some share their leading bits
        place = {t: i for i, t in enumerate(terms.tolist())}
        h = np.concatenate((terms, terms + np.uint64(1), rng.integers(0, 2**64, 500, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)))
        assert toxicity.Places(terms).find(h).tolist() == [place.get(x, -1) for x in h.tolist()]


def test_toxicity_uses_every_word_of_the_examples(spark):
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 != 2]
    texts = [("zork", 1)] * 3 + [(f"bad b{i}", 1) for i in range(40)] + [(f"fine {' '.join(f'f{i}x{j}' for j in range(9))}", 0) for i in range(160)]
    data = [(d, t, y) for d, (t, y) in zip(ids, texts)]
    docs = spark.createDataFrame([(d, t) for d, t, _ in data] + [(-1, "zork"), (-2, "f7x3"), (-3, "nowhere")], "doc_id bigint, text string")
    model = toxicity.fit(spark, docs, spark.createDataFrame([(d, y) for d, _, y in data], "doc_id bigint, toxic int"))
    assert len(model.terms) == len({w for _, t, _ in data for w in t.split()}) > 512
    got = {r["doc_id"]: r for r in rows(toxicity.score_documents(spark, docs, model))}
    assert got[-1]["nearest_id"] in ids[:3] and got[-1]["predicted"] == 1
    assert got[-2]["nearest_id"] == data[3 + 40 + 7][0] and got[-2]["predicted"] == 0
    assert got[-3]["nearest_id"] is None


def test_language_model(spark, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(maxent, "HEAD", 500)  # so that some words take the shuffled way
    for docs in (edge_docs, documents(spark)):
        data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
        words = [[*WORD.findall(lower(t)), None] for _, t in data]
        c = Counter(w for (d, _), ws in zip(data, words) if not out(d) for w in ws)
        n, v = sum(c.values()), len(c)
        want = sorted((str(d), out(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4)) for (d, _), ws in zip(data, words))
        training = maxent.typed(docs, "doc_id", "text").where(~maxent.held_out(maxent.F.col("doc_id"), 10, 0)).na.fill({"text": ""})
        vocabulary = maxent.word_counts(training)
        scored = rows(maxent.score_documents(spark, docs, *maxent.train(spark, training, vocabulary), vocabulary))
        got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in scored)
        assert got == want
        assert all(r["score"] < 0 for r in scored)
    assert sum(r["score"] for r in scored) > sum(r["base_score"] for r in scored)
    none = maxent.word_counts(no_docs.select("text"))
    assert maxent.score_documents(spark, no_docs, *maxent.train(spark, maxent.typed(no_docs, "doc_id", "text"), none), none).count() == 0


def test_shards(spark, edge_docs, no_docs):
    for docs in (edge_docs, documents(spark, MID)):
        got = rows(sharding.shard_documents(spark, docs))
        assert len(got) == docs.count()
        by = {}
        for r in got:
            by.setdefault(r["shard"], []).append(r)
        assert set(by) <= set(range(24))
        assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in by.values())
    sizes = [sum(r["size"] for r in own) for own in by.values()]
    largest = max(r["size"] for r in got)
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= largest
    assert sharding.shard_documents(spark, no_docs).count() == 0


def test_mixing(spark, edge_docs, no_docs):
    got = rows(mixing.mix_documents(spark, edge_docs))
    assert len(got) == edge_docs.count() and all(r["copies"] <= 3 for r in got)
    assert mixing.mix_documents(spark, no_docs).count() == 0 and mixing.mixed_rows(no_docs).count() == 0
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{MID}/documents.parquet'")
    want = con.execute(mixing.ORACLE_SQL).fetchall()
    out = mixing.query(spark, MID)
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert mixing.mixed_rows(documents(spark, MID)).count() == sum(r[-1] for r in want)
    assert "Python" not in out._jdf.queryExecution().toString()


def test_language_model_inside_classes(spark, edge_docs, monkeypatch):
    """Weights of (two previous words, word) against plain dictionaries, over all contexts."""
    monkeypatch.setattr(maxent, "HEAD", 400)
    monkeypatch.setattr(maxent, "SHARE", 1)
    fixed = spark.createDataFrame([(i, "a b c d a b c e a b c d") for i in range(6)] + [(9, "a b c d"), (10, "a b q")], "doc_id bigint, text string")
    for docs in (edge_docs, fixed, documents(spark)):
        training = maxent.typed(docs, "doc_id", "text").where(~maxent.held_out(maxent.F.col("doc_id"), 10, 0)).na.fill({"text": ""})
        vocabulary = maxent.word_counts(training).persist()
        model, features = maxent.train(spark, training, vocabulary)
        plain = rows(maxent.score_documents(spark, docs, model, features.limit(0), vocabulary))
        full = rows(maxent.score_documents(spark, docs, model, features, vocabulary))

        def events(text):
            words = [*WORD.findall(lower(text))]
            data = " ".join(words).encode()
            h, d = maxent._hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
            at = model.lookup(h)
            for i, w in enumerate(words):
                if at[i] < len(model.words):
                    context = (words[i - 1] if i else None, words[i - 2] if i > 1 else None, int(model.classes[at[i]]))
                    yield context, w, 10 ** model.inside[at[i]]

        seen = Counter((k, w) for r in training.collect() for k, w, _ in events(r["text"]))
        n, t = Counter(), Counter()
        for (k, _), times in seen.items():
            n[k] += times
            t[k] += 1
        assert features.count() == sum(x > 1 for x in seen.values()) + sum(n[k] > t[k] for k in n)
        by_text = {}
        for r in docs.collect():
            by_text.setdefault(r["doc_id"], []).append(sum(math.log10((max(seen[k, w] - 1, 0) + t[k] * p) / (n[k] * p)) for k, w, p in events(r["text"]) if k in n))
        got = {}
        for a, b in zip(sorted(plain, key=lambda r: (str(r["doc_id"]), r["score"])), sorted(full, key=lambda r: (str(r["doc_id"]), r["score"]))):
            got.setdefault(a["doc_id"], [0.0, 0.0])
            got[a["doc_id"]][0] += b["score"] - a["score"]
            got[a["doc_id"]][1] += sum(by_text[a["doc_id"]]) / len(by_text[a["doc_id"]])
        assert all(abs(x - y) < 1e-3 for x, y in got.values())
        # P sums to one inside each class, whatever the context
        own = {}
        for w, c, p in zip(model.words.tolist(), model.classes.tolist(), (10 ** model.inside).tolist()):
            own.setdefault(c, []).append(p)
        assert all(abs(sum(x) - 1) < 1e-6 for c, x in own.items() if c != maxent.REST)
    vocabulary = spark.createDataFrame([(i, 5 if i < 200 else 9 if i == 999 else 1) for i in range(1000)], "w bigint, c bigint")
    assert [r["w"] for r in maxent._head(vocabulary).collect()] == [999, *range(200), *range(200, 399)]
    wide = spark.createDataFrame([(((i * 7919) % 1000 - 500) << 53, 2) for i in range(1000)], "w bigint, c bigint")
    assert [r["w"] for r in maxent._head(wide).collect()] == sorted(r["w"] for r in wide.collect())[:400]


def test_language_model_learns_kinds_from_all_texts(spark):
    """Few kinds are found in short texts alone, others in texts over 32 KB; every training text counts in its kind's centre."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"{'ac'[k % 2]}{x}" for x in rng.integers(50, size=12 + k)) for k in range(30)] * 60
    texts += [" ".join(f"b{x}" for x in rng.integers(50, size=12_000)) for _ in range(9)] * 20 + ["", "rare"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")
    training = docs.where(~maxent.held_out(maxent.F.col("doc_id"), 10, 0))
    vocabulary = maxent.word_counts(training).persist()
    model, _ = maxent.train(spark, training, vocabulary)
    data = [r["text"].encode() for r in training.collect()]
    h, d = maxent._hashes(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    anchors = model.words[model.rank[: maxent.ANCHORS]]
    x = np.zeros((len(data), maxent.ANCHORS))
    for i, own in enumerate(x):
        own[: len(anchors)] = np.sqrt((h[d[i] : d[i + 1], None] == anchors).sum(axis=0))
        own /= max(1.0, np.linalg.norm(own))
    kind = np.argmax(x @ model.centres.T, axis=1)
    first = np.array([t[:1] for t in data])
    kinds = [set(kind[first == c]) for c in (b"a", b"b", b"c")]
    assert all(kinds) and len(set.union(*kinds)) == sum(map(len, kinds))
    for k in set.union(*kinds):
        mean = x[kind == k].sum(axis=0)
        assert np.abs(model.centres[k] - mean / np.linalg.norm(mean)).max() < 1e-3
    again, _ = maxent.train(spark, training.repartition(7), vocabulary)
    assert np.array_equal(model.centres, again.centres)


def test_language_model_knows_texts_that_occur_twice(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(200, size=300)) for _ in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:15])], "doc_id bigint, text string")
    training = docs.where(~maxent.held_out(maxent.F.col("doc_id"), 10, 0))
    vocabulary = maxent.word_counts(training).persist()
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in rows(maxent.score_documents(spark, docs, *maxent.train(spark, training, vocabulary), vocabulary)) if not r["held_out"]}
    both = [i for i in range(15) if i in got and i + 120 in got]
    assert both and min(got[i] for i in both) > max(got[i] for i in range(15, 120) if i in got)


def test_html_extract(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    model = html_extract.fit(pages)
    edge = [(1, "u", None), (2, None, ""), (None, "v", "<p>unclosed <b>text"), (3, "w", "<script>x</script>"), (3, "w", "<script>x</script>")]
    df = spark.createDataFrame(edge, "page_id bigint, url string, html string")
    assert html_extract.extract_pages(spark, df, model).count() == 5
    assert html_extract.extract_pages(spark, pages.limit(0), model).count() == 0
    assert html_extract.fit(pages.limit(0)).fitted is False
    found = {r["page_id"]: r["text"] for r in html_extract.extract_pages(spark, pages, model).collect()}
    want = {r["page_id"]: " ".join(t for p, t, _ in html_extract.blocks(r["html"]) if html_extract.teacher(p)) for r in pages.collect()}
    assert np.mean([found[k] == want[k] for k in want]) > 0.98
    assert html_extract.blocks("<p>a &amp; <b>b</b>c\n d<br>e")[0][1] == "a & bc d"


def test_html_extract_of_deep_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    model = html_extract.fit(pages)
    deep = []
    for r in pages.where("html like '%<article>%'").collect():
        for n in (13, 25):
            ends = ("<div class='x'>" * n, "</div>" * n)
            deep.append(r["html"].replace("<article>", "<article>" + ends[0]).replace("</article>", ends[1] + "</article>"))
            deep.append(r["html"].replace("<nav>", "<nav>" + ends[0]).replace("</nav>", ends[1] + "</nav>"))
    want = [" ".join(t for p, t, _ in html_extract.blocks(h) if html_extract.teacher(p)) for h in deep]
    got = html_extract.extract(deep, model, {})
    assert len(deep) > 40 and np.mean([a == b for a, b in zip(got, want)]) > 0.95
    # a page whose every block lies below more than twelve wrappers keeps the names above them apart
    near, far = ((("article",), *[("div",)] * 20, ("p",)), (("nav",), *[("div",)] * 20, ("p",)))
    assert set(html_extract._path_rows(near, {})) != set(html_extract._path_rows(far, {}))


def test_registered():
    assert {q.split("_")[0] for q in queries.queries()} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
