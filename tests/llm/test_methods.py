"""Results of the operators against plain reimplementations, and their needs of a cluster."""

import math
import os
import re
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from zerobill.llm import decontaminate, html_extract, mixing, quality_cnn, sharding, token_files, toxicity

SMALL = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def small(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def plain_words(text):
    marks = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return [w.strip(marks) or (w[:1] if set(w) <= set(marks) else w) for w in words]


def test_operators_run_where_the_package_is_not_on_the_workers_path(tmp_path):
    """The driver alone knows the package, as __spark_entry__ sets its path; workers start in another folder."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from zerobill.session import build_session
import __spark_entry__ as E
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {str(tmp_path / "shared")!r}}})
for name in ("op2_bm25_decontamination", "op4_nearest_example_toxicity", "op5_hashed_maxent_lm", "op10_lstm_html_extract", "op12_best_position_search"):
    print(name, E.queries()[name](spark, {SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=env)
    assert run.returncode == 0, run.stderr[-2000:]
    assert len(run.stdout.splitlines()) == 5
    assert [f for _, _, files in os.walk(tmp_path / "shared") for f in files] == []


def test_toxicity_against_plain_cosines(spark):
    """Every score of sf0.001 from dictionaries: weights, norms over all words, the nearest, votes, calibration."""
    docs, labels = small(spark, "documents"), small(spark, "labels")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out_ids = {r[0] for r in docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2").select("doc_id").collect()}
    mark = {r["doc_id"]: r["toxic"] for r in labels.where("toxic is not null").collect()}
    bags = {d: Counter(plain_words(t)) for d, t in texts.items()}
    known = sorted(d for d in mark if d in texts and d not in out_ids and len((texts[d] or "").encode()) <= toxicity.SAMPLE_BYTES)
    vocabulary = {w for d in known for w in bags[d]}
    df = Counter(w for b in bags.values() for w in b)
    n, n1 = len(known), sum(mark[d] for d in known)

    def damping(w):
        has = [d for d in known if w in bags[d]]
        h, h1 = len(has), sum(mark[d] for d in has)
        part = lambda x, e: x * math.log(x / e) if x > 0 else 0.0
        r = 2 * (part(h1, h * n1 / n) + part(h - h1, h * (n - n1) / n) + part(n1 - h1, (n - h) * n1 / n) + part(n - n1 - h + h1, (n - h) * (n - n1) / n))
        r = max(r, 0) + 1
        return r / (r + toxicity.HALF_RATIO)

    weight = {w: (math.log((1 + len(texts)) / (1 + df[w])) + 1) * damping(w) for w in vocabulary}
    other = (math.log(1 + len(texts)) + 1) / (1 + toxicity.HALF_RATIO)

    def vector(d):
        v = {w: (1 + math.log(c)) * weight.get(w, other) for w, c in bags[d].items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items() if w in weight}

    vectors = {d: vector(d) for d in texts}
    examples = [d for d in known if vectors[d]]
    prior = n1 / n

    def vote(d, own):
        sims = sorted(((sum(x * vectors[e].get(w, 0.0) for w, x in vectors[d].items()), e) for e in examples if not (own and e == d)), reverse=True)
        near = [(s, e) for s, e in sims[: toxicity.NEIGHBOURS] if s > 0]
        total = sum(s * s for s, _ in near)
        return (sum(s * s * mark[e] for s, e in near) + 0.05 * prior) / (total + 0.05), near

    raw = np.array([vote(d, True)[0] for d in examples])
    knots = toxicity.isotonic(raw, np.array([mark[d] for d in examples], float))
    got = {r["doc_id"]: r for r in toxicity.query(spark, SMALL).collect()}
    checked = 0
    for d in texts:
        if vectors[d]:
            v, near = vote(d, False)
            assert abs(got[d]["nearest_similarity"] - near[0][0]) < 1e-4
            assert abs(got[d]["score"] - float(np.interp(v, *knots))) < 0.02
            checked += 1
    assert checked > 150


def test_one_shared_word_is_not_close(spark):
    words = [f"w{i}x" for i in range(600)]
    rows = [(i, " ".join(words[j] for j in range(i % 7, 60, 7)), i % 2) for i in range(40)]
    far = (99, words[3] + " " + " ".join(f"new{i}" for i in range(500)))
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows] + [far], "doc_id bigint, text string")
    model = toxicity.fit(spark, docs, spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id bigint, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score_documents(spark, docs, model).collect()}
    assert got[99]["nearest_similarity"] < 0.2 and got[0]["nearest_similarity"] > 0.99


def test_inline_void_elements_do_not_cut_words():
    assert [t for _, t, _ in html_extract.blocks("<p>super<wbr>cali fra<img src=x>gile</p><div class=note/>in</div>out")] == ["supercali fragile", "in", "out"]


def test_short_last_sentences_do_not_decide(spark):
    """An item whose last sentence is one short phrase is found though that phrase was changed."""
    question = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my. nu xi omikron pi rho sigma tau ypsilon phi chi psi omega one two three four five. "
    items = spark.createDataFrame([(1, question + "yes.")], "item_id bigint, text string")
    noise = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, f"{noise} {question} no. {noise}"), (2, f"{noise} {question} yes. {noise}"), (3, noise)], "doc_id bigint, text string")
    assert {r["doc_id"] for r in decontaminate.contaminated(spark, docs, items).collect()} == {1, 2}
    assert decontaminate.question_and_answer(question + "yes.")[1] != "yes."


def test_token_files_take_the_library_for_other_settings():
    odd = ["Some Words, here", "a <|endoftext|> b c", "", None, "x  y\n\nz", "<|startoftext|>Word's end."]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        encode, tok = token_files.WordEncoder(path, 1), Tokenizer.from_file(path)
        assert encode.by_word == (name == "word_bpe_49k.json")
        assert [e.tolist() for e in encode(odd)] == [tok.encode(t or "", add_special_tokens=False).ids + [1] for t in odd]


def test_shards_carry_size_crc_and_copies(spark):
    docs = small(spark, "documents")
    got = sharding.query(spark, SMALL)
    assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(text)
    slots = {}
    for r in rows:
        assert r["size"] == len(text[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]])
        slots.setdefault(r["shard"], []).append((r["slot"], r["doc_id"]))
    for own in slots.values():
        assert sorted(s for s, _ in own) == list(range(len(own)))
        assert [d for _, d in sorted(own)] == sorted(d for _, d in own)


def test_pipeline_run_with_digests(spark, tmp_path):
    """run() on sf0.001: each document's ids are those of the library, in id order without a gap; nothing left staged but the result."""
    got = corpus_pipeline.run(spark, SMALL).collect()
    text = {r["doc_id"]: r["text"] for r in small(spark, "documents").collect()}
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at = 0
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == sorted(r["doc_id"] for r in got)
    for r in sorted(got, key=lambda r: r["start"]):
        ids = np.array(tok.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids + [1], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    good = {r["doc_id"] for r in quality_cnn.query(spark, SMALL).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in got} <= good
    assert Counter(r["doc_id"] for r in got).most_common(1)[0][1] <= mixing.MAX_REPEAT


def test_pipeline_on_no_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        small(spark, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
