"""The queries against plain versions of their contracts, on the smallest tables."""

import collections
import re
import zlib

import brute
import pyarrow.parquet as pq
import pytest

from routeline.llm.queries import LLM_QUERIES

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{ROOT}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs}


def rows(spark, name):
    return LLM_QUERIES[name](spark, ROOT).collect()


def test_fingerprints(spark, texts):
    edited = brute.edited(list(texts.items()))
    ids = sorted(texts)
    follow = {i: ids[(k + 1) % len(ids)] for k, i in enumerate(ids)}
    parts = lambda t: {x for x in re.split(r"\n|(?<=[.!?])[ \t]+", t or "") if x}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    got = rows(spark, "op1_fingerprints")
    assert len(got) == len(texts)
    for r in got:
        own = parts(texts[r.doc_id])
        assert (r.n_chars, r.edited_sha256) == (len(texts[r.doc_id] or ""), brute.sha(edited[r.doc_id]))
        assert r.near_edited == pytest.approx(like(own, parts(edited[r.doc_id])))
        assert r.near_next == pytest.approx(like(own, parts(texts[follow[r.doc_id]])))


def test_near_duplicates(spark, texts):
    want = brute.near_classes(list(texts.items()))
    for r in rows(spark, "op2_minhash"):
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_quality_rules(spark, texts):
    for r in rows(spark, "op3_weak_supervision"):
        want = brute.quality_base(texts[r.doc_id])
        assert want == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_language(spark, docs):
    lang = {r["doc_id"]: r["lang"] for r in docs}
    got = rows(spark, "op5_language")
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_secrets(spark, texts):
    for r in rows(spark, "op6_secrets"):
        want = brute.secret_base(texts[r.doc_id])
        spans = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        kinds = collections.Counter(k for *_, k in want)
        assert r.base_sha256 == brute.sha(spans)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])


def test_substrings(spark, texts):
    ids = list(texts)
    want = dict(zip(ids, brute.without_repeats([texts[i] for i in ids]), strict=True))
    for r in rows(spark, "op7_substrings"):
        assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id]


def test_mixing(spark, docs):
    sizes = collections.Counter()
    for r in docs:
        sizes[r["source"]] += len(brute.words(r["text"]))
    target = brute.targets(sizes)
    source = {r["doc_id"]: r["source"] for r in docs}
    for r in rows(spark, "op8_mixing"):
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken <= 2 * r.size


def test_pieces(spark, texts):
    got = rows(spark, "op9_pieces")
    assert all(r.lossless for r in got) and len(got) == len(texts)
    again = {r.doc_id: r.piece_ids for r in rows(spark, "op9_pieces")}
    assert all(again[r.doc_id] == r.piece_ids for r in got)


def test_quality_scores(spark, texts):
    got = rows(spark, "op10_quality")
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
