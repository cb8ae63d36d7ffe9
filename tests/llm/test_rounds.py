"""How much work the rounds of near-duplicate search and the chunks of the piece sampler take, on small made rows."""

import numpy as np
import pyarrow as pa

import brute
from routeline.llm import neardup, pieces


def _unlinked(n: int) -> list[tuple[int, str]]:
    """Texts that share bands, since each replaces six words of one, at similarity 0.72; a few are copied with one new word."""
    words = [f"t{i}" for i in range(100)]
    rows = []
    for k in range(n):
        own = words.copy()
        at = k * 94 // n
        own[at:at + 6] = [f"d{k}x{i}" for i in range(6)]
        rows.append((k, " ".join(own)))
    return rows + [(n + k, rows[k][1] + " more") for k in range(0, n, 9)]


def _classes(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.classify(frame).collect()}


def test_a_group_of_few_is_compared_in_one_round(spark, monkeypatch):
    rounds = []
    path = neardup.scratch_path
    monkeypatch.setattr(neardup, "scratch_path", lambda s, name: (rounds.append(name), path(s, name))[1])
    rows = _unlinked(40)
    assert _classes(spark, rows) == brute.near_classes(rows)
    assert rounds.count("likely") == 2  # the first centres, then all members; before, slots left members to later rounds


def test_groups_larger_than_a_round_s_centres(spark, monkeypatch):
    monkeypatch.setattr(neardup, "FAN", 3)
    monkeypatch.setattr(neardup, "WIDE", 1)
    monkeypatch.setattr(neardup, "SMALL", 2)
    rows = _unlinked(24)
    assert _classes(spark, rows) == brute.near_classes(rows)


def _mostly_linked(copies: int, others: int) -> list[tuple[int, str]]:
    """Copies of one text with one new word each, which are linked, and texts that share bands with it at similarity 0.72."""
    unlinked = [text for _, text in _unlinked(others)[:others]]
    rows = [" ".join(f"t{i}" for i in range(100)) + f" more{k}" for k in range(copies)] + unlinked
    return list(enumerate(rows))


def test_a_group_of_one_large_component_is_compared_in_one_round(spark, monkeypatch):
    rounds = []
    path = neardup.scratch_path
    monkeypatch.setattr(neardup, "scratch_path", lambda s, name: (rounds.append(name), path(s, name))[1])
    monkeypatch.setattr(neardup, "FAN", 4)
    monkeypatch.setattr(neardup, "WIDE", 1)
    rows = _mostly_linked(24, 4)
    assert _classes(spark, rows) == brute.near_classes(rows)
    assert rounds.count("likely") == 2  # before, the size of the whole group decided, and slots left members to later rounds


def test_large_groups_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 2)
    monkeypatch.setattr(neardup, "BLOCK", 5)
    rows = _mostly_linked(12, 18) + [(100 + k, text) for k, text in _unlinked(18)[18:]]
    want = brute.near_classes(rows)
    assert _classes(spark, rows) == want
    monkeypatch.setattr(neardup, "FAN", 3)
    monkeypatch.setattr(neardup, "WIDE", 1)
    assert _classes(spark, rows) == want


def test_equal_words_of_a_batch_share_a_lattice(monkeypatch):
    words = [f"wo{i}rd{i * 7919 % 1000}" for i in range(500)]
    texts = pa.array([" ".join(words[(k * 37 + i) % 500] for i in range(400)) for k in range(60)] + [None, "", "\u2581 \U0001F600\n"])
    keys = pa.array(np.arange(len(texts), dtype=np.int64))
    vocabulary, init, seen = pieces.load(), pieces.Lattice.__init__, []
    monkeypatch.setattr(pieces.Lattice, "__init__", lambda self, v, flat, begin, length: (
        seen.append(len(begin)), init(self, v, flat, begin, length))[1])

    def encoded(chunk=None):
        seen.clear()
        if chunk:
            monkeypatch.setattr(pieces, "CHUNK_CHARS", chunk)
        return pieces._encoded(vocabulary, texts, keys, 1), sum(seen)

    assert 1 << 17 < sum(len(t or "") for t in texts.to_pylist()) < 1 << 18
    ids, lattices = encoded()
    again, more = encoded(1 << 12)
    _, once = encoded(1 << 30)
    assert lattices == once < more and ids.equals(again)  # before, two chunks each made their own
    assert pieces._decoded(np.array(vocabulary.pieces, dtype=object), ids).equals(texts)
