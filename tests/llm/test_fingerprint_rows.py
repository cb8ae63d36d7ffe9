"""Every input row of op1_fingerprints gives one row, also with NULL and repeated ids."""

import re
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from routeline.llm import fingerprint

A, B, C = "One a.\nTwo b.\nThree c.", "Two b.\nFour d. Five e.", "Six f.\nOne a.\nSeven g. Two b."
LOW = -(1 << 63)
ROWS = [(None, A), (None, B), (None, B), (None, None), (1, A), (1, B), (1, A), (1, A), (2, C), (3, ""), (3, None),
        (LOW, C), (4, B)]


def plain(ordered):
    parts = lambda t: {x for x in re.split(r"\n|(?<=[.!?])[ \t]+", t) if x}
    like = lambda a, b: round(len(a & b) / len(a | b), 9) if a | b else 1.0
    for at, (i, t) in enumerate(ordered):
        after, k = ordered[(at + 1) % len(ordered)][1], len(t) // 4
        edited = t[:len(t) - k] + after[:k]
        yield i, len(t), brute.sha(edited), like(parts(t), parts(edited)), like(parts(t), parts(after))


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], [(5, A)] * 3, [(None, A)] * 2 + [(None, C)]])
@pytest.mark.parametrize("chunk", [2, fingerprint.COPIES_PER_TASK])
def test_one_row_per_row(spark, rows, chunk, monkeypatch):
    monkeypatch.setattr(fingerprint, "COPIES_PER_TASK", chunk)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    ordered = [(i, t) for i, t, _ in sorted(hashed, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))]
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
                  for r in fingerprint.compare(docs).collect())
    assert got == Counter(plain(ordered)) and got.total() == len(rows)
