"""Hard negatives against brute force: contract query, repeated rows and ids, ties, odd vectors, many blocks."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from routeline.llm import hardneg
from routeline.llm.queries import LLM_QUERIES

ROOT = "/root/testdata/sf0.001"


def brute(rows, is_anchor, positives=5, negatives=10):
    """rows: (id, label, whole vector); the result as a sorted list of tuples."""
    out = []
    first = lambda scored, k: sorted(scored, key=lambda r: (-r[0], r[1] is None, r[1]))[:k]
    for at, (i, label, v) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), j, other, k)
                  for k, (j, other, w) in enumerate(rows) if k != at]
        for p, positive, _, _ in first([s for s in scored if s[2] == label], positives):
            fits = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p]
            out += [(i, positive, rank + 1, n[1], p, n[0]) for rank, n in enumerate(first(fits, negatives))]
    return sorted(out, key=str)


def test_query(spark):
    rows = []
    for r in pq.read_table(f"{ROOT}/embeddings.parquet").to_pylist():
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        rows.append((r["vec_id"], label, [math.floor(256 * x) for x in r["embedding"]]))
    got = sorted((tuple(r) for r in LLM_QUERIES["op11_hard_negatives"](spark, ROOT).collect()), key=str)
    assert got == brute(rows, lambda i: i % 100 == 0)


@pytest.fixture(scope="module")
def clustered():
    """Five clusters of unlike sizes, one vector on a third of all rows, repeated ids."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 100, (5, 7))
    rows = []
    for i in range(600):
        v = centres[0] if i % 3 == 0 else centres[i % 5] + rng.normal(0, 12, 7)
        rows.append((None if i == 77 else i // 2 if i > 580 else i, int(rng.integers(0, 3)), [float(round(x)) for x in v]))
    return rows


@pytest.mark.parametrize("codes", [1, 4, 16])
def test_ties_and_copies(spark, clustered, codes):
    schema = "vec_id bigint, label int, embedding array<double>, row string, anchor int"
    odd = [(900, None, [1.0] * 7), (901, 1, None), (902, 1, [1.0, None, *[2.0] * 5]), (903, 1, [float("nan")] * 7),
           (904, 1, [float("inf")] * 7), (905, 1, []), (906, 1, [1.0] * 6)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in clustered + odd], schema)
    got = hardneg.mine(frame, F.col("vec_id") % 10 == 0, codes=codes, block_rows=50).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(clustered, lambda i: i is not None and i % 10 == 0)


def test_few_rows(spark):
    schema = "vec_id bigint, label int, embedding array<double>"
    assert hardneg.mine(spark.createDataFrame([], schema), F.col("vec_id") % 2 == 0).count() == 0
    rows = [(0, 1, [10.0, 0.0]), (1, 1, [10.0, 1.0]), (2, 2, [5.0, 0.0]), (4, 3, [1.0, 1.0])]
    got = sorted(tuple(r) for r in hardneg.mine(spark.createDataFrame(rows, schema), F.col("vec_id") % 2 == 0).collect())
    assert got == [(0, 1, 1, 2, 100, 50)]  # 2 and 4 have no positive
    negative = spark.createDataFrame([(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-1.0]), (3, 2, [0.0])], schema)
    assert hardneg.mine(negative, F.col("vec_id") == 0).count() == 0  # a window below zero is empty


def test_bounds_and_early_end():
    """Bounds lie above every score, cells come by falling bound, and far cells are never reached."""
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 200, (6, 8))
    vectors = np.round(centres[rng.integers(0, 6, 900)] + rng.normal(0, 3, (900, 8)))
    books = hardneg.fit_codebooks(vectors[:300], 6)
    block, queries = hardneg.Block(vectors, books), vectors[:5]
    first, second = block.bounds(queries)
    for q in range(5):
        visits, last, reached = hardneg.Visits(first[q], second[q]), np.inf, 0
        while visits.heap:
            bound = visits.bound
            assert bound <= last
            last, cell = bound, visits.take()
            rows = block.order[block.starts[cell]:block.starts[cell + 1]]
            assert (vectors[rows] @ queries[q] <= bound).all()
            reached += len(rows)
        assert reached == 900
        best = hardneg.Best([hardneg.ANY], 5)
        scores = vectors @ queries[q]
        best.add(np.column_stack([scores, np.arange(900), np.arange(900)]).astype(np.int64))
        visits, cells = hardneg.Visits(first[q], second[q]), 0
        while not best.certified(visits.bound):
            visits.take()
            cells += 1
        assert cells < 36 / 2


def test_large_numbers():
    vectors = np.array([[float(1 << 27), 3.0], [float(1 << 27), 4.0], [1.0, 1.0]])
    n = np.arange(3)
    best = hardneg.search(vectors[:1], np.array([1]), n[:1], [[hardneg.ANY]], 3, False, vectors, n, np.zeros(3, int), n,
                          hardneg.fit_codebooks(vectors, 2))
    assert best[0].found[0][:, 0].tolist() == [(1 << 54) + 12, (1 << 54) + 9, (1 << 27) + 3]
