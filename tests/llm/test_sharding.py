"""Shards: counts, gapless slots, mixture of every shard, reruns, edge cases."""

import zlib
from collections import Counter

import pytest

from routeline.llm import sharding

SCHEMA = "doc_id bigint, text string, source string, size string, __n int, shard double"


def rows_of(n):
    source = lambda i: "hot" if i % 3 else None if i % 7 == 0 else f"s{i % 4}"
    return [(None if i % 50 == 0 else i, "copy" if i % 2 else f"é{i}", source(i), "x", i, 1.0) for i in range(n)]


@pytest.mark.parametrize("n, shards", [(1, 8), (5, 8), (1003, 8), (800, 3)])
def test_law_and_mixture(spark, n, shards):
    rows = rows_of(n)
    got = sharding.interleave(spark.createDataFrame(rows, SCHEMA).repartition(5), shards=shards).collect()
    by = {r["__n"]: r for r in got}
    assert len(got) == n == len(by)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1 and set(counts) <= set(range(shards))
    for s, k in counts.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(k))
    total = Counter(r[2] for r in rows)
    for s in counts:
        mine = Counter(r.source for r in got if r.shard == s)
        for source, k in total.items():
            assert abs(mine[source] - k / shards) <= 2
    for _, text, source, _, i, _ in rows:
        r = by[i]
        assert (r.size, r.text_crc32, r.law, r.source) == (len(text.encode()) + 1, zlib.crc32(text.encode()), "rows", source)
        assert r.grown_shard is None


def test_reruns_agree_whatever_the_partitions(spark):
    frame = spark.createDataFrame([r for r in rows_of(600) if r[0] is not None], SCHEMA)
    places = [sorted((r.doc_id, r.shard, r.slot) for r in sharding.interleave(f, carry=["doc_id"]).collect())
              for f in (frame.repartition(2), frame.repartition(7, "text"))]
    assert places[0] == places[1]


def test_edges(spark, tmp_path):
    assert sharding.interleave(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, None, None, None, None)] * 20 + [(2, "", "a", None, None, None), (3, "w " * 300_000, "a", None, None, None)]
    placed = sharding.interleave(spark.createDataFrame(rows, SCHEMA))
    got = placed.collect()
    assert sorted(Counter(r.shard for r in got).values()) == [2, 2, 3, 3, 3, 3, 3, 3]
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {
        (1, 1, 0), (2, 1, 0), (3, 600_001, zlib.crc32(b"w " * 300_000))}
    sharding.write_shards(placed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "shard=3")).count() == Counter(r.shard for r in got)[3]
