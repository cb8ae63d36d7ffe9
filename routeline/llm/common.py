"""Helpers shared by the operators of this subpackage: scratch tables, global order, words, hashes.

Words are maximal runs of characters other than the six ASCII white-space characters. They are
found on UTF-8 bytes, where white space is one byte and never part of a longer character, so word
work runs on whole Arrow buffers with numpy, a bounded chunk of text at a time. A single text is
never cut: a text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from routeline.session import scratch_path

# The white space that ends a word, as bytes and as a Java character class.
SPACE_BYTES = (9, 10, 11, 12, 13, 32)
WORD = r"[^\x20\x09-\x0D]+"

CHUNK_BYTES = 1 << 20
NO_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the session's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it was running, not the steps before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positioned(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Add each row's place (from 0) in the global order, without a one-task sort.

    Rows are range-partitioned, numbered inside each range, and shifted by the row counts of the
    ranges before; only those counts, one row per range, meet in one task.
    """
    part, within = "__range", "__row"
    ranged = stored(
        df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(part).agg(F.count("*").alias("__n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(
        F.col(part).alias("__part"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    numbered = ranged.withColumn(
        within, F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1)
    return (numbered.join(shift, F.col(part) == F.col("__part"))
            .withColumn(name, F.col("__shift") + F.col(within))
            .drop(part, within, "__part", "__shift"))


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL. Every word and the space after it shrink to one character."""
    bare = F.regexp_replace(text, r"^[\x20\x09-\x0D]+", "")
    return F.coalesce(
        F.length(F.regexp_replace(bare, WORD + r"[\x20\x09-\x0D]*", "x")), F.lit(0)).cast("bigint")


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))


# ---- numpy on Arrow text ----------------------------------------------------------------------

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
BYTE_VALUE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about ``limit`` bytes; NULL reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and where each text's words begin (one more at the end)."""
    space = _IS_SPACE[data]
    before = np.ones(len(data) + 1, dtype=bool)
    before[1:] = space
    before[offsets] = True
    after = np.ones(len(data) + 1, dtype=bool)
    after[:-1] = space
    after[offsets] = True
    starts = np.flatnonzero(~space & before[:-1])
    ends = np.flatnonzero(~space & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= 1 << 22:
            _powers[base] = have
    return have[:n]


class RunHash:
    """64-bit hashes of runs ``values[start:end]``, alike wherever a run stands."""

    def __init__(self, values: np.ndarray, base: int = BASE_A):
        self.total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * _power(base, len(values)), out=self.total[1:])
        self.inverse = _power(pow(base, -1, 1 << 64), len(values) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.total[ends] - self.total[starts]) * self.inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(BASE_B))


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE_A) -> np.ndarray:
    return RunHash(values, base)(starts, ends)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(BYTE_VALUE[data], starts, ends)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data + np.uint8(32), data)


def windows(word_offsets: np.ndarray, size: int) -> np.ndarray:
    """Index of the first word of every window of ``size`` words that lies within one text."""
    n = int(word_offsets[-1])
    fits = np.zeros(n, dtype=bool)
    room = np.repeat(word_offsets[1:], np.diff(word_offsets))
    fits[:] = np.arange(n) + size <= room
    return np.flatnonzero(fits)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
