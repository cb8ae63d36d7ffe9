"""Substring dedup by level-wise doubling.

Wanted: every window of ``WINDOW`` words that starts in two places of the corpus. Short windows are
looked at first; what is repeated at one length alone is extended to about twice that length (9, 18,
35 words), and the last level decides. Hashes, positions and answers are tables; no text meets
another.

A level below the last does not look at all its windows. Each full window that is still a candidate
names one short window inside it, the one with the smallest hash (the leftmost of equals). Equal
full windows name equal short ones, so a full window whose short one occurs once in the corpus
occurs once itself and is dropped. That keeps about one short window in fourteen and loses nothing.

At a level, each text writes (hash, text key, position) of its named windows; hashes are counted
with an aggregate that is combined before its shuffle, and the positions of repeated ones go back to
their texts through joins on the hash and on the text key. A passage found in a third of all texts
is one hash: one row in the count and a join side that adaptive execution splits.

Equal texts share a key (128 hashed bits of the text) and are known to be repeated from the count of
the key alone, so copies need not write their windows again: a task writes those of a key once.

Hashes are 64 bits wide at the lower levels, where a collision only costs work, and 128 bits at the
last.

Defined cases: NULL text has no words; its kept text is empty. Fewer words than a window: nothing is
removed. Repeated rows are copies of each other: all their windows repeat. An empty table gives an
empty result. Rows need no unique id; other columns don't enter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeline.llm.common import (
    BASE_A, BASE_B, RunHash, mix, signed, stored, text_chunks, word_hashes, word_spans,
)

WINDOW = 35
LEVELS = (9, 18)        # short windows, about half as long each


def named(words: np.ndarray, text_words: np.ndarray, size: int, window: int) -> tuple[np.ndarray, ...]:
    """(start of each full window, its named window of ``size`` words, hash per word position)."""
    n = len(words)
    at = np.arange(n)
    room = np.repeat(text_words[1:], np.diff(text_words))
    starts = np.flatnonzero(at + window <= room)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    h = RunHash(words, BASE_B)(at, np.minimum(at + size, n))
    # smallest hash among window-size+1 neighbours, by doubling spans; ties stay left
    span, best = 1, at.copy()
    width = window - size + 1
    while span < width:
        step = min(span, width - span)
        other = np.empty_like(best)
        other[:n - step] = best[step:]
        other[n - step:] = best[n - step:]
        best = np.where(h[other] < h[best], other, best)
        span += step
    return starts, best[starts], h


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for first, data, offsets in text_chunks(batch.column(batch.schema.get_field_index("text"))):
        starts, ends, text_words = word_spans(data, offsets)
        yield first, data, starts, ends, text_words, word_hashes(data, starts, ends)


def _alive(starts: np.ndarray, names: np.ndarray, text_words: np.ndarray, kept: list, first: int) -> np.ndarray:
    """Which full windows have a named window among the kept ones (positions within the text)."""
    sizes = np.array([len(k) if k is not None else 0 for k in kept])
    flag = np.zeros(int(text_words[-1]), bool)
    if sizes.sum():
        base = np.repeat(text_words[:-1], sizes)
        flag[np.concatenate([k for k in kept if k is not None and len(k)]) + base] = True
    return flag[names]


def _writer(window: int, done: int | None, size: int | None) -> Callable:
    """mapInArrow: the named windows at ``size`` (None: the full windows) of those candidates whose
    named window at level ``done`` is listed in the column ``at``."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            listed = batch.column("at") if done else None
            for first, _, _, _, text_words, words in _texts(batch):
                count = len(text_words) - 1
                fresh = np.zeros(count, bool)
                for i, key in enumerate(zip(k1[first:first + count].tolist(), k2[first:first + count].tolist(), strict=True)):
                    if key not in seen:
                        seen.add(key)
                        fresh[i] = True
                owner = np.repeat(np.arange(count), np.diff(text_words))
                if done:
                    kept = [x.values.to_numpy() if x.is_valid else None for x in listed[first:first + count]]
                    starts, names, _ = named(words, text_words, done, window)
                    alive = _alive(starts, names, text_words, kept, first)
                    starts = starts[alive]
                    if size:
                        all_starts, names, h = named(words, text_words, size, window)
                        at = np.unique(names[alive])
                    else:
                        at = starts
                else:
                    _, names, h = named(words, text_words, size, window)
                    at = np.unique(names)
                at = at[fresh[owner[at]]] if len(at) else at
                if not len(at):
                    continue
                text = owner[at]
                columns = [pa.array(k1[first + text]), pa.array(k2[first + text]),
                           pa.array((at - text_words[text]).astype(np.int32))]
                if size:
                    columns.append(pa.array(signed(h[at])))
                    yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "at", "h"])
                else:
                    columns.append(pa.array(signed(RunHash(words, BASE_B)(at, at + window))))
                    columns.append(pa.array(signed(RunHash(mix(words), BASE_A)(at, at + window))))
                    yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "at", "h", "g"])

    return write


def _repeated(rows: DataFrame, hashes: list[str]) -> DataFrame:
    """(k1, k2, at array): the positions whose hash occurs twice or more, per text key."""
    twice = rows.groupBy(*hashes).agg(F.count("*").alias("times")).filter("times > 1").select(*hashes)
    return rows.join(twice, hashes, "left_semi").groupBy("k1", "k2").agg(F.collect_list("at").alias("at"))


def _remover(window: int) -> Callable:
    """mapInArrow: drop the words covered by the windows listed in ``at``; all windows of copies."""
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed, copies = batch.column("at"), batch.column("copies").to_pylist()
            n_words, n_removed, sha, kept_text = [], [], [], []
            for first, data, starts, ends, text_words, _ in _texts(batch):
                raw = data.tobytes()
                for i in range(len(text_words) - 1):
                    a, b = int(text_words[i]), int(text_words[i + 1])
                    at = listed[first + i]
                    if copies[first + i] > 1:
                        begin = np.arange(max(0, b - a - window + 1))
                    else:
                        begin = at.values.to_numpy() if at.is_valid else np.empty(0, np.int64)
                    cover = np.zeros(b - a + 1, np.int64)
                    if len(begin):
                        cover += np.bincount(begin, minlength=b - a + 1)
                        cover -= np.bincount(begin + window, minlength=b - a + 1)
                    left = np.flatnonzero(np.cumsum(cover)[:-1] == 0) + a
                    kept = b" ".join([raw[s:e] for s, e in zip(starts[left].tolist(), ends[left].tolist(), strict=True)])
                    n_words.append(b - a)
                    n_removed.append(b - a - len(left))
                    sha.append(hashlib.sha256(kept).hexdigest())
                    kept_text.append(kept.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(kept_text, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return remove


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
                   levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept_text."""
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumns(
        {"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})
    texts = source.select("k1", "k2", "text")
    rows = texts.mapInArrow(_writer(window, None, levels[0]), "k1 bigint, k2 bigint, at int, h bigint")
    kept = stored(_repeated(rows, ["h"]), "level")
    for done, size in zip(levels, [*levels[1:], None], strict=True):
        schema = "k1 bigint, k2 bigint, at int, h bigint" + ("" if size else ", g bigint")
        rows = stored(texts.join(kept, ["k1", "k2"]).mapInArrow(_writer(window, done, size), schema), "windows")
        kept = stored(_repeated(rows, ["h"] if size else ["h", "g"]), "level")
    copies = source.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    answer = kept.join(copies.filter("copies > 1"), ["k1", "k2"], "full")
    return (source.join(answer, ["k1", "k2"], "left")
            .select("doc_id", "text", "at", F.coalesce("copies", F.lit(1)).alias("copies"))
            .mapInArrow(_remover(window),
                        "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"))
