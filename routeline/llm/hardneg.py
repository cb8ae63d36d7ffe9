"""Hard-negative mining with an inverted multi-index, exact.

An anchor's positives are its best rows of the same label; its negatives for one positive are the best rows
of other labels whose score lies in a window below the positive's.

1. Vectors are cut into two halves. A codebook of CODES centres per half is fitted on a bounded sample. A row's
   cell is its nearest centre in each half.
2. All rows are dealt by hash into blocks of bounded size; anchors (also in blocks) meet every block. Within a
   block the rows are ordered by cell, and each centre has the radius of its own rows there.
3. For an anchor q, the score of a row in cell (i, j) is at most the sum of two half-scores q.c + |q| * radius.
   A heap per anchor (multi-sequence) yields the cells by falling bound. Anchors that reach a cell in the same
   round share one matrix product. A window is certified, and left, once its k-th best score is above the next bound or
   the next bound is below the window; an anchor ends when all its windows are left.
4. The blocks' best rows are merged: at most k rows of a block for each anchor and window.

Nothing is approximate: a bound never lies below a score, so a skipped cell holds no result, and the
sample only decides how early anchors stop. Vectors without structure have loose bounds; then all cells are
visited and the work is that of blocked matrix products.

Defined cases: rows with a NULL label or vector, a NULL or non-finite component, or a length other than the most
frequent one (ties: the shorter) take no part. Vectors hold whole numbers; scores must fit 64 bits. Ties go to
the smaller id, NULL ids last, then to the earlier row. Rows that repeat an id are rows of their own, and each
repeated anchor row is mined. Too few rows: all there are. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeline.llm.common import stored

CODES = 8                # centres per half
SAMPLE_ROWS = 2048       # rows the codebooks are fitted on
BLOCK_ROWS = 1 << 16     # rows a block
LEAST_BLOCKS = 8
ANCHOR_ROWS = 1 << 15    # anchors a block
ANCHORS_AT_ONCE = 256    # anchors whose heaps advance together
ROUNDS = 8               # Lloyd rounds
NO_ID = np.iinfo(np.int64).max


# ---- index --------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Codebooks:
    """Centres of the first and of the second half of a vector."""

    first: np.ndarray
    second: np.ndarray

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return vectors[:, :cut], vectors[:, cut:]


def nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    if not vectors.shape[1]:
        return np.zeros(len(vectors), dtype=np.int64)
    return ((centres * centres).sum(1) - 2 * (vectors @ centres.T)).argmin(1)


def _centres(vectors: np.ndarray, codes: int) -> np.ndarray:
    centres = vectors[np.linspace(0, len(vectors) - 1, codes).astype(int)].copy()
    for _ in range(ROUNDS):
        own = nearest(vectors, centres)
        for c in range(codes):
            if (own == c).any():
                centres[c] = vectors[own == c].mean(0)
    return centres


def fit_codebooks(sample: np.ndarray, codes: int = CODES) -> Codebooks:
    cut = (sample.shape[1] + 1) // 2
    return Codebooks(_centres(sample[:, :cut], codes), _centres(sample[:, cut:], codes))


class Block:
    """Rows ordered by cell, with the cells' ranges and the centres' radii."""

    def __init__(self, vectors: np.ndarray, books: Codebooks):
        self.books = books
        codes = len(books.first)
        halves = [(half, nearest(half, centres), centres)
                  for half, centres in zip(books.halves(vectors), (books.first, books.second), strict=True)]
        cell = halves[0][1] * codes + halves[1][1]
        self.order = np.argsort(cell, kind="stable")
        self.starts = np.searchsorted(cell[self.order], np.arange(codes * codes + 1))
        self.radii = []
        for half, own, centres in halves:
            radius = np.full(codes, -np.inf)  # a centre without rows is never reached
            np.maximum.at(radius, own, np.sqrt(((half - centres[own]) ** 2).sum(1)))
            self.radii.append(radius)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds of the half-scores, anchors by centres."""
        out = []
        for half, centres, radius in zip(
                self.books.halves(queries), (self.books.first, self.books.second), self.radii, strict=True):
            norm = np.sqrt((half * half).sum(1))[:, None]
            reach = norm * np.where(np.isfinite(radius), radius, 0.0)
            bound = half @ centres.T + reach
            bound += 1e-9 * (np.abs(bound) + norm * np.sqrt((centres * centres).sum(1))) + 1e-3  # rounding
            out.append(np.where(np.isfinite(radius), bound, -np.inf))
        return out[0], out[1]


class Visits:
    """Cells by falling sum of the half bounds: the multi-sequence algorithm."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.rows, self.columns = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        self.first, self.second = first[self.rows].tolist(), second[self.columns].tolist()
        self.heap, self.pushed = [], set()
        self._push(0, 0)

    def _push(self, i: int, j: int) -> None:
        if i < len(self.first) and j < len(self.second) and (i, j) not in self.pushed:
            bound = self.first[i] + self.second[j]
            if bound > -np.inf:
                self.pushed.add((i, j))
                heapq.heappush(self.heap, (-bound, i, j))

    @property
    def bound(self) -> float:
        """No row of a cell not yet visited has a higher score."""
        return -self.heap[0][0] if self.heap else -np.inf

    def take(self) -> int:
        _, i, j = heapq.heappop(self.heap)
        self._push(i + 1, j)
        self._push(i, j + 1)
        return int(self.rows[i]) * len(self.second) + int(self.columns[j])


class Best:
    """The best ``k`` (score, id, row) of each score window of one anchor."""

    def __init__(self, windows: list[tuple[int, int]], k: int):
        self.k, self.windows = k, windows
        self.found = [np.zeros((0, 3), dtype=np.int64) for _ in windows]
        self.least = [low for low, _ in windows]   # scores below can't enter any more
        self.highest = max(high for _, high in windows)

    def add(self, rows: np.ndarray) -> None:
        for w, (_, high) in enumerate(self.windows):
            new = rows[(rows[:, 0] >= self.least[w]) & (rows[:, 0] <= high)]
            if len(new):
                both = np.concatenate([self.found[w], new])
                self.found[w] = both = both[np.lexsort((both[:, 2], both[:, 1], -both[:, 0]))[:self.k]]
                if len(both) == self.k:
                    self.least[w] = int(both[-1, 0])

    @property
    def lowest(self) -> int:
        return min(self.least)

    def certified(self, bound: float) -> bool:
        """Whether rows of at most this score change nothing: a row that ties with the last could still have a smaller id."""
        return all(least > bound for least in self.least)


def _exact(vectors: np.ndarray, largest: float) -> np.ndarray:
    """The type in which inner products of at most ``largest`` are whole numbers without rounding."""
    return vectors.astype(np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64)


def search(queries: np.ndarray, query_labels: np.ndarray, query_rows: np.ndarray, windows: list, k: int, same: bool,
           vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, books: Codebooks) -> list[Best]:
    """The best rows of one block for each query and window, of the query's label (``same``) or of others."""
    block = Block(vectors, books)
    first, second = block.bounds(queries)
    norm = lambda m: float(np.sqrt((m * m).sum(1)).max(initial=0.0))
    largest = norm(queries) * norm(vectors)
    at = block.order
    vectors, ids, labels, rows = _exact(vectors, largest)[at], ids[at], labels[at], rows[at]
    queries = _exact(queries, largest)
    best = [Best(w, k) for w in windows]
    for start in range(0, len(queries), ANCHORS_AT_ONCE):
        active = {q: Visits(first[q], second[q]) for q in range(start, min(start + ANCHORS_AT_ONCE, len(queries)))}
        cells = 1
        while active:
            reached = defaultdict(list)
            for q, visits in active.items():
                for _ in range(cells):
                    if best[q].certified(visits.bound):
                        break
                    reached[visits.take()].append(q)
            found = defaultdict(list)
            for cell, who in reached.items():
                low, high = block.starts[cell], block.starts[cell + 1]
                if low == high:
                    continue
                scores = queries[who] @ vectors[low:high].T
                fits = (labels[low:high] == query_labels[who][:, None]) == same
                fits &= scores >= np.array([best[q].lowest for q in who])[:, None]
                fits &= scores <= np.array([best[q].highest for q in who])[:, None]
                if same:
                    fits &= rows[low:high] != query_rows[who][:, None]
                for i in np.flatnonzero(fits.any(1)):
                    hit = np.flatnonzero(fits[i])
                    found[who[i]].append(np.column_stack([
                        scores[i, hit].astype(np.int64), ids[low:high][hit], rows[low:high][hit]]))
            for q, parts in found.items():
                best[q].add(np.concatenate(parts))
            active = {q: v for q, v in active.items() if not best[q].certified(v.bound)}
            cells *= 2
    return best


# ---- on Spark -----------------------------------------------------------------------------------

HIT_SCHEMA = "anchor long, window int, score long, id long, row long"
ANY = (-(1 << 62), 1 << 62)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _searcher(books: Codebooks, k: int, same: bool, windows_of: Callable[[list[int]], list[tuple[int, int]]]):
    """Search of one block for one block of anchors, whose score windows follow from their ``scores``."""
    def meet(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(
                ("anchor", "window", "score", "id", "row"), (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)})
        windows = [windows_of(scores) for scores in anchors["scores"].to_pylist()]
        numbers = lambda c: c.to_numpy()
        query_rows = numbers(anchors["row"])
        best = search(_matrix(anchors["vector"]), numbers(anchors["label"]), query_rows, windows, k, same,
                      _matrix(rows["vector"]), numbers(rows["id"].fill_null(NO_ID)), numbers(rows["label"]),
                      numbers(rows["row"]), books)
        hits = [(query_rows[q], w, part) for q, b in enumerate(best) for w, part in enumerate(b.found)]
        sizes = [len(part) for *_, part in hits]
        all_hits = np.concatenate([part for *_, part in hits])
        return pa.table({
            "anchor": np.repeat([a for a, _, _ in hits], sizes).astype(np.int64),
            "window": np.repeat([w for _, w, _ in hits], sizes).astype(np.int32),
            "score": all_hits[:, 0], "id": pa.array(all_hits[:, 1], mask=all_hits[:, 1] == NO_ID), "row": all_hits[:, 2]})
    return meet


def _searched(anchors: DataFrame, rows: DataFrame, blocks: int, anchor_blocks: int, meet, k: int) -> DataFrame:
    """(anchor, window, score, id, row, rank): the best ``k`` rows over all blocks."""
    # every row's block meets every block of the stated anchors; neither side is replicated beyond the other's blocks
    queries = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = rows.withColumn("anchor_block", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))
    by, parts = ("anchor_block", "block"), min(2 * blocks * anchor_blocks, 20_000)
    hits = (queries.repartition(parts, *by).groupBy(*by).cogroup(dealt.repartition(parts, *by).groupBy(*by))
            .applyInArrow(meet, HIT_SCHEMA))
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def usable(vector: Column) -> Column:
    """Whether no component is NULL, NaN or infinite; NULL for a NULL vector."""
    wide = lambda x: x.cast("double")
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(wide(x)) & (F.abs(wide(x)) < float("inf")))


def mine(vectors: DataFrame, is_anchor: Column, row_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90,
         block_rows: int = BLOCK_ROWS, codes: int = CODES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` hold whole numbers. ``is_anchor`` states the queries over its columns. A negative of a positive with score p
    satisfies low_percent * p <= 100 * score <= high_percent * p.
    """
    rows = stored(vectors.filter(F.col(label).isNotNull() & F.col(vector).isNotNull() & usable(F.col(vector))).select(
        F.monotonically_increasing_id().alias("row"), F.col(row_id).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")), "vectors")
    lengths = rows.filter(F.size("vector") > 0).groupBy(F.size("vector").alias("length")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("anchors"))
    common = lengths.orderBy(F.desc("n"), "length").first()
    length, n, n_anchors = (common["length"], common["n"], common["anchors"]) if common else (0, 0, 0)
    blocks, anchor_blocks = max(LEAST_BLOCKS, -(-n // block_rows)), max(1, -(-n_anchors // ANCHOR_ROWS))
    rows = rows.filter(F.size("vector") == length)
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS).select("vector").collect()
    books = fit_codebooks(np.array([r["vector"] for r in sample], dtype=np.float64).reshape(len(sample), length)
                          if sample else np.zeros((1, 1)), codes)
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    dealt = rows.withColumn("block", deal(blocks)).select("row", "id", "label", "vector", "block")
    anchors = stored(rows.filter("is_anchor").withColumn("anchor_block", deal(anchor_blocks)).select(
        "row", "id", "label", "vector", "anchor_block"), "anchors")
    def below(scores: list[int]) -> list[tuple[int, int]]:
        return [(-(-low_percent * p // 100), high_percent * p // 100) for p in scores]

    none = F.array().cast("array<bigint>").alias("scores")
    found = _searched(anchors.select("*", none), dealt, blocks, anchor_blocks,
                      _searcher(books, positives, True, lambda scores: [ANY]), positives)
    chosen = stored(found.select("anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"),
                                 F.col("score").alias("positive_score")), "positives")
    scores = chosen.groupBy(F.col("anchor").alias("row")).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("window", "positive_score"))), lambda p: p["positive_score"]).alias("scores"))
    found = _searched(anchors.join(scores, "row"), dealt, blocks, anchor_blocks,
                      _searcher(books, negatives, False, below), negatives)
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(chosen, ["anchor", "window"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
