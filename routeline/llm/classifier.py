"""Quality classifier: hashed word n-gram logistic regression, FTRL-proximal updates.

A text becomes tokens: runs of letters, of digits, and of other visible characters inside each
word, letters folded to lower case. A word written in capitals adds the token CAPS, a token equal
to the one before adds REPEAT in its place. Single tokens and neighbouring pairs are hashed into
``DIM`` weights; a text's features are its distinct hashes, each valued SCALE/sqrt(number of them),
so that long and short texts score on one scale, and a bias of 1. A score is the sigmoid of a sparse
dot product.

Training reads at most ``MAX_ROWS`` labelled rows (the first in the order of a hash of the id, a
documented bound) dealt to ``SHARDS`` tasks. Each shard runs FTRL-proximal over its rows in that
order and returns its weights with the number of rows; the shards' average starts the next of
``ROUNDS`` rounds. Models, not rows, pass through the driver: SHARDS x DIM numbers.

Defined cases: NULL or empty text has the bias as its only feature, and a score. A NULL label, or a
label without a document, isn't learned from. No labelled row: every score is 0.5. Repeated rows
get equal scores; repeated labels count each. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeline.llm.common import BASE_B, BYTE_VALUE, RunHash, mix, stored, text_chunks

DIM_BITS = 18
DIM = 1 << DIM_BITS
MAX_ROWS = 20_000
SHARDS, ROUNDS = 4, 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.001, 0.01
SCALE = 6.0
SEED = 20240501

_LETTER, _DIGIT, _OTHER, _SPACE = 1, 2, 3, 0
_CLASS = np.full(256, _LETTER, np.uint8)   # bytes of longer characters count as letters
_CLASS[:128] = _OTHER
_CLASS[:33] = _SPACE
_CLASS[127] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _LETTER
_CLASS[97:123] = _LETTER
_REPEAT, _CAPS = np.uint64(0x5245504541540001), np.uint64(0x4341505300000001)


def token_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per chunk: distinct feature indexes ordered by text, and where each text's begin.

    Index 0 is the bias and belongs to every text.
    """
    for _, data, offsets in text_chunks(texts):
        kind = _CLASS[data]
        fresh = np.ones(len(data), bool)
        fresh[1:] = kind[1:] != kind[:-1]
        # a run of marks is one token per repeated mark, however long
        begin = np.zeros(len(data) + 1, bool)
        begin[offsets] = True
        starts = np.flatnonzero((fresh | begin[:-1]) & (kind != _SPACE))
        stop = np.ones(len(data) + 1, bool)
        stop[:-1] = fresh
        stop |= begin
        edges = np.flatnonzero(stop)
        ends = edges[np.searchsorted(edges, starts, side="right")]
        upper = (data >= 65) & (data <= 90)
        folded = np.where(upper, data + np.uint8(32), data)
        tokens = RunHash(BYTE_VALUE[folded])(starts, ends)
        capital = np.concatenate([[0], np.cumsum(upper)])
        letters = kind[starts] == _LETTER
        shouted = letters & (capital[ends] - capital[starts] == ends - starts) & (ends - starts > 1)
        text_tokens = np.searchsorted(starts, offsets)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(text_tokens))
        same_text = np.zeros(len(tokens), bool)
        same_text[1:] = owner[1:] == owner[:-1]
        again = same_text.copy()
        again[1:] &= tokens[1:] == tokens[:-1]
        single = np.where(again, _REPEAT, tokens)
        previous = np.roll(tokens, 1)
        pair = mix(np.where(shouted, _CAPS, tokens) * np.uint64(BASE_B) + previous)[same_text]
        features = np.concatenate([mix(single), pair, mix(np.full(int(shouted.sum()), _CAPS)),
                                   np.zeros(len(offsets) - 1, np.uint64)])
        rows = np.concatenate([owner, owner[same_text], owner[shouted], np.arange(len(offsets) - 1)])
        index = (features >> np.uint64(64 - DIM_BITS)).astype(np.int64)
        key = np.unique(rows * DIM + index)
        rows, index = key // DIM, key % DIM
        yield index, np.searchsorted(rows, np.arange(len(offsets)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def values(index: np.ndarray) -> np.ndarray:
    """Feature values of one text; the bias (index 0, always first) is 1."""
    x = np.full(len(index), SCALE / np.sqrt(len(index)))
    x[0] = 1.0
    return x


def margin(weights: np.ndarray, index: np.ndarray) -> float:
    return float(weights[index] @ values(index))


def ftrl(index: list[np.ndarray], labels: np.ndarray, start: np.ndarray) -> np.ndarray:
    """One pass of follow-the-regularised-leader over the rows, from weights ``start``."""
    # z is set so that the first weights equal the starting ones
    n = np.zeros(DIM)
    z = -start * (BETA / ALPHA + L2) - np.sign(start) * L1
    for at, label in zip(index, labels.tolist(), strict=True):
        zi, ni = z[at], n[at]
        w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
        x = values(at)
        g = (float(sigmoid(w @ x)) - label) * x
        root = np.sqrt(ni + g * g)
        z[at] = zi + g - (root - np.sqrt(ni)) / ALPHA * w
        n[at] = ni + g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return np.where(n > 0, w, start)


def train(labels: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "label",
          max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights learned from the documents of at most ``max_rows`` labels.

    The sample is drawn from the labels, so it is small enough to broadcast (two numbers a row) and
    the documents are not shuffled for it.
    """
    spark = labels.sparkSession
    order = F.xxhash64(F.col(doc_id), F.lit(SEED))
    sample = stored(
        labels.filter(F.col(label).isNotNull())
        .select(F.col(doc_id).alias("__id"), order.alias("place"), F.col(label).cast("double").alias("label"))
        .orderBy("place", "label").limit(max_rows), "labels")
    texts = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = stored(texts.join(F.broadcast(sample), "__id").drop("__id").withColumn(
        "shard", F.pmod(F.col("place"), F.lit(SHARDS)).cast("int")), "labelled")
    weights = np.zeros(DIM)
    for _ in range(ROUNDS):
        got = rows.groupBy("shard").applyInPandas(
            _learner(spark.sparkContext.broadcast(weights)), "rows bigint, weights binary").collect()
        if not got:
            break
        total = sum(r["rows"] for r in got)
        weights = sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * (r["rows"] / total)
                      for r in sorted(got, key=lambda r: (r["rows"], bytes(r["weights"]))))
    return weights


def _learner(shared):
    """One shard's pass from the broadcast weights (DIM numbers)."""
    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["place", "text", "label"], kind="stable")
        index = [i[b[k]:b[k + 1]] for i, b in token_features(pa.array(frame["text"], pa.string()))
                 for k in range(len(b) - 1)]
        w = ftrl(index, frame["label"].to_numpy(), shared.value)
        return pd.DataFrame({"rows": [len(frame)], "weights": [w.astype(np.float32).tobytes()]})

    return learn


def scorer(weights: np.ndarray, spark):
    """Arrow UDF text -> probability of label 1."""
    shared = spark.sparkContext.broadcast(weights.astype(np.float32))

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = shared.value
        for part in parts:
            out = []
            for index, begin in token_features(part):
                total = np.add.reduceat(w[index].astype(np.float64), begin[:-1])
                bias = np.float64(w[0])
                out.append(sigmoid((total - bias) * SCALE / np.sqrt(np.diff(begin)) + bias))
            yield pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return score
