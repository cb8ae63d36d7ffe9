"""Language spans of mixed-language text: script narrowing, per-word scores, Viterbi decoding.

A model holds, per language, log probabilities of hashed letter trigrams and the share of each
script among its letters. A word (maximal run of letters) may only take languages that write its
script; its score per language is the sum over its trigrams. A Viterbi pass over the words of a
text, with a fixed penalty for each change of language, labels spans. Texts in which no stretch of
words gains the penalty in another language are recognised by a running-minimum test; for them the
best path is the constant one, so the pass itself runs only over texts that may switch.

Training counts trigrams inside each task (languages x buckets numbers) and adds them up in one
small aggregate; the model is bounded by languages x buckets, whatever the corpus.

Defined cases: NULL text, or no letter: ``und``, score 0, no spans. NULL language or NULL text: not
learned from. No training row at all: every text is ``und``. Ties go to the first language by code
point. Repeated rows get equal answers. Other columns pass through untouched unless they carry the
name of an output column, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
SWITCH_PENALTY = 15.0
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
CHUNK_CHARS = 1 << 19

# First and last code point of each script's blocks.
SCRIPT_RANGES = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
}
SCRIPTS = [*SCRIPT_RANGES, "other"]

_tables: dict[str, np.ndarray] = {}


def _table(name: str) -> np.ndarray:
    """Per code point: is it a letter; which script. Built once per Python worker."""
    if not _tables:
        _tables["letter"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        script = np.full(0x110000, len(SCRIPTS) - 1, np.uint8)
        for i, ranges in enumerate(SCRIPT_RANGES.values()):
            for first, last in ranges:
                script[first:last + 1] = i
        _tables["script"] = script
    return _tables[name]


@dataclass
class Model:
    langs: list[str]
    log_p: np.ndarray     # buckets x languages
    allowed: np.ndarray   # scripts x languages


@dataclass
class Words:
    """The words of a run of texts: trigram buckets by letter, and where words and texts begin."""
    buckets: np.ndarray
    first_letter: np.ndarray  # per word, into buckets
    start: np.ndarray         # per word, code points into its text
    length: np.ndarray
    script: np.ndarray
    text_words: np.ndarray    # per text, into words (one more at the end)


def read_words(texts: list[str]) -> Words:
    # one separator after each text keeps trigrams and words inside it
    lowered = [t.lower() if len(t.lower()) == len(t) else "".join(c.lower()[:1] for c in t) for t in texts]
    flat = np.frombuffer(("\x00".join(lowered) + "\x00").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    starts = np.concatenate([[0], ends[:-1]])
    letter = _table("letter")[flat]
    x = np.where(letter, flat, 0).astype(np.uint64)
    before = np.concatenate([[np.uint64(0)], x[:-1]])
    after = np.concatenate([x[1:], [np.uint64(0)]])
    at = np.flatnonzero(letter)
    h = (before[at] * np.uint64(0x9E3779B97F4A7C15) + x[at] * np.uint64(0xC2B2AE3D27D4EB4F)
         + after[at] * np.uint64(0x165667B19E3779F9))
    buckets = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)
    first = np.flatnonzero(before[at] == 0)
    position = at[first]
    text_words = np.searchsorted(position, np.append(starts, len(flat)))
    owner = np.repeat(np.arange(len(texts)), np.diff(text_words))
    return Words(buckets, first, position - starts[owner],
                 np.diff(np.append(first, len(at))), _table("script")[flat[position]], text_words)


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK_CHARS characters."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > CHUNK_CHARS:
            yield first, i
            first, size = i, 0
        size += len(t or "") + 1
    if first < len(texts):
        yield first, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in _runs(texts):
            words = read_words([t or "" for t in texts[a:b]])
            owner = np.repeat(np.arange(b - a), np.diff(words.text_words))
            codes = sorted(set(langs[a:b]))
            code = np.array([codes.index(x) for x in langs[a:b]])
            by_letter = np.repeat(code[owner], words.length) if len(owner) else np.empty(0, int)
            for i, lang in enumerate(codes):
                have = grams.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                have[:BUCKETS] += np.bincount(words.buckets[by_letter == i], minlength=BUCKETS)
                mine = code[owner] == i
                have[BUCKETS:] += np.bincount(
                    words.script[mine], words.length[mine], len(SCRIPTS)).astype(np.int64)
    for lang, have in grams.items():
        at = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(have[at], pa.int64())],
            names=["lang", "bucket", "n"])


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from every row with a language and a text."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).dropna()
    counts = (rows.mapInArrow(_count, "lang string, bucket bigint, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(counts["lang"].to_pylist()))
    total = np.zeros((BUCKETS + len(SCRIPTS), len(langs)))
    index = {name: i for i, name in enumerate(langs)}
    lang_at = np.array([index[x] for x in counts["lang"].to_pylist()], dtype=int)
    total[counts["bucket"].to_numpy(), lang_at] = counts["n"].to_numpy()
    grams, scripts = total[:BUCKETS] + 0.5, total[BUCKETS:]
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    return Model(langs, np.log(grams / grams.sum(axis=0)).astype(np.float32), share >= SCRIPT_SHARE)


def _scores(words: Words, model: Model) -> np.ndarray:
    """Words x languages. A script no language writes gives no evidence: all zero."""
    if not len(words.first_letter):
        return np.zeros((0, len(model.langs)))
    s = np.add.reduceat(model.log_p[words.buckets], words.first_letter, axis=0).astype(np.float64)
    allowed = model.allowed[words.script]
    s[~allowed.any(axis=1)] = 0
    return s - np.where(allowed | ~allowed.any(axis=1)[:, None], 0, 50.0 * words.length[:, None])


def _may_switch(s: np.ndarray, best: int, penalty: float) -> bool:
    """Whether a path may beat the constant one in the best language.

    A path that uses ``best`` has a switch for every other stretch, so one stretch must gain more
    than a switch costs. One that never does has a switch at least, and can't do better than the
    best other language at every word.
    """
    others = np.delete(s, best, axis=1)
    if others.shape[1] > 1 and others.max(axis=1).sum() - penalty > s[:, best].sum():
        return True
    run = np.cumsum(s - s[:, best:best + 1], axis=0)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, s.shape[1])), run[:-1]]), axis=0)
    return bool((run - low).max() > penalty)


def viterbi(s: np.ndarray, penalty: float) -> np.ndarray:
    """Best language per word when each change costs ``penalty``; ties to the lower index."""
    n, k = s.shape
    back = np.empty((n, k), np.int32)
    rows = s.tolist()
    value, stay = rows[0], list(range(k))
    for i in range(1, n):
        top = max(value)
        leader, top = value.index(top), top - penalty
        keep = [v >= top for v in value]
        back[i] = [j if keep[j] else leader for j in stay]
        value = [(value[j] if keep[j] else top) + rows[i][j] for j in stay]
    path = np.empty(n, np.int64)
    path[-1] = value.index(max(value))
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def label(text_words: Words, s: np.ndarray, i: int, penalty: float) -> np.ndarray:
    own = s[text_words.text_words[i]:text_words.text_words[i + 1]]
    best = int(own.sum(axis=0).argmax())
    if _may_switch(own, best, penalty):
        return viterbi(own, penalty)
    return np.full(len(own), best)


OUT = "struct<lang:string,score:double,spans:array<struct<start:int,end:int,lang:string>>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def detector(model: Model, spark, penalty: float = SWITCH_PENALTY):
    """An Arrow UDF text -> (lang, score, spans).

    ``lang`` covers the most letters, ``score`` is its share of the letters, ``spans`` are code
    point ranges from the first to the end of the last word of each stretch.
    """
    shared = spark.sparkContext.broadcast(model)  # languages x buckets numbers

    @F.arrow_udf(OUT)
    def detect(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for part in parts:
            texts = part.to_pylist()
            lang, score, spans = [], [], []
            for a, b in _runs(texts):
                words = read_words([t or "" for t in texts[a:b]])
                s = _scores(words, m) if m.langs else None
                for i in range(b - a):
                    lo, hi = words.text_words[i], words.text_words[i + 1]
                    if lo == hi or s is None:
                        lang.append(UNKNOWN), score.append(0.0), spans.append([])
                        continue
                    path = label(words, s, i, penalty)
                    length = words.length[lo:hi]
                    letters = np.bincount(path, length, len(m.langs))
                    top = int(letters.argmax())
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [hi - lo]])
                    end = words.start[lo:hi] + length
                    lang.append(m.langs[top])
                    score.append(float(letters[top] / letters.sum()))
                    spans.append([{"start": int(words.start[lo + p]), "end": int(end[q - 1]), "lang": m.langs[path[p]]}
                                  for p, q in zip(cut[:-1], cut[1:], strict=True)])
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, _SPAN)],
                names=["lang", "score", "spans"])

    return detect


def identify(docs: DataFrame, model: Model, text: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Add ``lang_pred``, ``lang_score`` and ``lang_spans`` to every row."""
    found = detector(model, docs.sparkSession, penalty)(F.col(text).cast("string"))
    return (docs.withColumn("lang_found", found)
            .withColumns({"lang_pred": F.col("lang_found.lang"), "lang_score": F.col("lang_found.score"),
                          "lang_spans": F.col("lang_found.spans")}).drop("lang_found"))
