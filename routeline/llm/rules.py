"""Quality rules under weak supervision.

Each rule looks at one figure of a text and votes good, votes bad, or abstains. Nobody says which
rules are right: expectation-maximisation over all texts estimates, for each rule, how often it
votes each way on good and on bad texts, and the share of good texts. A text is then kept by its
posterior probability of being good given all its votes, so no single rule decides alone.

The figures come from one pass over the texts. The votes of all texts are counted per distinct
pattern (at most 3^rules of them, whatever the corpus), and EM runs on those counts.

Fixed failures (too few words, too many repeated five-word windows) drop a text before any vote; the
estimates leave those texts out.

Defined cases: NULL or blank text: no words, every figure 0, failed and not kept. One-sided votes
(no text voted on a rule) leave that rule at its starting accuracy. Empty table: empty result.
Repeated rows get equal answers and each counts in the estimates. Other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeline.llm.common import (
    BASE_B, BYTE_VALUE, RunHash, span_hash, text_chunks, windows, word_hashes, word_spans,
)

MIN_WORDS = 10
REPEAT_WINDOW = 5
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"[#*$%&|<>]"
STEPS = 50
PRIOR_VOTES = 10.0     # strength of the starting accuracies, in texts
START_GOOD_RIGHT = 0.99  # votes on good texts that are for good
START_BAD_RIGHT = 0.2    # votes on bad texts that are for bad: a bad text has one defect or two
START_GOOD = 0.8
THRESHOLD = 0.5

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
           "n_letters", "n_digits", "n_stop")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False     # continuation bytes
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[offsets])


def figures(texts: pa.Array) -> Iterator[dict[str, np.ndarray]]:
    """The figures of each text, a chunk of texts at a time."""
    for _, data, offsets in text_chunks(texts):
        starts, ends, text_words = word_spans(data, offsets)
        n = len(offsets) - 1
        owner = np.repeat(np.arange(n), np.diff(text_words))
        inside = np.concatenate([[0], np.cumsum(_LEAD[data], dtype=np.int64)])
        word_chars = np.bincount(owner, inside[ends] - inside[starts], n).astype(np.int64)
        words = word_hashes(data, starts, ends)

        # words covered by a five-word window that is found twice or more in its text
        at = windows(text_words, REPEAT_WINDOW)
        h = span_hash(words, at, at + REPEAT_WINDOW, BASE_B)
        order = np.lexsort((h, owner[at]))
        same = (h[order][1:] == h[order][:-1]) & (owner[at][order][1:] == owner[at][order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cover = (np.bincount(at[twice], minlength=len(words) + 1)
                 - np.bincount(at[twice] + REPEAT_WINDOW, minlength=len(words) + 1))
        repeated = np.cumsum(cover)[:-1] > 0

        # lines with a word, equal to an earlier line of the text
        line_break = data == 10
        line_start = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(line_break) + 1]))
        line_start = line_start[line_start < len(data)]
        line_end = np.append(line_start[1:], len(data))[:len(line_start)]
        closed = line_end - 1
        line_end = np.where(line_break[closed], closed, line_end) if len(closed) else line_end
        line_text = np.searchsorted(offsets, line_start, side="right") - 1
        has_word = np.searchsorted(starts, line_start) < np.searchsorted(starts, line_end)
        line_start, line_end, line_text = line_start[has_word], line_end[has_word], line_text[has_word]
        lh = RunHash(BYTE_VALUE[data])(line_start, line_end)
        order = np.lexsort((np.arange(len(lh)), lh, line_text))
        dup = np.zeros(len(lh), bool)
        dup[order[1:]] = (lh[order][1:] == lh[order][:-1]) & (line_text[order][1:] == line_text[order][:-1])
        short = (inside[ends] - inside[starts]) <= 3
        yield {
            "n_words": np.diff(text_words), "word_chars": word_chars,
            "n_symbols": _per_text(_SYMBOL[data], offsets),
            "n_dup_lines": np.bincount(line_text[dup], minlength=n),
            "n_repeat_words": np.bincount(owner[repeated], minlength=n),
            "n_lines": np.bincount(line_text, minlength=n),
            "n_upper": _per_text(_UPPER[data], offsets),
            "n_letters": _per_text(_ASCII_LETTER[data], offsets),
            "n_digits": _per_text(_DIGIT[data], offsets),
            "n_stop": np.bincount(owner[short], minlength=n),
        }


def measure(text: Column) -> Column:
    """The figures of a text as a struct."""
    @F.arrow_udf("struct<" + ",".join(f"{name}:bigint" for name in FIGURES) + ">")
    def measured(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            chunks = list(figures(part))
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate([c[name] for c in chunks]) if chunks else np.empty(0), pa.int64())
                 for name in FIGURES], names=list(FIGURES))

    return measured(text.cast("string"))


@dataclass(frozen=True)
class Rule:
    """Votes good below ``good``, bad above ``bad``, abstains between and without a base."""
    name: str
    part: str
    whole: str
    good: float
    bad: float


RULES = (
    Rule("symbols_per_word", "n_symbols", "n_words", 0.05, 0.3),
    Rule("symbols_per_character", "n_symbols", "word_chars", 0.01, 0.06),
    Rule("capitals", "n_upper", "n_letters", 0.15, 0.5),
    Rule("repeated_words", "n_repeat_words", "n_words", 0.1, 0.2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.2, 0.6),
    Rule("digits", "n_digits", "word_chars", 0.05, 0.4),
    Rule("word_length", "word_chars", "n_words", 9.0, 15.0),
)


def vote(rule: Rule) -> Column:
    """1 good, -1 bad, 0 abstain."""
    share = F.try_divide(F.col(rule.part).cast("double"), F.col(rule.whole).cast("double"))
    return F.when(F.col(rule.whole) < 1, 0).when(share <= rule.good, 1).when(share >= rule.bad, -1).otherwise(0)


@dataclass
class Estimates:
    good: float            # share of good texts
    votes: np.ndarray      # rules x (bad, good text) x (bad, good vote), abstentions aside

    def evidence(self, rule: int, given: int) -> float:
        """What a vote adds to the log odds of a good text."""
        if given == 0:
            return 0.0
        side = int(given > 0)
        return math.log(self.votes[rule, 1, side]) - math.log(self.votes[rule, 0, side])

    def posterior(self, pattern: tuple[int, ...]) -> float:
        odds = math.log(self.good / (1 - self.good)) + sum(self.evidence(r, v) for r, v in enumerate(pattern))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def estimate(patterns: dict[tuple[int, ...], int], rules: int, steps: int = STEPS) -> Estimates:
    """EM over counted vote patterns."""
    prior = np.empty((rules, 2, 2))
    prior[:, 1] = [1 - START_GOOD_RIGHT, START_GOOD_RIGHT]
    prior[:, 0] = [START_BAD_RIGHT, 1 - START_BAD_RIGHT]
    keys = sorted(patterns)
    count = np.array([patterns[k] for k in keys], dtype=float)
    seen = np.array(keys, dtype=int).reshape(len(keys), rules)
    now = Estimates(START_GOOD, prior.copy())
    for _ in range(steps if len(keys) else 0):
        p = np.array([now.posterior(k) for k in keys])
        votes = prior * PRIOR_VOTES
        for side, weight in ((1, p * count), (0, (1 - p) * count)):
            for r in range(rules):
                votes[r, side, 0] += weight[seen[:, r] < 0].sum()
                votes[r, side, 1] += weight[seen[:, r] > 0].sum()
        good = ((p * count).sum() + START_GOOD * PRIOR_VOTES) / (count.sum() + PRIOR_VOTES)
        now = Estimates(float(good), votes / votes.sum(axis=2, keepdims=True))
    return now


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the figures, ``base_failed``, ``quality_p`` (posterior) and ``kept`` to every row."""
    votes = F.array(*[vote(r) for r in rules])
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    figures_ = docs.drop(*FIGURES).withColumn("__figures", measure(F.col(text)))
    rated = (figures_.withColumns({name: F.col(f"__figures.{name}") for name in FIGURES}).drop("__figures")
             .withColumn("base_failed", failed).withColumn("quality_votes", votes))
    counted = (docs.select(measure(F.col(text)).alias("f")).select("f.*")
               .filter(~failed).groupBy(votes.alias("votes")).count().collect())  # at most 3^rules rows
    patterns = {tuple(r["votes"]): r["count"] for r in counted}
    model = estimate(patterns, len(rules))
    odds = F.lit(math.log(model.good / (1 - model.good)))
    for r in range(len(rules)):
        given = F.array(*[F.lit(float(model.evidence(r, v))) for v in (-1, 0, 1)])
        odds = odds + F.element_at(given, F.col("quality_votes")[r] + 2)
    posterior = F.when(F.col("n_words") > 0, 1 / (1 + F.exp(-odds))).otherwise(0.0)
    return rated.withColumn("quality_p", posterior).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality_p") >= THRESHOLD))
