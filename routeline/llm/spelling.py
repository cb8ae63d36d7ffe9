"""Spelling variants by blocked Gram matrices of letter counts.

1. Words are counted over all texts (combined map-side, so a frequent word is a few partial sums).
2. A word's block is its length and its numbers of letters of each class of CLASSES. One edit moves a word to an
   adjacent block: a replaced letter leaves the length and moves at most one unit from one class to another
   (letters of no class count as one more), an inserted letter adds one to the length and to one class at most.
   So pairs one edit apart meet in the task of their blocks' componentwise minimum, to which each word goes in
   2 * classes + 2 roles; of two roles only those pairs that one edit can make are multiplied.
3. With A and B the letter counts of two blocks, |a|^2 + |b|^2 - 2 A B' are all squared distances at once, from
   one product. One inserted or deleted letter makes 1, a replaced one 2, so pairs of at most 2 include every
   pair one edit apart; only those go on, and their letters are compared.
4. A word's form is its most frequent near word if at least twice as frequent. Along forms the count at
   least doubles, so a chain has fewer than 64 steps and six rounds of pointer doubling reach every root.

No candidate is missed, and only near pairs are emitted. A task with more than ROOM words is dealt by hash into
parts, and each pair of parts is a task of its own, so tasks stay bounded if one block holds a third of all words.

Defined cases: NULL and empty texts have no words. A NULL id counts as the empty text in the hash. Ties of
forms go to the word smallest in code-point order. Repeated rows count each. Empty table: empty result. Only
the named columns are read, so others may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeline.llm.common import stored

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT = 5, 3
FACTOR = 2               # a form is at least so many times as frequent
# Letters whose numbers choose a block. Any classes give the same result; alike frequent ones spread best.
CLASSES = ("ei", "nas", "otr")
ROOM = 1 << 16           # words that meet in one task
LETTERS = 1 << 24        # and letters, for very long words
TASK_ROWS = 50_000       # rows a task is planned for
CELLS = 1 << 22          # distances at once
CHAIN_ROUNDS = 6         # 2 ** 6 steps, more than a 64-bit count can double


def count_words(docs: DataFrame, text: str = "text", key: str = "doc_id", damage: int | None = None,
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of lower-cased letter runs.

    With ``damage``, a run whose crc32 of ``<key>:<run>`` is divisible by it loses the code point at
    crc32 % length first: planted misspellings.
    """
    word = F.explode(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(RUN), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), word.alias("word"))
    if damage:
        h = F.crc32(F.concat(F.col("key"), F.lit(":"), F.col("word")))
        at = (F.col("h") % F.char_length("word")).cast("int")
        cut = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.char_length("word")))
        runs = runs.select("word", h.alias("h")).select(
            F.when(F.col("h") % damage == 0, cut).otherwise(F.col("word")).alias("word"))
    return runs.filter(F.char_length("word") >= least_length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


# ---- blocks --------------------------------------------------------------------------------------

def _letters(words: list[str], length: int) -> np.ndarray:
    """Code points, one row a word; the words have one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(-1, length)


def letter_counts(letters: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    n, size = len(letters), len(alphabet)
    at = np.searchsorted(alphabet, letters) + np.arange(n)[:, None] * size
    kind = np.float32 if letters.shape[1] < 2048 else np.float64  # sums of squares stay exact
    return np.bincount(at.ravel(), minlength=n * size).reshape(n, size).astype(kind)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """|a|^2 + |b|^2 - 2 a b' of all rows, as one matrix product."""
    one = lambda m: np.ones((len(m), 1), m.dtype)
    norm = lambda m: (m * m).sum(1, keepdims=True)
    return np.hstack([-2 * a, norm(a), one(a)]) @ np.hstack([b, one(b), norm(b)]).T


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row i of ``a`` becomes row i of ``b`` by one replaced or one inserted code point."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= length


def near_pairs(a: np.ndarray, b: np.ndarray, counts_a: np.ndarray, counts_b: np.ndarray,
               same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs one edit apart; of one block with itself (``same``) each pair once."""
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step, some = max(1, CELLS // max(len(b), 1)), max(1, CELLS // a.shape[1])
    for start in range(0, len(a) if len(b) else 0, step):
        left, right = np.nonzero(squared_distances(counts_a[start:start + step], counts_b) <= 2)
        left += start
        if same:
            left, right = left[left < right], right[left < right]
        for i in range(0, len(left), some):
            x, y = left[i:i + some], right[i:i + some]
            near = one_edit(a[x], b[y])
            lefts.append(x[near])
            rights.append(y[near])
    return np.concatenate(lefts), np.concatenate(rights)


def meetings(classes: int) -> list[tuple[int, int]]:
    """Pairs of roles that one edit can make. Role 0 is the task's own block, role i has one more letter of
    class i, role classes + 1 one more letter of no class, role classes + 1 + i one more of class i (and so
    one more in length)."""
    more, longer = range(1, classes + 1), range(classes + 1, 2 * classes + 2)
    return [(0, 0), *[(0, i) for i in more], *[(i, j) for i in more for j in more if i < j], *[(0, k) for k in longer]]


NEAR_SCHEMA = "word string, near string, near_n bigint"


def _meet(classes: int):
    def meet(key: tuple, group: pa.Table) -> pa.Table:
        """Near pairs of one task, in both directions."""
        length, one_part = key[0].as_py(), key[-2] == key[-1]
        group = group.take(pc.sort_indices(group["role"]))
        words, n = np.array(group["word"].to_pylist(), dtype=object), group["n"].to_numpy()
        part = group["part"].to_numpy()
        begin = np.searchsorted(group["role"].to_numpy(), np.arange(2 * classes + 3))
        cut = begin[classes + 1]
        short, long = _letters(words[:cut], length), _letters(words[cut:], length + 1)
        alphabet = np.union1d(short, long)
        counts = [letter_counts(m, alphabet) for m in (short, long)]
        # rows of a role; the long ones count from the first long row
        rows = [np.arange(begin[r], begin[r + 1]) - (cut if r > classes else 0) for r in range(2 * classes + 2)]
        found = []
        for r, s in meetings(classes):
            side = int(s > classes)
            for p, q in ([(None, None)] if one_part else [(0, 1), (1, 0)] if (r, s) != (0, 0) else [(0, 1)]):
                x = rows[r] if p is None else rows[r][part[rows[r]] == p]
                y = rows[s] if q is None else rows[s][part[rows[s] + side * cut] == q]
                if len(x) and len(y):
                    i, j = near_pairs(short[x], (short, long)[side][y], counts[0][x], counts[side][y],
                                      (r, s) == (0, 0) and one_part)
                    found.append((x[i], y[j] + side * cut))
        i = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
        j = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        return pa.table([pa.array(words[a], pa.string()), pa.array(words[b], pa.string()), pa.array(n[b], pa.int64())],
                        names=["word", "near", "near_n"])
    return meet


def near_words(words: DataFrame, classes: tuple[str, ...] = CLASSES, room: int = ROOM, letters: int = LETTERS) -> DataFrame:
    """(word, near, near_n) for every ordered pair of words one edit apart; ``words`` (word, n) are distinct."""
    k = len(classes)
    number = lambda c: F.char_length("word") - F.char_length(F.translate("word", c, ""))
    names = [f"c{i}" for i in range(1, k + 1)]
    block = words.select("word", "n", F.char_length("word").alias("length"), *[
        number(c).alias(name) for c, name in zip(classes, names, strict=True)])

    def role(r: int) -> Column:
        of_class = r if r <= k else r - k - 1
        return F.struct((F.col("length") - int(r > k)).alias("length"), *[
            (F.col(name) - int(i == of_class)).alias(name) for i, name in enumerate(names, 1)], F.lit(r).alias("role"))

    at = ["length", *names]
    dealt = block.select("word", "n", F.explode(F.array(*[role(r) for r in range(2 * k + 2)])).alias("r")).select(
        "word", "n", "r.*")
    # a block can't hold fewer than no letters of a class, nor more than its length
    dealt = dealt.filter(" and ".join([*[f"{c} >= 0" for c in names], f"{' + '.join(names)} <= length"]))
    space = F.greatest(F.lit(1), F.least(F.lit(room), F.floor(letters / F.greatest("length", F.lit(1)))))
    sizes = stored(dealt.groupBy(*at).agg(F.count(F.lit(1)).alias("rows")).select(
        *at, "rows", F.ceil(F.col("rows") / space).cast("int").alias("parts")), "blocks")
    rows = sizes.agg(F.sum(F.col("rows") * F.col("parts"))).first()[0] or 0
    own, o = F.pmod(F.crc32("word"), F.col("parts")).cast("int"), F.col("other")
    pairs = (dealt.join(sizes.drop("rows"), at).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("word", "n", *at, "role", (F.col("own") > o).cast("int").alias("part"),
                     F.least("own", o).alias("first"), F.greatest("own", o).alias("second")))
    by = (*at, "first", "second")
    tasks = int(min(max(words.sparkSession.sparkContext.defaultParallelism, rows // TASK_ROWS), 100_000))
    return pairs.repartition(tasks, *by).groupBy(*by).applyInArrow(_meet(k), NEAR_SCHEMA)


# ---- forms and roots ----------------------------------------------------------------------------

def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form) rows without cycles of up to 2 ** CHAIN_ROUNDS steps."""
    jumps = forms.select("word", F.col("form").alias("root"))
    for _ in range(CHAIN_ROUNDS):
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumps = stored(jumps.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if jumps.filter("moved").isEmpty():
            break
        jumps = jumps.drop("moved")
    return jumps.select("word", "root")


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, n, n_near, form, form_n, root of distinct counted words (word, n)."""
    words = stored(words.select("word", "n"), "words")
    found = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    fits = -F.col("best")["less"] >= factor * F.col("n")
    judged = stored(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("best")["near"]).alias("form"), F.when(fits, -F.col("best")["less"]).alias("form_n")), "forms")
    roots = roots_of(judged.filter("form is not null").select("word", "form"))
    return judged.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
