"""Spelling variants against plain versions: contract query, Gram blocks, edge cases."""

import itertools
import random
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq

from routeline.llm import spelling
from routeline.llm.queries import LLM_QUERIES

ROOT = "/root/testdata/sf0.001"


def edits(word, alphabet):
    cut = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return ({a + b[1:] for a, b in cut if b} | {a + c + b for a, b in cut for c in alphabet}
            | {a + c + b[1:] for a, b in cut if b for c in alphabet}) - {word}


def grouped(words):
    alphabet = {c for w in words for c in w}
    near = {w: [x for x in edits(w, alphabet) if x in words] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, words[w], len(near[w]), form[w], words.get(form[w]), root))
    return out


def counted(docs, damage):
    words = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{ROOT}/documents.parquet").to_pylist()]
    got = {tuple(r) for r in LLM_QUERIES["op12_spelling"](spark, ROOT).collect()}
    assert got == grouped(counted(docs, 97))


def test_blocks_of_any_size(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abeé") for _ in range(rng.randint(5, 8))): rng.randint(3, 400) for _ in range(400)}
    words |= {"x" * 3000: 5, "x" * 2999 + "y": 30, "x" * 3001: 90}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    want = {(w, x, words[x]) for w in words for x in words
            if abs(len(w) - len(x)) <= 1 and x in edits(w, {"a", "b", "e", "é", "x", "y"})}
    for classes, room in ((("a", "b", "é"), 17), (("a",), 5), (("ab", "e"), 2048), (("q", "r"), 40)):
        got = spelling.near_words(frame, classes, room, 10_000).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert {tuple(r) for r in spelling.group_variants(frame).collect()} == grouped(words)


def test_chain_of_forms(spark):
    words = {"a" * 5 + "b" * k: 3 * 2 ** k for k in range(40)}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert {r.root for r in spelling.group_variants(frame).collect()} == {"a" * 5 + "b" * 39}


def test_ties_and_pairs():
    import numpy as np
    letters = lambda ws: np.array([[ord(c) for c in w] for w in ws], dtype=np.uint32)
    alphabet = np.arange(ord("a"), ord("z") + 1, dtype=np.uint32)
    pairs = lambda a, b, same: [x.tolist() for x in spelling.near_pairs(
        a, b, spelling.letter_counts(a, alphabet), spelling.letter_counts(b, alphabet), same)]
    a = letters(["abcde", "abced", "abcdf"])
    assert pairs(a, a, True) == [[0], [2]]  # a swap is two edits
    assert pairs(a, letters(["xabcde", "abcdfe", "abcdez"]), False) == [[0, 0, 0, 2], [0, 1, 2, 1]]
    for w in itertools.product("ab", repeat=4):
        assert bool(spelling.one_edit(letters(["aba"]), letters(["".join(w)]))[0]) == ("".join(w) in edits("aba", "ab"))


def test_edges(spark):
    schema = "doc_id bigint, text string, word string, n string"
    assert spelling.group_variants(spelling.count_words(spark.createDataFrame([], schema), damage=97)).count() == 0
    rows = [(1, None), (2, ""), (3, "12 ... x"), (None, "Colour colour COLOUR color Éclair éclair"),
            (5, "color color tie tiesa tiesa tiesb tiesb tiesc"), (5, "color color tie tiesa tiesa tiesb tiesb tiesc"),
            (7, "largeword " * 50_000), (8, "abcde" * 20_000)]
    frame = spark.createDataFrame([(*r, "w", "n") for r in rows], schema)
    for damage in (None, 3):
        got = {tuple(r) for r in spelling.group_variants(spelling.count_words(frame, damage=damage)).collect()}
        assert got == grouped(counted(rows, damage))
    assert {r.word: r.form for r in spelling.group_variants(spelling.count_words(frame)).collect()} == {
        "colour": None, "color": None, "tiesa": None, "tiesb": None, "largeword": None}
