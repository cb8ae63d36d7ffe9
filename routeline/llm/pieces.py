"""Sampled SentencePiece segmentations by forward filtering and backward sampling.

Text is turned into pieces as the format does it: a space becomes U+2581 and opens a word, one is
put before the text. No piece crosses the start of a word or two characters that no piece holds side
by side, so the lattice of a text falls apart into words, and equal words share their forward pass. Over the characters of a word

    alpha[j] = log sum over pieces ending at j of exp(alpha[start] + weight(piece))

is filled once per distinct word. Sampling runs backward: at position j a piece ending there is
drawn with probability exp(alpha[start] + weight - alpha[j]), which draws a whole segmentation with
probability proportional to the product of its piece weights. All occurrences of a chunk of words
step together in numpy. The uniform numbers are hashed from (seed, row key, word number, step), so
a row's segmentation depends on nothing but its key, text, seed and model.

A character without a piece is spelt in byte pieces, so every text has a segmentation; U+2581 and
U+0000 themselves are spelt in bytes, which keeps decoding lossless for any text. Lone surrogates do
not occur in Spark strings.

Model files that hold merge ranks instead of probabilities (byte-pair models) get Zipf weights,
log p = -log(1 + rank) up to a constant; ``temperature`` scales weights, higher is flatter.

The vocabulary (bounded by the model file) is read on the driver and broadcast.

Defined cases: NULL text: NULL pieces, decoded to NULL. Empty text: no pieces, decoded to the empty
text. NULL key: a key of its own. Repeated rows: equal segmentations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from routeline.llm.common import BASE_A, BASE_B, mix, span_hash

SEED = 20240501
TEMPERATURE = 0.5
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 0x2581
CHUNK_CHARS = 1 << 18  # characters handled together; a longer text is a chunk of its own
WORD_CELLS = 1 << 14    # characters of distinct words handled together
EMPTY, NO_PIECE = -2, -1
BYTE_PENALTY = 4.0      # added cost of a spelt-out character


@dataclass
class Vocabulary:
    keys: np.ndarray       # open-addressed table of piece hashes
    ids: np.ndarray        # NO_PIECE for a string that only begins pieces, EMPTY for a free slot
    weight: np.ndarray     # per id, -inf at -1
    byte_id: np.ndarray    # per byte value
    longest: int
    pieces: list[bytes]    # per id, the bytes it stands for
    joint: np.ndarray      # by hash of two neighbouring characters: may some piece hold both


def _hash(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(mix(codes.astype(np.uint64) + np.uint64(BASE_B)), starts, ends, BASE_A)


JOINT_SLOTS = 1 << 20


def _pair_slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = left.astype(np.uint32) * np.uint32(0x9E3779B1) + right.astype(np.uint32) * np.uint32(0x85EBCA77)
    return (h ^ (h >> np.uint32(15))) & np.uint32(JOINT_SLOTS - 1)


def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(size)]
    scores = np.array([model.get_score(i) for i in range(size)])
    byte_id = np.full(256, -1, np.int64)
    plain, spelt = [], [b""] * size
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte_id[int(name[3:5], 16)] = i
            spelt[i] = bytes([int(name[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            spelt[i] = name.replace(chr(SPACE), " ").encode()
            # a space inside a piece, or no space but U+2581, can't be told from a word start
            if chr(SPACE) not in name[1:]:
                plain.append(i)
    if (byte_id < 0).any():
        raise ValueError(f"{path}: the model has no byte pieces, so it can't spell every text")
    ranks = scores[plain].max() - scores[plain]
    if ranks.max() > 100:  # merge ranks, not log probabilities
        logp = -np.log1p(ranks)
    else:
        logp = scores[plain]
    weight = np.full(size + 1, -np.inf, np.float32)  # the last entry answers for id -1, no piece
    weight[plain] = logp / TEMPERATURE
    flat = np.frombuffer("".join(names[i] for i in plain).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(names[i]) for i in plain])
    starts = np.concatenate([[0], ends[:-1]])
    # the table holds every piece and every beginning of one
    size_of = ends - starts
    head = np.repeat(starts, size_of)
    hashes = _hash(flat, head, np.arange(len(flat)) + 1)
    entries = dict.fromkeys(hashes.tolist(), NO_PIECE)
    entries.update(zip(hashes[ends - 1].tolist(), plain, strict=True))
    slots = 1 << int(np.ceil(np.log2(len(entries) * 4)))
    keys, ids = np.zeros(slots, np.uint64), np.full(slots, EMPTY, np.int32)
    for h, i in entries.items():
        at = h & (slots - 1)
        while ids[at] != EMPTY:
            at = (at + 1) & (slots - 1)
        keys[at], ids[at] = h, i
    joint = np.zeros(JOINT_SLOTS, bool)
    inner = np.ones(len(flat), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    codes = np.where(flat == SPACE, 32, flat)
    joint[_pair_slot(codes[at - 1], codes[at])] = True
    return Vocabulary(keys, ids, weight, byte_id, max(len(names[i]) for i in plain), spelt, joint)


def find(vocabulary: Vocabulary, h: np.ndarray) -> np.ndarray:
    """Piece id per hash, NO_PIECE if pieces begin with it, else EMPTY."""
    mask = np.uint64(len(vocabulary.keys) - 1)
    at = (h & mask).view(np.int64)
    out = vocabulary.ids.take(at)
    # nearly all are settled by the first slot; the others go on from slot to slot
    left = np.flatnonzero((out != EMPTY) & (vocabulary.keys.take(at) != h))
    at = at[left]
    while len(left):
        at = (at + 1) & np.int64(mask)
        ids = vocabulary.ids.take(at)
        out[left] = ids
        on = (ids != EMPTY) & (vocabulary.keys.take(at) != h[left])
        left, at = left[on], at[on]
    return out


def split_words(texts: list[str], joint: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts with a space before each, word starts, and each text's first word.

    A word also starts between two characters that no piece holds side by side (letter and line
    break, say): no path of the lattice crosses such a place, so cutting there changes nothing.
    """
    flat = np.frombuffer("".join(" " + t if t else "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    open_ = flat == 32
    open_[1:] |= ~joint[_pair_slot(flat[:-1], flat[1:])]
    first = (ends - sizes)[sizes > 0]
    open_[first] = True
    starts = np.flatnonzero(open_)
    return flat, starts, np.searchsorted(starts, np.append(ends - sizes, len(flat)))


class Lattice:
    """Forward tables of a block of distinct words, padded to the longest."""

    def __init__(self, v: Vocabulary, flat: np.ndarray, begin: np.ndarray, length: np.ndarray):
        # Words lie along the last axis, so that each step works on long runs of numbers
        n, width = len(begin), int(length.max())
        most = min(v.longest, width)
        self.length = length
        at = np.minimum(begin + np.arange(width)[:, None], len(flat) - 1)
        codes = flat[at].astype(np.int64)
        spelt = (codes == SPACE) | (codes == 0)          # literal U+2581: bytes only
        codes = np.where(codes == 32, SPACE, codes)
        utf8 = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        utf8 = np.where(codes == SPACE, np.where(spelt, 3, 1), utf8)
        # doubles: the sums of a long word are far from 0, and only their differences decide
        alpha = np.full((width + 1, n), -np.inf)
        alpha[0] = 0.0
        # from each start, grow while some piece begins with what has been read; its hash grows along
        stop = np.ones((width + 1, n), bool)
        stop[:width] = spelt | (np.arange(width)[:, None] >= length)
        stop = stop.ravel()
        values = mix(codes.ravel().astype(np.uint64) + np.uint64(BASE_B))
        s = np.flatnonzero(~stop)
        total = np.zeros(len(s), np.uint64)
        found = []
        for size in range(1, most + 1):
            end = s + (size - 1) * n
            total += values.take(end) * np.uint64(pow(BASE_A, size - 1, 1 << 64))
            ids = find(v, mix(total + np.uint64(size * BASE_B % (1 << 64))))
            hit = np.flatnonzero(ids >= 0)
            found.append((end[hit], ids[hit]))
            on = np.flatnonzero((ids != EMPTY) & ~stop.take(end + n))
            if not len(on):
                break
            s, total = s[on], total[on]
        most = len(found)
        # edge[l, j, i]: the piece of l+1 characters that ends after character j of word i; -1 none
        self.edge = np.full((most, width, n), -1, np.int32)
        weight = np.full((most, width, n), -np.inf, np.float32)
        cumulated = np.ones((width, most + 1, n), np.float32)  # last: the spelt character
        for size, (end, ids) in enumerate(found):
            self.edge[size].put(end, ids)
            weight[size].put(end, v.weight.take(ids))
        floor = np.float32(v.weight[np.isfinite(v.weight)].min())
        spell = floor - np.float32(BYTE_PENALTY) * utf8.astype(np.float32)
        for j in range(width):
            reach = min(j + 1, most)
            p = np.empty((reach + 1, n))
            np.add(alpha[j - reach + 1:j + 1][::-1], weight[:reach, j], out=p[:reach])
            p[reach] = np.where(self.edge[0, j] < 0, alpha[j] + spell[j], -np.inf)
            top = p.max(axis=0)
            p -= top
            np.exp(p, out=p)
            np.cumsum(p, axis=0, out=p)
            alpha[j + 1] = top + np.log(p[reach])
            np.divide(p[:reach], p[reach], out=cumulated[j, :reach], casting="same_kind")
            cumulated[j, reach:most] = cumulated[j, reach - 1]
        self.cumulated = cumulated.transpose(0, 2, 1).reshape(width * n, most + 1)
        self.codes, self.spelt = codes.ravel(), spelt.ravel()

    def sample(self, word: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each occurrence, its pieces from the last to the first: (occurrence, step, end, length)."""
        at = self.length[word].astype(np.int64)
        most, width, n = self.edge.shape
        live = np.arange(len(word))
        out = []
        step = 0
        while len(live):
            place = (at[live] - 1) * n + word[live]
            u = (mix(key[live] + np.uint64(step * BASE_B % (1 << 64))) >> np.uint64(40)).astype(np.float32) * np.float32(2.0 ** -24)
            # the first sum above u; the last sum is 1, and u is less
            pick = (self.cumulated.take(place, axis=0) > u[:, None]).argmax(axis=1)
            spelt = pick == most
            size = np.where(spelt, 1, pick + 1)
            ids = np.where(spelt, -1, self.edge.take(np.minimum(pick, most - 1) * (width * n) + place))
            out.append((live, np.full(len(live), step), ids, self.codes[place], self.spelt[place]))
            at[live] -= size
            live = live[at[live] > 0]
            step += 1
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else ()


def _spell(codes: np.ndarray, literal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of each code point in four columns, and how many there are."""
    codes = np.where((codes == SPACE) & ~literal, 32, codes)
    n = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    out = np.zeros((len(codes), 4), np.int64)
    tail = lambda k: 0x80 | (codes >> k & 0x3F)
    for size, lead in ((1, codes), (2, 0xC0 | codes >> 6), (3, 0xE0 | codes >> 12), (4, 0xF0 | codes >> 18)):
        m = n == size
        out[m, 0] = lead[m]
        for k in range(1, size):
            out[m, k] = tail(6 * (size - 1 - k))[m]
    return out, n


def sample_ids(v: Vocabulary, texts: list[str], keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts in order, and where each text's begin (one more at the end)."""
    flat, starts, text_words = split_words(texts, v.joint)
    total = len(starts)
    if not total:
        return np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    ends = np.append(starts[1:], len(flat))
    length = ends - starts
    h = _hash(flat, starts, ends)
    _, first, word = np.unique(h, return_index=True, return_inverse=True)
    owner = np.repeat(np.arange(len(texts)), np.diff(text_words))
    number = np.arange(total) - text_words[owner]
    key = mix(mix(keys.view(np.uint64) ^ mix(np.array([seed], np.uint64)))[owner] + number.astype(np.uint64) * np.uint64(BASE_A))
    # distinct words by length, so that a block pads little; occurrences follow their word
    by_length = np.argsort(length[first], kind="stable")
    place = np.empty(len(first), np.int64)
    place[by_length] = np.arange(len(first))
    ordered = np.argsort(place[word], kind="stable")
    bound = np.searchsorted(place[word][ordered], np.arange(len(first) + 1))
    found = []
    lo = 0
    sizes = length[first][by_length]
    while lo < len(first):
        hi = lo + 1
        limit = max(1, WORD_CELLS // int(sizes[lo]))
        hi = min(lo + limit, len(first), int(np.searchsorted(sizes, max(sizes[lo] + 4, sizes[lo] * 5 // 4), side="right")))
        hi = max(hi, lo + 1)
        distinct = first[by_length[lo:hi]]
        lattice = Lattice(v, flat, starts[distinct], length[distinct])
        rows = ordered[bound[lo]:bound[hi]]
        occ, step, ids, codes, literal = lattice.sample(place[word[rows]] - lo, key[rows])
        found.append((rows[occ], step, ids, codes, literal))
        lo = hi
    occ, step, ids, codes, literal = (np.concatenate(x) for x in zip(*found, strict=True))
    # backward draws come out last piece first
    steps = np.bincount(occ, minlength=total)
    base = np.concatenate([[0], np.cumsum(steps)])
    order = np.empty(len(occ), np.int64)
    order[base[occ + 1] - 1 - step] = np.arange(len(occ))
    ids, codes, literal = ids[order], codes[order], literal[order]
    spelt = np.flatnonzero(ids < 0)
    piece_text = np.repeat(owner, steps)
    if len(spelt):
        data, n = _spell(codes[spelt].astype(np.int64), literal[spelt])
        width = np.ones(len(ids), np.int64)
        width[spelt] = n
        out = np.repeat(ids, width)
        begin = np.concatenate([[0], np.cumsum(width)])[:-1]
        for k in range(4):
            m = n > k
            out[begin[spelt[m]] + k] = v.byte_id[data[m, k]]
        piece_text = np.repeat(piece_text, width)
        ids = out
    return ids, np.searchsorted(piece_text, np.arange(len(texts) + 1))


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about CHUNK_CHARS; ``sizes`` has a text's characters."""
    total = np.concatenate([[0], np.cumsum(sizes + 1)])
    first = 0
    while first < len(sizes):
        last = max(int(np.searchsorted(total, total[first] + CHUNK_CHARS, side="right")) - 1, first + 1)
        yield first, min(last, len(sizes))
        first = last


def _encoded(v: Vocabulary, texts: pa.Array, keys: pa.Array, seed: int) -> pa.ListArray:
    """Piece ids of a batch, a chunk of texts at a time, so that a batch is never held as Python objects."""
    numbers = keys.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = pc.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ids, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
    for a, b in _runs(lengths):
        found, begin = sample_ids(v, texts.slice(a, b - a).fill_null("").to_pylist(), numbers[a:b], seed)
        ids.append(found.astype(np.int32))
        sizes.append(np.diff(begin))
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(ids)), mask=texts.is_null())


def _decoded(pieces: np.ndarray, ids: pa.ListArray) -> pa.Array:
    offsets, values = np.asarray(ids.offsets), np.asarray(ids.values)
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    return pa.array((None if null else b"".join(pieces[values[a:b]])[1:].decode()
                     for a, b, null in zip(offsets[:-1], offsets[1:], missing, strict=True)), pa.string())


def encode(spark: SparkSession, text: Column, key: Column, model: str = MODEL, seed: int = SEED) -> Column:
    """Sampled piece ids of ``text``; ``key`` is any column that tells rows apart."""
    shared = spark.sparkContext.broadcast(load(model))  # bounded by the model file

    @F.arrow_udf("array<int>")
    def sample(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for part, keys in parts:
            yield _encoded(shared.value, part, keys, seed)

    return sample(text, F.xxhash64(key))


def decode(spark: SparkSession, ids: Column, model: str = MODEL) -> Column:
    """The text of a list of piece ids."""
    shared = spark.sparkContext.broadcast(load(model).pieces)

    @F.arrow_udf("string")
    def restore(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = np.array(shared.value, dtype=object)
        for part in parts:
            yield _decoded(pieces, part)

    return restore(ids)


def roundtrip(spark: SparkSession, text: Column, key: Column, model: str = MODEL, seed: int = SEED) -> Column:
    """Struct of the sampled ``piece_ids`` and the text ``decoded`` from them, in one pass of one worker."""
    shared = spark.sparkContext.broadcast(load(model))

    @F.arrow_udf("struct<piece_ids:array<int>,decoded:string>")
    def both(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pieces = np.array(shared.value.pieces, dtype=object)
        for part, keys in parts:
            ids = _encoded(shared.value, part, keys, seed)
            yield pa.StructArray.from_arrays([ids, _decoded(pieces, ids)], names=["piece_ids", "decoded"])

    return both(text, F.xxhash64(key))
