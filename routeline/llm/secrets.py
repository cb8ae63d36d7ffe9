"""Secret scans: fixed credential shapes plus sliding-window entropy over candidate strings.

Everything is a column expression on the text, so the scan is one pass without a shuffle.

Three fixed shapes are taken leftmost and non-overlapping: assignments, access keys and long hex
runs. The entropy rule then looks at candidate strings: runs of token characters with at least one
digit, one letter and ``WINDOW`` characters. A string of one character class (hex digits, letters
and digits, the full token alphabet) is scored by the Shannon entropy of a window slid over it one
character at a time. Entering and leaving characters change two counts only: with ``S`` the sum of
c*log2(c) over the window's counts, the entropy is log2(w) - S/w, and each step adds and removes
the terms of those two counts. A candidate whose best window reaches its class's threshold is a
span of kind ``entropy``, unless an allow-list pattern matches the string or a fixed shape already
covers part of it.

Spans are code point ranges [start, end). They follow from lengths alone: a text is split at the
matches, and running sums of piece and match lengths give the positions (summed in blocks, so that
a text with very many matches stays near linear).

Defined cases: NULL text counts as empty and has no spans. Empty text: no spans. Repeated rows:
equal answers. Equal starts order by kind as listed. Other columns pass through untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Credential shapes.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_LENGTH = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
# character classes from narrow to wide, and the bits per character that make a string suspect
CLASSES = (("[0-9a-fA-F]+", 3.0), ("[A-Za-z0-9]+", 3.6), ("[A-Za-z0-9+/_=-]+", 3.8))
# strings that look random and are not secret
ALLOW_LIST = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # uuid
    r"(?i)example|sample|dummy|placeholder|xxxx",
    r"^(.)\1+$",
    r"(?i)^(0123456789)?abcdefghijklmnopqrstuvwxyz|^[0-9]+$",
)
BLOCK = 256


def _running(lengths: Column) -> Column:
    """Sums of all earlier entries, for each entry."""
    def block(b: Column) -> Column:
        offset = F.aggregate(F.slice(lengths, 1, b * BLOCK), F.lit(0), lambda a, x: a + x)
        own = F.slice(lengths, b * BLOCK + 1, BLOCK)
        start = F.struct(offset.alias("sum"), F.array().cast("array<int>").alias("all"))
        step = lambda a, x: F.struct((a.sum + x).alias("sum"), F.concat(a.all, F.array(a.sum)).alias("all"))
        return F.aggregate(own, start, step, lambda a: a.all)
    blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.lit(0), F.size(lengths) - 1) / BLOCK).cast("int"))
    return F.flatten(F.transform(blocks, block))


def matches(text: Column, pattern: str) -> Column:
    """Every leftmost non-overlapping match: array of (start, end, found)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    # piece, match, piece, match, ...: a match begins after one more piece than matches
    pieces = F.slice(F.transform(between, lambda x: F.length(x)), 1, F.size(found))
    taken = F.transform(found, lambda x: F.length(x))
    begun = _running(F.zip_with(pieces, taken, lambda p, m: p + m))
    starts = F.zip_with(begun, pieces, lambda s, p: s + p)
    return F.zip_with(starts, found, lambda s, m: F.struct(
        s.alias("start"), (s + F.length(m)).cast("int").alias("end"), m.alias("found")))


def _term(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def _count(window: Column, char: Column) -> Column:
    return (F.length(window) - F.length(F.replace(window, char, F.lit("")))).cast("double")


def window_entropy(token: Column, width: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits per character, of any ``width`` characters of ``token``."""
    first = F.substring(token, 1, width)
    distinct = F.array_distinct(F.split(first, ""))
    s0 = F.aggregate(distinct, F.lit(0.0), lambda a, c: a + F.when(c == "", 0.0).otherwise(_term(_count(first, c))))

    def step(state: Column, i: Column) -> Column:
        window = F.substr(token, i, F.lit(width))
        leaving, entering = F.substr(token, i, F.lit(1)), F.substr(token, i + width, F.lit(1))
        out, into = _count(window, leaving), _count(window, entering)
        change = F.when(leaving == entering, 0.0).otherwise(
            _term(out - 1) - _term(out) + _term(into + 1) - _term(into))
        s = state.s + change
        return F.struct(s.alias("s"), F.least(state.low, s).alias("low"))

    moves = F.filter(F.sequence(F.lit(0), F.length(token) - width), lambda i: i > 0)
    low = F.aggregate(moves, F.struct(s0.alias("s"), s0.alias("low")), step, lambda a: a.low)
    return F.lit(math.log2(width)) - low / width


def _overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o.start < span.end) & (span.start < o.end))


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda m: F.struct(
        m.start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m.end.alias("end"), F.lit(kind).alias("kind")))


_NONE = "array<struct<start:int,rank:int,end:int,kind:string>>"


def base_spans(text: Column) -> Column:
    """Spans of the three fixed shapes, by start and kind: array of (start, rank, end, kind)."""
    text = F.coalesce(text, F.lit(""))
    group2 = lambda m: F.length(F.regexp_extract(m.found, ASSIGN, 2))
    assign = F.filter(matches(text, ASSIGN), lambda m: group2(m) >= MIN_LENGTH["assign"])
    # a run shorter than the least length can't hold a longer one, so the pattern may ask for it
    access = matches(text, rf"AKIA[A-Z0-9]{{{MIN_LENGTH['access'] - 4},}}")
    hexes = matches(text, rf"[0-9a-f]{{{MIN_LENGTH['hex']},}}+")
    parts = [F.when(F.regexp_like(text, F.lit(p)), _tagged(s, k)).otherwise(F.array().cast(_NONE))
             for k, p, s in (("assign", "(?i:passw|secret|token|api_?key)", assign), ("access", "AKIA", access),
                             ("hex", rf"[0-9a-f]{{{MIN_LENGTH['hex']}}}", hexes))]
    return F.array_sort(F.concat(*parts))


def entropy_spans(text: Column, base: Column, allow_list: tuple[str, ...] = ALLOW_LIST) -> Column:
    """Candidate strings with a window of high entropy, without those listed or already found."""
    text = F.coalesce(text, F.lit(""))

    def suspect(m: Column) -> Column:
        token = m.found
        listed = F.lit(False)
        for pattern in allow_list:
            listed = listed | F.regexp_like(token, F.lit(pattern))
        needed = F.lit(CLASSES[-1][1])
        for pattern, bits in reversed(CLASSES[:-1]):
            needed = F.when(F.regexp_like(token, F.lit(f"^{pattern}$")), bits).otherwise(needed)
        mixed = F.regexp_like(token, F.lit("[0-9]")) & F.regexp_like(token, F.lit("[A-Za-z]"))
        return mixed & ~listed & ~_overlaps(m, base) & (window_entropy(token) >= needed)

    # only texts with a digit in a long run of token characters can hold a candidate
    near = rf"[A-Za-z0-9+/_=-]*[0-9][A-Za-z0-9+/_=-]*"
    may = F.exists(F.regexp_extract_all(text, F.lit(near), F.lit(0)), lambda x: F.length(x) >= WINDOW)
    return F.when(may, _tagged(F.filter(matches(text, CANDIDATE), suspect), "entropy")).otherwise(
        F.array().cast(_NONE))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def scan(docs, text: str = "text"):
    """Add ``secret_base`` and ``secret_spans`` (arrays of start, rank, end, kind) to every row."""
    docs = docs.withColumn("secret_base", base_spans(F.col(text)))
    extra = entropy_spans(F.col(text), F.col("secret_base"))
    return docs.withColumn("secret_spans", F.array_sort(F.concat(F.col("secret_base"), extra)))


def masked(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced by ``mark``; overlapping spans become one mark."""
    step = lambda a, s: F.struct(
        F.greatest(a.at, s.end).alias("at"),
        F.when(s.start < a.at, a.parts).otherwise(F.concat(
            a.parts, F.array(F.substr(text, a.at + 1, s.start - a.at), F.lit(mark)))).alias("parts"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    whole = F.aggregate(spans, start, step, lambda a: F.concat(
        F.array_join(a.parts, ""), F.substr(text, a.at + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
