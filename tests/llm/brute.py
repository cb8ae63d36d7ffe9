"""Plain versions of the operators' contracts, for small tables only."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def edited(rows: list[tuple[int, str | None]]) -> dict[int, str]:
    rows = sorted((i, t or "") for i, t in rows)
    out = {}
    for at, (i, t) in enumerate(rows):
        k = len(t) // 4
        out[i] = t[:len(t) - k] + rows[(at + 1) % len(rows)][1][:k]
    return out


def shingles(text: str | None, size: int) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def near_classes(rows: list[tuple[int, str | None]], size: int = 3, percent: int = 85) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t, size) for i, t in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i in ids:
        for s in sets[i]:
            holders[s].append(i)
    for i in ids:
        shared = Counter(j for s in sets[i] for j in holders[s] if j > i)
        for j, k in shared.items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def quality_base(text: str | None) -> tuple[int, ...]:
    text = text or ""
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    repeated = {i + k for starts in at.values() if len(starts) > 1 for i in starts for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret_base(text: str | None) -> list[tuple[int, int, int, str]]:
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def without_repeats(texts: list[str | None], window: int = 35) -> list[tuple[int, int, str]]:
    lists = [words(t) for t in texts]
    times = Counter(tuple(w[i:i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        gone = set()
        for i in range(len(w) - window + 1):
            if times[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), sha(" ".join(kept))))
    return out


def targets(sizes: dict, weights=(5.0, 2.0, 1.0), budget: float = 1.5, limit: float = 2.0) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = dict.fromkeys(order, 0.0), set(order), budget * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if limit * sizes[s] <= weight[s] * level}
        if not full:
            for s in free:
                target[s] = weight[s] * level
            break
        for s in full:
            target[s] = limit * sizes[s]
            left -= target[s]
        free -= full
    return target
