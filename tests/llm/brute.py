"""Plain versions of the operators, row by row, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text) -> list[bytes]:
    return (text or "").encode().split()


class Union:
    def __init__(self, items):
        self.of = {i: i for i in items}

    def find(self, x):
        while self.of[x] != x:
            x = self.of[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.of[max(a, b)] = min(a, b)


def linked(sets: dict, percent: int) -> Union:
    """Components of sets (by key); empty sets link with nothing."""
    out, keys = Union(sets), sorted(k for k in sets if sets[k])
    holds = defaultdict(list)
    for k in keys:
        for s in sets[k]:
            holds[s].append(k)
    for k in keys:
        both = Counter(j for s in sets[k] for j in holds[s] if j > k)
        for j, n in both.items():
            if 100 * n >= percent * (len(sets[k]) + len(sets[j]) - n):
                out.join(k, j)
    return out


def shingles(text, k=5) -> frozenset:
    w = [x.lower() for x in words(text)]
    if len(w) < k:
        return frozenset([b" ".join(w)]) if w else frozenset()
    return frozenset(b" ".join(w[i : i + k]) for i in range(len(w) - k + 1))


def near_duplicates(rows, percent=85):
    """{(doc_id): (set size, component, kept)}; rows: (doc_id, text)."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    found = linked(sets, percent)
    return {i: (len(s), found.find(i), found.find(i) == i) for i, s in sets.items()}


def line_places(rows):
    return [(i, k, line.translate(_LOWER)) for i, t in rows if i is not None and t is not None for k, line in enumerate(t.split("\n"))]


def judged_lines(rows, percent=80, k=8):
    """{(doc_id, line_no): (first place, kept)}."""
    first = {}
    places = line_places(rows)
    for i, n, line in sorted(places):
        if re.search(r"[^\t\n\x0b\x0c\r \xa0]", line):
            first.setdefault(line, (i, n))
    sets = {p: frozenset(line[j : j + k] for j in range(max(1, len(line) - k + 1))) for line, p in first.items()}
    found = linked(sets, percent)
    return {(i, n): ((h := found.find(first[line]) if line in first else (i, n)), h == (i, n)) for i, n, line in places}


def line_dedup(rows, percent=80):
    kept = judged_lines(rows, percent)
    return [(i, t if i is None or t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if kept[i, n][1])) for i, t in rows]


def substrings(rows, size=20):
    """[(doc_id, words, removed, digest)]."""
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        for p in range(len(w) - size + 1):
            at = first.setdefault(b" ".join(w[p : p + size]), (i, p))
            first[b" ".join(w[p : p + size])] = min(at, (i, p))
    out = []
    for i, t in rows:
        if i is None:
            continue
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if first[b" ".join(w[p : p + size])] != (i, p):
                gone[p : p + size] = [True] * size
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out)


def suffixes(rows, size=200):
    """[(doc_id, bytes, removed, runs, digest)]."""
    texts = [(i, (t or "").encode()) for i, t in rows if i is not None]
    count = Counter(t[p : p + size] for _, t in texts for p in range(len(t) - size + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - size + 1):
            if count[t[p : p + size]] > 1:
                gone[p : p + size] = b"\1" * size
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out)


def counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    t, w = text or "", words(text)
    lines = [x for x in t.split("\n") if words(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = [False] * len(w)
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            cover[i : i + 8] = [True] * 8
    return len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(cover)


def overlaps(docs, items, masks, span=10, window=20, percent=80):
    """{(doc_id, item_id, doc_start, item_start, n_words, n_equal)}."""

    def tokens(t):
        return [w for w in re.split("[\x20\x09-\x0d]+", (t or "").lower()) if w]

    def seeds(w):
        return [(m, tuple(w[i + o] for o in mask), i) for m, mask in enumerate(masks) for i in range(len(w) - span + 1)]

    known = defaultdict(set)
    coded = {b: tokens(t) for b, t in items if b is not None}
    for b, w in coded.items():
        for m, s, i in seeds(w):
            known[m, s].add((b, i))
    out = set()
    for d, t in docs:
        if d is None:
            continue
        w = tokens(t)
        for b, shift in {(b, i - j) for m, s, i in seeds(w) for b, j in known[m, s]}:
            df, bf, item = max(shift, 0), max(-shift, 0), coded[b]
            same = [x == y for x, y in zip(w[df:], item[bf:])]
            size = min(window, len(item))
            good = [i for i in range(len(same) - size + 1) if sum(same[i : i + size]) * 100 >= size * percent]
            if good:
                end = good[-1] + size
                out.add((d, b, df + good[0], bf + good[0], end - good[0], sum(same[good[0] : end])))
    return out


def base_spans(text):
    """'kind:start:end' of the fixed patterns, joined."""
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(sum(divmod(2 * v, 10)) if i % 2 else v for i, v in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in sorted(out))


def base_scores(rows):
    """[(doc_id, held out, tokens, known, training tokens, base score)]."""
    coded = [(i, zlib.crc32(str(i).encode()) % 7 == 2, [x.lower() for x in words(t)] + [None]) for i, t in rows if i is not None]
    count = Counter(x for _, held, w in coded if not held for x in w)
    total, kinds = sum(count.values()), len(count)
    return [(i, held, len(w), sum(count[x] > 0 for x in w), total, sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w)) for i, held, w in coded]


def best_segmentation(word: bytes, scores: dict, unknown: int, longest: int):
    """(score, tokens) of the best segmentation; ties: the shorter last piece."""
    best = [(0, 0)]
    for e in range(1, len(word) + 1):
        top = None
        for n in range(1, min(e, longest) + 1):
            s = scores.get(word[e - n : e], unknown if n == 1 else None)
            if s is not None and (top is None or best[e - n][0] + s > top[0]):
                top = (best[e - n][0] + s, best[e - n][1] + 1)
        best.append(top)
    return best[-1]
