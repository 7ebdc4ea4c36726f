"""Plain Python versions of the operators, for small inputs, and awkward documents."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import xxhash

BREAKS = b" \t\n\x0b\x0c\r"
SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, score string, chunk int, words string, row int"


def awkward() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, copies, repeated rows, odd characters."""
    base = "the quick brown fox jumps over the lazy dog and runs far away from every other animal in the wood"
    long_text = " ".join(f"word{i % 977} tail{i % 13}" for i in range(30_000))
    texts = [None, "", "   \n\t ", "one", "two words", base, base, base.upper(), base + " again", long_text, long_text + " end",
             "a b\x1cc   d﻿", "naïve İstanbul \U0001f600 " * 9, base + "\n" + base + "\n" + base, "x" * 5000, "ab " * 400,
             "é" * 120, "z" + "é" * 120]
    rows = [(i, t, "en" if i % 3 else None, [None, "a", "b", "é"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, base + " without id", None, None, None), (None, None, None, None, None),
             (-4, "negative id " + base, "en", "a", 3), (2**60 + 1, "large id", "en", "b", 8), (2**60 + 2, "large id", "en", "b", 8)]
    return [r + (i, -i, "x", i % 2, None, 7) for i, r in enumerate(rows)]


def words(text) -> list[bytes]:
    return (text or "").encode().lower().split()


def raw_words(text) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def simhash(text, k=3) -> int:
    w = words(text)
    if not w:
        return 0
    grams = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows: list[tuple], radius=3) -> dict:
    """doc_id -> (fingerprint, smallest doc_id reachable)."""
    fps = {r[0]: simhash(r[1]) for r in rows}
    distinct = sorted(set(fps.values()))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least = defaultdict(lambda: 1 << 70)
    for d, f in fps.items():
        if d is not None:
            least[root(f)] = min(least[root(f)], d)
    return {d: (f, least[root(f)]) for d, f in fps.items()}


def suffix_dedup(rows: list[tuple], need=50) -> list[tuple]:
    """Sorted (doc_id, bytes, removed, spans, hash of the rest); a null id is the largest."""
    order = lambda d: (d is None, d or 0)
    first: dict[bytes, tuple] = {}
    for d, t, *_ in rows:
        b = (t or "").encode()
        for i in range(len(b) - need + 1):
            first[b[i:i + need]] = min(first.get(b[i:i + need], (True, 1)), order(d))
    out = []
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - need + 1):
            if first[b[i:i + need]] < order(d):
                gone[i:i + need] = [True] * need
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def language_model(rows: list[tuple], priors) -> dict:
    """doc_id -> (held out, tokens, known, N, base score, score)."""
    def held(d):
        return d is not None and zlib.crc32(str(d).encode()) % 7 == 2

    one, two, three, texts = Counter(), Counter(), Counter(), 0
    for d, t, *_ in rows:
        if not held(d):
            w = ["<s>"] + words(t) + ["</s>"]
            texts += 1
            one.update(w[1:])
            two.update(zip(w, w[1:]))
            three.update(zip(w, w[1:], w[2:]))
    n, v = sum(one.values()), len(one)
    one["<s>"] = texts
    out = {}
    for d, t, *_ in rows:
        w = ["<s>"] + words(t) + ["</s>"]
        base = score = 0.0
        for i in range(1, len(w)):
            p = (one[w[i]] + 1) / (n + v + 1)
            base += math.log10(p)
            p = (two[w[i - 1], w[i]] + priors[0] * p) / (one[w[i - 1]] + priors[0])
            if i > 1:
                p = (three[w[i - 2], w[i - 1], w[i]] + priors[1] * p) / (two[w[i - 2], w[i - 1]] + priors[1])
            score += math.log10(p)
        out[d] = (held(d), len(w) - 1, sum(one[x] > 0 for x in w[1:]), n, base, score)
    return out


def mixing(rows: list[tuple], weights, epochs, seed) -> list[tuple]:
    """Sorted (doc_id, size, source size, target, taken)."""
    sized = [(r[0], r[3], len(words(r[1]))) for r in rows]
    sources = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(n for _, x, n in sized if x == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    capped: set = set()
    while True:
        free = [s for s in sources if s not in capped]
        share = (sum(size.values()) - sum(epochs * size[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * share > epochs * size[s]}
        if not above:
            break
        capped |= above
    target = {s: float(epochs * size[s]) if s in capped else weight[s] * share for s in sources}
    out = []
    for s in sources:
        whole = int(target[s]) // size[s] if size[s] else 0
        beyond, before = int(target[s]) - whole * size[s], 0
        key = lambda r: (hashlib.md5(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, r[2])
        for d, _, n in sorted((r for r in sized if r[1] == s), key=key):
            out.append((d, n, size[s], target[s], whole * n + max(0, min(n, beyond - before))))
            before += n
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def quality(text) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t, w = text or "", raw_words(text)
    found = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if found[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if raw_words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))
