"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its own hashed embedding beside the mean of its hashed character
4-grams' embeddings; two gated layers read a window from either side, attention pools
their states, and one logistic unit scores the window.
"""

from __future__ import annotations

import zlib

import numpy as np

WORD_BUCKETS, CHAR_BUCKETS = 1 << 15, 1 << 15
EDGE = b".,;:!?\"'()[]{}*-_"


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Vocabulary:
    """Numbers words as they come; 0 is the padding. Character 4-grams of word k: ``grams[at[k]:at[k + 1]]``."""

    def __init__(self):
        self.number: dict[bytes, int] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        number = self.number
        return np.fromiter((number.setdefault(w, len(number) + 1) for w in words), np.int32, len(words))

    def inputs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = [w.strip(EDGE) or w for w in self.number]
        bucket = np.zeros(len(words) + 1, np.int64)
        bucket[1:] = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % (WORD_BUCKETS - 1) + 1
        line = np.frombuffer(b" " + b"  ".join(words) + b"  ", np.uint8).astype(np.int64)
        length = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(length + 2) - length - 2  # the blank before the word
        at = np.concatenate([[0, 0], np.cumsum(length)])
        place = np.arange(at[-1]) - np.repeat(at[1:-1], length) + np.repeat(start, length)
        mixed = sum(line[place + i] * k for i, k in enumerate((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)))
        return bucket, (mixed ^ (mixed >> 15)) % CHAR_BUCKETS, at


def restrict(inputs, used: np.ndarray):
    """The inputs of the words ``used`` alone (0 among them, first), renumbered in that order."""
    bucket, grams, at = inputs
    count = at[used + 1] - at[used]
    ends = np.concatenate([[0], np.cumsum(count)])
    where = np.repeat(at[used] - ends[:-1], count) + np.arange(ends[-1])
    return bucket[used], grams[where], ends


class Network:
    def __init__(self, size: int = 8, hidden: int = 8, seed: int = 5):
        rng = np.random.default_rng(seed)
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        d, h = 2 * size, hidden
        self.size, self.hidden = size, hidden
        self.p = {"word": 0.1 * rng.standard_normal((WORD_BUCKETS, size)).astype(np.float32),
                  "char": 0.3 * rng.standard_normal((CHAR_BUCKETS, size)).astype(np.float32),
                  "att": init(2 * h, h), "att_b": np.zeros(h, np.float32), "att_v": init(h), "out": init(2 * h),
                  "out_b": np.float32([-1.0])}
        self.p["word"][0] = 0
        for way in "fb":
            self.p |= {f"{way}_in": init(d, 3 * h), f"{way}_b": np.zeros(3 * h, np.float32),
                       f"{way}_zr": init(h, 2 * h), f"{way}_c": init(h, h)}

    def words(self, inputs) -> np.ndarray:
        """The input vector of each word of a vocabulary; the padding's is zero."""
        bucket, grams, at = inputs
        x = np.zeros((len(bucket), 2 * self.size), np.float32)
        x[:, :self.size] = self.p["word"][bucket]
        if len(grams):
            n = np.diff(at)
            full = np.flatnonzero(n)
            sums = np.add.reduceat(self.p["char"][grams], at[full], axis=0)
            x[full, self.size:] = sums / n[full, None]
        return x

    def _read(self, way: str, px: np.ndarray, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of one direction, time first."""
        h_n, steps = self.hidden, ids.shape[1]
        zr_w, c_w = self.p[f"{way}_zr"], self.p[f"{way}_c"]
        h = np.zeros((len(ids), h_n), np.float32)
        out = np.empty((steps, len(ids), h_n), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            own = ids[:, t]
            gx = px[own]
            zr = sigmoid(gx[:, :2 * h_n] + h @ zr_w)
            z, r = zr[:, :h_n] * (own > 0)[:, None], zr[:, h_n:]
            c = np.tanh(gx[:, 2 * h_n:] + (r * h) @ c_w)
            if keep is not None:
                keep.append((t, h, zr, z, r, c))
            h = h + z * (c - h)
            out[t] = h
        return out

    def forward(self, x: np.ndarray, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """The logit of each window; ``ids`` (windows, words) point into ``x``."""
        p, tape = self.p, {"f": [], "b": []}
        states = [self._read(w, x @ p[f"{w}_in"] + p[f"{w}_b"], ids, tape[w] if keep is not None else None) for w in "fb"]
        h = np.concatenate(states, axis=2)
        u = np.tanh(h @ p["att"] + p["att_b"])
        e = np.where(ids.T > 0, u @ p["att_v"], np.float32(-1e9))
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = (a[:, :, None] * h).sum(axis=0)
        if keep is not None:
            keep |= {"tape": tape, "h": h, "u": u, "a": a, "pooled": pooled}
        return pooled @ p["out"] + p["out_b"][0]

    def gradients(self, inputs, x, ids, wrong: np.ndarray, keep: dict) -> dict[str, np.ndarray]:
        """``wrong``: derivative of the loss by each window's logit."""
        p, n = self.p, self.hidden
        h, u, a, pooled = (keep[k] for k in ("h", "u", "a", "pooled"))
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"], g["out_b"] = pooled.T @ wrong, wrong.sum(keepdims=True)
        d_pool = wrong[:, None] * p["out"]
        d_a = (h * d_pool).sum(axis=2)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        d_u = d_e[:, :, None] * p["att_v"] * (1 - u * u)
        g["att_v"], g["att_b"] = (u * d_e[:, :, None]).sum((0, 1)), d_u.sum((0, 1))
        g["att"] = np.einsum("tbi,tbj->ij", h, d_u)
        d_h = a[:, :, None] * d_pool + d_u @ p["att"].T
        d_x = np.zeros((ids.shape[1], len(ids), x.shape[1]), np.float32)
        for k, way in enumerate("fb"):
            carry = np.zeros((len(ids), n), np.float32)
            d_g = np.zeros((ids.shape[1], len(ids), 3 * n), np.float32)
            for t, before, zr, z, r, c in reversed(keep["tape"][way]):
                d = d_h[t, :, k * n:(k + 1) * n] + carry
                d_c = d * z * (1 - c * c)
                d_rh = d_c @ p[f"{way}_c"].T
                d_z = d * (c - before) * (ids[:, t] > 0)[:, None] * zr[:, :n] * (1 - zr[:, :n])
                d_r = d_rh * before * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], axis=1)
                carry = d * (1 - z) + d_rh * r + d_zr @ p[f"{way}_zr"].T
                g[f"{way}_zr"] += before.T @ d_zr
                g[f"{way}_c"] += (r * before).T @ d_c
                d_g[t, :, :2 * n], d_g[t, :, 2 * n:] = d_zr, d_c
            g[f"{way}_in"] = np.einsum("tbi,tbj->ij", x[ids.T], d_g)
            g[f"{way}_b"] = d_g.sum((0, 1))
            d_x += d_g @ p[f"{way}_in"].T
        bucket, grams, at = inputs
        d_word = np.zeros_like(x)
        np.add.at(d_word, ids.T.ravel(), d_x.reshape(-1, x.shape[1]))
        np.add.at(g["word"], bucket[1:], d_word[1:, :self.size])
        count = np.diff(at)
        np.add.at(g["char"], grams, np.repeat(d_word[:, self.size:] / np.maximum(1, count)[:, None], count, axis=0))
        return g


class Adam:
    def __init__(self, net: Network, rate: float = 0.01):
        self.net, self.rate, self.t = net, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in net.p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        fix = np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, x in g.items():
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.001 * (x * x - self.v[k])
            self.net.p[k] = (self.net.p[k] - self.rate * fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-6)).astype(np.float32)
