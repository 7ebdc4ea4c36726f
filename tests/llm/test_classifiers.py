"""Plain loops over games, words and windows against the two classifiers."""

import math
import zlib

import brute
import numpy as np
import pytest

from stationlake.llm import quality_classifier, toxicity
from stationlake.llm.recurrent import CHAR_BUCKETS, EDGE, WORD_BUCKETS, Network, Vocabulary


# quality

def _games(n, games):
    """A labelled sample and the games that the classifier draws from it."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 4)) * [1, 3, 0.1, 0] + [0, 5, 1, 2]
    label = (x[:, 0] + rng.normal(size=n) > 0.3).astype(int)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    draw = np.random.default_rng(11)
    losers = [b for b in bad for _ in range(games)] + list(draw.choice(bad, len(good)))
    winners = list(draw.choice(good, len(bad) * games)) + list(good)
    return x, label, list(zip(winners, losers))


def _loss(z, w, games, penalty):
    raw = [sum(a * b for a, b in zip(row, w)) for row in z]
    return sum(math.log1p(math.exp(raw[lose] - raw[win])) for win, lose in games) + penalty / 2 * sum(a * a for a in w)


def test_weights_minimise_the_games_loss():
    x, label, games = _games(60, 5)
    model = quality_classifier.fit(x, label, games=5)
    z = np.clip((x - x.mean(0)) / (x.std(0) + 1e-6), -8, 8).tolist()
    least = _loss(z, model.weights.tolist(), games, quality_classifier.PENALTY)
    assert least < _loss(z, [0.0] * 4, games, quality_classifier.PENALTY)
    for i in range(4):
        for step in (-0.02, 0.02):
            moved = model.weights.tolist()
            moved[i] += step
            assert _loss(z, moved, games, quality_classifier.PENALTY) > least
    raw = sorted(sum(a * b for a, b in zip(row, model.weights)) for row in z)
    k = int((label == 0).sum())  # the quantile that label 0 fills
    assert raw[k - 1] <= model.threshold <= raw[k]
    assert sorted(model.score(x) >= quality_classifier.THRESHOLD) == [False] * k + [True] * (60 - k)


def test_scores_follow_from_features_one_text_at_a_time(spark, awkward):
    texts = [r[1] for r in brute.awkward()]
    x = np.array([quality_classifier.features(t) for t in texts])
    assert np.isfinite(x).all()
    model = quality_classifier.fit(x, np.arange(len(x)) % 2)
    want = []
    for row in x:
        raw = sum(max(-8, min(8, (v - c) / s)) * w for v, c, s, w in zip(row, model.centre, model.scale, model.weights))
        want.append(1 / (1 + math.exp(-(raw - model.threshold + math.log(3 / 7)))))
    got = quality_classifier.score(awkward, model).collect()
    assert sorted(round(r["score"], 9) for r in got) == sorted(round(v, 9) for v in want)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


# toxicity

def _vector(net, word):
    """A word's input: its own embedding beside the mean of its character 4-grams'."""
    bare = word.strip(EDGE) or word
    line = b" " + bare + b"  "
    out = list(map(float, net.p["word"][zlib.crc32(bare) % (WORD_BUCKETS - 1) + 1]))
    grams = []
    for i in range(len(bare)):
        mixed = sum(line[i + j] * k for j, k in enumerate((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)))
        grams.append(net.p["char"][(mixed ^ (mixed >> 15)) % CHAR_BUCKETS])
    return out + [sum(float(g[d]) for g in grams) / len(grams) for d in range(net.size)]


def _logit(net, words):
    """One window, one step and one number at a time."""
    p, n = net.p, net.hidden
    squash = lambda v: 1 / (1 + math.exp(-v))
    dot = lambda v, m, j: sum(a * float(m[i, j]) for i, a in enumerate(v))
    x = [_vector(net, w) for w in words]
    states = {}
    for way in "fb":
        h, states[way] = [0.0] * n, [None] * len(x)
        for t in range(len(x)) if way == "f" else reversed(range(len(x))):
            g = [dot(x[t], p[f"{way}_in"], j) + float(p[f"{way}_b"][j]) for j in range(3 * n)]
            z = [squash(g[j] + dot(h, p[f"{way}_zr"], j)) for j in range(n)]
            r = [squash(g[n + j] + dot(h, p[f"{way}_zr"], n + j)) for j in range(n)]
            c = [math.tanh(g[2 * n + j] + dot([a * b for a, b in zip(r, h)], p[f"{way}_c"], j)) for j in range(n)]
            h = [(1 - a) * b + a * d for a, b, d in zip(z, h, c)]
            states[way][t] = h
    both = [f + b for f, b in zip(states["f"], states["b"])]
    e = [sum(math.tanh(dot(h, p["att"], j) + float(p["att_b"][j])) * float(p["att_v"][j]) for j in range(n)) for h in both]
    a = [math.exp(v - max(e)) for v in e]
    pooled = [sum(w * h[j] for w, h in zip(a, both)) / sum(a) for j in range(2 * n)]
    return sum(v * float(o) for v, o in zip(pooled, p["out"])) + float(p["out_b"][0])


def _best(net, text):
    words, scores, at = toxicity.words_of(text), [], 0
    while words:
        scores.append(_logit(net, words[at:at + toxicity.WINDOW]))
        if at + toxicity.WINDOW >= len(words):
            break
        at += toxicity.STRIDE
    return 1 / (1 + math.exp(-max(scores))) if scores else 0.0


@pytest.mark.parametrize("small", [False, True])
def test_scores_against_a_network_of_single_steps(small, monkeypatch):
    if small:  # every text is cut in pieces, and pieces are scored in many batches
        monkeypatch.setattr(toxicity, "FRAME", 40)
        monkeypatch.setattr(toxicity, "PIECE", toxicity.STRIDE)
        monkeypatch.setattr(toxicity, "BATCH", 30)
    net = Network(seed=9)
    texts = [t for _, t, *_ in brute.awkward() if len(t or "") < 6000][:22]
    texts += [" ".join(f"n{i}" for i in range(n)) for n in (15, 16, 17, 31, 32, 33, 47, 48, 49, 64, 80, 81)]
    assert toxicity.document_scores(net, texts) == pytest.approx([_best(net, t) for t in texts], abs=1e-5)


@pytest.mark.parametrize("n", [1, 16, 17, 31, 32, 33, 48, 49, 63, 64, 65, 96, 200, 1000])
def test_pieces_have_the_windows_of_the_whole_text(n, monkeypatch):
    monkeypatch.setattr(toxicity, "FRAME", 50)
    monkeypatch.setattr(toxicity, "PIECE", 48)
    text = " \n".join(f"w{i}" for i in range(n))
    whole, _ = toxicity.windows(np.arange(1, n + 1), np.array([n]))
    parts = list(toxicity.pieces(text))
    flat = np.array([int(w[1:]) + 1 for p in parts for w in p])
    cut, _ = toxicity.windows(flat, np.array([len(p) for p in parts]))
    assert cut.tolist() == whole.tolist()
    assert max(map(len, parts)) < 48 + toxicity.WINDOW
    assert [list(toxicity.pieces(t)) for t in (None, "", " \n ")] == [[], [], []]


def test_a_text_of_megabytes_is_scored_in_pieces():
    net = Network(seed=9)
    words = [f"w{i % 4001}" for i in range(600_000)]
    words[571_234] = "singular"
    parts = list(toxicity.pieces(" ".join(words)))
    assert len(parts) == 5 and max(map(len, parts)) < toxicity.PIECE + toxicity.WINDOW
    ids = Vocabulary().ids(words)
    seen, _ = toxicity.windows(ids, np.array([len(words)]))
    assert sum(len(toxicity.windows(np.arange(len(p)), np.array([len(p)]))[0]) for p in parts) == len(seen)
    assert 0 < toxicity.document_scores(net, [" ".join(words), "short"])[0] < 1


def test_gradients_against_differences():
    net = Network(seed=4)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    vocabulary = Vocabulary()
    ids = np.zeros((2, 5), np.int32)
    ids[0], ids[1, :3] = vocabulary.ids([b"a", b"bc", b"def!", b"a", b"ghij"]), vocabulary.ids([b"bc", b"new", b"def!"])
    inputs = vocabulary.inputs()

    def loss():
        return float((net.forward(net.words(inputs), ids) * [0.7, -1.3]).sum())

    keep = {}
    x = net.words(inputs)
    net.forward(x, ids, keep)
    g = net.gradients(inputs, x, ids, np.array([0.7, -1.3]), keep)
    rng = np.random.default_rng(1)
    for k, v in net.p.items():
        busy = np.flatnonzero(g[k].ravel())
        for i in rng.choice(busy, min(4, len(busy)), replace=False):
            old = v.ravel()[i]
            sides = []
            for step in (0.01, -0.01):
                v.ravel()[i] = old + step
                sides.append(loss())
            v.ravel()[i] = old
            assert g[k].ravel()[i] == pytest.approx((sides[0] - sides[1]) / 0.02, rel=0.05, abs=2e-3)
