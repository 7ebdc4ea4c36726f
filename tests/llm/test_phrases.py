"""Phrase mining against counting every phrase in plain Python."""

import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationlake.llm import phrases

DOCS = "doc_id long, text string, lang string"


def pieces(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0a-\x0d]", low)]


def counts(rows):
    f = defaultdict(Counter)
    for text, lang in rows:
        for w in pieces(text):
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f


def mined(rows, least=10, top=2000, share=50):
    out = []
    for lang, f in counts(rows).items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in kept.items():
            if len(p) == 3:
                inside[p[:2]], inside[p[1:]] = max(inside[p[:2]], a), max(inside[p[1:]], a)
        found = []
        for p, a in kept.items():
            if len(p) == 2 and p in inside and 100 * inside[p] >= share * a:
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), left, right))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, left, right, n, s) for i, (s, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def random_docs(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "ÄB", "a-b", "x\x00y", "　", "Foo"]
    weights = [1 / (i + 1) for i in range(len(words))]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; ", "\x0b"]
    return [(i, "".join(w + rng.choice(joins) for w in rng.choices(words, weights, k=rng.randint(0, 60))), rng.choice(["en", "de", None, "und"])) for i in range(n)]


def test_random_documents(spark):
    rows = random_docs(1, 1500)
    want = mined([r[1:] for r in rows])
    assert len(want) > 200 and {w[0] for w in want} == {"en", "de", "und"}
    assert rows_of(phrases.mine(spark.createDataFrame(rows, DOCS))) == want


def test_small_chunks_and_slices_give_the_same(spark, monkeypatch):
    rows = random_docs(2)
    rows.append((999, " ".join(f"w{i % 7} w{i % 5}" for i in range(4000)), "en"))  # cut into many blocks
    monkeypatch.setattr(phrases, "BLOCK", 500)
    docs = spark.createDataFrame(rows, DOCS)
    whole, found = phrases.levels(docs, least=4, chunk_bytes=700, slice_load=300)
    f = counts([r[1:] for r in rows])
    assert {(r.lang, r.n) for r in whole.collect()} == {(k, sum(a for p, a in c.items() if len(p) == 1)) for k, c in f.items()}
    words = {(r.lang, r.id): r.word for r in found[0].collect()}
    pairs = {(r.lang, r.id): (words[r.lang, r.unit], words[r.lang, r.word], r.a) for r in found[1].collect()}
    assert sorted((k[0], *v) for k, v in pairs.items()) == sorted((k, *p, a) for k, c in f.items() for p, a in c.items() if len(p) == 2 and a >= 4)
    triples = [(r.lang, *pairs[r.lang, r.unit][:2], words[r.lang, r.word], r.a) for r in found[2].collect()]
    assert sorted(triples) == sorted((k, *p, a) for k, c in f.items() for p, a in c.items() if len(p) == 3 and a >= 4)
    # ids are ranks: from 1, by falling frequency
    by_id = sorted((r.id, r.a) for r in found[1].collect() if r.lang == "en")
    assert [i for i, _ in by_id] == list(range(1, len(by_id) + 1)) and [a for _, a in by_id] == sorted((a for _, a in by_id), reverse=True)


def test_four_words(spark):
    rows = [(i, "a b c d e " * 3 + "b c d", "en") for i in range(4)]
    _, found = phrases.levels(spark.createDataFrame(rows, DOCS), words=4, least=10)
    seen = Counter(tuple(w[i:i + 4]) for r in rows for w in pieces(r[1]) for i in range(len(w) - 3))
    assert len(found) == 4 and sorted(r.a for r in found[3].collect()) == sorted(a for a in seen.values() if a >= 10)


def test_awkward_rows(spark, awkward, nothing):
    rows = [r[1:3] for r in brute.awkward()]
    assert rows_of(phrases.mine(awkward)) == mined(rows)
    assert rows_of(phrases.mine(awkward, least=2, top=5)) == mined(rows, 2, 5)
    assert phrases.mine(nothing).count() == 0
    assert phrases.mine(awkward.select("text", F.lit(None).cast("string").alias("lang")).where("text = 'one'")).count() == 0
    clash = awkward.select("text", "lang", *[F.lit(i).alias(c) for i, c in enumerate(["rank", "phrase", "a", "l", "r", "n", "score", "chunk", "kind", "slice", "words"])])
    assert rows_of(phrases.mine(clash)) == mined(rows)


def test_ties_and_repeated_rows(spark):
    rows = [(1, "b a . a b . c d . é f . z z z", "x")] * 12
    got = rows_of(phrases.mine(spark.createDataFrame(rows, DOCS)))
    assert got == mined([r[1:] for r in rows]) and [r[2] for r in sorted(got, key=lambda r: r[1])][0] == "c d"


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    df = spark.createDataFrame([(big - 1, big, big + 7), (10, 10, 10), (10, 11, 13)], "a long, l long, r long")
    got = [r[0] for r in df.select(phrases._score("a", "l", "r")).collect()]
    assert got == [1_000_000 * a * a // (left * r) for a, left, r in ((big - 1, big, big + 7), (10, 10, 10), (10, 11, 13))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3000), st.integers(1, 3000)), max_size=200), st.integers(1, 1 << 14), st.integers(1, 9))
def test_plane(pairs, chunks, slices):
    plane = phrases.Plane(3000, 3000, chunks, slices)
    unit, word = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    counted = np.arange(len(unit)) % 5 != 0
    address, count = phrases.chunk_pairs(unit, word, counted, plane)
    assert (np.diff(address.astype(object)) > 0).all()
    want = {p: 0 for p in pairs}
    for p, c in zip(pairs, counted):
        want[p] += int(c)
    assert dict(zip(zip(*(x.tolist() for x in plane.pair(address))), count.tolist())) == want
    tally = phrases.Tally(plane)
    for s, a, c in plane.by_slice(address, count):
        assert 0 <= s < slices
        tally.add(a, c)
        tally.add(a, c)
    a, c = tally.frequent(4)
    assert dict(zip(zip(*(x.tolist() for x in plane.pair(a))), c.tolist())) == {p: 2 * n for p, n in want.items() if 2 * n >= 4}


def test_dense_tiles():
    plane = phrases.Plane(4000, 4000, 1, 1)
    grid = np.arange(1, 301)
    unit, word = (x.ravel() for x in np.meshgrid(grid, grid))
    tally = phrases.Tally(plane)
    address, count = phrases.chunk_pairs(unit, word, np.ones(len(unit), bool), plane)
    for _ in range(3):
        tally.add(address, count)
    tally.add(address[::50], count[::50])
    assert tally.tiles
    a, c = tally.frequent(4)
    assert sorted(a.tolist()) == address[::50].tolist() and set(c.tolist()) == {4}


@pytest.mark.parametrize("most", [1 << 40])
def test_too_many_pairs_are_an_error(most):
    with pytest.raises(ValueError, match="2\\^64"):
        phrases.Plane(most, most, 1, 1)
