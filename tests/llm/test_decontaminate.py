"""Wu-Manber search against looking for every window everywhere."""

import hashlib
import random
import re

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm import decontaminate

ITEMS = "item_id long, text string"


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def judged(docs, items):
    wanted = {}
    for name, text in items:
        w = words(text)
        for i in range(max(0, len(w) - 10) + 1 if w else 0):
            wanted.setdefault(tuple(w[i:i + 10]), set()).add("" if name is None else str(name))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(g) for g in wanted}:
            for i in range(len(w) - k + 1):
                if (g := tuple(w[i:i + k])) in wanted:
                    hit.update(range(i, i + k))
                    found |= wanted[g]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def planted(seed, n=200):
    rng = random.Random(seed)
    some = [rng.choice("abcdé") * rng.randint(1, 3) + rng.choice("xyz") for _ in range(60)]
    items = [(i, " ".join(rng.choices(some, k=rng.choice([1, 2, 3, 9, 10, 11, 14, 40])))) for i in range(30)]
    items += [(30, None), (31, "..."), (None, "only null item words here"), (3, "second text of item three"), (32, items[5][1])]
    docs = []
    for i in range(n):
        w = rng.choices(some, k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            passage = (rng.choice(items)[1] or "").upper().split()
            cut = rng.randint(0, max(0, len(passage) - 9))
            at = rng.randint(0, len(w))
            w[at:at] = passage[cut:]
        docs.append((i, rng.choice([" ", "\n", " ... ", "-"]).join(w)))
    return docs, items


@pytest.mark.parametrize("most", [decontaminate.MOST, 300])
def test_planted_passages(spark, most):
    docs, items = planted(1)
    got = decontaminate.judge(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), most=most)
    want = judged(docs, items)
    assert sum(w[5] for w in want) > 50 and not all(w[5] for w in want)
    assert rows_of(got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == want


@pytest.mark.parametrize("most", [decontaminate.MOST, 60])
def test_awkward_rows(spark, awkward, nothing, most):
    rows = brute.awkward()
    items = [(1, rows[6][1]), (2, "word7 tail7 word8 tail8 word9 tail9 word10 tail10 word11 tail11 word12"), (3, "naïve"), (None, "large ID"), (4, "")]
    benchmark = spark.createDataFrame(items, ITEMS)
    got = decontaminate.judge(awkward.drop("lang", "source"), benchmark, most=most)
    want = judged([r[:2] for r in rows], items)
    assert rows_of(got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == want
    assert decontaminate.judge(nothing, benchmark, most=most).count() == 0
    kept = decontaminate.reject(awkward, benchmark)
    assert kept.columns == awkward.columns and kept.count() == sum(not w[5] for w in want)
    assert rows_of(decontaminate.report(awkward, benchmark.limit(0))) == judged([r[:2] for r in rows], [])
    clash = awkward.selectExpr("doc_id", "text", "1 as n_words", "'x' as items", "2 as item_id", "row")
    assert rows_of(decontaminate.report(clash, benchmark)) == want


def test_pieces_of_a_task(spark, monkeypatch):
    docs, items = planted(2, 60)
    monkeypatch.setattr(decontaminate, "PIECE", 50)
    monkeypatch.setattr(decontaminate, "STRETCH", 7)
    got = decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    assert rows_of(got) == judged(docs, items)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab ", max_size=30), max_size=8), st.lists(st.text("ab ", max_size=40), max_size=5))
def test_every_occurrence(texts, items):
    matcher = decontaminate.Matcher(decontaminate.windows(enumerate(items)))
    n, hits = matcher.search(texts) if texts else ([], {})
    want = judged(enumerate(texts), enumerate(items))
    got = sorted(((i, int(n[i]), decontaminate._covered(int(n[i]), *hits[i][:2]) if i in hits else 0, len(hits[i][2]) if i in hits else 0,
                   decontaminate._digest(hits[i][2] if i in hits else []), i in hits) for i in range(len(texts))), key=str)
    assert got == want
