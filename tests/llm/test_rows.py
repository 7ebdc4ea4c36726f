"""Operators that judge, score, pack or mix rows."""

import zlib
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationlake.llm import (
    language_model, mixing, packing, quality_classifier, quality_rules, toxicity, url_filter,
)
from stationlake.llm.labelled import sample

PATH = public_tokenizers.path("word_bpe_49k.json")


def by_id(rows, key=lambda r: r[0]):
    return sorted(rows, key=lambda r: (key(r) is None, key(r) or 0, tuple(map(str, r))))


# packing

def _pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for d, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.append((d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return by_id(out)


@pytest.mark.parametrize("which", ["awkward", "small"])
def test_packing(which, awkward, small_docs, small_rows):
    rows = brute.awkward() if which == "awkward" else small_rows
    packed = packing.pack(awkward if which == "awkward" else small_docs, PATH, capacity=512, group=100).collect()
    assert by_id([tuple(r)[:5] for r in packed]) == _pieces(rows, 512)
    bins = defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 512
    assert len(bins) <= -(-sum(r["length"] for r in packed) // 512) + 2 * (len(packed) // 100 + 1)


def test_packing_numerals_among_letters(spark):
    latin = [w for c in map(chr, range(0x80, 0x250)) for w in (c, "a" + c, c + "b", "Km" + c + ".", c + c + "é")]
    rows = [(i, w) for i, w in enumerate(["area of 5 km²", "m³", "x¹", "a²b", "a½ cup", " ".join(latin), *latin])]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, capacity=512, group=5000).collect()
    assert by_id([tuple(r)[:5] for r in packed]) == _pieces(rows, 512)


def test_packing_many_equal_rows(spark):
    """Ten thousand rows of one id, and as many without an id, are spread over the groups, each packed once."""
    rows = [(7, "one two three")] * 10_000 + [(None, "four five")] * 10_000
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, capacity=512, group=500).toPandas()
    assert packed["doc_id"].isna().sum() == 10_000 and (packed["doc_id"] == 7).sum() == 10_000
    per_group = (packed["sequence_id"] // (1 << 32)).value_counts()
    assert len(per_group) == 40 and per_group.max() < 2000
    for _, f in packed.sort_values("offset").groupby("sequence_id"):
        assert (f["offset"].to_numpy() == f["length"].cumsum().to_numpy() - f["length"].to_numpy()).all() and f["length"].sum() <= 512


def test_packing_nothing(nothing):
    assert packing.pack(nothing, PATH).count() == 0


# mixing

@pytest.mark.parametrize("which", ["awkward", "small"])
def test_mixing(which, awkward, small_docs, small_rows, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 3)
    rows = brute.awkward() if which == "awkward" else small_rows
    docs = awkward if which == "awkward" else small_docs
    got = mixing.plan(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    want = brute.mixing(rows, mixing.WEIGHTS, mixing.EPOCHS, mixing.SEED)
    assert by_id(map(tuple, got)) == by_id(want)
    assert sum(r["taken"] for r in got) == pytest.approx(sum(r["size"] for r in got), abs=len({r[3] for r in rows}))
    assert all(r["taken"] <= 3 * r["size"] for r in got)


def test_mixed_texts_hold_the_words_taken(small_docs):
    taken = {r["doc_id"]: r["taken"] for r in mixing.plan(small_docs).collect()}
    mixed = mixing.apply(small_docs)
    assert mixed.schema.names == small_docs.schema.names
    found = defaultdict(int)
    for r in mixed.collect():
        found[r["doc_id"]] += len(brute.raw_words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert {d: n for d, n in taken.items() if n} == {d: n for d, n in found.items() if n}


def test_a_text_taken_in_part_keeps_its_white_space(spark):
    rows = [(i, f"\n one  two\t{i}\n\nthree \x0b four five\n", "a" if i % 3 else "b") for i in range(40)]
    text, whole = {r[0]: r[1] for r in rows}, len(rows[0][1].split())
    mixed = mixing.apply(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(2, 1)).collect()
    cut = [r for r in mixed if r["text"] != text[r["doc_id"]]]
    assert cut and all(text[r["doc_id"]].startswith(r["text"]) and 0 < len(r["text"].split()) < whole for r in cut)


def test_mixing_awkward(awkward, nothing):
    assert mixing.apply(awkward).schema.names == awkward.schema.names and mixing.apply(awkward).count() > 0
    assert mixing.plan(nothing).count() == 0 and mixing.apply(nothing).count() == 0


# quality rules

def test_quality_rules(awkward, small_docs, small_rows, nothing):
    for docs, rows in ((awkward, brute.awkward()), (small_docs, small_rows)):
        got = quality_rules.judge(docs).collect()
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert by_id([(r["doc_id"], *(r[n] for n in names)) for r in got]) == by_id([(r[0], *brute.quality(r[1])) for r in rows])
        for r in got:
            verdict = not r["base_failed"] and all(
                (low is None or r[a] >= low * r[b]) and (high is None or r[a] <= high * r[b]) for _, a, b, low, high in quality_rules.RULES)
            assert r["kept"] == verdict
    assert quality_rules.judge(nothing).count() == 0


def test_both_ways_to_find_repeats_agree(awkward, monkeypatch):
    want = quality_rules.judge(awkward).select("n_repeat_words").collect()
    for few in (0, 10**6):
        monkeypatch.setattr(quality_rules, "FEW", few)
        assert quality_rules.judge(awkward.where("length(text) < 9000 or text is null")).count() > 0
        assert sorted(map(tuple, quality_rules.judge(awkward.where("length(coalesce(text, '')) < 9000")).select("n_repeat_words").collect())) == \
            sorted(tuple(r) for r, d in zip(want, awkward.collect()) if len(d["text"] or "") < 9000)


# URL filters

URLS = ["http://a.net/x", "https://EXAMPLE.net/en/1?q#f", "http://www.example.net/en/", "http://example.net/en", "http://example.com/de/5",
        "http://m.example.com/fr/", "ftp://b.org/fr/9", "http://b.org/fr", "http://net", "http://net/", "no scheme net/", "", None,
        "http://notnet/x", "http://x.net?y=/", "http://casino.org/", "http://best-casino-win.com", "http://mycasino.com/",
        "http://a.net\n/x", "http://u:p@c.NET:80/p", "x://y://z.net/q", "http://free-bets.org/fr/1", "http://free-bets.example.net/de/"]


def _verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(h + p, v) for h, p, v in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fit, key=lambda r: len(r[0]), default=(None, None))
    spam = any(f"-{k}-" in "-" + "".join(c if c.isalnum() else "-" for c in host) + "-"
               for k in ("casino", "cheap-pills", "free-bets", "poker", "porn", "spam-farm", "viagra", "xxx"))
    return host, path, rule, verdict or ("block" if spam else "allow")


def test_url_filter(spark):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS + URLS[:3])] + [(None, "http://q.net/", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string")
    got = by_id([tuple(r) for r in url_filter.judge(pages).collect()])
    assert got == by_id([(i, *_verdict(u)) for i, u, *_ in rows])
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.createDataFrame([(i, f"http://a{i}.example.net/en/") for i in range(9)] + [(9, "http://x.net/")], "page_id long, url string")
    urls = url_filter.with_parts(pages)
    token = url_filter.rarest_tokens(urls, url_filter.CONTRACT_RULES)
    assert {r.name: t for r, t in token.items()} == {"net/": "net", "example.net/en/": "en", "example.com/de/": "com", "org/fr/": "fr"}


# language model

@pytest.mark.parametrize("how", [{}, {"chunk_chars": 3000, "slice_chars": 20_000}])
def test_language_model(how, awkward, nothing):
    rows = brute.awkward()
    want = brute.language_model(rows, language_model.PRIORS)
    got = language_model.score(awkward, **how).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            w = want[r["doc_id"]]
            assert tuple(r)[1:5] == w[:4] and r["base_score"] == pytest.approx(w[4]) and r["score"] == pytest.approx(w[5])
    # rows without an id are trained on and scored like the same texts under an id
    named = [(-100 - i, *r[1:]) if r[0] is None else r for i, r in enumerate(rows)]
    named = [(next(k for k in range(r[0] * 50, r[0] * 50 - 49, -1) if not language_model.is_held_out(str(k))), *r[1:])
             if r[0] is not None and -300 < r[0] <= -100 else r for r in named]
    alike = brute.language_model(named, language_model.PRIORS)
    assert sorted((r["n_tokens"], round(r["score"], 6)) for r in got if r["doc_id"] is None) == sorted(
        (alike[d][1], round(alike[d][5], 6)) for d, *_ in named if d is not None and d <= -5000)
    assert language_model.score(nothing).count() == 0


# classifiers

def _labelled(spark, n=400):
    rng = np.random.default_rng(0)
    docs, labels = [], []
    for i in range(n):
        w = [f"w{rng.integers(0, 900)}" for _ in range(rng.integers(5, 150))]
        toxic, junk = i % 3 == 0, i % 4 == 0
        if toxic:
            w[rng.integers(0, len(w))] = rng.choice(["vile!", "Vilest", "vileness,"])
        docs.append((i, " ".join(x + "%%%" if junk else x for x in w), 0.5, "y"))
        labels.append((i, int(not junk), int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string, score double, predicted string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_classifier(spark, awkward, nothing):
    docs, labels = _labelled(spark)
    got = quality_classifier.score(docs, quality_classifier.train(docs, labels)).collect()
    assert all(0 <= r["score"] <= 1 for r in got)
    right = [(r["predicted"] == 1) == (r["doc_id"] % 4 != 0) for r in got if r["held_out"]]
    assert np.mean(right) > 0.95 and len(right) > 40
    model = quality_classifier.train(awkward, labels)
    assert quality_classifier.score(awkward, model).count() == len(brute.awkward()) and quality_classifier.score(nothing, model).count() == 0
    none = quality_classifier.train(docs, labels.limit(0))
    assert all(r["score"] == pytest.approx(0.5) for r in quality_classifier.score(docs, none).collect())


def test_games_move_only_by_differences():
    x = np.array([[1.0, 5.0], [2.0, 5.0], [3.0, 5.0], [4.0, 5.0]])
    model = quality_classifier.fit(x, np.array([0, 0, 1, 1]))
    s = model.score(x)
    assert (np.diff(s) > 0).all() and model.weights[1] == 0 and s[1] < 0.3 <= s[2]


def test_toxicity(spark, awkward, nothing):
    docs, labels = _labelled(spark, 1200)
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    held = [(r["predicted"], int(r["doc_id"] % 3 == 0)) for r in got if r["held_out"]]
    assert np.mean([p == t for p, t in held]) > 0.9
    left = toxicity.reject(docs, model)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in got if r["score"] < 0.5}
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(awkward, model).collect()}
    assert scores[0] == scores[1] == scores[2] == 0 and len(scores) > 20
    assert toxicity.score(nothing, model).count() == toxicity.reject(nothing, model).count() == 0
    flat = toxicity.train(docs, labels.where("toxic = 0"))
    assert flat == 0.0 and toxicity.reject(docs, flat).count() == 1200


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs, labels = _labelled(spark)
    drawn = sample(docs, labels.unionByName(labels.limit(50)), "toxic", 60)
    assert len(drawn) == 120 and drawn["doc_id"].is_unique
    assert all(zlib.crc32(str(d).encode()) % 5 for d in drawn["doc_id"])
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sample(docs, turned, "toxic", 60).equals(sample(docs, labels, "toxic", 60))


def test_absent_documents_cost_no_sample_row_and_long_ones_are_learnt_from(spark):
    long = F.expr("id % 4 < 2")
    text = F.when(long, F.concat(F.repeat(F.lit("x "), 50_001), F.repeat(F.lit("é "), 20_000))).otherwise("short text")
    docs = spark.range(400).select(F.col("id").alias("doc_id"), text.alias("text"))
    labels = spark.range(800).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    drawn = sample(docs, labels, "toxic", 30)
    assert drawn["label"].value_counts().to_dict() == {0: 30, 1: 30}
    windows = [t for t in drawn["text"] if t != "short text"]
    whole = "x " * 50_001 + "é " * 20_000
    assert len(windows) > 10 and all(len(t) == 25_000 and t in whole for t in windows) and len(set(windows)) > 3
    assert len(drawn) - len(windows) > 10
    one = toxicity.train(docs, labels.where("toxic = 1"))
    assert one == 1.0 and toxicity.reject(docs, one).count() == 400


def test_an_id_of_many_rows_is_one_sample_row(spark):
    docs = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text")) \
        .unionByName(spark.createDataFrame([(8, None), (8, "other"), (9, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (7, 1), (8, 0), (9, 0)], "doc_id long, toxic int")
    drawn = sample(docs, labels, "toxic", 30)
    assert len(drawn) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in (7, 8, 9))
    assert drawn["doc_id"].is_unique and all(t == "other" for t in drawn[drawn["doc_id"] == 8]["text"])
    assert drawn.equals(sample(docs.repartition(5), labels, "toxic", 30))


def test_quality_learns_from_every_labelled_document(spark, monkeypatch):
    for name, value in (("GROUP", 16), ("FEWEST", 4), ("PER_FILE", 2), ("BINS", 8)):
        monkeypatch.setattr(quality_classifier, name, value)
    texts = [(i, f"{'good words here. ' if i % 5 else 'BAD!! 99 '}" * (i % 7 + 1)) for i in range(400)]
    docs = spark.createDataFrame(texts + texts[:20], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(400)], "doc_id long, quality int")
    own = [(i, t) for i, t in texts if zlib.crc32(str(i).encode()) % 5]
    x = np.array([quality_classifier.features(t) for _, t in own])
    good = sum(i % 5 > 0 for i, _ in own)
    rows = quality_classifier.learnable(docs, labels)
    assert rows.count() == len(own)
    placed = quality_classifier.dealt(rows, good, len(own) - good).collect()
    assert sorted(r["doc_id"] for r in placed if r["own"]) == [i for i, _ in own]
    assert all({r["label"] for r in placed if r["group"] == g} == {0, 1} for g in {r["group"] for r in placed})
    model = quality_classifier.train(docs, labels)
    assert np.allclose(model.centre, x.mean(0)) and np.allclose(model.scale, x.std(0) + 1e-6)
    raw = np.sort(np.clip((x - model.centre) / model.scale, -8, 8) @ model.weights)
    k = len(own) - good
    assert model.threshold == pytest.approx((raw[k - 1] + raw[k]) / 2)
    assert np.array_equal(model.weights, quality_classifier.train(docs.repartition(3), labels).weights)
    assert sum(r["predicted"] == int(r["doc_id"] % 5 > 0) for r in quality_classifier.score(docs, model).collect()) >= 415


def test_value_at_a_rank(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "BINS", 4)
    values = [float(i % 37) ** 2 for i in range(500)]
    raw = spark.createDataFrame([(v,) for v in values], "raw double")
    for k in (0, 1, 250, 498, 499):
        assert quality_classifier.value_at(raw, 500, k) == sorted(values)[k]
