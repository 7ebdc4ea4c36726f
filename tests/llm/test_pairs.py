"""Near fingerprints, components, SimHash dedup, fingerprints of edited texts, suffix dedup."""

import hashlib
import random

import brute
import numpy as np
import pytest

from stationlake.llm import fingerprints, hamming, simhash_dedup, suffix_dedup
from stationlake.llm.components import components


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("dense", [False, True])
def test_near_pairs_find_all(spark, dense):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(4 if dense else 60)]
    fps = set(seeds)
    for s in seeds:
        for _ in range(220 if dense else 6):  # dense: far more than a drawer holds
            fps.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    fps = sorted(fps)
    df = spark.createDataFrame([(_long(f), i) for i, f in enumerate(fps)], "fp long, id long")
    got = {tuple(sorted((r["a"], r["b"]))): r["distance"] for r in hamming.near_pairs(df).collect()}
    want = {(i, j): d for i, a in enumerate(fps) for j in range(i + 1, len(fps)) if (d := (a ^ fps[j]).bit_count()) <= 3}
    assert got == want and len(want) > 50


def test_finer_masks_keep_a_pair_together():
    mask = hamming.first_masks(6, 3)[7]
    while bin(mask & (2**64 - 1)).count("1") < 58:
        free = [b for b in range(64) if not mask >> b & 1]
        finer = hamming.finer_masks(mask, 3)
        for _ in range(50):
            far = sum(1 << b for b in random.sample(free, 3))
            assert any(not (far & m & (2**64 - 1)) for m in finer)
        mask = finer[0]


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 90)] + [(2000, 2000), (3001, 3000)]
    random.Random(1).shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 90)} | {3001: 3000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _near_texts():
    rng = random.Random(8)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) + str(rng.randint(0, 999)) for _ in range(900)) for _ in range(5)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(5, 60):
        w = base[i % 5].split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 99)}"
        rows.append((i * 7, " ".join(w)))
    return rows


def test_simhash_against_brute_force(spark, awkward):
    rows = _near_texts()
    got = {r[0]: (int(r[1], 16), r[2]) for r in simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.components(rows)
    assert got == want and len({c for _, c in want.values()}) < len({f for f, _ in want.values()})


def test_simhash_awkward(awkward, nothing):
    rows = brute.awkward()
    want = brute.components(rows)
    got = simhash_dedup.near_duplicates(awkward).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (int(r["fingerprint"], 16), r["component_id"]) == want[r["doc_id"]]
    assert simhash_dedup.near_duplicates(nothing).count() == 0 and simhash_dedup.keep_first(nothing).columns == nothing.columns


def test_one_of_each_group_stays(awkward):
    kept = simhash_dedup.keep_first(awkward)
    assert kept.schema.names == awkward.schema.names
    ids = [r["doc_id"] for r in kept.collect()]
    want = brute.components(brute.awkward())
    assert sorted(i for i in ids if i is not None) == sorted({c for d, (_, c) in want.items() if c < 1 << 70})


def _chain():
    """Texts a, b and c, of which a and c link to b only."""
    rng = random.Random(21)
    while True:
        base = [f"w{rng.randint(0, 999)}" for _ in range(300)]
        made = []
        for _ in range(40):
            w = list(base)
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 999)}"
            made.append(" ".join(w))
        fp = {t: brute.simhash(t) for t in made}
        near = lambda s, t: 0 < (fp[s] ^ fp[t]).bit_count() <= 3
        for b in made:
            around = [t for t in made if near(b, t)]
            for a in around:
                for c in around:
                    if (fp[a] ^ fp[c]).bit_count() > 3:
                        return a, b, c


def test_rows_without_an_id_link_like_any_other(spark):
    a, b, c = _chain()
    rows = [(9, a, 1), (None, b, 2), (4, c, 3), (7, "quite another text", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    got = {r[0]: (r[1], r[2]) for r in simhash_dedup.near_duplicates(docs).select("doc_id", "component_id", "component_size").collect()}
    assert got == {9: (4, 3), None: (4, 3), 4: (4, 3), 7: (7, 1)}
    assert sorted(r["row"] for r in simhash_dedup.keep_first(docs).collect()) == [3, 4]
    docs = spark.createDataFrame([(None, a, 1), (None, b, 2), (None, c, 3)], "doc_id long, text string, row int")
    got = [tuple(r) for r in simhash_dedup.near_duplicates(docs).select("component_id", "component_size").collect()]
    assert got == [(None, 3)] * 3 and simhash_dedup.keep_first(docs).count() == 1


def test_fingerprints_against_brute_force(small_docs, small_rows):
    rows = sorted(small_rows, key=lambda r: -r[0])
    got = {r["doc_id"]: r for r in fingerprints.edited_pairs(small_docs, ranges=7).collect()}
    assert len(got) == len(rows)
    for (d, t, *_), (e, u, *_) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + u[:half]
        assert got[d]["n_chars"] == len(t) and got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d]["fp"] == _votes(t) and got[d]["edited_fp"] == _votes(edited) and got[d]["next_fp"] == got[e]["fp"]


def _votes(text) -> int:
    import xxhash

    total, votes = 0, [0] * 64
    for w in text.lower().encode().split():
        n = min(12, len(w.decode()))
        weight = -(-n**3 // 8)
        h = xxhash.xxh64_intdigest(w, 42)
        total += weight
        for b in range(64):
            votes[b] += weight * (h >> b & 1)
    return _long(sum(1 << b for b in range(64) if 2 * votes[b] > total))


def test_fingerprints_awkward(spark, awkward, nothing):
    out = fingerprints.report(awkward).collect()
    assert len(out) == len(brute.awkward()) and all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in out)
    by_text = {}
    text = {r[0]: r[1] or "" for r in brute.awkward()}
    for r in out:
        if r["doc_id"] is not None:
            assert by_text.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    assert fingerprints.report(nothing).count() == 0
    one = fingerprints.report(spark.createDataFrame([(3, "alone here")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"alonealone").hexdigest()


def test_neighbours_against_brute_force(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = [(i, _long(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))) for i in range(300)]
    got = {r["doc_id"]: (r["n_same"], r["n_near"]) for r in fingerprints.neighbours(spark.createDataFrame(fps, "doc_id long, fp long")).collect()}
    for d, f in fps[::20]:
        same = sum(g == f for _, g in fps) - 1
        near = sum(0 < ((f ^ g) & (2**64 - 1)).bit_count() <= 3 for _, g in fps)
        assert got.pop(d) == (same, near)
    assert not got


@pytest.mark.parametrize("how", [{}, {"chunk": 20_000, "slice_bytes": 30_000, "limit": 5_000}, {"chunk": 60_000, "hot": 2, "limit": 3_000}])
def test_suffix_dedup_against_brute_force(spark, how, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HASHED", 150 if how else suffix_dedup.HASHED)  # most texts are read in pieces
    rng = random.Random(11)
    word = lambda: rng.choice(["alpha", "été", "be", "c"]) + str(rng.randint(0, 60))
    shared = [" ".join(word() for _ in range(rng.randint(9, 40))) for _ in range(6)]
    rows = []
    for i in range(160):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared)[rng.randint(0, 9):], " ".join(word() for _ in range(rng.randint(0, 9)))]
        rows.append((rng.randint(0, 9) * 1000 + i, "".join(parts)))
    got = suffix_dedup.report(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect()
    assert sorted(map(tuple, got)) == brute.suffix_dedup(rows)


def test_suffix_dedup_awkward(awkward, nothing):
    rows = [r[:2] for r in brute.awkward()]
    got = sorted(map(tuple, suffix_dedup.report(awkward).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert got == brute.suffix_dedup(rows)
    left = suffix_dedup.strip(awkward)
    assert left.schema.names == awkward.schema.names and left.count() == len(rows)
    assert {r["doc_id"]: r["text"] for r in left.collect()}[6] == ""
    assert suffix_dedup.report(nothing).count() == 0 and suffix_dedup.strip(nothing).count() == 0


def test_characters_stay_whole():
    raw = "abé\U0001f600z".encode()
    gone = np.array([False, True, True, False, True, True, True, True, True])
    kept = np.frombuffer(raw, np.uint8)[~suffix_dedup._whole_characters(raw, gone)].tobytes().decode()
    assert kept == "aé"


@pytest.mark.parametrize("texts", [["only one text here"], ["a b c d", "e f g h", "i j k l"], [None, "", "x y"], ["same text"] * 40])
def test_fingerprints_where_all_ids_are_null(spark, texts):
    got = fingerprints.report(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")).collect()
    assert len(got) == len(texts) and all(r.near_next is not None and 0 <= r.near_next <= 1 and r.near_edited is not None for r in got)
    n = len(texts)
    whole = [t or "" for t in texts]
    edits = {hashlib.sha256((t[:len(t) - len(t) // 2] + u[:len(t) // 2]).encode()).hexdigest(): 0 for t in whole for u in whole}
    assert all(r.edited_sha256 in edits for r in got)
    if n == 1:
        t = whole[0]
        assert got[0].edited_sha256 == hashlib.sha256((t[:len(t) - len(t) // 2] + t[:len(t) // 2]).encode()).hexdigest() and got[0].near_next == 1
