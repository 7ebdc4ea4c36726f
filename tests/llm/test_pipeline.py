"""The pipeline stage by stage against brute force on its own input, and the registered queries."""

import brute
import corpus_pipeline
import pytest

from stationlake.llm import mixing, toxicity
from stationlake.llm.common import staged
from stationlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def outputs(spark):
    docs = [spark.read.parquet(f"{brute.SMALL}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(staged(stage(spark, docs[-1], brute.SMALL), name))
    return docs


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_columns(outputs):
    assert all(df.columns == outputs[0].columns for df in outputs[:-1])


def test_toxic_documents_go(spark, outputs):
    labels = spark.read.parquet(f"{brute.SMALL}/labels.parquet")
    model = toxicity.train(outputs[0], labels)
    texts = rows(outputs[0])
    scores = toxicity.document_scores(model, [r[1] for r in texts])
    assert sorted(rows(outputs[1])) == sorted(r for r, s in zip(texts, scores) if s < 0.5)


def test_one_document_of_each_group_stays(outputs):
    group = brute.components(rows(outputs[1]))
    assert sorted(rows(outputs[2])) == sorted(r for r in rows(outputs[1]) if group[r[0]][1] == r[0])


def test_repeated_passages_go(outputs):
    want = {r[0]: r for r in brute.suffix_dedup(rows(outputs[2]))}
    before = {r[0]: r for r in rows(outputs[2])}
    after = {r[0]: r for r in rows(outputs[3])}
    assert set(after) == set(before)
    for d, (_, n, removed, spans, _) in want.items():
        left = len((after[d][1] or "").encode())
        assert n - removed <= left <= n - removed + 6 * spans  # whole characters at the edges of each span
        assert after[d][2:4] == before[d][2:4] and after[d][4] == len(after[d][1])


def test_mixing_meets_its_targets(outputs):
    want = {r[0]: r[4] for r in brute.mixing(rows(outputs[3]), mixing.WEIGHTS, mixing.EPOCHS, mixing.SEED)}
    found = dict.fromkeys(want, 0)
    for r in rows(outputs[4]):
        found[r[0]] += len(brute.words(r[1]))
    assert found == want


def test_packing_takes_every_token(outputs):
    from test_rows import _pieces, by_id

    assert by_id([r[:5] for r in rows(outputs[5])]) == _pieces(rows(outputs[4]), 4096)


def test_run_is_the_stages(spark, outputs):
    got = corpus_pipeline.run(spark, brute.SMALL)
    assert sorted(rows(got.drop("sequence_id", "offset"))) == sorted(rows(outputs[5].drop("sequence_id", "offset")))


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not q.startswith("op11")))
def test_queries_return_a_row_for_each_input_row(spark, name):
    table = {"op7": "pages", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{brute.SMALL}/{table}.parquet").count()
    out = QUERIES[name](spark, brute.SMALL).count()
    if name.startswith("op2_"):
        assert out >= n  # pieces
    else:
        assert out == n * (8 if name.startswith("op12") else 1)


def test_phrases_are_ranked_within_their_language(spark):
    got = QUERIES["op11_phrase_mining"](spark, brute.SMALL).collect()
    by_lang = {lang: sorted((r for r in got if r.lang == lang), key=lambda r: r["rank"]) for lang in {r.lang for r in got}}
    for some in by_lang.values():
        assert [r["rank"] for r in some] == list(range(1, len(some) + 1)) and len(some) <= 2000
        order = [(-r.score, -r.a, r.phrase.encode()) for r in some]
        assert order == sorted(order) and all(r.a >= 10 and r.score == min(r.score, 1_000_000) for r in some)
