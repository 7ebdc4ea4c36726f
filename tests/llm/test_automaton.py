import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm import automaton, language_model

BITS = (64, 64)


def _model(texts, priors=language_model.PRIORS, held=()):
    ids = [next(str(k) for k in range(i * 1000, i * 1000 + 999) if language_model.is_held_out(str(k)) == (i in held)) for i in range(len(texts))]
    chunk = language_model.Chunk.of(ids, texts, BITS)
    grams = list(chunk.grams())
    totals = [count for _, _, count in grams]
    n, v = int(totals[0].sum()), int((totals[0] > 0).sum())
    known = (totals, n, v, int((~chunk.held).sum()))
    return chunk, known, language_model.automaton_of(chunk, [where for _, where, _ in grams], *known, priors)


def _plain(model, state, word):
    """One arc at a time, through a dictionary."""
    arcs = {int(a): i for i, a in enumerate(model.arcs)}
    total = 0.0
    while (i := arcs.get(int(state) * model.words + int(word))) is None:
        total += model.fail_weights[state]
        state = model.fail[state]
    return total + model.weights[i], int(model.targets[i])


TEXTS = ["a b a c", "b a", "c c c b", None, "a b a b a b a", "q only held words q"]


def test_arcs_of_every_state_sum_to_one():
    chunk, (totals, n, v, texts), (model, _, _) = _model(TEXTS, held=(5,))
    seen = np.flatnonzero(totals[0] > 0)
    unseen = np.flatnonzero((totals[0] == 0) & (np.arange(len(totals[0])) != chunk.start()))
    assert len(unseen) and len(model.fail) > 10
    for state in range(len(model.fail)):
        words = np.append(seen, unseen[0])  # all unseen words weigh the same
        weight, _ = model.read(np.full(len(words), state, np.int32), words)
        assert (10 ** weight).sum() == pytest.approx(1)


def test_failure_arcs_shorten_the_context_and_end_at_the_root():
    _, _, (model, _, begin) = _model(TEXTS, held=(5,))
    assert model.fail[automaton.ROOT] == automaton.ROOT and begin != automaton.ROOT
    assert (model.fail[1:] < np.arange(1, len(model.fail))).all()
    assert (model.fail_weights[1:] < 0).all()
    assert len(np.unique(model.arcs)) == len(model.arcs)


def test_a_read_follows_the_arcs_one_by_one():
    _, _, (model, _, _) = _model(TEXTS, held=(5,))
    states, words = (x.ravel() for x in np.meshgrid(np.arange(len(model.fail)), np.arange(model.words)))
    weight, reached = model.read(states.astype(np.int32), words)
    for s, w, x, r in zip(states, words, weight, reached):
        want, target = _plain(model, s, w)
        assert x == pytest.approx(want) and r == target


@settings(max_examples=40, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from("abcd"), max_size=40).map(" ".join), min_size=1, max_size=6),
       held=st.sets(st.integers(0, 5)), span=st.integers(1, 9))
def test_texts_cut_in_spans_are_walked_like_whole_ones(texts, held, span):
    chunk, _, (model, after, begin) = _model(texts, held=held)
    starts = np.cumsum(chunk.sizes) - chunk.sizes
    whole = []
    for at, size in zip(starts, chunk.sizes):
        state, total = begin, 0.0
        for i in range(at, at + size):  # one traversal that carries its state
            weight, state = _plain(model, state, chunk.tokens[i])
            assert state == after[i]
            total += weight
        whole.append(total)
    text, place, size = automaton.spans(chunk.sizes, span)
    assert size.max() <= span and np.bincount(text, size).tolist() == chunk.sizes.tolist()
    first = np.isin(place, starts)
    got = model.walk(chunk.tokens, place, size, np.where(first, begin, after[place - 1]))
    assert np.bincount(text, got) == pytest.approx(whole)


def test_a_text_of_megabytes_is_read_by_many_cursors():
    rng = np.random.default_rng(3)
    long = " ".join(f"w{i}" for i in rng.integers(0, 300, 400_000))
    chunk, known, (model, after, begin) = _model([long, "short text", ""])
    _, base, got = language_model.score_chunk(chunk, *known)
    one_by_one = model.walk(chunk.tokens, np.cumsum(chunk.sizes)[1:] - chunk.sizes[1:], chunk.sizes[1:], np.full(2, begin))
    assert got[1:] == pytest.approx(one_by_one) and got[0] > base[0]
