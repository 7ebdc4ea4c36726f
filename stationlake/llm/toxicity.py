"""Toxicity by a bidirectional gated recurrent network over all overlapping windows.

A document's words are read in windows of ``WINDOW``, each starting ``STRIDE`` after the one
before, up to the last word; the document's score is that of its most toxic window. The
network (:mod:`stationlake.llm.recurrent`) learns in numpy from a bounded sample of labelled
documents: a window of a document stands for it, drawn at random at first, then the one
that the network itself finds most toxic. A long text is read in pieces that keep all its windows.

Null, empty and blank texts score 0. Without labels of both kinds every other score is the
sample's share of label 1, and :func:`reject` keeps every row. Repeated rows each get their score; other columns are ignored by
:func:`score` and kept by :func:`reject`; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import by_bytes
from stationlake.llm.labelled import held_out, sample
from stationlake.llm.recurrent import Adam, Network, Vocabulary, restrict, sigmoid

WINDOW, STRIDE, THRESHOLD = 32, 16, 0.5
#: Documents of each label to learn from, times that they are read, windows read at once, characters of a frame.
ROWS, EPOCHS, BLOCK, FRAME = 1500, 16, 2048, 2 << 20
#: Words of a piece of a long text (a multiple of the stride), and words of pieces scored together.
PIECE, BATCH = 1 << 17, 1 << 19
BREAK = re.compile(rb"[\x20\x09-\x0D]")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def windows(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows over texts of ``sizes`` words laid end to end in ``ids``, and whose each is.
    A text of n words has windows at 0, STRIDE, .. until one reaches its end; none if n is 0."""
    count = np.where(sizes > 0, np.maximum(0, -(-(sizes - WINDOW) // STRIDE)) + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), count)
    first = np.cumsum(sizes) - sizes
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = (first[owner] + nth * STRIDE)[:, None] + np.arange(WINDOW)
    inside = at < (first + sizes)[owner][:, None]
    padded = np.concatenate([ids, [0]]).astype(np.int32)
    return np.where(inside, padded[np.minimum(at, len(ids))], 0), owner


def logits(net: Network, x: np.ndarray, some: np.ndarray) -> np.ndarray:
    out = [net.forward(x, some[at:at + BLOCK]) for at in range(0, len(some), BLOCK)]
    return np.concatenate(out) if out else np.zeros(0, np.float32)


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in pieces whose windows, taken together, are those of the whole text:
    each piece but the last ends where its last window does, and the next starts a stride later."""
    raw, at, held = (text or "").encode().lower(), 0, []
    while at < len(raw):
        gap = BREAK.search(raw, at + FRAME)
        stop = gap.start() if gap else len(raw)
        held += raw[at:stop].split()
        at = stop
        while len(held) >= PIECE + WINDOW:
            yield held[:PIECE + WINDOW - STRIDE]
            held = held[PIECE:]
    if held:
        yield held


def _batches(texts: list[str | None]) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """The pieces of all texts and whose they are, some ``BATCH`` words at a time."""
    owners, held, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in pieces(text):
            owners.append(i)
            held.append(piece)
            size += len(piece)
            if size >= BATCH:
                yield owners, held
                owners, held, size = [], [], 0
    if held:
        yield owners, held


def document_scores(net: Network, texts: list[str | None]) -> np.ndarray:
    """The score of each text's most toxic window; memory follows ``BATCH``, not the longest text."""
    best = np.full(len(texts), -np.inf)
    for owners, words in _batches(texts):
        vocabulary = Vocabulary()
        ids = vocabulary.ids([w for ws in words for w in ws])
        seen, piece = windows(ids, np.array([len(ws) for ws in words], np.int64))
        np.maximum.at(best, np.array(owners)[piece], logits(net, net.words(vocabulary.inputs()), seen))
    return np.where(np.isfinite(best), sigmoid(best), 0.0)


def fit(texts: list[str | None], label: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network | float:
    """The trained network, or the share of label 1 where only one label occurs."""
    rng, net = np.random.default_rng(seed), Network()
    words = [words_of(t) for t in texts]
    vocabulary = Vocabulary()
    ids = vocabulary.ids([w for ws in words for w in ws])
    seen, owner = windows(ids, np.array([len(ws) for ws in words], np.int64))
    docs = np.unique(owner)
    if len(np.unique(label[docs])) < 2:
        return float(label.mean()) if len(label) else 0.0
    inputs, adam = vocabulary.inputs(), Adam(net)
    weight = np.where(label == 1, 0.5 / max(1e-9, label.mean()), 0.5 / max(1e-9, 1 - label.mean()))
    for epoch in range(epochs):
        if epoch < 3:
            key = rng.random(len(seen))
        elif epoch % 2:
            key = logits(net, net.words(inputs), seen)
        order = np.lexsort((key, owner))
        last = order[np.r_[owner[order][1:] != owner[order][:-1], True]]  # of each document the largest key
        rng.shuffle(last)
        adam.rate = 0.02 if epoch < epochs // 2 else 0.005
        for at in range(0, len(last), 64):
            some = last[at:at + 64]
            used = np.union1d([0], seen[some])
            own, renumbered = restrict(inputs, used), np.searchsorted(used, seen[some])
            x, keep = net.words(own), {}
            out = net.forward(x, renumbered, keep)
            wrong = ((sigmoid(out) - label[owner[some]]) * weight[owner[some]] / len(some)).astype(np.float32)
            adam.step(net.gradients(own, x, renumbered, wrong, keep))
    return net


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Network | float:
    drawn = sample(docs, labels, "toxic", rows)
    return fit(drawn["text"].tolist(), drawn["label"].to_numpy(np.int64))


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; one pass, no shuffle."""

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in by_bytes(frames, "text", FRAME):
            texts = f["text"].tolist()
            if isinstance(model, float):
                scores = np.array([model if words_of(t) else 0.0 for t in texts])
            else:
                scores = document_scores(model, texts)
            yield pd.DataFrame({"doc_id": f["doc_id"], "score": scores})

    out = docs.select(docs["doc_id"].cast("string").alias("doc_id"), docs["text"]).mapInPandas(scored, "doc_id string, score double") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), "score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject(docs: DataFrame, model: Network | float) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns; all rows where
    the sample had one label only, which tells no document from another."""
    if isinstance(model, float):
        return docs

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            at = 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= FRAME):
                    size += len(texts[stop] or "")
                    stop += 1
                some = texts[at:stop]
                scores = document_scores(model, some)
                yield batch.slice(at, stop - at).filter(pa.array(scores < THRESHOLD))
                at = stop

    return docs.mapInArrow(kept, docs.schema)
