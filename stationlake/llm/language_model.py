"""LM scoring by a weighted backoff automaton over smoothed n-grams.

Up to three words in a row are counted over the training documents. A state of the
automaton is a context that was seen (two words, one, or none); it has an arc for each
word seen after it, whose weight is the smoothed log-probability

    p(w | context) = (count(context w) + prior * p(w | shorter context)) / (count(context) + prior)

and a failure arc to the state of the shorter context, whose weight
log(prior / (count(context) + prior)) is added where the word has no arc. The shortest
context has an arc for every word, known or not: (count + 1) / (N + V + 1). A text is read
once from left to right: a cursor carries the state, follows an arc or failure arcs at each
word, and sums their weights (:mod:`stationlake.llm.automaton`). A long text is read by several
cursors, each set down in the state that the two words before it lead to. The probabilities of all
words after a context sum to one.

Nothing is broadcast. Documents are read in chunks; a chunk sends the hashes of the n-grams
it has, each once, with its training counts, to the slices of the key space, and gets
the totals over the corpus back: the part of the automaton that its own texts can reach. What
is exchanged grows with the corpus and no task's share does.

``docs`` must give the same rows in the same order when a task is repeated, as files do.
Null text counts as empty: its only token is the end. Repeated rows count and are scored
each on their own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.automaton import ROOT, Automaton, spans
from stationlake.llm.common import by_bytes, parts
from stationlake.llm.exchange import bundle, mixed, pack, pack_sorted, slice_bounds, unbundle, unpack, unpack_sorted

FOLDS, HELD_FOLD, ORDER = 7, 2, 3
#: Smoothing priors of contexts of one and two words.
PRIORS = (50.0, 10.0)
#: Characters of a chunk, and of the corpus for each slice of the key space.
CHUNK, SLICE = 6 << 20, 8 << 20
END, START = b"\n", b"\r"  # no word has these bytes
OUT = ("doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
       "base_score double, score double")


def is_held_out(doc_id: str | None) -> bool:
    return doc_id is not None and zlib.crc32(doc_id.encode()) % FOLDS == HELD_FOLD


def key_bits(chars: int) -> tuple[int, int]:
    """Bits of the hashes of words and of longer n-grams, such that collisions stay as rare
    in a large corpus as in a small one."""
    size = max(1, math.ceil(math.log2(max(2, chars))))
    return min(64, 26 + size), min(64, 18 + size)


class Chunk:
    """Documents as numbers of words: ``tokens`` laid end to end, the end of each included."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, held: np.ndarray, bits: tuple[int, int]):
        self.words, self.tokens, self.sizes, self.held, self.bits = words, tokens, sizes, held, bits

    @classmethod
    def of(cls, ids: list, texts: list, bits: tuple[int, int]) -> Chunk:
        number = {END: 0, START: 1}
        tokens, sizes = [], []
        for text in texts:
            words = (text or "").encode().lower().split()
            words.append(END)
            tokens.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
            sizes.append(len(words))
        digest, drop = xxhash.xxh64_intdigest, 64 - bits[0]
        words = np.fromiter((digest(w) >> drop for w in number), np.uint64, len(number))
        order = np.argsort(words)  # words are numbered by their hashes: sorted keys are short to send
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        return cls(words[order], rank[np.concatenate(tokens)] if tokens else np.zeros(0, np.int64),
                   np.array(sizes, np.int64), np.array([is_held_out(i) for i in ids], bool), bits)

    def start(self) -> int:
        return int(np.searchsorted(self.words, np.uint64(xxhash.xxh64_intdigest(START) >> (64 - self.bits[0]))))

    def _history(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The word before each token (START at a text's first), the one before that, and
        whether there is such a one."""
        start = self.start()
        first = np.zeros(len(self.tokens), bool)
        first[np.cumsum(self.sizes) - self.sizes] = True
        one = np.concatenate([[start], self.tokens[:-1]])
        one[first] = start
        two = np.concatenate([[start], one[:-1]])
        return one, two, ~first

    def grams(self):
        """For n = 1, 2, 3: the sorted keys of the n-grams, each position's place in them
        (-1: none there), and how often each occurs in training texts."""
        train = np.repeat(~self.held, self.sizes)
        one, two, inner = self._history()
        at = [np.arange(len(self.tokens)), np.arange(len(self.tokens)), np.flatnonzero(inner)]
        shift = np.uint64(64 - self.bits[1])
        w = self.words
        yield w, self.tokens, np.bincount(self.tokens[train], minlength=len(w))
        for n in (2, 3):
            columns = [w[c[at[n - 1]]] for c in (two, one, self.tokens)[3 - n:]]
            keys, place = np.unique(mixed(*columns) >> shift, return_inverse=True)
            where = np.full(len(self.tokens), -1)
            where[at[n - 1]] = place
            yield keys, where, np.bincount(place[train[at[n - 1]]], minlength=len(keys))

    def body(self, ids: list) -> bytes:
        names = "\n".join("" if i is None else i for i in ids).encode()
        often = np.argsort(-np.bincount(self.tokens, minlength=len(self.words)), kind="stable")
        small = np.empty(len(often), np.int64)
        small[often] = np.arange(len(often))  # frequent words get small numbers
        return bundle([pack_sorted(self.words), pack(often), pack(small[self.tokens]), pack(self.sizes), self.held.tobytes(), zlib.compress(names, 1)])

    @classmethod
    def from_body(cls, body: bytes, bits: tuple[int, int]) -> tuple[Chunk, list]:
        words, often, tokens, sizes, held, names = unbundle(body)
        tokens = unpack(often).astype(np.int64)[unpack(tokens).astype(np.int64)]
        chunk = cls(unpack_sorted(words), tokens, unpack(sizes).astype(np.int64), np.frombuffer(held, bool), bits)
        return chunk, [i or None for i in zlib.decompress(names).decode().split("\n")]


def automaton_of(chunk: Chunk, grams: list, totals: list[np.ndarray], n: int, v: int, texts: int, priors=PRIORS) -> tuple[Automaton, np.ndarray, np.ndarray]:
    """The part of the corpus' automaton that the chunk's texts can reach, the state after each of
    their tokens, and the state that a text starts in. ``grams``: the place of each position's
    n-grams, for n = 1, 2, 3; the rest as in :func:`score_chunk`."""
    one, _, _ = chunk._history()
    start, end, width = chunk.start(), chunk.tokens[-1], len(chunk.words)
    seen = totals[0].copy()  # of words as contexts:
    seen[start], seen[end] = texts, 0  # texts that begin are what START counts, and nothing follows an END
    # states: the root, then words that were seen, then pairs of words that were seen
    single = np.where(seen > 0, np.cumsum(seen > 0), ROOT)
    ones = int((seen > 0).sum())
    place2, place3 = grams[1], grams[2]
    # one position where each pair and each triple stands: every token ends a pair, all but a text's first a triple
    at2, at3 = np.zeros(len(totals[1]), np.int64), np.zeros(len(totals[2]), np.int64)
    at2[place2] = np.arange(len(place2))
    inner = np.flatnonzero(place3 >= 0)
    at3[place3[inner]] = inner
    left, last = one[at2], chunk.tokens[at2]
    pairs = (totals[1] > 0) & (last != end)
    double = np.where(pairs, ones + np.cumsum(pairs), single[last])
    root = (totals[0] + 1) / (n + v + 1)
    p_one = (totals[1] + priors[0] * root[last]) / (seen[left] + priors[0])
    context, longer = place2[at3 - 1], place2[at3]  # the pair before a triple's last word, and the pair that ends it
    p_two = (totals[2] + priors[1] * p_one[longer]) / (totals[1][context] + priors[1])
    has1, has2 = (totals[1] > 0) & (seen[left] > 0), (totals[2] > 0) & pairs[context]
    arcs = np.concatenate([np.arange(width), single[left[has1]] * width + last[has1],
                           double[context[has2]] * width + chunk.tokens[at3[has2]]])
    weights = np.log10(np.concatenate([root, p_one[has1], p_two[has2]]))
    targets = np.concatenate([single, double[has1], double[longer[has2]]])
    fail = np.concatenate([[ROOT], np.full(ones, ROOT), single[last[pairs]]])
    fail_weights = np.concatenate([[0.0], np.log10(priors[0] / (seen[seen > 0] + priors[0])), np.log10(priors[1] / (totals[1][pairs] + priors[1]))])
    return Automaton(width, arcs, weights, targets, fail, fail_weights), double[place2], single[start]


def score_chunk(chunk: Chunk, totals: list[np.ndarray], n: int, v: int, texts: int, priors=PRIORS):
    """Walks all texts of a chunk. ``totals``: counts in all training texts of the chunk's n-grams
    in the order of :meth:`Chunk.grams`; ``n``, ``v``, ``texts``: tokens, words and texts there.
    Returns known tokens, base score and score of each text."""
    automaton, after, begin = automaton_of(chunk, [where for _, where, _ in chunk.grams()], totals, n, v, texts, priors)
    text, place, size = spans(chunk.sizes)
    first = place == (np.cumsum(chunk.sizes) - chunk.sizes)[text]
    walked = automaton.walk(chunk.tokens, place, size, np.where(first, begin, after[place - 1]))
    at = np.cumsum(chunk.sizes) - chunk.sizes
    single = totals[0][chunk.tokens]
    base = np.log10((single + 1) / (n + v + 1))
    return (np.add.reduceat(single > 0, at, dtype=np.int64), np.add.reduceat(base, at), np.bincount(text, walked, len(chunk.sizes)))


def score(docs: DataFrame, priors=PRIORS, chunk_chars: int = CHUNK, slice_chars: int = SLICE) -> DataFrame:
    """The columns of ``OUT`` for every row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("string").alias("doc_id"), docs["text"].alias("text"))
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits, slices = key_bits(chars), parts(spark, chars, slice_chars)
    widths = (bits[0], bits[1], bits[1])

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        for k, f in enumerate(by_bytes(frames, "text", chunk_chars)):
            ids, number = f["doc_id"].tolist(), (task << 24) + k
            chunk = Chunk.of(ids, f["text"].tolist(), bits)
            cut = [[] for _ in range(slices)]
            for (keys, _, count), width in zip(chunk.grams(), widths):
                bounds = slice_bounds(keys, width, slices)
                for s in range(slices):
                    cut[s] += [pack_sorted(keys[bounds[s]:bounds[s + 1]]), pack(count[bounds[s]:bounds[s + 1]])]
            begun = pack(np.array([(~chunk.held).sum()]))
            for s in range(slices):
                yield pd.DataFrame({"slice": [s], "chunk": [number], "texts": [False], "body": [bundle(cut[s] + [begun])]})
            yield pd.DataFrame({"slice": [number % slices], "chunk": [number], "texts": [True], "body": [chunk.body(ids)]})

    def answered(f: pd.DataFrame) -> pd.DataFrame:
        asks, own = f[~f["texts"]], f[f["texts"]]
        bodies = [unbundle(b) for b in asks["body"]]
        totals: list[list[bytes]] = [[] for _ in bodies]
        stats = [0, 0, sum(int(unpack(b[-1])[0]) for b in bodies)]
        for n in range(ORDER):
            keys = [unpack_sorted(b[2 * n]) for b in bodies]
            counts = np.concatenate([unpack(b[2 * n + 1]) for b in bodies])
            _, place = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(place, counts).astype(np.int64)
            if n == 0:
                stats[:2] = [int(total.sum()), int((total > 0).sum())]
            at = np.cumsum([0, *map(len, keys)])
            for i in range(len(bodies)):
                totals[i].append(pack(total[place[at[i]:at[i + 1]]]))
        tail = pack(np.array(stats))
        out = pd.DataFrame({"slice": asks["slice"], "chunk": asks["chunk"], "texts": False, "body": [bundle(t + [tail]) for t in totals]})
        return pd.concat([out, own]) if len(own) else out

    def scored(f: pd.DataFrame) -> pd.DataFrame:
        chunk, ids = Chunk.from_body(f.loc[f["texts"], "body"].iloc[0], bits)
        answers = [unbundle(b) for b in f[~f["texts"]].sort_values("slice")["body"]]
        totals = [np.concatenate([unpack(a[n]) for a in answers]).astype(np.int64) for n in range(ORDER)]
        stats = np.array([unpack(a[ORDER]) for a in answers]).astype(np.int64)
        n, v, texts = int(stats[:, 0].sum()), int(stats[:, 1].sum()), int(stats[0, 2])
        known, base, walked = score_chunk(chunk, totals, n, v, texts, priors)
        return pd.DataFrame({"doc_id": ids, "held_out": chunk.held, "n_tokens": chunk.sizes, "n_known": known, "train_tokens": n,
                             "base_score": base, "score": walked})

    schema = "slice int, chunk long, texts boolean, body binary"
    asks = docs.mapInPandas(asked, schema)
    answers = asks.groupBy("slice").applyInPandas(answered, schema)
    return answers.groupBy("chunk").applyInPandas(scored, OUT).withColumn("doc_id", F.col("doc_id").cast("long"))

