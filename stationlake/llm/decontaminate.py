"""Benchmark decontamination: Wu-Manber search of documents for the word windows of test items.

Texts are lower-cased (A-Z); words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A window is 10 consecutive words of
an item, or all of its words where it has fewer (but not none). The windows are the patterns: their words with
one blank around each, as bytes, so a pattern is found only at word limits. Patterns are searched in classes of
similar length. For a class of shortest length m:

* the shift table says, by the hash of the ``block`` bytes that end a window of m bytes of text, how far the window
  can be moved on without passing an occurrence;
* where it says 0, the bucket of that block holds the patterns whose first m bytes end with it, and
  each is compared with the text byte by byte.

The text is read by many cursors at a time (numpy), each over a stretch of its own: a step moves all of
them by their shifts. Whole texts are read, in pieces cut between documents; results do not depend on the pieces.

Patterns come to the tasks as a broadcast of at most ``MOST`` bytes of item text; a larger benchmark is searched in blocks of that
size, each in a scan of its own over all documents, and the hits of a document are then united.

Null has no words. Rows with equal or null ids are judged each on their own. Items with the same id count once,
items whose id is null count as one with an empty name. An empty benchmark leaves every document clean; an empty
table gives an empty result. Other columns are not read by :func:`report`, and kept by :func:`reject`.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import LOWER, UPPER, staged

WINDOW = 10
#: Bytes of item texts whose windows are searched in one scan, bytes of text searched at a time, bytes for each cursor.
MOST, PIECE, STRETCH = 8 << 20, 4 << 20, 512
#: Shortest pattern of each class, and the longest block of a shift table.
CLASSES, LONGEST_BLOCK = (1, 6, 12, 24, 48), 8
_TABLE = bytearray(range(256))
for _c in [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]:
    _TABLE[_c] = 0x20
for _u, _l in zip(UPPER.encode(), LOWER.encode()):
    _TABLE[_u] = _l
_TABLE = bytes(_TABLE)
_END = 0  # between documents; no pattern has it


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


def windows(items, size: int = WINDOW) -> dict[bytes, list[str]]:
    """Pattern -> the sorted names of the items that have it, from (id, text) pairs."""
    found = defaultdict(set)
    for name, text in items:
        words = words_of(text)
        for i in range(max(0, len(words) - size) + 1 if words else 0):
            found[b" " + b" ".join(words[i:i + size]) + b" "].add("" if name is None else str(name))
    return {p: sorted(names) for p, names in found.items()}


class Class:
    """The tables of patterns of similar length."""

    def __init__(self, patterns: list[bytes], numbers: list[int]):
        self.m = min(map(len, patterns))
        # blocks grow with the patterns, so that most blocks of a text are in none
        self.block = min(self.m, LONGEST_BLOCK, max(3, math.ceil(math.log(2 * self.m * len(patterns), 8))))
        heads = np.frombuffer(b"".join(p[:self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m)
        self.bits = min(22, max(10, math.ceil(math.log2(4 * heads.size + 1))))
        self.shift = np.full(1 << self.bits, self.m - self.block + 1, np.int32)
        for end in range(self.block, self.m + 1):  # later blocks shift less and are written last
            code = _codes(np.ascontiguousarray(heads[:, end - self.block:end]).reshape(-1), self.block, np.arange(len(patterns)) * self.block)
            self.shift[self._hash(code)] = self.m - end
        order = np.argsort(code, kind="stable")  # ``code`` is of the last blocks now
        self.suffix, self.first = np.unique(code[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(order)))
        self.order = order
        self.numbers = np.array(numbers, np.int64)
        self.lengths = np.array([len(p) for p in patterns], np.int64)
        self.patterns = patterns

    def _hash(self, code: np.ndarray) -> np.ndarray:
        return (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def search(self, text: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Starts and numbers of all occurrences. ``text`` are the bytes ``raw``."""
        last = len(text) - self.m  # the last place where a window can start
        if last < 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.arange(0, last + 1, STRETCH)
        stop = np.minimum(at + STRETCH, last + 1)
        hits = []
        while len(at):
            code = _codes(text, self.block, at + self.m - self.block)
            shift = self.shift[self._hash(code)]
            may = np.flatnonzero(shift == 0)
            if len(may):
                found = np.minimum(np.searchsorted(self.suffix, code[may]), len(self.suffix) - 1)
                same = self.suffix[found] == code[may]
                hits.append((at[may[same]], found[same]))
            at = at + np.maximum(shift, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        starts, numbers = [], []
        for place, bucket in hits:
            # every pattern of the bucket against the place, by direct comparison
            n = self.count[bucket]
            where = np.repeat(place, n)
            which = self.order[np.repeat(self.first[bucket] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
            for p, s in zip(which, where):
                if raw.startswith(self.patterns[p], s):
                    starts.append(s)
                    numbers.append(self.numbers[p])
        return np.array(starts, np.int64), np.array(numbers, np.int64)


def _codes(text: np.ndarray, block: int, at: np.ndarray) -> np.ndarray:
    """The ``block`` bytes from each place as one number."""
    if len(text) >= 8 and block == 8:
        return np.ndarray(len(text) - 7, "<u8", np.ascontiguousarray(text), strides=(1,))[at]
    code = np.zeros(len(at), np.uint64)
    for i in range(block):
        code |= text[at + i].astype(np.uint64) << np.uint64(8 * i)
    return code


class Matcher:
    def __init__(self, patterns: dict[bytes, list[str]]):
        self.patterns = list(patterns)
        self.names = list(patterns.values())
        self.n_words = np.array([p.count(b" ") - 1 for p in self.patterns], np.int64)
        groups = defaultdict(list)
        for i, p in enumerate(self.patterns):
            groups[sum(len(p) >= c for c in CLASSES)].append(i)
        self.classes = [Class([self.patterns[i] for i in g], g) for _, g in sorted(groups.items())]

    def search(self, texts: list[str | None]):
        """Number of words of each text, and for the texts with an occurrence: index, first word and words of each hit, item names."""
        raw = [(t or "").encode("utf-8", "replace").translate(_TABLE) for t in texts]
        spaced = np.frombuffer(b" " + b" \x00 ".join(raw) + b" ", np.uint8)
        blank = spaced == 0x20
        keep = ~blank
        keep[0] = True
        keep[1:] |= ~blank[:-1]  # of a run of blanks the first
        text = spaced[keep]
        body = text.tobytes()
        ends = np.append(np.flatnonzero(text == _END), len(text))
        starts = np.concatenate([[0], ends[:-1] + 1])
        blanks = np.cumsum(text == 0x20, dtype=np.int32)
        at_start = blanks[starts] - 1  # each text begins with a blank
        n_words = blanks[ends - 1] - at_start - 1
        place, number = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for c in self.classes:
            s, k = c.search(text, body)
            place.append(s)
            number.append(k)
        place, number = np.concatenate(place), np.concatenate(number)
        doc = np.searchsorted(starts, place, "right") - 1
        word = blanks[place] - 1 - at_start[doc]
        order = np.argsort(doc, kind="stable")
        edges = np.flatnonzero(np.diff(doc[order], prepend=-1, append=len(texts)))
        hits = {}
        for lo, hi in zip(edges[:-1], edges[1:]):
            mine = order[lo:hi]
            names = set().union(*(self.names[k] for k in np.unique(number[mine])))
            hits[int(doc[mine[0]])] = (word[mine], self.n_words[number[mine]], names)
        return n_words.astype(np.int64), hits


def _pieces(texts: pa.Array):
    """Row ranges of about ``PIECE`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lo, size = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and size + n > PIECE:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(sizes):
        yield lo, len(sizes)


def _covered(n: int, first: np.ndarray, length: np.ndarray) -> int:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + length, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def _digest(names) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


_JUDGED = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"
_JUDGED_ARROW = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()),
                 ("contaminated", pa.bool_()), ("items", pa.list_(pa.string()))]
_CLEAN = _digest([])


def _judged(n_words, spans) -> list[pa.Array]:
    """Columns of the verdict; ``spans``: index -> (first words, lengths, names)."""
    hit, names = [0] * len(n_words), [[]] * len(n_words)
    for i, (first, length, found) in spans.items():
        hit[i], names[i] = _covered(int(n_words[i]), first, length), sorted(found)
    digests = [_digest(x) if h else _CLEAN for x, h in zip(names, hit)]
    values = (n_words, hit, [len(x) for x in names], digests, [h > 0 for h in hit], names)
    return [pa.array(v, t) for v, (_, t) in zip(values, _JUDGED_ARROW)]


def _judge(held, columns: list[str]):
    """Batches -> the same columns and the verdict on ``_text``."""

    def fn(batches):
        matcher = Matcher(held.value)
        for batch in batches:
            texts = batch.column("_text")
            for lo, hi in _pieces(texts):
                n_words, hits = matcher.search(texts.slice(lo, hi - lo).to_pylist())
                kept = batch.slice(lo, hi - lo).select(columns)
                yield pa.RecordBatch.from_arrays([*kept.columns, *_judged(n_words, hits)], names=[*columns, *(n for n, _ in _JUDGED_ARROW)])

    return fn


def _hits(held):
    """Batches of (_row, _text) -> rows with an occurrence: their words, the hit words and the items."""

    def fn(batches):
        matcher = Matcher(held.value)
        for batch in batches:
            texts, rows = batch.column("_text"), batch.column("_row")
            for lo, hi in _pieces(texts):
                n_words, hits = matcher.search(texts.slice(lo, hi - lo).to_pylist())
                for i, (first, length, names) in hits.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rows[lo + i].as_py()], pa.int64()), pa.array([int(n_words[i])], pa.int64()), pa.array([first], pa.list_(pa.int64())),
                         pa.array([length], pa.list_(pa.int64())), pa.array([sorted(names)], pa.list_(pa.string()))],
                        names=["_row", "n_words", "first", "length", "items"])

    return fn


def _count_words(batches):
    for batch in batches:
        n = [len(words_of(t.as_py())) for t in batch.column("_text")]
        yield pa.RecordBatch.from_arrays([*batch.select([c for c in batch.schema.names if c != "_text"]).columns, pa.array(n, pa.int64())],
                                         names=[*(c for c in batch.schema.names if c != "_text"), "n_words"])


def _united(frames: pd.DataFrame) -> pd.DataFrame:
    """All hits of one row, from the blocks of the benchmark that found some."""
    first, length = (np.concatenate([np.asarray(x) for x in frames[c]]) for c in ("first", "length"))
    names = sorted(set().union(*frames["items"]))
    n = int(frames["n_words"].iloc[0])
    return pd.DataFrame({"_row": [frames["_row"].iloc[0]], "n_hit": [_covered(n, first, length)], "items": [names]})


def _blocks(benchmark: DataFrame, most: int):
    """The (id, text) pairs of the benchmark, ``most`` bytes of text at a time; an item larger than that is a block."""
    items, size = [], 0
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    for row in rows.toLocalIterator():
        n = len(row["text"].encode("utf-8", "replace"))
        if items and size + n > most:
            yield items
            items, size = [], 0
        items.append((row["item_id"], row["text"]))
        size += n
    yield items


def judge(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most: int = MOST) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, items_sha256, contaminated`` and the sorted ``items``; columns of
    ``docs`` with these names are replaced."""
    spark = docs.sparkSession
    added = [n for n, _ in _JUDGED_ARROW]
    rest = docs.drop(*added)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    blocks = _blocks(benchmark, most)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        held = spark.sparkContext.broadcast(windows(block, size))
        return rest.withColumn("_text", F.col("text").cast("string")).mapInArrow(_judge(held, rest.columns), f"{types}, {_JUDGED}")
    keyed = staged(rest.withColumns({"_row": F.monotonically_increasing_id(), "_text": F.col("text").cast("string")}), "decontaminate")
    hits = None
    while block is not None:
        held = spark.sparkContext.broadcast(windows(block, size))
        found = staged(keyed.select("_row", "_text").mapInArrow(
            _hits(held), "_row long, n_words long, first array<long>, length array<long>, items array<string>"), "decontaminate-hits")
        held.destroy()
        hits = found if hits is None else hits.unionByName(found)
        block, following = following, next(blocks, None)
    united = hits.groupBy("_row").applyInPandas(lambda f: _united(f), "_row long, n_hit long, items array<string>")
    counted = ", ".join([types, "_row long, n_words long"])
    out = keyed.mapInArrow(_count_words, counted).join(united, "_row", "left").drop("_row")
    items = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(*rest.columns, "n_words", hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), items.alias("items"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text"), benchmark) \
        .select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def reject(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any window of the benchmark, with their own columns."""
    verdict = judge(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"), benchmark)
    return verdict.where(~F.col("contaminated")).select("row.*")


def oracle_sql(size: int = WINDOW) -> str:
    words = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {words} AS w FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item, w, least({size}, len(w)) AS k FROM items WHERE len(w) > 0),
wanted AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
           FROM (SELECT item, k, w, unnest(generate_series(1, len(w) - k + 1)) AS i FROM sized)),
docs AS (SELECT row_number() OVER () AS row, doc_id, {words} AS w FROM documents),
places AS (SELECT row, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
           FROM (SELECT row, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
                 FROM docs, (SELECT DISTINCT k FROM sized) WHERE len(w) >= k)),
found AS (SELECT row, p.i, p.k, item FROM places p JOIN wanted USING (k, g)),
spans AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(generate_series(i, i + k - 1)) AS j FROM found) GROUP BY row),
named AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT row, item FROM found) GROUP BY row)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN spans USING (row) LEFT JOIN named USING (row)"""
