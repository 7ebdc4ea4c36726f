"""Phrase collocation mining: direct-address tiles of pairs, level by level.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words
``[^\\x20\\x09]+``. A phrase of k+1 words is a pair: a frequent phrase of k words and the word that
follows. Both have ids by falling frequency within their language, so that the frequent pairs lie
together in a corner of the plane of pairs, and the plane is cut into square tiles:

1. Chunks of text count their words; frequent ones are ranked, and chunks are rewritten in ranks.
2. Each chunk counts its pairs: the corner of the plane by one ``bincount`` over its cells, the rest by
   sorting addresses (COO). It sends the counts, sorted by address, to the slices of the tiles.
3. A slice adds up what the chunks sent, as it streams by: tiles that a chunk fills densely are arrays
   of cells and ``bincount``, all others sorted COO. Memory is bounded by different pairs, not by chunks.
4. Pairs seen ``least`` times are ranked again and their ranks sent back to the chunks that have them;
   with these as units the chunks count phrases of one word more. Only where both halves of a phrase
   are frequent can it be.

No vocabulary or table of phrases is broadcast or brought to the driver. A tile gets smaller as chunks
get more, so no tile holds more than about 2^27 counts. Slices get a row from a chunk only where they
share a pair, so rows never exceed pairs.

Null text is empty and null lang is ``und``; rows with equal texts or ids count each. Ids and other columns
are not read. Long texts are cut between words; the words before a cut are repeated behind it as context
and counted once. An empty table, or one without frequent phrases, gives an empty result.
"""

from __future__ import annotations

import math
import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import LOWER, UPPER, staged
from stationlake.llm.exchange import mixed, pack, pack_sorted, unpack, unpack_sorted
from stationlake.operators.sequence import split_groups_sequence

LEAST, TOP, SHARE, UNDEFINED = 10, 2000, 50, "und"
#: Bytes of text in a chunk and read at a time; side of the corner that a chunk counts densely.
CHUNK, BLOCK, CORNER = 8 << 20, 1 << 20, 1024
#: log2 of a tile's side, the most entries that a tile may get, entries for each slice.
SIDE, TILE_LOAD, SLICE_LOAD = 8, 1 << 27, 4 << 20
CHUNKS_PER_TASK = 4
_CUT = 0xFF  # never a byte of UTF-8
_BREAK = re.compile(rb"[ \t\xff]")
_TABLE = bytearray(range(256))
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = _CUT
for _u, _l in zip(UPPER.encode(), LOWER.encode()):
    _TABLE[_u] = _l
_TABLE = bytes(_TABLE)

_CHUNKS = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("context", pa.int32()), ("n", pa.int64()),
                     ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("tokens", pa.binary())])
_ROWS = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("lang", pa.string()), ("slice", pa.int32()),
                   ("context", pa.int32()), ("body", pa.binary()), ("more", pa.binary())])
ROWS = "kind int, chunk long, lang string, slice int, context int, body binary, more binary"
TOKENS, ASKED, KNOWN = 2, 1, 0


class _Ids(dict):
    """Numbers words as they are first seen; the mark of a cut is 0."""

    def __init__(self):
        super().__init__({bytes([_CUT]): 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Chunk:
    def __init__(self, carried: list[bytes] | None = None):
        self.ids, self.parts, self.size, self.context = _Ids(), [], 0, 0
        if carried:
            self.add(carried, 0)
            self.context = len(carried)

    def add(self, words: list[bytes], size: int) -> None:
        self.parts.append(np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words)))
        self.size += size

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        tokens = np.concatenate(self.parts)
        counts = np.bincount(tokens[self.context:], minlength=len(self.ids))[1:]
        words = [w.decode() for w in islice(self.ids, 1, None)]
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([lang], pa.string()), pa.array([self.context], pa.int32()),
             pa.array([int(counts.sum())], pa.int64()), pa.array([words], pa.list_(pa.string())),
             pa.array([counts], pa.list_(pa.int64())), pa.array([pack(tokens)], pa.binary())], schema=_CHUNKS)


def _blocks(text: str):
    """The words of a text, with marks where pieces end, some at a time; a block ends between words."""
    raw = text.encode("utf-8", "replace").translate(_TABLE)
    start = 0
    while start < len(raw):
        stop = min(len(raw), start + BLOCK)
        if stop < len(raw):
            found = _BREAK.search(raw, stop)
            stop = found.start() if found else len(raw)
        yield raw[start:stop].replace(bytes([_CUT]), b" \xff ").split(), stop - start
        start = stop


def _cut(words: int, chunk_bytes: int):
    """Documents of a partition -> chunks of one language each."""

    def fn(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        held: dict[str, _Chunk] = {}

        def out(lang: str, carried=None):
            nonlocal number
            row = held.pop(lang).row(number, lang)
            number += 1
            if carried:
                held[lang] = _Chunk(carried)
            return row

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                last: list[bytes] = []
                for tokens, size in _blocks(text.as_py() or ""):
                    if lang in held and held[lang].size >= chunk_bytes:
                        yield out(lang, last)
                    chunk = held.setdefault(lang, _Chunk())
                    chunk.add(tokens, size)
                    tail = (last + tokens)[-(words - 1):] if words > 1 else []
                    cut = max((i + 1 for i, w in enumerate(tail) if w[0] == _CUT), default=0)
                    last = tail[cut:]
                if lang in held:
                    held[lang].add([bytes([_CUT])], 1)
                if sum(c.size for c in held.values()) > 4 * chunk_bytes or len(held) > 256:
                    yield out(max(held, key=lambda k: held[k].size))
        for lang in list(held):
            yield out(lang)

    return fn


class Plane:
    """Addresses of pairs (unit, word), tile after tile: 2^side units by 2^side words are a tile."""

    def __init__(self, most_unit: int, most_word: int, chunks: int, slices: int):
        self.side = max(0, SIDE - max(0, math.ceil(math.log(max(1, chunks) * 4 ** SIDE / TILE_LOAD, 4))))
        self.across = max(1, (most_word >> self.side).bit_length())
        if max(1, (most_unit >> self.side).bit_length()) + self.across + 2 * self.side > 64:
            raise ValueError("more than 2^64 pairs of units and words")
        self.slices = slices

    def address(self, unit: np.ndarray, word: np.ndarray) -> np.ndarray:
        u, w, s = unit.astype(np.uint64), word.astype(np.uint64), np.uint64(self.side)
        low = np.uint64((1 << self.side) - 1)
        tile = (u >> s) << np.uint64(self.across) | w >> s
        return tile << np.uint64(2 * self.side) | (u & low) << s | w & low

    def pair(self, address: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s, low = np.uint64(self.side), np.uint64((1 << self.side) - 1)
        tile = address >> np.uint64(2 * self.side)
        unit = (tile >> np.uint64(self.across)) << s | (address >> s) & low
        word = (tile & np.uint64((1 << self.across) - 1)) << s | address & low
        return unit.astype(np.int64), word.astype(np.int64)

    def slice(self, address: np.ndarray) -> np.ndarray:
        return (mixed(address >> np.uint64(2 * self.side)) % np.uint64(self.slices)).astype(np.int32)

    def by_slice(self, address: np.ndarray, values: np.ndarray):
        """(slice, addresses, values) of each slice that has some; ``address`` is sorted."""
        at = self.slice(address)
        order = np.argsort(at, kind="stable")
        at = at[order]
        edges = np.flatnonzero(np.diff(at, prepend=-1, append=self.slices))
        for lo, hi in zip(edges[:-1], edges[1:]):
            yield int(at[lo]), address[order[lo:hi]], values[order[lo:hi]]


def merged(address: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted COO: different addresses in order, with their counts added up."""
    order = np.argsort(address, kind="stable")
    address = address[order]
    first = np.flatnonzero(np.diff(address, prepend=address[:1] ^ np.uint64(1)))
    return address[first], np.add.reduceat(count[order], first) if len(first) else count[:0]


def chunk_pairs(unit: np.ndarray, word: np.ndarray, counted: np.ndarray, plane: Plane) -> tuple[np.ndarray, np.ndarray]:
    """Sorted addresses and counts of a chunk's pairs; those of its context are there with a count of 0."""
    if not counted.all():
        address, count = chunk_pairs(unit[counted], word[counted], counted[counted], plane)
        context = plane.address(unit[~counted], word[~counted])
        return merged(np.concatenate([address, context]), np.concatenate([count, np.zeros(len(context), np.int64)]))
    dense = (unit < CORNER) & (word < CORNER)
    cells = np.bincount(unit[dense] * CORNER + word[dense], minlength=0)
    found = np.flatnonzero(cells)
    near = plane.address(found // CORNER, found % CORNER)
    far = np.sort(plane.address(unit[~dense], word[~dense]))
    first = np.flatnonzero(np.diff(far, prepend=far[:1] ^ np.uint64(1)))
    counts = np.diff(np.append(first, len(far)))
    address = np.concatenate([near, far[first]])
    order = np.argsort(address, kind="stable")
    return address[order], np.concatenate([cells[found], counts])[order]


class Tally:
    """What the chunks sent to one slice, added up."""

    def __init__(self, plane: Plane):
        self.shift, self.cells = np.uint64(2 * plane.side), 1 << 2 * plane.side
        self.tiles: dict[int, np.ndarray] = {}
        self.sparse, self.held = [], 0

    def add(self, address: np.ndarray, count: np.ndarray) -> None:
        tile = address >> self.shift
        edges = np.append(np.flatnonzero(np.diff(tile, prepend=tile[:1] ^ np.uint64(1))), len(tile))
        dense = np.zeros(len(tile), bool)
        for k in np.flatnonzero(np.diff(edges) * 4 >= self.cells):
            lo, hi = edges[k], edges[k + 1]
            self._to_tile(int(tile[lo]), address[lo:hi], count[lo:hi])
            dense[lo:hi] = True
        self.sparse.append((address[~dense], count[~dense]))
        self.held += len(address) - int(dense.sum())
        if self.held > SLICE_LOAD and len(self.sparse) > 1:
            self.sparse = [self._coo()]
            self.held = len(self.sparse[0][0]) // 2  # merged anew when as many again have come

    def _to_tile(self, tile: int, address: np.ndarray, count: np.ndarray) -> None:
        local = (address & (np.uint64(self.cells - 1))).astype(np.int64)
        add = np.bincount(local, weights=count, minlength=self.cells).astype(np.int64)
        if tile in self.tiles:
            self.tiles[tile] += add
        else:
            self.tiles[tile] = add

    def _coo(self):
        return merged(np.concatenate([a for a, _ in self.sparse]), np.concatenate([c for _, c in self.sparse]))

    def frequent(self, least: int):
        address, count = self._coo() if self.sparse else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        if self.tiles:
            tile = address >> self.shift
            own = np.isin(tile, np.fromiter(self.tiles, np.uint64, len(self.tiles)))
            for t in np.unique(tile[own]):
                mine = tile == t
                self._to_tile(int(t), address[mine], count[mine])
            address, count = address[~own], count[~own]
        out = [(address[count >= least], count[count >= least])]
        for t, cells in self.tiles.items():
            found = np.flatnonzero(cells >= least)
            out.append(((np.uint64(t) << self.shift) | found.astype(np.uint64), cells[found]))
        return np.concatenate([a for a, _ in out]), np.concatenate([c for _, c in out])


def _rows(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ROWS)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS)], schema=_ROWS)


def _asked(chunk: int, lang: str, address: np.ndarray, count: np.ndarray, plane: Plane):
    return [(ASKED, chunk, lang, s, 0, pack_sorted(a), pack(c)) for s, a, c in plane.by_slice(address, count)]


def _encode(plane: Plane):
    """Chunks with the ranks of their frequent words -> their tokens in ranks, and the pairs they have."""

    def fn(batches):
        for batch in batches:
            for chunk, lang, context, n, body, known in zip(*(batch.column(c) for c in ("chunk", "lang", "context", "n_words", "tokens", "ranks"))):
                rank = np.zeros(n.as_py() + 1, np.int64)
                rank[known.values.field("at").to_numpy()] = known.values.field("id").to_numpy()
                tokens = rank[unpack(body.as_py()).astype(np.int64)]
                both = np.flatnonzero((tokens[:-1] > 0) & (tokens[1:] > 0))
                pairs = chunk_pairs(tokens[both], tokens[both + 1], both + 1 >= context.as_py(), plane)
                asked = _asked(chunk.as_py(), lang.as_py(), *pairs, plane)
                if asked:
                    yield _rows([(TOKENS, chunk.as_py(), lang.as_py(), 0, context.as_py(), pack(tokens), None), *asked])

    return fn


def _count(plane: Plane, least: int):
    """Rows sorted by slice and language -> the frequent pairs."""

    def fn(batches):
        key, tally = None, None

        def out():
            address, count = tally.frequent(least)
            unit, word = plane.pair(address)
            return pa.RecordBatch.from_arrays([pa.array([key[1]] * len(unit), pa.string()), pa.array(unit), pa.array(word),
                                               pa.array(count.astype(np.int64))], names=["lang", "unit", "word", "a"])

        for batch in batches:
            for s, lang, body, more in zip(*(batch.column(c) for c in ("slice", "lang", "body", "more"))):
                if (s.as_py(), lang.as_py()) != key:
                    if key:
                        yield out()
                    key, tally = (s.as_py(), lang.as_py()), Tally(plane)
                tally.add(unpack_sorted(body.as_py()), unpack(more.as_py()).astype(np.int64))
        if key:
            yield out()

    return fn


def _known(plane: Plane):
    """Frequent pairs with their ranks -> rows for the slices."""

    def fn(batches):
        for batch in batches:
            langs, which = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
            address = plane.address(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("unit", "word")))
            rank = batch.column("id").to_numpy(zero_copy_only=False)
            order = np.lexsort([address, which])
            edges = np.searchsorted(which[order], np.arange(len(langs) + 1))
            yield _rows([(KNOWN, 0, lang, s, 0, pack_sorted(a), pack(r)) for lang, lo, hi in zip(langs, edges[:-1], edges[1:])
                         for s, a, r in plane.by_slice(address[order[lo:hi]], rank[order[lo:hi]])])

    return fn


def _answer(batches):
    """Rows sorted by slice, language and kind: what is frequent, then what chunks have -> ranks for the chunks."""
    key, parts, table = None, [], None
    for batch in batches:
        rows = []
        for kind, chunk, lang, s, _, body, more in zip(*(batch.column(f.name) for f in _ROWS)):
            if (s.as_py(), lang.as_py()) != key:
                key, parts, table = (s.as_py(), lang.as_py()), [], None
            address = unpack_sorted(body.as_py())
            if kind.as_py() == KNOWN:
                parts.append((address, unpack(more.as_py())))
                continue
            if not parts:
                continue
            if table is None:
                known, rank = (np.concatenate(c) for c in zip(*parts))
                order = np.argsort(known)
                table = known[order], rank[order]
            at = np.minimum(np.searchsorted(table[0], address), len(table[0]) - 1)
            hit = table[0][at] == address
            if hit.any():
                rows.append((KNOWN, chunk.as_py(), lang.as_py(), s.as_py(), 0, pack_sorted(address[hit]), pack(table[1][at[hit]])))
        yield _rows(rows)


def _extend(plane: Plane, longer: Plane, words: int):
    """Rows sorted by chunk and kind: ranks of its phrases of ``words`` words, then its units and tokens -> its
    units of that length, and the phrases of one word more that it has."""

    def fn(batches):
        key, parts = None, []
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if row["chunk"] != key:
                    key, parts = row["chunk"], []
                if row["kind"] == KNOWN:
                    parts.append((unpack_sorted(row["body"]), unpack(row["more"])))
                    continue
                if not parts:
                    continue
                known, rank = (np.concatenate(c) for c in zip(*parts))
                order = np.argsort(known)
                known, rank = known[order], rank[order].astype(np.int64)
                tokens = unpack(row["body"]).astype(np.int64)
                before = unpack(row["more"]).astype(np.int64) if row["more"] else tokens
                n = max(0, len(tokens) - words + 1)  # where a phrase may start
                unit, last = before[:n], tokens[words - 1:]
                at = np.flatnonzero((unit > 0) & (last > 0))
                address = plane.address(unit[at], last[at])
                found = np.minimum(np.searchsorted(known, address), len(known) - 1)
                hit = known[found] == address
                units = np.zeros(n, np.int64)
                units[at[hit]] = rank[found[hit]]
                both = np.flatnonzero((units[:-1] > 0) & (units[1:] > 0))
                pairs = chunk_pairs(units[both], tokens[both + words], both + words >= row["context"], longer)
                asked = _asked(key, row["lang"], *pairs, longer)
                if asked:
                    yield _rows([(TOKENS, key, row["lang"], 0, row["context"], row["body"], pack(units)), *asked])

    return fn


def _sliced(rows: DataFrame, slices: int) -> DataFrame:
    return rows.repartition(slices, "slice").sortWithinPartitions("slice", "lang", "kind")


def _ranked(frequent: DataFrame, by: list[str]) -> DataFrame:
    """Ids from 1 by falling frequency in each language."""
    falling = frequent.withColumn("_falling", -F.col("a"))
    return staged(split_groups_sequence(falling, ["lang"], ["_falling", *by], "id").drop("_falling"), "phrase-ranks")


def _most(ranked: DataFrame) -> int:
    return int(ranked.agg(F.max("id")).first()[0] or 0)


def levels(docs: DataFrame, words: int = 3, least: int = LEAST, chunk_bytes: int = CHUNK,
           slice_load: int = SLICE_LOAD) -> tuple[DataFrame, list[DataFrame]]:
    """``(lang, n)``, and for each length the frequent phrases.

    Length 1: ``lang, word, a, id``; others ``lang, unit, word, a, id``: the ids of the phrase without its last word,
    and of that word.
    """
    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNDEFINED)).alias("lang"), F.col("text").cast("string").alias("text"))
    chunks = staged(source.mapInArrow(_cut(words, chunk_bytes), "chunk long, lang string, context int, n long, words array<string>, "
                                      "counts array<long>, tokens binary"), "phrase-chunks")
    totals = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
    size = chunks.agg(F.count("*").alias("chunks"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    slices = max(1, math.ceil(size["n"] / slice_load))
    seen = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")) \
        .select("chunk", "lang", (F.col("at") + 1).alias("at"), F.col("w.words").alias("word"), F.col("w.counts").alias("c"))
    vocabulary = _ranked(seen.groupBy("lang", "word").agg(F.sum("c").alias("a")).where(F.col("a") >= least), ["word"])
    found, most_word = [vocabulary], _most(vocabulary)
    plane = Plane(most_word, most_word, size["chunks"], slices)
    ranks = seen.select("chunk", "lang", "at", "word").join(vocabulary.select("lang", "word", "id"), ["lang", "word"]) \
        .groupBy("chunk").agg(F.collect_list(F.struct("at", "id")).alias("ranks"))
    rows = chunks.select("chunk", "lang", "context", F.size("words").alias("n_words"), "tokens").join(ranks, "chunk") \
        .mapInArrow(_encode(plane), ROWS)
    for k in range(2, words + 1):
        rows = staged(rows, "phrase-pairs")
        asked = rows.where(F.col("kind") == ASKED)
        counted = _sliced(asked, slices).mapInArrow(_count(plane, least), "lang string, unit long, word long, a long")
        found.append(_ranked(staged(counted, "phrase-frequent"), ["unit", "word"]))
        if k == words:
            break
        longer = Plane(_most(found[-1]), most_word, size["chunks"], slices)
        known = found[-1].select("lang", "unit", "word", "id").mapInArrow(_known(plane), ROWS)
        answers = _sliced(known.unionByName(asked), slices).mapInArrow(_answer, ROWS)
        parts = max(1, math.ceil(size["chunks"] / CHUNKS_PER_TASK))
        rows = answers.unionByName(rows.where(F.col("kind") == TOKENS)).repartition(parts, "chunk") \
            .sortWithinPartitions("chunk", "kind").mapInArrow(_extend(plane, longer, k), ROWS)
        plane = longer
    return totals, found


def _score(a, left, right):
    wide = "decimal(38,0)"
    return F.expr(f"cast((cast(1000000 as {wide}) * cast({a} as decimal(19,0)) * cast({a} as decimal(19,0))) "
                  f"div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0))) as long)")


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE) -> DataFrame:
    """The first ``top`` phrases of two or three words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut with the lowest score (the first of equal ones).
    Phrases within a longer one that has at least ``share`` per cent of their count are left out.
    """
    totals, (words, pairs, triples) = levels(docs, 3, least)
    word = words.select("lang", F.col("id").alias("_w"), F.col("word").alias("_text"), F.col("a").alias("_a"))

    def with_word(df: DataFrame, id_col: str, text: str, count: str) -> DataFrame:
        named = word.select("lang", F.col("_w").alias(id_col), F.col("_text").alias(text), F.col("_a").alias(count))
        return df.join(named, ["lang", id_col])

    two = with_word(with_word(pairs.withColumnsRenamed({"unit": "w1", "word": "w2", "id": "pair"}), "w1", "t1", "f1"), "w2", "t2", "f2")
    two = staged(two.select("lang", "pair", "w1", "w2", F.concat_ws(" ", "t1", "t2").alias("phrase"), "a", "f1", "f2",
                            _score("a", "f1", "f2").alias("score")), "phrase-two")
    front = two.select("lang", "pair", "w2", F.col("phrase").alias("head"), F.col("a").alias("f12"), "f1")
    back = two.select("lang", F.col("pair").alias("pair2"), "w1", F.col("w2").alias("w3"), F.col("a").alias("f23"))
    three = triples.select("lang", F.col("unit").alias("pair"), F.col("word").alias("w3"), "a").join(front, ["lang", "pair"])
    three = with_word(three, "w3", "t3", "f3").join(back.withColumnRenamed("w1", "w2"), ["lang", "w2", "w3"])
    first, second = _score("a", "f1", "f23"), _score("a", "f12", "f3")
    three = staged(three.select("lang", "pair", "pair2", F.concat_ws(" ", "head", "t3").alias("phrase"), "a", "f1", "f23", "f12", "f3",
                                first.alias("s1"), second.alias("s2")), "phrase-three")
    inside = three.select("lang", F.explode(F.array("pair", "pair2")).alias("pair"), "a").groupBy("lang", "pair").agg(F.max("a").alias("_longer"))
    short = two.join(inside, ["lang", "pair"], "left") \
        .where(F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("a") * share)) \
        .select("lang", "phrase", "a", F.col("f1").alias("l"), F.col("f2").alias("r"), "score")
    low = F.col("s1") <= F.col("s2")
    long = three.select("lang", "phrase", "a", F.when(low, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                        F.when(low, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    # numbered by ranges of the order, so that no language is ranked by one task
    falling = short.unionByName(long).withColumns({"_score": -F.col("score"), "_a": -F.col("a")})
    ranked = split_groups_sequence(falling, ["lang"], ["_score", "_a", "phrase"], "rank").where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = LEAST, top: int = TOP, share: int = SHARE) -> str:
    return rf"""
WITH pieces AS (
  SELECT doc, lang, unnest(string_split(t, chr(10))) AS piece, generate_subscripts(string_split(t, chr(10)), 1) AS p
  FROM (SELECT row_number() OVER () AS doc, coalesce(lang, '{UNDEFINED}') AS lang,
               regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]', chr(10), 'g') AS t FROM documents)),
split AS (SELECT doc, p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT doc, p, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM split),
grams AS (
  SELECT lang, w1, lead(w1) OVER s AS w2, lead(w1, 2) OVER s AS w3 FROM words WINDOW s AS (PARTITION BY doc, p ORDER BY i)),
one AS (SELECT lang, w1, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS a FROM grams WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {least}),
three AS (SELECT lang, w1, w2, w3, count(*) AS a FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {least}),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.a, 1 AS k, l.f AS l, r.f AS r,
         coalesce((SELECT max(x.a) FROM three x WHERE x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2), 0) AS longer1,
         coalesce((SELECT max(x.a) FROM three x WHERE x.lang = t.lang AND x.w2 = t.w1 AND x.w3 = t.w2), 0) AS longer2
  FROM two t JOIN one l ON l.lang = t.lang AND l.w1 = t.w1 JOIN one r ON r.lang = t.lang AND r.w1 = t.w2
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 1, l.f, r.a, 0, 0
  FROM three t JOIN one l ON l.lang = t.lang AND l.w1 = t.w1 JOIN two r ON r.lang = t.lang AND r.w1 = t.w2 AND r.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 2, l.a, r.f, 0, 0
  FROM three t JOIN two l ON l.lang = t.lang AND l.w1 = t.w1 AND l.w2 = t.w2 JOIN one r ON r.lang = t.lang AND r.w1 = t.w3),
scored AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts
  WHERE 100 * greatest(longer1, longer2) < {share} * a),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}"""
