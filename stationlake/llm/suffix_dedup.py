"""Suffix-array dedup: bytes of passages that also stand in a document with a smaller id.

A byte goes when some ``need`` bytes that cover it also start in a document with a smaller
id. Matches are found by suffix arrays (:mod:`stationlake.llm.difference_cover`) of those
parts of the texts that can match at all:

1. Every ``need`` bytes are represented by one anchor in them, the run of ``GRAM`` bytes with
   the smallest hash: equal bytes have equal anchors. Chunks of documents ask the slices of the
   hash space which of their anchors other documents have too (and which whole texts are copies).
2. The bytes around shared anchors are sent, each different one once per chunk, to the slice of
   the anchor, which sorts their suffixes by the difference cover, compares adjacent prefixes and
   answers with the smallest document id that has the same ``need`` bytes, for each of them.
3. Each chunk removes what has a smaller id elsewhere.

An anchor found more than ``HOT`` times is not gathered in one slice: its matches are then dealt by
their own ``need`` bytes. Only hashes and the surroundings of shared anchors are exchanged, and only
where there are some, so the rows exchanged are never more than the anchors; a chunk's texts are
dealt out once, by id, and met again where answers return.

Null text counts as empty; texts shorter than ``need`` bytes lose nothing. A null id counts as the
largest. Rows with the same id never match each other. Other columns pass through :func:`strip`
untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import parts
from stationlake.llm.difference_cover import match_classes
from stationlake.llm.exchange import bundle, mixed, pack, pack_sorted, slice_bounds, unbundle, unpack, unpack_sorted

NEED, GRAM, HOT = 50, 20, 200_000
#: Bytes of text in a chunk and for each slice; bytes whose suffixes are sorted, and hashed, at a time: each
#: takes a dozen or two of 64-bit columns, which are what a task's memory is made of.
CHUNK, SLICE, SORTED, HASHED = 4 << 20, 4 << 20, 1 << 18, 1 << 18
NO_ID = (1 << 64) - 1
ROWS = "slice int, chunk long, memo boolean, body binary"
_ARROW = pa.schema([("slice", pa.int32()), ("chunk", pa.int64()), ("memo", pa.bool_()), ("body", pa.binary())])
_PLACE = (1 << 24) - 1


def _rows(slices, chunks, memo: bool, bodies) -> pa.Table:
    slices, chunks, bodies = list(slices), list(chunks), list(bodies)
    return pa.table([pa.array(slices, pa.int32()), pa.array(chunks, pa.int64()), pa.array([memo] * len(bodies), pa.bool_()),
                     pa.array(bodies, pa.binary())], schema=_ARROW)


def _ordered(ids: list) -> np.ndarray:
    """Ids as unsigned numbers in the same order; null last."""
    return np.array([NO_ID if i is None else i + (1 << 63) for i in ids], np.uint64)


class Texts:
    """A chunk's documents in one canonical order, laid end to end."""

    def __init__(self, table: pa.Table, bits: int, need: int = NEED, gram: int = GRAM):
        raw = [(t or "").encode() for t in table.column("text").to_pylist()]
        ids = _ordered(table.column("doc_id").to_pylist())
        digest = [xxhash.xxh3_128_digest(t) for t in raw]
        self.rows = sorted(range(len(raw)), key=lambda i: (int(ids[i]), digest[i]))
        self.raw, self.ids = [raw[i] for i in self.rows], ids[self.rows]
        self.digest = np.array([np.frombuffer(digest[i], ">u8") for i in self.rows], np.uint64).reshape(-1, 2)
        self.need, self.gram, self.bits = need, gram, bits
        self.sizes = np.array([len(t) for t in self.raw], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.text = b"".join(self.raw)

    def anchors(self):
        """Runs of starts with the same anchor: key (truncated hash) and place of the anchor, first
        start, number of starts, document. Documents are read in groups that keep arrays small."""
        out = [[] for _ in range(5)]
        done = 0
        while done < len(self.raw):
            stop, size = done, 0
            while stop < len(self.raw) and (stop == done or size + self.sizes[stop] <= HASHED):
                size += int(self.sizes[stop])
                stop += 1
            for columns, values in zip(out, self._anchors(done, stop)):
                columns.append(values)
            done = stop
        empty = [np.zeros(0, np.uint64)] + [np.zeros(0, np.int64)] * 4
        return [np.concatenate(c) if c else e for c, e in zip(out, empty)]

    def _anchors(self, lo: int, hi: int):
        """Of one long document, read piece by piece, or of several that are one piece together.
        A run that a piece cuts counts as two."""
        base, sizes = int(self.first[lo]), self.sizes[lo:hi]
        whole = np.frombuffer(self.text, np.uint8)[base:base + int(sizes.sum())]
        out = [[] for _ in range(5)]
        for offset in range(0, max(1, len(whole)), 2 * HASHED):
            key, place = self._piece(whole[offset:offset + 2 * HASHED + self.need - 1], offset, 2 * HASHED)
            start = np.arange(offset, offset + len(place))
            doc = np.repeat(np.arange(hi - lo), sizes)[:len(start)] if hi - lo > 1 else np.zeros(len(start), np.int64)
            fits = start + self.need <= (self.first[lo:hi] - base + sizes)[doc]
            new = fits.copy()
            new[1:] &= (place[1:] != place[:-1]) | ~fits[:-1]
            at = np.flatnonzero(new)
            total = np.concatenate([[0], np.cumsum(fits)])
            count = np.diff(np.append(total[at], total[-1]))
            for column, values in zip(out, (key[at], place[at] + base, start[at] + base, count, doc[at] + lo)):
                column.append(values)
        return [np.concatenate(c) for c in out]

    def _piece(self, b: np.ndarray, offset: int, step: int):
        """Anchor key and place of each start in a piece, in order."""
        width = self.need - self.gram + 1
        if len(b) < self.need:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        hashes = _gram_hashes(b, self.gram)
        least = (hashes & np.uint64(~_PLACE & NO_ID)) | np.arange(len(hashes), dtype=np.uint64)
        have, total = 1, least
        while 2 * have <= width:
            total = np.minimum(total[:-have], total[have:])
            have *= 2
        if have < width:
            total = np.minimum(total[:len(hashes) - width + 1], total[width - have:])
        total = total[:step]
        place = (total & np.uint64(_PLACE)).astype(np.int64)
        return hashes[place] >> np.uint64(64 - self.bits), place + offset


def _gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from every place."""
    table = mixed(np.arange(256, dtype=np.uint64)) | np.uint64(1)
    power, done, have = 0x9E3779B97F4A7C15, None, 0
    part, size, left = table[b], 1, gram
    while left:
        if left & 1:
            if done is None:
                done, have = part, size
            else:
                n = len(b) - have - size + 1
                done = done[:n] * np.uint64(power) + part[have:have + n]
                have += size
        left >>= 1
        if left:
            n = len(b) - 2 * size + 1
            part = part[:n] * np.uint64(power) + part[size:size + n]
            power, size = power * power & NO_ID, 2 * size
    done = done * np.uint64(0xBF58476D1CE4E5B9)
    return done ^ (done >> np.uint64(31))


def _first_round(t: Texts, slices: int) -> dict[int, bytes]:
    """What a chunk asks the slices: its anchors and its texts."""
    key, _, _, _, doc = t.anchors()
    order = np.argsort(key, kind="stable")  # documents ascend within a key
    keys, at, found = np.unique(key[order], return_index=True, return_counts=True)
    doc = doc[order]
    several = doc[at] != doc[at + found - 1] if len(keys) else np.zeros(0, bool)
    cut = slice_bounds(keys, t.bits, slices)
    low = t.digest[:, 0] if len(t.raw) else np.zeros(0, np.uint64)
    by = np.argsort(low, kind="stable")
    own = slice_bounds(low[by], 64, slices)
    out = {}
    for s in np.flatnonzero(np.diff(cut) + np.diff(own)).tolist():
        a, b, some = cut[s], cut[s + 1], by[own[s]:own[s + 1]]
        out[s] = bundle([pack_sorted(keys[a:b]), pack(several[a:b]), pack(found[a:b]),
                         pack_sorted(low[some]), pack(t.digest[some, 1]), pack(t.ids[some])])
    return out


def _first_answers(bodies: list[bytes], hot: int) -> list[bytes]:
    """For each anchor 0 (not shared), 1 or 2 (shared, hot); for each text its smallest id."""
    asks = [unbundle(b) for b in bodies]
    keys = [unpack_sorted(a[0]) for a in asks]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    several, found = (np.concatenate([unpack(a[i]) for a in asks]).astype(float) for i in (1, 2))
    shared = (np.bincount(place, several) > 0) | (np.bincount(place) > 1)
    state = np.where(shared, 1 + (np.bincount(place, found) > hot), 0)[place]
    low, high = [unpack_sorted(a[3]) for a in asks], np.concatenate([unpack(a[4]) for a in asks])
    ids = np.concatenate([unpack(a[5]) for a in asks])
    text = np.unique(np.stack([np.concatenate(low), high]), axis=1, return_inverse=True)[1].ravel() if len(ids) else np.zeros(0, np.int64)
    least = np.full(int(text.max(initial=-1)) + 1, NO_ID, np.uint64)
    np.minimum.at(least, text, ids)
    least = least[text]
    a, b = np.cumsum([0, *map(len, keys)]), np.cumsum([0, *map(len, low)])
    return [bundle([pack(state[a[i]:a[i + 1]]), pack(least[b[i]:b[i + 1]])]) for i in range(len(asks))]


class Passages:
    """The bytes around a chunk's shared anchors, each different one once, in a fixed order."""

    def __init__(self, t: Texts, state: np.ndarray, least: np.ndarray, slices: int):
        key, place, start, count, doc = t.anchors()
        keys, at = np.unique(key, return_inverse=True)
        low = np.argsort(t.digest[:, 0], kind="stable") if len(t.raw) else np.zeros(0, np.int64)
        self.copy = np.zeros(len(t.raw), bool)
        self.copy[low] = least < t.ids[low]
        kind = state[at] if len(at) else np.zeros(0, np.int64)
        use = (kind > 0) & ~self.copy[doc] if len(doc) else np.zeros(0, bool)
        place, start, count, doc, kind = place[use], start[use], count[use], doc[use], kind[use]
        split = np.where(kind == 2, count, 1)  # a hot anchor's starts go each by its own bytes
        nth = np.arange(split.sum()) - np.repeat(np.cumsum(split) - split, split)
        self.start = np.repeat(start, split) + nth
        self.count = np.where(np.repeat(kind == 2, split), 1, np.repeat(count, split))
        self.doc, hot, place = np.repeat(doc, split), np.repeat(kind == 2, split), np.repeat(place, split)
        number: dict[bytes, int] = {}
        text, need, gram = t.text, t.need, t.gram
        self.number = np.fromiter((number.setdefault(text[a:a + n + need - 1], len(number)) for a, n in
                                   zip(self.start.tolist(), self.count.tolist())), np.int64, len(self.start))
        self.passages = list(number)
        first = np.unique(self.number, return_index=True)[1]
        route = np.fromiter((xxhash.xxh64_intdigest(text[a:a + need] if h else text[p:p + gram]) for a, h, p in
                             zip(self.start[first].tolist(), hot[first].tolist(), place[first].tolist())), np.uint64, len(first))
        self.least = np.full(len(number), NO_ID, np.uint64)
        np.minimum.at(self.least, self.number, t.ids[self.doc])
        self.order = np.argsort(route, kind="stable")
        self.route = route[self.order]
        self.cut = slice_bounds(self.route, 64, slices)
        self.starts = np.array([len(p) - need + 1 for p in self.passages], np.int64)

    @classmethod
    def from_memo(cls, body: bytes) -> Passages:
        self = cls.__new__(cls)
        start, count, doc, number, order, starts, copy = unbundle(body)
        self.start = unpack_sorted(start).astype(np.int64)
        self.count, self.doc, self.number, self.order, self.starts = (unpack(x).astype(np.int64) for x in (count, doc, number, order, starts))
        self.copy = np.frombuffer(copy, bool)
        return self

    def memo(self) -> bytes:
        """What is left to know when the answers come."""
        return bundle([pack_sorted(self.start), *(pack(x) for x in (self.count, self.doc, self.number, self.order, self.starts)), self.copy.tobytes()])

    def asks(self) -> dict[int, bytes]:
        out = {}
        for s in np.flatnonzero(np.diff(self.cut)).tolist():
            a, b = self.cut[s], self.cut[s + 1]
            some = self.order[a:b]
            found = [self.passages[i] for i in some]
            out[s] = bundle([zlib.compress(b"".join(found), 1), pack(np.array([len(p) for p in found], np.int64)),
                             pack(self.least[some]), pack(self.route[a:b] >> np.uint64(24))])
        return out


def _second_answers(bodies: list[bytes], need: int, limit: int) -> list[bytes]:
    """For each start in each passage the smallest id of the documents that have its ``need`` bytes."""
    joined, lengths, ids, route, owner = [], [], [], [], []
    for i, body in enumerate(bodies):
        text, size, least, way = unbundle(body)
        joined.append(zlib.decompress(text))
        lengths.append(unpack(size).astype(np.int64))
        ids.append(unpack(least))
        route.append(unpack(way))
        owner.append(len(lengths[-1]))
    size, least, way = np.concatenate(lengths), np.concatenate(ids), np.concatenate(route)
    text = b"".join(joined)
    begin = np.cumsum(size) - size
    begins = np.cumsum(np.maximum(0, size - need + 1)) - np.maximum(0, size - need + 1)
    answer = np.full(int(np.maximum(0, size - need + 1).sum()), NO_ID, np.uint64)
    order = np.argsort(way, kind="stable")
    # passages that may match have the same route: whole routes are sorted together, some at a time
    ends = np.append(np.flatnonzero(np.diff(way[order])) + 1, len(order)) if len(order) else np.zeros(0, np.int64)
    bytes_to = np.cumsum(size[order]) if len(order) else size
    at = 0
    while at < len(order):
        limit_at = np.searchsorted(bytes_to, (bytes_to[at - 1] if at else 0) + limit, "right")
        stop = ends[max(np.searchsorted(ends, limit_at, "right") - 1, np.searchsorted(ends, at, "right"))]
        some = order[at:stop]
        _sort_passages(text, some, way, begin, begins, size, least, answer, need)
        at = int(stop)
    out, done = [], 0
    total = np.cumsum(np.maximum(0, size - need + 1))
    passed = 0
    for n in owner:
        passed += n
        upto = int(total[passed - 1]) if passed else 0
        values = answer[done:upto]
        step = np.diff(values, prepend=np.uint64(0)).view(np.int64)  # runs of equal ids become zeros
        out.append(pack(((step << 1) ^ (step >> 63)).view(np.uint64)))
        done = upto
    return out


def _sort_passages(text: bytes, some: np.ndarray, way, begin, begins, size, least, answer, need: int) -> None:
    """Answers for the passages ``some``. Copies count once; a passage that no other one shares a
    route with has nothing to be compared with, the others are sorted together."""
    number: dict[bytes, int] = {}
    which = np.fromiter((number.setdefault(text[a:a + n], len(number)) for a, n in
                         zip(begin[some].tolist(), size[some].tolist())), np.int64, len(some))
    found = list(number)
    smallest = np.full(len(found), NO_ID, np.uint64)
    np.minimum.at(smallest, which, least[some])
    first = np.unique(which, return_index=True)[1]
    _, at, same_way = np.unique(way[some[first]], return_inverse=True, return_counts=True)
    met = np.flatnonzero(same_way[at] > 1)
    count = np.maximum(0, np.array([len(p) for p in found], np.int64) - need + 1)
    offset = np.cumsum(count) - count
    result = np.repeat(smallest, count)
    # bytes become 1 to 256; a zero ends each passage
    flat = np.frombuffer(b"".join([found[i] for i in met.tolist()]), np.uint8).astype(np.int64) + 1
    n = count[met] + need - 1
    string = np.zeros(len(flat) + len(met), np.int64)
    string[np.arange(len(flat)) + np.repeat(np.arange(len(met)), n)] = flat
    nth = np.arange(count[met].sum()) - np.repeat(np.cumsum(count[met]) - count[met], count[met])
    classes = match_classes(string, need, np.repeat(np.cumsum(n + 1) - n - 1, count[met]) + nth)
    by_class = np.full(int(classes.max(initial=-1)) + 1, NO_ID, np.uint64)
    np.minimum.at(by_class, classes, np.repeat(smallest[met], count[met]))
    result[np.repeat(offset[met], count[met]) + nth] = by_class[classes]
    each = count[which]  # every passage of the slice takes the answers of its equal
    nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    answer[np.repeat(begins[some], each) + nth] = result[np.repeat(offset[which], each) + nth]


def _removed(t: Texts, p: Passages, answers: np.ndarray) -> np.ndarray:
    """Which bytes of the chunk go. ``answers``: of each start of each passage, passages in order."""
    count = p.starts[p.order]
    offset = np.empty(len(count), np.int64)
    offset[p.order] = np.cumsum(count) - count
    edge = np.zeros(len(t.text) + 1, np.int32)
    ends = np.cumsum(p.count)
    at = 0
    while at < len(ends):  # some starts at a time: all of a chunk's would be many columns of eight times its bytes
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HASHED, "right")))
        n = p.count[at:stop]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        smaller = answers[np.repeat(offset[p.number[at:stop]], n) + nth] < np.repeat(t.ids[p.doc[at:stop]], n)
        where = (np.repeat(p.start[at:stop], n) + nth)[smaller]
        np.add.at(edge, where, 1)
        np.add.at(edge, where + t.need, -1)
        at = stop
    for i in np.flatnonzero(p.copy & (t.sizes >= t.need)):
        edge[t.first[i]] += 1
        edge[t.first[i] + t.sizes[i]] -= 1
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


def _whole_characters(raw: bytes, gone: np.ndarray) -> np.ndarray:
    """Keeps every character of which some byte is kept, so that what is left is UTF-8."""
    b = np.frombuffer(raw, np.uint8)
    lead = (b & 0xC0) != 0x80
    letter = np.cumsum(lead) - 1
    kept = np.zeros(int(letter[-1]) + 1 if len(b) else 0, bool)
    kept[letter[~gone]] = True
    return ~kept[letter] if len(b) else gone


def _exchange(docs: DataFrame, finish, schema: str, need: int, gram: int, hot: int, chunk: int, slice_bytes: int, limit: int) -> DataFrame:
    """``docs`` has doc_id, text and perhaps others; ``finish`` gets a chunk's table, its texts and
    which bytes go, and makes the result."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, slices = parts(spark, size, chunk), parts(spark, size, slice_bytes)
    bits = min(64, 8 + int(size).bit_length())  # more than the anchors need to be told apart, mostly
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(chunks)))

    def number(key) -> int:
        return key[0].as_py()

    def first(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        asks = _first_round(Texts(table, bits, need, gram), slices)
        return _rows(asks, [number(key)] * len(asks), False, asks.values())

    def answer_first(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _rows(table.column("slice").to_pylist(), table.column("chunk").to_pylist(), False,
                     _first_answers(table.column("body").to_pylist(), hot))

    def told(table: pa.Table) -> list[bytes]:
        got = sorted(zip(table.column("slice").to_pylist(), table.column("body").to_pylist()))
        return [b for _, b in got]

    def passages(t: Texts, bodies: list[bytes]) -> Passages:
        answers = [unbundle(b) for b in bodies]
        state, least = (np.concatenate([unpack(a[i]) for a in answers]) for i in (0, 1))
        return Passages(t, state.astype(np.int64), least, slices)

    def second(key: tuple[pa.Scalar, ...], answers: pa.Table, table: pa.Table) -> pa.Table:
        p = passages(Texts(table, bits, need, gram), told(answers))
        asks, memo = p.asks(), _rows([number(key) % slices], [number(key)], True, [p.memo()])
        return pa.concat_tables([_rows(asks, [number(key)] * len(asks), False, asks.values()), memo])

    def answer_second(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        asks = table.filter(pa.compute.invert(table.column("memo")))
        if not asks.num_rows:
            return table.cast(_ARROW)
        out = _rows(asks.column("slice").to_pylist(), asks.column("chunk").to_pylist(), False,
                    _second_answers(asks.column("body").to_pylist(), need, limit))
        return pa.concat_tables([out, table.filter(table.column("memo")).cast(_ARROW)])

    def last(key: tuple[pa.Scalar, ...], answers: pa.Table, table: pa.Table) -> pa.Table:
        memo = answers.filter(answers.column("memo")).column("body")[0].as_py()
        t = Texts(table, bits, need, gram)
        p = Passages.from_memo(memo)
        values, done = np.zeros(int(p.starts.sum()), np.uint64), 0
        for body in told(answers.filter(pa.compute.invert(answers.column("memo")))):
            step = unpack(body)
            step = (step >> np.uint64(1)).view(np.int64) ^ -(step & np.uint64(1)).view(np.int64)
            values[done:done + len(step)] = np.cumsum(step).view(np.uint64)
            done += len(step)
        return finish(table, t, _removed(t, p, values))

    # few bytes stand for much work here: tasks are counted by what they do, not merged by size
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)

    def by(df: DataFrame, key: str, groups: int):
        return df.repartition(min(groups, most), key).groupBy(key)

    texts = by(dealt, "chunk", chunks)
    told_first = by(texts.applyInArrow(first, ROWS), "slice", slices).applyInArrow(answer_first, ROWS)
    sent = by(told_first, "chunk", chunks).cogroup(texts).applyInArrow(second, ROWS)
    told_second = by(sent, "slice", slices).applyInArrow(answer_second, ROWS)
    return by(told_second, "chunk", chunks).cogroup(texts).applyInArrow(last, schema)


def report(docs: DataFrame, need: int = NEED, gram: int = GRAM, hot: int = HOT, chunk: int = CHUNK,
           slice_bytes: int = SLICE, limit: int = SORTED) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``."""
    def finish(table: pa.Table, t: Texts, gone: np.ndarray) -> pa.Table:
        own = [table.column("doc_id")[i].as_py() for i in t.rows]
        removed, spans, digest = [], [], []
        for raw, at, n in zip(t.raw, t.first, t.sizes):
            mask = gone[at:at + n]
            removed.append(int(mask.sum()))
            spans.append(int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum()))
            kept = np.frombuffer(raw, np.uint8)[~mask].tobytes() if removed[-1] else raw
            digest.append(hashlib.sha256(kept).hexdigest())
        return pa.table({"doc_id": pa.array(own, pa.int64()), "n_bytes": pa.array(t.sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string())})

    return _exchange(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")), finish,
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                     need, gram, hot, chunk, slice_bytes, limit)


def strip(docs: DataFrame, need: int = NEED, gram: int = GRAM, hot: int = HOT, chunk: int = CHUNK,
          slice_bytes: int = SLICE, limit: int = SORTED) -> DataFrame:
    """``docs`` with the repeated passages cut from ``text``. A character at the edge of a passage
    stays whole if any of its bytes is kept; ``n_chars``, if there, is counted anew."""
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])  # whatever its columns are called
    at = {c: F.col(f"c{names.index(c)}") for c in ("doc_id", "text")}
    others = [c for c in flat.columns if c != f"c{names.index('text')}"]
    source = flat.select(at["doc_id"].cast("long").alias("doc_id"), at["text"].alias("text"), F.struct(*others).alias("row"))

    def finish(table: pa.Table, t: Texts, gone: np.ndarray) -> pa.Table:
        out: list[str | None] = [None] * len(t.rows)
        changed = np.zeros(len(t.rows), bool)
        empty = table.column("text").is_null().to_pylist()
        for i, raw, first, n in zip(t.rows, t.raw, t.first, t.sizes):
            mask = gone[first:first + n]
            changed[i] = mask.any()
            kept = np.frombuffer(raw, np.uint8)[~_whole_characters(raw, mask)].tobytes() if changed[i] else raw
            out[i] = None if empty[i] else kept.decode()
        return pa.table({"row": table.column("row"), "kept": pa.array(out, pa.string()), "changed": pa.array(changed)})

    schema = T.StructType([source.schema["row"], T.StructField("kept", T.StringType()), T.StructField("changed", T.BooleanType())])
    out = _exchange(source, finish, schema, need, gram, hot, chunk, slice_bytes, limit)
    new = {"text": F.col("kept")}
    if "n_chars" in names:
        old = F.col(f"row.c{names.index('n_chars')}")
        new["n_chars"] = F.when(F.col("changed"), F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(old)
    return out.select(*[new.get(c, F.col(f"row.c{i}")).alias(c) for i, c in enumerate(names)])
