"""Best-fit packing of tokenised documents into sequences, improved by local search.

Documents are tokenised whole and cut into pieces of at most ``capacity`` tokens. The
pieces, a few numbers each, are dealt at random into groups of about ``GROUP``; each
group is packed on its own by best fit, longest first, and then by exchanging one
document for one, two for one, or moving one, between underfull bins whenever that
raises the sum of squared fills, until a group has as few bins as its tokens allow or no such step
between any of its bins is left. So a group may end with more bins than its tokens fill, where lengths do not go together.

Null text counts as empty (its only token is the end id). Repeated rows are packed each
on its own; they are counted first and dealt ``TOGETHER`` at a time, so that however many there are,
no group grows with them. Other input columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import parts, staged

CAPACITY, END_ID, GROUP = 4096, 1, 16384
#: Equal rows (of one id, piece and checksum) that go to one group.
TOGETHER = 64
#: Words whose ids a task remembers; beyond that it starts to remember anew.
REMEMBERED = 700_000
#: Ids travel through pandas as text, so that nulls and large ids stay exact.
PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"


#: A run of letters, then a run of ASCII marks without the apostrophe: two separate inputs of the merges.
_LETTERS_MARKS = re.compile(r"([^\W\d_]*)([!-&(-/:-@\[-`{-~]*)")
#: The last letter of the blocks whose letters have no other composed form; only U+0130 lower-cases to two characters.
_LATIN_END, _DOTTED = "\u024f", "\u0130"


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as a printable character: itself, or the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Token ids of words as little-endian unsigned 32-bit bytes, learnt on first sight.

    The tokenizer drops white space and never merges across it, so a text's ids are
    those of its words in order. Latin letters with marks behind them, which need no
    normalisation but lower case, go straight to the merges; other words are encoded whole."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.letters, self.parts = Tokenizer.from_file(path), _byte_letters(), {}
        self.merges = self.tokenizer.model

    @classmethod
    def of_worker(cls, path: str) -> WordIds:
        """The one that earlier tasks in the same Python worker have filled."""
        home = sys.modules.setdefault("stationlake_word_ids", types.ModuleType("stationlake_word_ids"))
        if path not in home.__dict__:
            home.__dict__[path] = cls(path)
        return home.__dict__[path]

    def _part(self, text: str, marks: bool) -> bytes:
        if text not in self.parts:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids if marks else \
                [t.id for t in self.merges.tokenize(text.encode().decode("latin-1").translate(self.letters))]
            self.parts[text] = np.array(ids, "<u4").tobytes()
        return self.parts[text]

    def learn(self, words: set[bytes]) -> None:
        others = []
        for raw in words:
            if raw in self:
                continue
            word = raw.decode()
            split = _LETTERS_MARKS.fullmatch(word)
            # the class of letters also matches numerals such as U+00B2, which the tokenizer splits off
            if split and (raw.isascii() or ((split[1] or "a").isalpha() and max(split[1], default="a") <= _LATIN_END and _DOTTED not in word)):
                letters, marks = split[1].lower(), split[2]
                self[raw] = (self._part(letters, False) if letters else b"") + (self._part(marks, True) if marks else b"")
            else:
                others.append(word)
        for word, e in zip(others, self.tokenizer.encode_batch(others, add_special_tokens=False)):
            self[word.encode()] = np.array(e.ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        words = (text or "").encode().split()
        if len(self) > REMEMBERED:
            self.clear()
            self.parts.clear()
        self.learn(set(words))
        return b"".join(map(self.__getitem__, words))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32. ``tokenizer`` is a file that
    every executor can open."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = WordIds.of_worker(tokenizer)
        for f in frames:
            out = []
            for doc_id, text in zip(f["doc_id"].tolist(), f["text"].tolist()):
                ids = ids_of.encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype(
                {"piece": "int32", "start": "int64", "length": "int64", "ids_crc32": "int64"})

    return docs.select(docs["doc_id"].cast("string").alias("doc_id"), docs["text"]).mapInPandas(cut, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: each item, longest first, goes where the least room stays."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            bins[b].append(i)
        else:
            b, room = len(bins), capacity
            bins.append([i])
        left = room - n
        if left:
            if left not in by_room:
                by_room[left] = []
                insort(rooms, left)
            by_room[left].append(b)
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search: empties bins into the room of the others.

    It goes through the underfull bins, the emptiest first, and takes documents out of each as
    long as a step (:func:`_step`) raises the sum of squared fills; so the search ends. It stops when the
    bins are as few as the tokens allow, or after a round in which no bin had a step left."""
    least = -(-int(lengths.sum()) // capacity)
    bins = [list(b) for b in bins if b]
    fill = np.array([lengths[b].sum() for b in bins], np.int64)
    where = np.zeros(len(lengths), np.int64)
    for k, b in enumerate(bins):
        where[b] = k
    left, going = len(bins), True
    while going and left > least:
        going = False
        for k in np.argsort(fill, kind="stable").tolist():
            while left > least and fill[k] < capacity and _step(bins, fill, k, lengths, capacity, where):
                going = True
                if not bins[k]:
                    fill[k], left = capacity, left - 1  # takes no part any more
    return [b for b in bins if b]


def _step(bins: list[list[int]], fill, k: int, lengths: np.ndarray, capacity: int, where: np.ndarray | None = None) -> bool:
    """Moves one document of bin ``k``, or exchanges one or two for one of another underfull bin, if that raises
    the sum of squared fills. Every bin, document and pair is looked at, by length: the distinct
    lengths of a bin add up to ``capacity`` at most, so they are few. ``where`` is the bin of each document."""
    if where is None:
        where = np.zeros(len(lengths), np.int64)
        for j, b in enumerate(bins):
            where[b] = j
    fills = np.asarray(fill)
    room, behind = capacity - fills, fills[k] - fills  # a gain must be above ``behind`` to raise the squares
    room[k] = 0
    most = int(room.max())
    if not most:
        return False
    own: dict[int, list[int]] = {}
    for i in bins[k]:
        own.setdefault(int(lengths[i]), []).append(i)
    sizes = sorted(own, reverse=True)
    for n in sizes:  # move: where the least room stays
        fits = np.flatnonzero((room >= n) & (behind < n)) if n <= most else ()
        if len(fits):
            _exchange(bins, fill, where, k, own[n][:1], int(fits[np.argmin(room[fits])]), [], lengths)
            return True
    # what one or two documents of this bin add up to, and for each number the largest such sum up to it
    one = np.array(sizes)
    two = one[:, None] + one
    twice = np.array([len(own[n]) > 1 for n in sizes])
    sums = np.zeros(capacity + 1, np.int64)
    sums[one] = one
    two = two[np.triu(np.ones(two.shape, bool), 1) | np.diag(twice)]
    sums[two] = two
    up_to = np.maximum.accumulate(sums)
    theirs = np.flatnonzero(room[where] > 0)
    size, other = lengths[theirs], where[theirs]
    gain = up_to[size + room[other]] - size  # the largest that the other bin has room for
    gain[gain <= np.maximum(0, behind)[other]] = 0
    at = int(np.argmax(gain)) if len(gain) else -1
    if at < 0 or gain[at] <= 0:
        return False
    total = int(gain[at] + size[at])
    a = total if total in own else next(n for n in sizes if total - n in own and (total != 2 * n or len(own[n]) > 1))
    mine = own[a][:1] if a == total else [own[a][0], own[total - a][-1]]
    _exchange(bins, fill, where, k, mine, int(other[at]), [int(theirs[at])], lengths)
    return True


def _exchange(bins, fill, where, k: int, mine: list[int], j: int, theirs: list[int], lengths: np.ndarray) -> None:
    moved = int(lengths[mine].sum()) - int(lengths[theirs].sum() if theirs else 0)
    bins[k] = [i for i in bins[k] if i not in mine] + theirs
    bins[j] = [i for i in bins[j] if i not in theirs] + mine
    where[mine], where[theirs] = j, k
    fill[k] -= moved
    fill[j] += moved


def pack_group(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every item."""
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, items in enumerate(improve(best_fit(lengths, capacity), lengths, capacity)):
        at = np.cumsum(lengths[items])
        bin_of[items], offset[items] = b, at - lengths[items]
    return bin_of, offset


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """All pieces of ``docs`` with ``sequence_id`` and ``offset`` (see :func:`pieces`)."""
    cut = staged(pieces(docs, tokenizer, capacity, end_id), "pieces")
    groups = parts(docs.sparkSession, cut.count(), group)
    together = max(1, min(TOGETHER, group // 4))

    def packed(f: pd.DataFrame) -> pd.DataFrame:
        f = f.loc[f.index.repeat(f["copies"])]
        # the order of arrival may differ between attempts; the packing must not
        f = f.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable")
        bin_of, offset = pack_group(f["length"].to_numpy(), capacity)
        f["sequence_id"] = f["sequence_group"].to_numpy() * (1 << 32) + bin_of
        f["offset"] = offset
        return f.drop(columns=["sequence_group", "copies"])

    lots = cut.groupBy(*cut.columns).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / together))))
    copies = F.least(F.lit(together), F.col("n") - F.col("lot") * together).alias("copies")
    dealt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "lot"), F.lit(groups)).alias("sequence_group")
    return lots.select(*cut.columns, copies, dealt).groupBy("sequence_group") \
        .applyInPandas(packed, PIECES + ", sequence_id long, offset long") \
        .withColumn("doc_id", F.col("doc_id").cast("long"))
