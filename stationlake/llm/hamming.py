"""Pairs of 64-bit fingerprints within a small Hamming distance, by pigeonhole blocks.

The 64 bits are cut into ``blocks`` blocks. Two fingerprints that differ in at most
``radius`` bits agree on at least ``blocks - radius`` of them, so for every choice of
that many blocks all fingerprints are filed under the bits of the chosen blocks (the
permuted tables), and only fingerprints in the same drawer are compared.

A drawer of more than ``DRAWER`` fingerprints is not compared as it is: its remaining
bits are cut into ``radius + 1`` blocks again and each fingerprint is filed under one
of them in addition, level by level. After some levels six or fewer bits remain free,
so a drawer then holds at most 64 different fingerprints: the number of comparisons
grows in proportion to the fingerprints, whatever their distribution, and no pair is lost.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import staged

BITS, DRAWER = 64, 64


def _cut(bits: list[int], n: int) -> list[list[int]]:
    """Nearly equal runs; empty ones are left out."""
    size, more = divmod(len(bits), n)
    out, at = [], 0
    for i in range(n):
        step = size + (i < more)
        out.append(bits[at:at + step])
        at += step
    return [b for b in out if b]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << BITS) if m >> (BITS - 1) else m


def first_masks(blocks: int, radius: int) -> list[int]:
    cut = _cut(list(range(BITS)), blocks)
    return [_mask([b for block in pick for b in block]) for pick in combinations(cut, blocks - radius)]


def finer_masks(mask: int, radius: int) -> list[int]:
    """The masks that a full drawer of ``mask`` is filed under; a pair keeps at least one in common."""
    free = [b for b in range(BITS) if not (mask >> b) & 1]
    have = [b for b in range(BITS) if (mask >> b) & 1]
    return [_mask(have + block) for block in _cut(free, radius + 1)]


def near_pairs(fps: DataFrame, radius: int = 3, blocks: int = 6, asked: bool = False) -> DataFrame:
    """``fps``: distinct (fp long, id). Returns distinct pairs a, b (ids, fp of a below that of b)
    with ``distance`` of 1 to ``radius``. No pair is left out.

    With ``asked``, ``fps`` also has a boolean ``ask``, and a runs over the rows where it is
    true, b over all others within the radius, above or below."""
    spark = fps.sparkSession
    columns = ["fp", "id", "ask"] if asked else ["fp", "id"]
    masks = F.explode(F.array(*[F.lit(m).cast("long") for m in first_masks(blocks, radius)]))
    rows = fps.select(*columns, masks.alias("mask"))
    found = None
    while True:
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        drawers = staged(rows.join(sizes, ["mask", "key"]), "drawers")
        small = drawers.where(F.col("n") <= DRAWER).select("mask", "key", *columns)
        a, b = small.alias("a"), small.alias("b")
        distance = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp")))
        order = F.col("a.ask") & (F.col("a.fp") != F.col("b.fp")) if asked else F.col("a.fp") < F.col("b.fp")
        pairs = a.join(b, (F.col("a.mask") == F.col("b.mask")) & (F.col("a.key") == F.col("b.key"))
                       & order & (distance <= radius)) \
            .select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), distance.alias("distance"))
        found = pairs if found is None else found.unionByName(pairs)
        full = drawers.where(F.col("n") > DRAWER).select(*columns, "mask")
        # a few thousand masks at most: their number depends on the levels, not on the data
        open_masks = [r["mask"] for r in full.select("mask").distinct().collect()]
        if not open_masks:
            return found.distinct()
        finer = spark.createDataFrame([(m, f) for m in open_masks for f in finer_masks(m, radius)], "mask long, finer long")
        rows = full.join(F.broadcast(finer), "mask").select(*columns, F.col("finer").alias("mask")).distinct()
