"""Document fingerprints by SimHash over weighted words, in built-in expressions only.

Every word occurrence adds its weight to the bits that its 64-bit hash sets; a bit of the
fingerprint is 1 where set bits gathered more than half of the text's weight. Weights grow
with the cube of a word's length, so that frequent short words say little. The votes are
summed by a hash aggregate of 32 sums, two bits in each.

:func:`edited_pairs` deals documents by ranges of ``doc_id`` so that each meets its
successor: the one shuffle of the texts. :func:`neighbours` finds all fingerprints within a
Hamming radius by permuted block tables (see :mod:`stationlake.llm.hamming`).

Null text counts as empty; a text without words has fingerprint zero. Rows with the same
doc_id follow each other in the order of their texts' hashes, null ids last. A table of one
row succeeds itself. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import staged, text_or_empty
from stationlake.llm.hamming import near_pairs

RADIUS, LONGEST = 3, 12
#: Bits i and i + 32 of a word's hash, each with room for 2^31 of weight: words are summed by so many.
_PAIR, CHUNK = 0x0000000100000001, 1 << 20


def _weight(word: Column) -> Column:
    n = F.least(F.length(word), F.lit(LONGEST))
    return (F.ceil(n * n * n / 8)).cast("long")  # 1 to 216


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``fp`` (long). The keys must tell the rows apart; no shuffle happens where
    ``texts`` is already dealt out by some of them."""
    words = F.split(F.lower(F.col(text)), r"[\x20\x09-\x0D]+", -1)
    rows = texts.select(*keys, F.posexplode(words).alias("word_at", "word"))
    h, w = F.xxhash64("word"), F.when(F.col("word") == "", F.lit(0).cast("long")).otherwise(_weight(F.col("word")))
    rows = rows.select(*keys, F.shiftright("word_at", CHUNK.bit_length() - 1).alias("word_chunk"), h.alias("h"), w.alias("w"))
    packed = rows.groupBy(*keys, "word_chunk").agg(F.sum("w").alias("all"), *[
        F.sum(F.shiftright("h", i).bitwiseAND(F.lit(_PAIR)) * F.col("w")).alias(f"v{i}") for i in range(32)])
    low, high = (lambda i: F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF))), (lambda i: F.shiftrightunsigned(f"v{i}", 32))
    sums = packed.groupBy(*keys).agg(F.sum("all").alias("all"), *[
        F.sum(low(i) if i < 32 else high(i - 32)).alias(f"v{i}") for i in range(64)])
    fp = F.lit(0).cast("long")
    for i in range(64):
        bit = (1 << i) - (1 << 64 if i == 63 else 0)
        fp = fp.bitwiseOR(F.when(2 * F.col(f"v{i}") > F.col("all"), F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, fp.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _ranges(docs: DataFrame, n: int) -> tuple[list[int], DataFrame]:
    """Bounds that cut the ids in about ``n`` ranges, and the largest id of each range with the
    range above it, whose last row it succeeds (the largest of all succeeds the last row)."""
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], min(100 * n, 1_000_000)).alias("c")).first()["c"] if n > 1 else []
    cuts = sorted(set(cuts or []))
    tops = docs.groupBy(_range_of(cuts).alias("range")).agg(F.max("doc_id").alias("top"))
    above = F.lead("range").over(Window.orderBy("range"))  # one row for each range
    first = F.min("range").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return cuts, tops.select("top", F.coalesce(above, first).alias("follows"))


def _range_of(cuts: list[int]) -> Column:
    """How many cuts are below the id, found in two steps of about the root of their number;
    range 0 holds null ids and the smallest ones."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    blocks = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b < F.col("doc_id")))
    longs = lambda values: F.array(*[F.lit(c).cast("long") for c in values])
    block = below(longs([b[0] for b in blocks]))  # blocks that begin below the id
    inside = below(F.get(F.array(*[longs(b) for b in blocks]), block - 1))
    return F.coalesce(F.when(block > 0, (block - 1) * step + inside), F.lit(0))


def edited_pairs(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp and next_fp of every row."""
    spark = docs.sparkSession
    ids = docs.select("doc_id")
    cuts, tops = _ranges(ids, ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = docs.select(docs["doc_id"].alias("doc_id"), text_or_empty(docs["text"]).alias("text")).withColumn("range", _range_of(cuts))
    # a range's largest id is dealt to its own range and, behind all others, to the one that it follows
    rows = rows.join(F.broadcast(tops), F.col("doc_id").eqNullSafe(F.col("top")), "left")  # null: no row has an id
    here = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("follows").alias("range"), F.lit(True).alias("guest"))
    rows = rows.select("doc_id", "text", F.explode(F.when(F.col("follows").isNull(), F.array(here)).otherwise(F.array(here, guest))).alias("at"))
    rows = rows.select("doc_id", "text", "at.range", "at.guest")
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")
    rows = rows.select("range", F.row_number().over(order).alias("place"), "guest", "doc_id", "text",
                       F.lead("text").over(order).alias("next"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr(F.coalesce("next", F.lit("")), F.lit(1), half))
    rows = rows.select("range", "place", "guest", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    keys = ["range", "place", "guest", "doc_id", "n_chars", "edited_sha256", "kind"]
    both = rows.select(*keys[:-2], F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))).alias("b"))
    fps = fingerprints(both.select(*keys[:-1], "b.kind", "b.body"), keys, "body")
    wide = fps.groupBy(*keys[:-1]).agg(F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"),
                                       F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"))
    follow = Window.partitionBy("range").orderBy("place")
    wide = wide.select("*", F.lead("fp").over(follow).alias("next_fp")).where("not guest")
    return wide.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")


def neighbours(fps: DataFrame, radius: int = RADIUS, every: int = 20) -> DataFrame:
    """For each row of ``fps`` (doc_id, fp) whose id is divisible by ``every``: ``n_same``, other rows
    with its fingerprint, and ``n_near``, rows whose fingerprint differs in 1 to ``radius`` bits."""
    classes = staged(fps.groupBy("fp").agg(F.count("*").alias("n"), F.max(F.coalesce(F.col("doc_id") % every == 0, F.lit(False))).alias("ask")), "classes")
    pairs = near_pairs(classes.select("fp", F.col("fp").alias("id"), "ask"), radius, asked=True)
    near = pairs.join(classes.select(F.col("fp").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("n_near"))
    found = classes.where("ask").join(near, F.col("fp") == F.col("a"), "left").select("fp", (F.col("n") - 1).alias("n_same"), F.coalesce("n_near", F.lit(0)).alias("n_near"))
    return fps.where(F.col("doc_id") % every == 0).join(found, "fp").select("doc_id", "n_same", "n_near")


def hex_of(c: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(c)), 16, "0"))


def report(docs: DataFrame) -> DataFrame:
    """The columns of the query: fingerprints as 16 hex digits and their likenesses, and for ids
    divisible by 20 the rows found within the radius."""
    pairs = staged(edited_pairs(docs), "fingerprints")
    near = neighbours(pairs.select("doc_id", "fp")).groupBy("doc_id").agg(F.max("n_same").alias("n_same"), F.max("n_near").alias("n_near"))
    return pairs.join(near, "doc_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", hex_of("fp").alias("fingerprint"), hex_of("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "n_same", "n_near")
