"""SimHash near-dedup: word-shingle fingerprints, pigeonhole blocks, Hamming check, components.

A text is lower-cased in A-Z and cut into words; each run of ``shingle`` words (repeats
included; a shorter text is one shingle) is hashed with XXH64, seed 42, and a bit of the
fingerprint is 1 if more than half of the hashes have it. Documents whose fingerprints
differ in at most ``radius`` bits are linked; a component is what links connect.

Null text counts as empty; texts without words have fingerprint zero and link like any
other, and so do rows without an id. Equal fingerprints are one node, named by the fingerprint,
so copies never become pairs. Repeated rows each keep their row. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import staged
from stationlake.llm.components import components
from stationlake.llm.hamming import near_pairs

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Shingles hashed and counted at a time, so that a very long text needs no more memory.
BLOCK = 1 << 15


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and exactly the six ASCII breaks
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        some = words[at:min(at + BLOCK, n) + shingle - 1]
        grams = map(b" ".join, zip(*[some[i:] for i in range(shingle)])) if len(words) >= shingle else [b" ".join(words)]
        h = np.fromiter((digest(g, SEED) for g in grams), np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp long) for every row; one pass over the texts, no shuffle."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fps = np.array([simhash(t, shingle) for t in f["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": f["doc_id"], "text_hash": f["text_hash"], "fp": fps})

    rows = docs.select(docs["doc_id"].cast("string").alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"), docs["text"])
    return rows.mapInPandas(hashed, "doc_id string, text_hash long, fp long") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text_hash", "fp")


def hex_of(fp: str) -> F.Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, text_hash, fp, root, component_id and component_size of every row. ``root`` is the
    component's smallest fingerprint; component_id, its smallest id, is null where no row has one."""
    fps = staged(fingerprints(docs, shingle), "simhash")
    nodes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")), "nodes")
    joined = components(near_pairs(nodes.select("fp", F.col("fp").alias("id")), radius)).withColumnRenamed("id", "fp")
    roots = nodes.join(joined, "fp", "left").select("fp", "id", "n", F.coalesce("component", "fp").alias("root"))
    whole = roots.groupBy("root").agg(F.min("id").alias("component_id"), F.sum("n").alias("component_size"))
    named = roots.join(whole, "root").select("fp", "root", "component_id", "component_size")
    return fps.join(named, "fp", "left").select("doc_id", "text_hash", "fp", "root", "component_id", "component_size")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id and component_size of every row."""
    return classes(docs, shingle, radius).select("doc_id", hex_of("fp").alias("fingerprint"), "component_id", "component_size")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, that of its smallest id, with all its columns. Rows without an
    id link like any other and come last in their component."""
    found = staged(classes(docs, shingle, radius), "components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    chosen = found.groupBy("root").agg(first).select(F.col("first.doc_id").alias("chosen_id"), F.col("first.text_hash").alias("chosen_hash"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.xxhash64("text").alias("own_hash"), row)
    same = F.col("own_id").eqNullSafe(F.col("chosen_id")) & (F.col("own_hash") == F.col("chosen_hash"))
    kept = rows.join(chosen, same, "left_semi")
    repeated = found.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count()
    if repeated:  # rows that are there twice: only then are the kept texts shuffled once more
        kept = kept.dropDuplicates(["own_id", "own_hash"])
    return kept.select("row.*")
