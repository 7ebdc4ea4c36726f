"""A bounded, repeatable sample of labelled documents for fitting a classifier."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import staged

FOLDS, HELD_FOLD = 5, 0
#: Bytes of the longest text that is learnt from whole; of a longer one a window of at most so many bytes is.
LONGEST = 100_000


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learnt from: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> pd.DataFrame:
    """Texts with their ``label`` (0 or 1): of each label ``rows`` documents that are not
    held out, or all where there are fewer: those with the smallest hashes of their ids. Of several rows with one
    id the text with the smallest hash counts, of several labels the smallest. Of a text above ``LONGEST`` a window is
    taken, at a place drawn by the id. The only thing that comes to the driver; ``rows`` and ``LONGEST`` bound it.
    Labels of other values and ids without a document are left out."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    marked = marked.where(~held_out(F.col("doc_id"))).withColumn("draw", F.xxhash64("doc_id"))
    known = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    marked = staged(marked.join(known.select("doc_id"), "doc_id", "left_semi"), "learnable")  # before the draw, so that none is lost
    drawn = [marked.where(F.col("label") == v).orderBy("draw", "doc_id").limit(rows) for v in (0, 1)]
    chosen = drawn[0].unionByName(drawn[1])  # at most 2 * rows short rows
    width = LONGEST // 4  # characters of up to four bytes
    place = (F.pmod(F.col("draw"), F.length("text") - width + 1) + 1).cast("int")
    learnt = F.when(F.octet_length("text") <= LONGEST, F.col("text")).when(F.length("text") <= width, F.col("text")) \
        .otherwise(F.substring(F.col("text"), place, F.lit(width)))
    texts = known.join(F.broadcast(chosen), "doc_id").select("draw", "doc_id", "label", learnt.alias("text"), F.xxhash64("text").alias("_h"))
    one = texts.groupBy("draw", "doc_id", "label").agg(F.min_by("text", F.struct(F.col("text").isNull(), F.col("_h"))).alias("text"))
    return one.select("draw", "doc_id", "text", "label").toPandas().sort_values(["draw", "doc_id"], ignore_index=True)
