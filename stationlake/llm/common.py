"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.session import staging_dir

#: Characters that end a word: the pattern [\x20\x09-\x0D].
BREAKS = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: Column | str = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z only, whatever the locale."""
    return F.translate(col, UPPER, LOWER)


def words_of(col: Column) -> Column:
    """The words of a text in order; an empty array for null or blank text."""
    spaced = F.translate(F.coalesce(col, F.lit("")), BREAKS[1:], " " * (len(BREAKS) - 1))
    return F.array_remove(F.split(spaced, " ", -1), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back, so that what
    follows starts from files that outlive any executor."""
    path = staging_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession, units: float, per_part: float) -> int:
    """How many groups keep each below ``per_part`` units; one at least."""
    return max(1, math.ceil(units / per_part))


def by_bytes(batches: Iterator[pd.DataFrame], column: str, limit: int) -> Iterator[pd.DataFrame]:
    """Regroups the frames of a partition so that each holds about ``limit`` characters
    of ``column`` (a longer single text is a frame of its own)."""
    held: list[pd.DataFrame] = []
    size = 0
    for frame in batches:
        sizes = frame[column].str.len().fillna(0).to_numpy()
        start, acc = 0, size
        for i, n in enumerate(sizes):
            if acc and acc + n > limit:
                held.append(frame.iloc[start:i])
                yield pd.concat(held, ignore_index=True)
                held, start, acc = [], i, 0
            acc += n
        if start < len(frame):
            held.append(frame.iloc[start:])
        size = acc
    if held:
        yield pd.concat(held, ignore_index=True)
