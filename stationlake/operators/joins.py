"""Size checks that decide whether a side of a join may be broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broadcast_limit(spark) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes, whatever unit it is written in."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    return 0 if raw.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(raw)


def measured_bytes(df: DataFrame, size_expr: Column) -> int:
    """Sum of ``size_expr`` over ``df`` (one small aggregate job)."""
    row = df.agg(F.coalesce(F.sum(size_expr), F.lit(0)).alias("b")).first()
    return int(row["b"]) if row else 0
