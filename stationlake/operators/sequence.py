"""Dense 1-based numbering of rows inside groups, without one task per group.

``row_number().over(Window.partitionBy(g).orderBy(o))`` puts a whole group into
one task; a group holding a third of the data would then be sorted by a single
core.  Here the rows are range-partitioned on ``(g, o)`` instead, so a hot group
is cut across many partitions, and each partition is numbered locally in one
pass.  Only the first group of a partition can continue from earlier
partitions; its offset comes from a table with one row per partition -- its
size is bounded by the partition count, so broadcasting it is safe.

``run_index`` is the per-partition step on its own: it numbers runs of equal
keys in the order rows arrive, which is also how lines are numbered inside one
file split straight after the scan (no shuffle at all).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.session import staged


def _run_index_batches(keys: list[str], out_col: str, of_run: dict | None = None):
    """mapInArrow body: 1-based position inside runs of equal ``keys``.

    Only the key columns are looked at (as Arrow arrays); every other column
    passes through without conversion. Columns ``of_run`` are computed once a run.  State carries across batches of one
    partition, so a run may span batches.
    """

    def fn(batches):
        last_key = None
        last_count = 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                for name in of_run or ():
                    batch = batch.append_column(name, pa.array([], type=pa.string()))
                yield batch.append_column(out_col, pa.array([], type=pa.int64()))
                continue
            starts = np.zeros(n, dtype=bool)
            starts[0] = True
            for k in keys:
                col = batch.column(k)
                if n > 1:
                    diff = pc.not_equal(col.slice(1), col.slice(0, n - 1))
                    diff = pc.fill_null(diff, True).to_numpy(zero_copy_only=False)
                    starts[1:] |= diff
            pos = np.arange(n, dtype=np.int64)
            run_start = np.maximum.accumulate(np.where(starts, pos, 0))
            idx = pos - run_start + 1
            first_key = tuple(batch.column(k)[0].as_py() for k in keys)
            if last_key is not None and first_key == last_key:
                first_run = run_start == 0
                idx[first_run] += last_count
            last_key = tuple(batch.column(k)[n - 1].as_py() for k in keys)
            last_count = int(idx[-1])
            if of_run:
                firsts = batch.column(keys[0]).take(pa.array(np.flatnonzero(starts))).to_pylist()
                run = pa.array(np.cumsum(starts) - 1)
                for name, f in of_run.items():
                    batch = batch.append_column(name, pa.array([f(k) for k in firsts], pa.string()).take(run))
            yield batch.append_column(out_col, pa.array(idx, type=pa.int64()))

    return fn


def run_index(df: DataFrame, keys: Sequence[str], out_col: str = "run_idx",
              of_run: dict[str, Callable[[str], str]] | None = None) -> DataFrame:
    """Append the 1-based position of each row inside its run of equal ``keys``.

    Partition-local (no shuffle): rows must already arrive grouped, e.g. a file
    split in scan order, or a partition sorted on ``keys``.  A run that spans
    partitions restarts at 1 in each; callers add per-partition offsets. ``of_run``: further
    text columns, each a function of the first key.
    """
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.StringType()) for c in of_run or ()]
                          + [T.StructField(out_col, T.LongType(), False)])
    return df.mapInArrow(_run_index_batches(list(keys), out_col, of_run), schema)


def split_groups_sequence(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                          out_col: str = "seq", num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` per group without ever holding a whole group in one task.

    Plan: one range shuffle on (group, order) and a local numbering pass, written once to the
    shared folder; the size of every group's part in every partition becomes a table with one
    row per partition, broadcast back.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group_cols, order_cols = list(group_cols), list(order_cols)
    keys = group_cols + order_cols
    # both branches below read what one execution of the range shuffle has written: two
    # separately planned range exchanges would sample different bounds
    ranged = (df.repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id()))
    local = staged(run_index(ranged, group_cols, "_local"), "numbered")
    gkey = F.struct(*group_cols)

    # rows of every group in every partition (map-side partial maxima: tiny shuffle)
    per_part = local.groupBy("_pid", *group_cols).agg(F.max("_local").alias("_n"))
    # rows of the same group in earlier partitions
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # one row per partition: its first group and that group's offset
    offsets = (per_part.groupBy("_pid")
                       .agg(F.min_by(F.struct(gkey.alias("g"), F.col("_before").alias("b")), gkey)
                            .alias("_first"))
                       .select("_pid", F.col("_first.g").alias("_first_g"),
                               F.col("_first.b").alias("_offset")))

    # bounded by the number of partitions n -> broadcast is safe at any data size
    joined = local.join(F.broadcast(offsets), "_pid", "left")
    seq = F.col("_local") + F.when(gkey == F.col("_first_g"), F.col("_offset")).otherwise(F.lit(0))
    return joined.withColumn(out_col, seq.cast("long")).drop("_pid", "_local", "_first_g", "_offset")
