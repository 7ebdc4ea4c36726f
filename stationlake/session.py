"""Session helpers.

On a cluster the session is created by ``spark-submit`` and carries its own
settings; these helpers only fill in what is missing (tests, bench).
Durable intermediate data (checkpoints, staged files) always goes below the
shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reliable checkpoints of merged tables are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "stationlake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings this library assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # station clocks are wall-clock times: pin the zone so parsing is stable
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Only a session whose tasks run inside the driver's own process (``local[..]``: tests,
    bench) may go without the setting and gets a fresh folder; on a cluster that would be
    a folder other machines cannot see, so the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="stationlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Folders named while a :func:`staging` block is open, a list for each open block.
_OPEN: list[list[str]] = []


def staging_dir(spark: SparkSession, purpose: str) -> str:
    """The name of a fresh folder below the shared one; Spark's writers create it."""
    path = f"{checkpoint_root(spark).rstrip('/')}/staging/{purpose}-{uuid.uuid4().hex[:12]}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Removes what is staged inside the block when it ends: what reads it must have been written by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        hadoop_path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
        for name in _OPEN.pop():
            path = hadoop_path(name)
            path.getFileSystem(conf).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block leaves no shuffle files behind: those of a write go when it ends,
    not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df``, a plain scan, reads."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` once below the shared folder and reads it back: what follows does not
    compute it again, and its files outlive any executor."""
    path = staging_dir(df.sparkSession, purpose)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
