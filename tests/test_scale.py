"""What must grow with the rows and no faster: joins with headers, copies that an import writes, rendered files."""

import random
import time
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stationlake.fixtures import render
from stationlake.operators import tables as tb
from stationlake.plans.ingest import ingest_lines
from stationlake.plans.pipeline import parse_lines
from stationlake.schemas import LINES_SCHEMA, MEASUREMENT_COLUMNS, MEASUREMENT_KEY, MEASUREMENT_SCHEMA
from stationlake.sources import tables as stored_tables
from stationlake.sources.files import read_lines, scan_text_raw
from stationlake.sources.tables import partition_cols_for, partition_schema, read_table

PREAMBLE = ["ST1,Version: V1; VX", "Product,SerialNumber,Station ID,Test Pass/Fail Status,StartTime,EndTime,A,B", "Display Name ----->",
            "PDCA Priority ----->,,,,,,0,1", "Upper Limit ----->,,,,,,5,6", "Lower Limit ----->,,,,,,1,2", "Measurement Unit ----->,,,,,,V,A"]


def _lines(spark):
    rows = []
    for n in range(12):
        data = [f"P{i},S{n}-{i},FX_F1_L1_M1,PASS,{'bad' if n % 3 == 0 and i == 4 else '2024-01-05 10:00:00'},2024-01-05 10:00:09,{i},{n}"
                + (",more" if n == 7 and i == 2 else "") for i in range(6)]
        rows += [(f"/in/f{n}.csv", f"f{n}.csv", k, v) for k, v in enumerate(PREAMBLE + data, 1)]
    return spark.createDataFrame(rows, LINES_SCHEMA).repartition(3)


def _seen(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("on_error", ["quarantine", "stop"])
@pytest.mark.parametrize("keep", [False, True])
def test_headers_too_many_to_broadcast(spark, on_error, keep):
    some = parse_lines(_lines(spark), on_error=on_error, keep=keep, header_is_small=True)
    many = parse_lines(_lines(spark), on_error=on_error, keep=keep, header_is_small=False)
    cell = ("csv_file", "line_no", "pos", "item", "value", "upper", "lower", "unit", "version", "starttime")
    assert sum(_seen(some.good_cells, *cell).values()) > 0
    assert _seen(many.good_cells, *cell) == _seen(some.good_cells, *cell)
    for name in ("good_rows", "rejects", "file_errors"):
        a, b = getattr(some, name), getattr(many, name)
        cols = [c for c in b.columns if not c.startswith("_")]
        assert _seen(a, *cols) == _seen(b, *cols), name


def test_lines_meet_their_headers_unsplit_and_unsorted(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = parse_lines(_lines(spark)).good_rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    join = plan.index("ShuffledHashJoin")
    assert "split(" not in plan[join:]  # neither in the join's condition nor moved as arrays


def test_an_upsert_writes_no_copy_of_what_is_written(spark, workdir, monkeypatch):
    purposes = []
    for module in (tb, stored_tables):
        real = module.staged
        monkeypatch.setattr(module, "staged", lambda df, purpose, real=real: purposes.append(purpose) or real(df, purpose))
    at = datetime(2024, 1, 5)
    df = spark.createDataFrame([("ST", "k1", at, "a.csv", 8, 0, "x"), ("ST", "k1", at, "a.csv", 9, 0, "y"), ("ST", "k2", at, "a.csv", 9, 1, "z")],
                               "station_name string, k string, starttime timestamp_ntz, csv_file string, line_no long, pos long, v string")
    keys = ["station_name", "k", "starttime"]
    rows = stored_tables.staged(tb.with_row_number(df), "cells")
    stored_tables.upsert_table(spark, f"{workdir}/t", rows, keys)
    assert "upsert-rows" not in purposes and "upsert-fresh" not in purposes
    stored_tables.upsert_table(spark, f"{workdir}/t", df.where("v = 'z'").withColumn("v", F.lit("new")), keys)
    got = spark.read.parquet(f"{workdir}/t")
    assert sorted((r.k, r.v) for r in got.collect()) == [("k1", "y"), ("k2", "new")] and "_row" not in got.columns


def test_tasks_that_write_follow_what_they_sort(spark, workdir):
    path = f"{workdir}/same"
    spark.range(100_000).select(F.lit("the same text").alias("a"), F.lit("again").alias("b")).write.parquet(path)
    assert stored_tables.sorted_bytes(spark.read.parquet(path)) >= 100_000 * 32


def test_tasks_that_number_follow_the_rows(spark, monkeypatch):
    asked = []
    real = render.split_groups_sequence
    monkeypatch.setattr(render, "split_groups_sequence", lambda *a, **k: asked.append(k["num_partitions"]) or real(*a, **k))
    monkeypatch.setattr(render, "TASK_ROWS", 10)
    li = spark.range(300).select(F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 3 + 1).alias("l_suppkey"),
                                 F.lit(1).alias("l_linenumber"), *[F.lit(1.5).cast("decimal(12,2)").alias(c) for c in (
                                     "l_quantity", "l_extendedprice", "l_discount", "l_tax")], F.lit("R").alias("l_returnflag"),
                                 F.lit(datetime(2024, 1, 5)).alias("l_shipdate"))
    lines = render.render_lines(li)
    assert asked == [30]
    assert sorted(r.line_no for r in lines.where("csv_file = 'f1.csv'").collect()) == list(range(1, 108))


def test_each_time_is_parsed_once_a_row(spark):
    p = parse_lines(_lines(spark), header_is_small=False)
    for df in (tb.measurement(p.good_cells), tb.run_meta(p.good_rows), p.rejects, tb.spec_dims(p.good_cells)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("gettimestamp(") == 2  # a start and an end
        assert "arrays_zip" not in plan


def test_sightings_of_lines_beyond_a_block_keep_their_order(spark):
    far = tb.BLOCK_LINES
    rows = [("a.csv", 3 * far + 2, 9, 1), ("a.csv", 3 * far + 3, 0, 2), ("a.csv", 2 * far + 7, 12, 3), ("a.csv", far - 1, 5, 4), ("a.csv", 1, 1, 5)]
    cells = spark.createDataFrame([(f, n, p, datetime(2024, 1, day)) for f, n, p, day in rows], "csv_file string, line_no long, pos long, starttime timestamp_ntz")
    cells = cells.select("*", *[F.lit(k).alias(k) for k in (*tb.SPEC_KEY, *tb.LIMIT_KINDS)])
    assert {r.seen_at for r in tb.spec_history_rows(cells).collect()} == {datetime(2024, 1, 2)}
    assert tb.spec_history_rows(cells.where(f"line_no <> {3 * far + 3}")).first().seen_at == datetime(2024, 1, 1)


def test_months_of_any_time(spark):
    times = ["0001-01-01 00:00:00", "0999-12-31 23:59:59", "2024-02-29 10:00:00", "9999-12-31 23:59:59", "+12345-06-01 00:00:00", "-0005-06-01 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "v string").select(F.col("v").cast("timestamp_ntz").alias("t"))
    got = df.select(stored_tables.start_month(F.col("t")).alias("a"), F.coalesce(F.date_format("t", "yyyy-MM"), F.lit("none")).alias("b")).collect()
    assert len(got) == 7 and all(r.a == r.b for r in got), got


def test_sightings_are_compared_as_longs(spark):
    types = dict(tb.limit_events(parse_lines(_lines(spark), header_is_small=True).good_cells).dtypes)
    assert types["_lp"] == types["_block"] == "bigint"


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def test_a_write_leaves_no_shuffle_files(spark, workdir):
    before = _shuffle_files(spark)
    stored_tables.staged(spark.range(1000).repartition(5, "id"), "dealt")
    parts = spark.range(1000).select((F.col("id") % 3).cast("string").alias("station_part"), F.col("id").alias("k"))
    stored_tables._write_partitions(parts, f"{workdir}/t", ["station_part"], ["k"], 100)
    until = time.time() + 20  # executors remove them a moment later
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


@pytest.mark.parametrize("on_error", ["quarantine", "stop"])
def test_an_import_writes_lines_once_and_no_cells(spark, workdir, monkeypatch, on_error):
    purposes = []
    for module in (tb, stored_tables):
        real = module.staged
        monkeypatch.setattr(module, "staged", lambda df, purpose, real=real: purposes.append(purpose) or real(df, purpose))
    lines = _lines(spark)
    files = lines.where("line_no = 1").select("file_path", "csv_file")
    for _ in range(2):  # the second import meets every row of the first
        parsed, _ = ingest_lines(spark, lines, files, workdir, on_error=on_error)
    assert not {"cells", "upsert", "upsert-rows", "upsert-won"} & set(purposes)
    got = read_table(spark, f"{workdir}/measurement", partition_schema(MEASUREMENT_SCHEMA, partition_cols_for(MEASUREMENT_KEY)))
    cells = tb.measurement(parsed.good_cells)
    assert _seen(got, *MEASUREMENT_COLUMNS) == _seen(cells, *MEASUREMENT_COLUMNS) and got.count() > 100
    assert _seen(tb.unpack_lines(tb.measurement_lines(parsed.cell_rows)), *MEASUREMENT_COLUMNS, "line_no", "pos") == \
        _seen(tb.measurement(parsed.good_cells, keep_order=True), *MEASUREMENT_COLUMNS, "line_no", "pos")


@pytest.mark.parametrize("key_rows, slice_bytes", [(100_000, 1 << 40), (100_000, 20_000), (3, 20_000)])
def test_the_last_write_of_a_key_stays(spark, workdir, monkeypatch, key_rows, slice_bytes):
    """Partitions written some at a time, keys with many rows, null keys and places."""
    monkeypatch.setattr(stored_tables, "KEY_ROWS", key_rows)
    monkeypatch.setattr(stored_tables, "SLICE_BYTES", slice_bytes)
    rng, want = random.Random(5), {}
    for batch in range(2):
        rows = [(rng.choice(["A", None, "", "B"]), rng.choice([None, *map(str, range(30))]), rng.choice([None, datetime(2024, 1, 1), datetime(2024, 2, 3)]),
                 rng.choice(["a", "b", None]), line, 0, f"{batch}-{line}") for line in range(200)]
        want |= {r[:3]: r[6] for r in sorted(rows, key=lambda r: (r[3] is not None, r[3] or "", r[4]))}
        df = spark.createDataFrame(rows, "station_name string, k string, starttime timestamp_ntz, csv_file string, line_no long, pos long, v string")
        stored_tables.upsert_table(spark, f"{workdir}/t", df, ["station_name", "k", "starttime"])
    got = spark.read.parquet(f"{workdir}/t").collect()
    assert {(r.station_name, r.k, r.starttime): r.v for r in got} == want and len(got) == len(want)


def test_many_small_files_are_read_by_few_tasks(spark, workdir):
    for i in range(120):
        with open(f"{workdir}/f+{i} %41é.csv", "w") as f:
            f.write(f"{i}\nlast\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    try:
        raw = scan_text_raw(spark, workdir)
        assert raw.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        got = read_lines(spark, workdir)
        assert _seen(got, "file_path", "csv_file", "line_no", "value") == Counter(
            (f"file://{workdir}/f+{i} %41é.csv", f"f+{i} %41é.csv", n, v) for i in range(120) for n, v in ((1, str(i)), (2, "last")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
