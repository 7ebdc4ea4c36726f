"""Latest rows by position, stored limit maps, the ledger, the catalog and what an import leaves behind."""

import datetime as dt
import os
import random

import pytest
from helpers import write_text
from pyspark.sql import functions as F
from station_samples import small_file

from stationlake.operators import tables as tb
from stationlake.plans.ingest import ingest, ledger_path, table_paths
from stationlake.session import checkpoint_root, staging, staging_dir
from stationlake.sources import tables as stored_tables

PLACED = "k1 string, k2 string, v string, csv_file string, line_no long, pos long"


def _latest(rows, n_keys=2):
    best = {}
    for r in rows:
        if r[:n_keys] not in best or (r[3], r[4], r[5]) > best[r[:n_keys]][3:]:
            best[r[:n_keys]] = r
    return sorted(best.values(), key=str)


def _rows(seed, keys, n=400):
    rng = random.Random(seed)
    places = [(f, line, pos) for f in ("b.csv", "a.csv", "é.csv", "c") for line in range(8, 40) for pos in (-1, 6, 7)]
    rng.shuffle(places)
    return [(rng.choice([None, "", f"k{rng.randrange(keys)}"]), rng.choice([None, "x"]), f"v{i}", *p) for i, p in enumerate(places[:n])]


@pytest.mark.parametrize("keys", [1, 5, 3000])  # few rows win, many do
def test_latest_rows(spark, keys):
    rows = _rows(keys, keys)
    got = tb.latest_rows(spark.createDataFrame(rows, PLACED), ["k1", "k2"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == _latest(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan


def test_latest_rows_without_a_broadcast(spark):
    rows = _rows(9, 30)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = tb.latest_rows(spark.createDataFrame(rows, PLACED), ["k1", "k2"])
        assert sorted((tuple(r) for r in got.collect()), key=str) == _latest(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_of_rows_with_one_place_is_one(spark):
    rows = [("a", "x", f"v{i}", "f.csv", 8, 6) for i in range(50)] + [("b", None, "w", None, 8, 6)]
    got = tb.latest_rows(spark.createDataFrame(rows, PLACED), ["k1", "k2"]).collect()
    assert sorted(r.k1 for r in got) == ["a", "b"]
    assert tb.latest_rows(spark.createDataFrame([], PLACED), ["k1"]).count() == 0


def test_position_only_aggregate_is_a_hash_aggregate(spark, monkeypatch):
    plans = []
    real = tb.staged
    monkeypatch.setattr(tb, "staged", lambda df, purpose: plans.append((purpose, df._jdf.queryExecution().executedPlan().toString())) or real(df, purpose))
    tb.latest_rows(spark.createDataFrame(_rows(2, 4), PLACED), ["k1", "k2"])
    plan = dict(plans)["upsert-won"]
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan


def _spec(spark, rows):
    schema = "product string, station_id string, factorycode string, floor string, line_id string, machine_id string, station_name string, " \
             "version string, item string, upper map<string,timestamp_ntz>, lower map<string,timestamp_ntz>, unit map<string,timestamp_ntz>"
    return spark.createDataFrame([(p, s, "f", "1", "", "", n, "v", i, u, low, unit) for p, s, n, i, u, low, unit in rows], schema)


def test_stored_maps_are_joined(spark):
    d = [dt.datetime(2020, 1, i) for i in range(1, 5)]
    old = _spec(spark, [("p", "s", None, "a", {"1": d[0], "2": d[1]}, {}, {"u": d[3]}), ("p", "s", "n", "only old", {"9": d[0]}, {"0": d[0]}, {})])
    new = _spec(spark, [("p", "s", None, "a", {"2": d[0], "3": d[2]}, {"0": d[1]}, None), ("p", None, "n", "only new", {"7": d[2]}, {}, {})])
    got = {r.item: r for r in tb.merge_spec(old, new).collect()}
    assert set(got) == {"a", "only old", "only new"}
    assert got["a"].upper == {"1": d[0], "2": d[0], "3": d[2]} and got["a"].lower == {"0": d[1]} and got["a"].unit == {"u": d[3]}
    assert got["only old"].upper == {"9": d[0]} and got["only new"].upper == {"7": d[2]} and got["only new"].station_id is None
    assert got["a"].station_name is None and got["a"].factorycode == "f"


ROW = "P1,S{i},F_1,2020-0{i}-01 00:00:00,2020-0{i}-01 00:00:05,1,2,3"


def _file(path, i):
    return write_text(path, small_file(rows=[ROW.format(i=i)]))


def test_a_file_whose_move_failed_is_not_imported_again(spark, workdir):
    inbox, out = os.path.join(workdir, "in"), os.path.join(workdir, "out")
    os.makedirs(inbox)
    _file(os.path.join(inbox, "a.csv"), 1)
    write_text(os.path.join(inbox, "bad.csv"), small_file(station=",,,"))
    blocked = os.path.join(workdir, "no folder")
    write_text(blocked, "a file where the archive should be")
    r = ingest(spark, inbox, out, archive_root=blocked)
    assert (r.total, r.success) == (2, 1) and sorted(os.listdir(inbox)) == ["a.csv", "bad.csv"]
    _file(os.path.join(inbox, "b.csv"), 2)
    r = ingest(spark, inbox, out)
    assert (r.total, r.success) == (1, 1) and [x.file_name for x in r.log.collect()] == ["b.csv"]
    assert spark.read.parquet(table_paths(out)["run_meta"]).count() == 2
    r = ingest(spark, inbox, out)
    assert (r.total, r.success, r.failure) == (0, 0, 0)
    # a file that is there anew under an old name is imported
    path = _file(os.path.join(inbox, "a.csv"), 3)
    os.utime(path, (1_700_000_000, 1_700_000_000))
    r = ingest(spark, inbox, out)
    assert [x.file_name for x in r.log.collect()] == ["a.csv"]
    assert spark.read.parquet(ledger_path(out)).count() == 4


def test_tables_of_the_catalog(spark, workdir):
    name = "stationlake_import"
    out = os.path.join(workdir, "db's tables")
    for i in (1, 2):
        inbox = os.path.join(workdir, f"in{i}")
        os.makedirs(inbox)
        station = "ST'\\9,Version: v1" if i == 2 else "ST9,Version: v1"
        write_text(os.path.join(inbox, f"f{i}.csv"), small_file(station=station, rows=[ROW.format(i=i)]))
        ingest(spark, inbox, out, database=name)
        assert spark.table(f"{name}.measurement").count() == 3 * i
        assert spark.table(f"{name}.run_meta").count() == i and spark.table(f"{name}.spec").count() == 3 * i
        assert spark.table(f"{name}.import_log").count() == i
    found = spark.sql(f"SELECT DISTINCT station_name FROM {name}.run_meta WHERE start_month = '2020-02'").collect()
    assert [r.station_name for r in found] == ["ST'\\9"]
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_an_import_leaves_nothing_staged(spark, workdir):
    root = checkpoint_root(spark).removeprefix("file:") + "/staging"
    os.makedirs(root, exist_ok=True)
    inbox = os.path.join(workdir, "in")
    os.makedirs(inbox)
    _file(os.path.join(inbox, "a.csv"), 1)
    before = set(os.listdir(root))
    ingest(spark, inbox, os.path.join(workdir, "out"))
    assert set(os.listdir(root)) == before
    with pytest.raises(ZeroDivisionError), staging(spark):
        spark.range(3).write.parquet(staging_dir(spark, "given-up"))
        assert set(os.listdir(root)) != before
        1 / 0
    assert set(os.listdir(root)) == before


def test_tasks_that_write_follow_the_bytes(spark, workdir, monkeypatch):
    df = spark.range(2000).select(F.lit("p").alias("station_part"), F.col("id").cast("string").alias("k"))
    seen = []
    for size, tasks in ((10, 8), (100, 50)):
        monkeypatch.setattr(stored_tables, "TASK_BYTES", 2)
        path = f"{workdir}/t{size}"
        stored_tables._write_partitions(df, path, ["station_part"], ["k"], size)
        seen.append((len(spark.read.parquet(path).inputFiles()), tasks))
    assert all(n >= tasks - 1 for n, tasks in seen), seen
