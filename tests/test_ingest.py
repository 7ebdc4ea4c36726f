"""Batch import into stored tables, archive, re-import; streaming import."""

import datetime as dt
import os
import zipfile

from pyspark.sql import functions as F

from helpers import write_text
from station_samples import small_file
from stationlake.plans.ingest import ingest, table_paths
from stationlake.streaming.stream_ingest import import_batch, run_stream_ingest


def _inbox(workdir, name, files):
    d = os.path.join(workdir, name)
    os.makedirs(d)
    for fn, text in files.items():
        write_text(os.path.join(d, fn), text)
    return d


def test_ingest_twice_with_limit_change(spark, workdir):
    out = os.path.join(workdir, "tables")
    bad = small_file(station=",,,")
    inbox1 = _inbox(workdir, "in1", {
        "a.csv": small_file(rows=["P1,S1,F_1_L_M,2020-01-01 00:00:00,2020-01-01 00:00:05,10,20,30"]),
        "bad.csv": bad})
    r = ingest(spark, inbox1, out, archive_root=os.path.join(workdir, "backup"), model="rd",
               log_text_root=os.path.join(workdir, "imported"))
    assert (r.total, r.success, r.failure) == (2, 1, 1)
    text = spark.read.text(os.path.join(workdir, "imported", "*", "*")).collect()
    assert sorted(t.value.split(",")[0] for t in text) == ["((a.csv", "((bad.csv"]
    assert sorted(t.value[-4:] for t in text) == ["),0)", "),1)"] and all(",message: " in t.value for t in text)
    assert sorted(os.listdir(inbox1)) == []
    assert os.listdir(os.path.join(workdir, "backup", "LX", "PDCA", "RD")) == ["a.csv"]
    assert os.listdir(os.path.join(workdir, "backup", "LX", "PDCA", "RD_FAILED")) == ["bad.csv"]

    inbox2 = _inbox(workdir, "in2", {
        "b.csv": small_file(upper="U,,,,,11,2,3",
                            rows=["P1,S1,F_1_L_M,2020-01-01 00:00:00,2020-01-01 00:00:05,99,20,30"])})
    ingest(spark, inbox2, out)
    paths = table_paths(out)
    m = spark.read.parquet(paths["measurement"])
    # same key (same unit, time, item): the later import replaced the value
    assert {(r.item, r.value, r.csv_file) for r in m.collect()} == {
        ("a", "99", "b.csv"), ("b", "20", "b.csv"), ("c", "30", "b.csv")}
    assert spark.read.parquet(paths["run_meta"]).count() == 1
    spec = spark.read.parquet(paths["spec"]).where(F.col("item") == "a").first()
    assert spec.upper == {"1": dt.datetime(2020, 1, 1), "11": dt.datetime(2020, 1, 1)}
    assert (spec.factorycode, spec.floor, spec.line_id, spec.machine_id) == ("F", "1", "L", "M")
    log = spark.read.parquet(paths["import_log"]).collect()
    assert sorted((r.file_name, r.success) for r in log) == [("a.csv", 1), ("b.csv", 1), ("bad.csv", 0)]


def test_stream_ingest(spark, workdir):
    inbox = _inbox(workdir, "stream-in", {
        "s1.csv": small_file(rows=["P1,S1,F_1,2020-01-01 00:00:00,2020-01-01 00:00:05,1,2,3"]),
        "s2.csv": small_file(rows=["P2,S2,F_2,2020-01-02 00:00:00,2020-01-02 00:00:05,4,5,6",
                                   "P3,S3,F_3,2020-01-03 00:00:00,2020-01-03 00:00:05,7,8,"])})
    out = os.path.join(workdir, "stream-out")
    ckpt = os.path.join(workdir, "stream-ckpt")
    paths = run_stream_ingest(spark, inbox, out, checkpoint=ckpt)
    m = spark.read.parquet(paths["measurement"])
    assert m.count() == 3 + 3 + 2
    assert spark.read.parquet(paths["run_meta"]).count() == 3
    # a second run sees no new files: tables unchanged
    run_stream_ingest(spark, inbox, out, checkpoint=ckpt)
    assert spark.read.parquet(paths["measurement"]).count() == 8


ROW = "P1,S{i},F_1,2020-01-0{i} 00:00:00,2020-01-0{i} 00:00:05,1,2,3"


def test_blank_station_keeps_earlier_imports(spark, workdir):
    out = os.path.join(workdir, "tables")
    for i in (1, 2):
        inbox = _inbox(workdir, f"in{i}", {f"f{i}.csv": small_file(station=",Version: v1", rows=[ROW.format(i=i)])})
        ingest(spark, inbox, out)
    paths = table_paths(out)
    assert spark.read.parquet(paths["run_meta"]).count() == 2
    m = spark.read.parquet(paths["measurement"])
    assert m.count() == 6 and {r.station_name for r in m.collect()} == {""}
    spec = spark.read.parquet(paths["spec"])
    assert spec.count() == 3 and {len(r.upper) for r in spec.collect()} == {1}


def test_broken_file_is_logged_and_the_others_imported(spark, workdir):
    inbox = _inbox(workdir, "in", {"a b.csv": small_file(rows=[ROW.format(i=1)])})
    with open(os.path.join(inbox, "x %1.csv.gz"), "wb") as f:
        f.write(b"not a gzip stream")
    open(os.path.join(inbox, "empty.csv"), "w").close()
    out, backup = os.path.join(workdir, "tables"), os.path.join(workdir, "backup")
    r = ingest(spark, inbox, out, archive_root=backup)
    assert (r.total, r.success, r.failure) == (3, 2, 1)
    log = {x.file_name: x for x in spark.read.parquet(table_paths(out)["import_log"]).collect()}
    assert log["x %1.csv.gz"].success == 0 and log["x %1.csv.gz"].message.startswith("message: unreadable file")
    assert log["a b.csv"].success == 1
    assert {x.csv_file for x in spark.read.parquet(table_paths(out)["measurement"]).collect()} == {"a b.csv"}
    assert sorted(os.listdir(os.path.join(backup, "LX", "PDCA", "RD"))) == ["a b.csv", "empty.csv"]
    assert os.listdir(os.path.join(backup, "LX", "PDCA", "RD_FAILED")) == ["x %1.csv.gz"] and os.listdir(inbox) == []
    moved = spark.read.parquet(os.path.join(out, "archived")).collect()
    assert len(moved) == 3 and all(m.moved for m in moved)


def test_equal_names_are_both_archived(spark, workdir):
    inbox = os.path.join(workdir, "in")
    for i, sub in ((1, "day 1"), (2, "day2")):
        os.makedirs(os.path.join(inbox, sub))
        write_text(os.path.join(inbox, sub, "a.csv"), small_file(rows=[ROW.format(i=i)]))
    out, backup = os.path.join(workdir, "tables"), os.path.join(workdir, "backup")
    r = ingest(spark, inbox, out, archive_root=backup, recursive=True)
    root = os.path.join(backup, "LX", "PDCA", "RD")
    assert r.total == 2 and all(os.listdir(os.path.join(root, d)) == ["a.csv"] for d in ("day 1", "day2"))
    # the same name once more: nothing is overwritten
    write_text(os.path.join(inbox, "day2", "a.csv"), small_file(rows=[ROW.format(i=3)]))
    ingest(spark, inbox, out, archive_root=backup, recursive=True)
    assert sorted(os.listdir(os.path.join(root, "day2"))) == ["a.csv", "a.csv.1"]


def test_replayed_batch_leaves_the_same_tables(spark, workdir):
    inbox = _inbox(workdir, "in", {"a.csv": small_file(rows=[ROW.format(i=1), "P1,S9,F_1,bad time,2020-01-01 00:00:05,1,2,3"]),
                                   "b.csv": small_file(rows=[ROW.format(i=2)])})
    with zipfile.ZipFile(os.path.join(inbox, "z.zip"), "w") as z:
        z.writestr("first.csv", small_file(rows=[ROW.format(i=3)]))
    paths = [os.path.join(inbox, n) for n in os.listdir(inbox)]
    out, seen = os.path.join(workdir, "out"), []
    for _ in range(2):
        import_batch(spark, paths, out, "stream-x-0", inbox)
        seen.append({k: spark.read.parquet(p).count() for k, p in table_paths(out).items()})
    assert seen[0] == seen[1] and seen[0]["import_log"] == 3 and seen[0]["rejects"] == 1


def test_stream_takes_archives(spark, workdir):
    inbox = _inbox(workdir, "in", {"a b.csv": small_file(rows=[ROW.format(i=1)])})
    with zipfile.ZipFile(os.path.join(inbox, "z.zip"), "w") as z:
        z.writestr("first.csv", small_file(rows=[ROW.format(i=2)]))
    out = os.path.join(workdir, "out")
    paths = run_stream_ingest(spark, inbox, out)
    assert spark.read.parquet(paths["measurement"]).count() == 6
    assert {r.file_name for r in spark.read.parquet(paths["import_log"]).collect()} == {"a b.csv", "z.zip"}
    run_stream_ingest(spark, inbox, out)  # the same folder of the stream's own: nothing is taken twice
    assert spark.read.parquet(paths["import_log"]).count() == 2


def _logged(spark, out):
    rows = spark.read.parquet(table_paths(out)["import_log"]).collect()
    return sorted((r["file_name"], r["success"]) for r in rows)


def test_stream_and_batch_log_the_same_files(spark, workdir):
    """Files without bytes, alone in a batch too, and names that a reader would take for patterns."""
    files = {"a.csv": small_file(rows=[ROW.format(i=1)]), "b[1]{x}*.csv": small_file(rows=[ROW.format(i=2)]), "empty.csv": "", "none.gz": ""}
    inbox = _inbox(workdir, "in", files)
    batch, stream = os.path.join(workdir, "batch"), os.path.join(workdir, "stream")
    ingest(spark, inbox, batch)
    run_stream_ingest(spark, inbox, stream)
    assert _logged(spark, stream) == _logged(spark, batch) and len(_logged(spark, batch)) == 4
    assert spark.read.parquet(table_paths(stream)["measurement"]).count() == 6
    write_text(os.path.join(inbox, "later.csv"), "")
    run_stream_ingest(spark, inbox, stream)
    ingest(spark, inbox, batch)
    assert _logged(spark, stream) == _logged(spark, batch) and len(_logged(spark, batch)) == 5


def test_committed_batch_is_archived_when_run_again(spark, workdir):
    """The driver is lost between two moves: the batch comes again, though one of its files is gone."""
    inbox = _inbox(workdir, "in", {f"{i}.csv": small_file(rows=[ROW.format(i=i)]) for i in (1, 2)})
    paths = [os.path.join(inbox, n) for n in os.listdir(inbox)]
    out, backup = os.path.join(workdir, "out"), os.path.join(workdir, "backup")
    import_batch(spark, paths, out, "stream-x-0", inbox)
    os.makedirs(backup)
    os.rename(os.path.join(inbox, "1.csv"), os.path.join(backup, "1.csv"))
    log = import_batch(spark, paths, out, "stream-x-0", inbox, archive_to=backup)
    assert log.count() == 2 and os.listdir(inbox) == [] and sorted(n for n in os.listdir(backup) if not n.startswith(".")) == ["1.csv", "2.csv"]
    assert spark.read.parquet(table_paths(out)["measurement"]).count() == 6


def test_hot_partition_is_cut(spark, workdir):
    rows = [f"P1,S{i},F_1,2020-01-01 00:00:00,2020-01-01 00:00:05,{i},2,3" for i in range(4000)]
    inbox = _inbox(workdir, "in", {"a.csv": small_file(rows=rows)})
    out = os.path.join(workdir, "out")
    ingest(spark, inbox, out)
    files = spark.read.parquet(table_paths(out)["measurement"]).inputFiles()
    assert len({f.rsplit("/", 1)[0] for f in files}) == 1 and len(files) > 1


def test_wide_header(spark, workdir):
    from stationlake.operators.tables import _line_pos

    df = spark.sql("select 9000000000L line_no, 5000000L pos union all select 9000000001L, 0L")
    a, b = [r[0] for r in df.select(_line_pos()).collect()]
    assert a < b and a == 9000000000 * (1 << 31) + 5000000
