"""Input variants and failure semantics (quarantine and stop modes)."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import lines_df
from station_samples import small_file
from stationlake.operators import tables as tb
from stationlake.plans.pipeline import import_log, parse_lines

T0 = "2020-01-01 00:00:00,2020-01-01 00:00:05"


def cells_of(spark, text, on_error="quarantine"):
    p = parse_lines(lines_df(spark, {"f.csv": text}), on_error=on_error)
    return p, sorted((r.line_no, r.item, r.value) for r in p.good_cells.collect())


def log_of(p):
    return import_log(p.header, p.file_errors, with_clock=False).first()


def test_trailing_and_middle_empty(spark):
    _, c = cells_of(spark, small_file(rows=[f"P,S,F,{T0},1,,", f"P,S,F,{T0},,2,"]))
    assert c == [(8, "a", "1"), (9, "a", ""), (9, "b", "2")]


def test_tab_padding_and_quoted_comma(spark):
    _, c = cells_of(spark, small_file(rows=[f"\tP , S,F,{T0}, 1 ,\"x,y\""]))
    assert c == [(8, "a", "1"), (8, "b", "\"x"), (8, "c", "y\"")]


def test_short_limits_stop_mode(spark):
    text = small_file(upper="U,,,,,1,2", rows=[f"P,S,F,{T0},1,2,3", f"P,S,F,{T0},4,5,6"])
    p, c = cells_of(spark, text, on_error="stop")
    # the first two cells of line 8 were written before the failing third one
    assert c == [(8, "a", "1"), (8, "b", "2")]
    assert p.good_rows.count() == 0
    rec = log_of(p)
    assert rec.success == 0 and "line 8, position 7: no upper limit" in rec.message


def test_long_row_quarantine(spark):
    text = small_file(rows=[f"P,S,F,{T0},1,2,3,4", f"P,S,F,{T0},5,6,7"])
    p, c = cells_of(spark, text)
    assert c == [(9, "a", "5"), (9, "b", "6"), (9, "c", "7")]
    rej = p.rejects.collect()
    assert [(r.line_no, r.err_pos) for r in rej] == [(8, 8)]
    assert "more fields than the header" in rej[0].err_msg


def test_bad_and_missing_time(spark):
    text = small_file(rows=[f"P,S,F,{T0},1,2,3", "P,S,F,2020-13-01 00:00:00,2020-01-01 00:00:00,1,2,3",
                            "", f"P,S,F,{T0},7,8,9"])
    p, c = cells_of(spark, text, on_error="stop")
    assert [x[0] for x in c] == [8, 8, 8]
    assert 'line 9: invalid StartTime "2020-13-01 00:00:00"' in log_of(p).message
    p, c = cells_of(spark, text)
    assert sorted({x[0] for x in c}) == [8, 11]
    msgs = sorted(r.err_msg for r in p.rejects.collect())
    assert msgs == ['line 10: invalid StartTime "null"', 'line 9: invalid StartTime "2020-13-01 00:00:00"']


def test_preamble_errors(spark):
    for station, msg in ((",,,", "station line has no fields"),
                         ("ST,Version", "station line: no version after ':'"),
                         ("ST,Version:;", "station line: empty version list")):
        p, c = cells_of(spark, small_file(station=station))
        assert c == []
        rec = log_of(p)
        assert rec.success == 0 and rec.message == "message: " + msg


def test_preamble_only_is_success(spark):
    text = "\n".join(small_file().split("\n")[:5]) + "\n"
    p, c = cells_of(spark, text)
    assert c == [] and log_of(p).success == 1


def test_duplicate_item_later_position_wins(spark):
    text = small_file(header="Product,SerialNumber,Station ID,StartTime,EndTime,A,A,C",
                      rows=[f"P,S,F,{T0},1,2,3"])
    p, c = cells_of(spark, text)
    assert [x[1] for x in c] == ["a", "a", "c"]
    m = tb.upsert_latest(tb.measurement(p.good_cells, keep_order=True),
                         ["serialnumber", "item"])
    assert {(r.item, r.value) for r in m.collect()} == {("a", "2"), ("c", "3")}


def test_limit_change_and_repeat(spark):
    f1 = small_file(rows=[f"P,S,F,2020-01-01 00:00:00,2020-01-01 00:00:00,1,2,3",
                          f"P,S,F,2020-01-02 00:00:00,2020-01-02 00:00:00,1,2,3"])
    f2 = small_file(upper="U,,,,,9,2,3", rows=[f"P,S,F,2020-02-01 00:00:00,2020-02-01 00:00:00,1,2,3"])
    p = parse_lines(lines_df(spark, {"f1.csv": f1, "f2.csv": f2}))
    spec = {r.item: r for r in tb.spec_table(p.good_cells).collect()}
    assert spec["a"].upper == {"1": dt.datetime(2020, 1, 2), "9": dt.datetime(2020, 2, 1)}
    assert spec["b"].upper == {"2": dt.datetime(2020, 2, 1)}


def test_stored_spec_merge(spark):
    f1 = small_file(rows=[f"P,S,F,2020-01-01 00:00:00,2020-01-01 00:00:00,1,2,3"])
    f2 = small_file(upper="U,,,,,9,2,3", rows=[f"P,S,F,2020-02-01 00:00:00,2020-02-01 00:00:00,1,2,3"])
    first = tb.spec_table(parse_lines(lines_df(spark, {"f1.csv": f1})).good_cells)
    merged = tb.spec_table(parse_lines(lines_df(spark, {"f2.csv": f2})).good_cells,
                           tb.explode_spec(first))
    a = merged.where(F.col("item") == "a").first()
    assert a.upper == {"1": dt.datetime(2020, 1, 1), "9": dt.datetime(2020, 2, 1)}
