"""The documented sample file: 53 measurements, 1 run row, 53 spec rows."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import lines_df
from station_samples import GOLDEN_ROW, golden_text
from stationlake.operators import tables as tb
from stationlake.plans.pipeline import parse_lines


def test_golden_measurements(spark):
    p = parse_lines(lines_df(spark, {"sample.csv": golden_text()}))
    m = tb.measurement(p.good_cells, keep_order=True).orderBy("pos").collect()
    assert len(m) == 53
    first, second = m[0], m[1]
    assert (first.item, first.value, first.upper, first.lower, first.unit) == ("dfp", ".121", "0.23", "0.01", "NA")
    assert (second.item, second.value, second.upper, second.lower) == ("dfvdown", ".769", "0.87", "0.65")
    assert first.station_name == "DP2"
    # the version column wins over the file version
    assert first.version == "BZ-02.01-25.41-71.84-01.04_1.2.1"
    assert (first.factorycode, first.floor, first.line_id, first.machine_id) == ("FXGL", "C03-5FT-02B", "1", "AE-22")
    assert first.starttime == dt.datetime(2017, 1, 14, 15, 31, 30)
    assert first.endtime == dt.datetime(2017, 1, 14, 15, 31, 30)
    assert first.csv_file == "sample.csv"
    assert first.product == "D22" and first.serialnumber == "C3970130009HP2NA6"
    # empty common cells are '' (they exist in the row), absent columns are NULL
    assert first.special_build_name == "" and first.phase is None
    assert p.rejects.count() == 0


def test_golden_meta_and_spec(spark):
    p = parse_lines(lines_df(spark, {"sample.csv": golden_text()}))
    assert tb.run_meta(p.good_rows).count() == 1
    assert tb.spec_table(p.good_cells).count() == 53


def test_spec_history_second_row(spark):
    later = GOLDEN_ROW.replace("2017-01-14 15:31:30,2017-01-14 15:31:30",
                               "2017-01-14 16:00:00,2017-01-14 16:00:00")
    p = parse_lines(lines_df(spark, {"sample.csv": golden_text([GOLDEN_ROW, later])}))
    assert p.good_cells.count() == 106
    spec = tb.spec_table(p.good_cells)
    assert spec.count() == 53
    dfp = spec.where(F.col("item") == "dfp").first()
    assert dfp.upper == {"0.23": dt.datetime(2017, 1, 14, 16, 0, 0)}
    assert dfp.factorycode == "FXGL"


def test_file_version_used_without_version_column(spark):
    text = golden_text()
    header_no_version = text.split("\n")[1].replace(",Version,", ",Ver,")
    lines = text.split("\n")
    lines[1] = header_no_version
    p = parse_lines(lines_df(spark, {"nov.csv": "\n".join(lines)}))
    versions = {r.version for r in p.good_rows.select("version").collect()}
    assert versions == {"BZ-02.00-25.41-71.84-01.04_1.2.1"}
    # the renamed column became an item
    assert p.good_cells.where(F.col("item") == "ver").count() == 1
