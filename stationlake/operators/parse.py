"""From ``LINES`` to header, data rows, cells and errors.

``file_header``  one row per file: station, version, header names, limit lines,
                 positions of the common columns (the preamble, lines 1-7).
``data_rows``    one row per data line (line 8 on) with its fields and header.
``cells``        the wide-to-long unpivot: one row per (data line, item column),
                 limits and unit attached by column position.

All of it is Column expressions over arrays (``split``, ``get``,
``posexplode``, ``array_position``): code-generated, no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.text import (file_version_parts, parse_station_time,
                                        split_fields, station_id_parts)
from stationlake.operators.joins import broadcast_limit, measured_bytes
from stationlake.schemas import DEFAULT_DIALECT, Dialect, STATION_ID_PARTS

#: What a file says of its item columns alone, and the array it is taken from.
_OF_ITEMS = {"item_names": "header", "item_upper": "upper_limits", "item_lower": "lower_limits", "item_units": "units"}
ITEM_ARRAYS = ("item_at", *_OF_ITEMS)


def _pos_col(out: str) -> str:
    return f"pos_{out}"


def file_header(lines: DataFrame, dialect: Dialect = DEFAULT_DIALECT) -> DataFrame:
    """One row per file from its preamble lines (role decided by line number).

    Columns: file_path, csv_file, station_name, file_version, has_version,
    header, display, priority, upper_limits, lower_limits, units,
    pos_<common column> (0-based, -1 when absent), common_pos, n_preamble,
    preamble_error, header_bytes; of the item columns alone: item_at (their
    positions), item_names, item_upper, item_lower, item_units.
    """
    d = dialect
    pre = (lines.where(F.col("line_no") <= F.lit(d.preamble_lines))
                .select("file_path", "csv_file", "line_no",
                        split_fields("value", d.separator).alias("f"),
                        F.octet_length("value").alias("_b")))

    def role(k: int) -> Column:
        # exactly one line has number k, so max() just picks it (arrays are orderable)
        return F.max(F.when(F.col("line_no") == k, F.col("f")))

    agg = pre.groupBy("file_path", "csv_file").agg(
        role(d.station_line).alias("l_station"),
        role(d.header_line).alias("l_header"),
        role(d.display_line).alias("display"),
        role(d.priority_line).alias("priority"),
        role(d.upper_line).alias("upper_limits"),
        role(d.lower_line).alias("lower_limits"),
        role(d.unit_line).alias("units"),
        F.count(F.lit(1)).alias("n_preamble"),
        F.sum("_b").alias("header_bytes"),
    )
    header = F.transform(F.col("l_header"), lambda x: F.lower(x))
    version_field = F.get(F.col("l_station"), 1)
    file_version, version_err = file_version_parts(version_field)
    station_err = F.when(F.col("l_station").isNotNull() & (F.size("l_station") == 0), F.lit("E1"))
    positions = [(out, (F.array_position(F.col("header"), name) - 1).cast("long"))
                 for name, out in d.common_columns]
    out = agg.select(
        "file_path", "csv_file",
        F.get(F.col("l_station"), 0).alias("station_name"),
        file_version.alias("file_version"),
        header.alias("header"),
        "display", "priority", "upper_limits", "lower_limits", "units",
        "n_preamble", "header_bytes",
        F.coalesce(station_err, version_err).alias("preamble_error"),
    )
    out = out.select("*", *[p.alias(_pos_col(o)) for o, p in positions])
    pos_cols = [F.col(_pos_col(o)) for o, _ in positions]
    vpos = F.col(_pos_col(d.version_output))
    out = out.select(
        "*",
        (vpos >= 0).alias("has_version"),
        F.filter(F.array(*pos_cols), lambda p: p >= 0).alias("common_pos"),
    )
    # Per-file constants, computed once per file instead of once per data row:
    # the first item position, and the first item position that lacks a header
    # name, an upper/lower limit or a unit (every position from ``m`` on).
    cp = F.col("common_pos")
    m = F.least(*[F.coalesce(F.size(c), F.lit(0)).cast("long")
                  for c in ("header", "upper_limits", "lower_limits", "units")])

    def first_free(start: Column) -> Column:
        cand = F.sequence(start, start + F.size(cp).cast("long"))
        return F.array_min(F.filter(cand, lambda p: ~F.array_contains(cp, p)))

    out = out.select("*", first_free(F.lit(0).cast("long")).alias("first_item_pos"),
                     first_free(m).alias("first_bad_pos"),
                     F.filter(F.sequence(F.lit(0).cast("long"), F.greatest(m, F.lit(1)) - 1),
                              lambda p: (p < m) & ~F.array_contains(cp, p)).alias("item_at"))

    def at_items(c: str) -> Column:
        return F.transform("item_at", lambda p: F.get(F.col(c), p.cast("int")))

    return out.select("*", *[at_items(c).alias(k) for k, c in _OF_ITEMS.items()])


_PREAMBLE_MESSAGES = {
    "E1": "station line has no fields",
    "E2": "station line: no version after ':'",
    "E3": "station line: empty version list",
}


def preamble_message(code: Column) -> Column:
    expr = F.lit(None).cast("string")
    for k, v in _PREAMBLE_MESSAGES.items():
        expr = F.when(code == k, F.lit(v)).otherwise(expr)
    return expr


def header_fits_broadcast(header: DataFrame) -> bool:
    """Measure the per-file header table (one small aggregate) against the broadcast limit."""
    est = measured_bytes(header, F.col("header_bytes") * 3 + 256)
    return est <= broadcast_limit(header.sparkSession)


def data_rows(lines: DataFrame, header: DataFrame, dialect: Dialect = DEFAULT_DIALECT,
              header_is_small: bool | None = None) -> DataFrame:
    """Data lines (line 8 on) joined with their file's header.

    The header table has one row per file; it is broadcast only after measuring
    it (``header_fits_broadcast``), otherwise the join is a shuffle join on
    ``file_path`` where AQE splits skewed files. Then a task keeps its files' headers and
    no line is sorted; lines are moved as text and split behind that join.
    """
    d = dialect
    rows = (lines.where(F.col("line_no") >= F.lit(d.first_data_line))
                 .select("file_path", "line_no", F.col("value").alias("raw")))
    hdr = header.drop("display", "priority")
    if header_is_small is None:
        header_is_small = header_fits_broadcast(header)
    small = hdr.drop("header_bytes")
    fields = split_fields("raw", d.separator)
    if header_is_small:
        return _with_row_fields(rows.withColumn("f", fields).join(F.broadcast(small), "file_path"), d)
    joined = rows.join(small.hint("shuffle_hash"), "file_path")
    # generated, not projected: a filter on what follows from the fields would else be pushed into the
    # join with the split in every place that names them
    return _with_row_fields(joined.select("*", F.explode(F.array(fields)).alias("f")), d)


def _with_row_fields(rows: DataFrame, d: Dialect) -> DataFrame:
    f = F.col("f")

    def common(out: str) -> Column:
        return F.get(f, F.col(_pos_col(out)).cast("int"))

    version = F.when(F.col("has_version"), common(d.version_output)).otherwise(
        F.coalesce(F.col("file_version"), F.lit("")))
    start_txt, end_txt = common("starttime"), common("endtime")
    parts = station_id_parts(common("station_id"))
    cols = {out: common(out) for _, out in d.common_columns
            if out not in (d.version_output, "starttime", "endtime")}
    n_fields = F.size(f).cast("long")
    first_item = F.when(F.col("first_item_pos") < n_fields, F.col("first_item_pos"))
    first_bad = F.when(F.col("first_bad_pos") < n_fields, F.col("first_bad_pos"))
    # generated, not projected, so that each time is parsed once: a row's outcome names the times in many places,
    # and so would every filter on it
    times = F.struct(parse_station_time(start_txt).alias("starttime"), parse_station_time(end_txt).alias("endtime"))
    return rows.select("*", F.explode(F.array(times)).alias("_t")).select(
        *rows.columns,
        *[c.alias(k) for k, c in cols.items()],
        *[p.alias(n) for p, n in zip(parts, STATION_ID_PARTS)],
        version.alias("version"),
        start_txt.alias("_start_txt"), end_txt.alias("_end_txt"),
        F.col("_t.starttime").alias("starttime"), F.col("_t.endtime").alias("endtime"),
        first_item.alias("_first_item"),
        first_bad.alias("_first_bad"),
    ).transform(_row_errors)


def _bad_cell_message(line: Column, pos: Column) -> Column:
    p = pos.cast("int")
    def n(c: str) -> Column:
        return F.coalesce(F.size(c), F.lit(0))

    what = (F.when(p >= n("header"), F.lit("more fields than the header"))
             .when(p >= n("upper_limits"), F.lit("no upper limit"))
             .when(p >= n("lower_limits"), F.lit("no lower limit"))
             .otherwise(F.lit("no measurement unit")))
    return F.format_string("line %d, position %d: %s", line, p, what)


def _time_message(line: Column) -> Column:
    which = F.when(F.col("starttime").isNull(), F.lit("StartTime")).otherwise(F.lit("EndTime"))
    txt = F.when(F.col("starttime").isNull(), F.col("_start_txt")).otherwise(F.col("_end_txt"))
    return F.format_string('line %d: invalid %s "%s"', line, which,
                           F.coalesce(txt, F.lit("null")))


def _row_errors(rows: DataFrame) -> DataFrame:
    """Per data row: the first failing (position, message), or NULLs.

    A cell is written with its row's times, so bad times fail the row at its
    first item cell (nothing of the row survives: position -1); a missing
    header name or limit fails at that cell (cells left of it survive).
    """
    line = F.col("line_no")
    time_bad = F.col("starttime").isNull() | F.col("endtime").isNull()
    fb, fi = F.col("_first_bad"), F.col("_first_item")
    pre = F.col("preamble_error")
    err_pos = (F.when(pre.isNotNull(), F.lit(-1))
                .when(fb.isNotNull() & (fb == fi), fb)
                .when(time_bad, F.lit(-1))
                .when(fb.isNotNull(), fb)).cast("long")
    err_msg = (F.when(pre.isNotNull(), preamble_message(pre))
                .when(fb.isNotNull() & (fb == fi), _bad_cell_message(line, fb))
                .when(time_bad, _time_message(line))
                .when(fb.isNotNull(), _bad_cell_message(line, fb)))
    return rows.select("*", err_pos.alias("err_pos"), err_msg.alias("err_msg"))


_CELL_PARTS = ("f", "header", "upper_limits", "lower_limits", "units")


def cells(rows: DataFrame) -> DataFrame:
    """Wide -> long: one row per item column of every data row.

    The row's fields are exploded once, and a cell takes its header, limits and unit
    by its position from the file's arrays, which are not copied per cell.  Empty cells between values stay as ''; trailing empty
    cells are already gone (Java split).  Cells at or right of the row's first
    error carry ``bad = true``.
    """
    keep = [c for c in rows.columns if c not in _CELL_PARTS
            and c not in ("raw", "display", "priority", *ITEM_ARRAYS)]
    exploded = rows.select(*keep, *_CELL_PARTS[1:], F.posexplode("f").alias("_at", "value"))
    pos = F.col("_at").cast("long")
    item_cell = ~F.array_contains(F.col("common_pos"), pos)
    bad = F.col("err_msg").isNotNull() & ((F.col("err_pos") < 0) | (pos >= F.col("err_pos")))
    return (exploded.where(item_cell)
                    .select(*keep, pos.alias("pos"),
                            "value",
                            F.get("header", "_at").alias("item"),
                            F.get("upper_limits", "_at").alias("upper"),
                            F.get("lower_limits", "_at").alias("lower"),
                            F.get("units", "_at").alias("unit"),
                            bad.alias("bad")))
