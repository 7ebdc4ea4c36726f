"""The parse stage as one plan: LINES -> header, rows, cells, errors.

``on_error="quarantine"`` (default): a row with any error is rejected whole,
every other row is kept; the file is logged as failed.
``on_error="stop"``: like the original importer -- everything of a file before
its first error is kept (cells left of a bad cell included), nothing after it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.operators.joins import broadcast_limit, measured_bytes
from stationlake.operators.parse import cells as make_cells
from stationlake.operators.parse import (ITEM_ARRAYS, data_rows, file_header, header_fits_broadcast,
                                         preamble_message)
from stationlake.plans.export import now_text
from stationlake.schemas import DEFAULT_DIALECT, Dialect
from stationlake.session import staged


@dataclass
class Parsed:
    header: DataFrame       # one row per file
    rows: DataFrame         # every data row, with err_pos / err_msg
    cells: DataFrame        # every item cell, with ``bad``
    good_rows: DataFrame    # rows that become RUN_META rows
    good_cells: DataFrame   # cells that become MEASUREMENT rows
    cell_rows: DataFrame    # data rows of which all cells but the ``bad`` ones are good_cells
    file_errors: DataFrame  # file_path, csv_file, err_line, err_pos, err_msg (failed files only)
    rejects: DataFrame      # rejected data rows with reason (quarantine view)
    header_is_small: bool = False  # per-file tables were measured under the broadcast limit


def file_errors(header: DataFrame, rows: DataFrame) -> DataFrame:
    """First error of every failed file: preamble errors count as line 0."""
    pre = (header.where(F.col("preamble_error").isNotNull())
                 .select("file_path", "csv_file", F.lit(0).cast("long").alias("line_no"),
                         F.lit(-1).cast("long").alias("err_pos"),
                         preamble_message(F.col("preamble_error")).alias("err_msg")))
    body = (rows.where(F.col("err_msg").isNotNull() & F.col("preamble_error").isNull())
                .select("file_path", "csv_file", "line_no", "err_pos", "err_msg"))
    first = F.min(F.struct("line_no", "err_pos", "err_msg"))
    return (pre.unionByName(body).groupBy("file_path", "csv_file").agg(first.alias("_e"))
               .select("file_path", "csv_file", F.col("_e.line_no").alias("err_line"),
                       F.col("_e.err_pos").alias("err_pos"), F.col("_e.err_msg").alias("err_msg")))


#: What a row has from its file's header; it is written with the rows only where the headers are too many to broadcast.
_HEADER_ARRAYS = ("header", "upper_limits", "lower_limits", "units", "common_pos", *ITEM_ARRAYS)
#: What a row's outcome follows from and nothing else does: it is not written with the rows.
_PARSED_FROM = ("file_version", "has_version", "n_preamble", "first_item_pos", "first_bad_pos", "_start_txt", "_end_txt",
                "_first_item", "_first_bad")


def parse_lines(lines: DataFrame, dialect: Dialect = DEFAULT_DIALECT, on_error: str = "quarantine",
                keep: bool = False, header_is_small: bool | None = None) -> Parsed:
    """Build every parse output from one ``LINES`` DataFrame.

    Headers, which are measured and joined, are written once to the shared folder. With ``keep`` (imports,
    which use every output) so are the rows, fields and outcome together, so the text is parsed once, whatever number of tables follow. The stop mode
    needs a file's first error before it can keep a cell, so it writes its rows too; a query
    that wants one output of the other mode leaves it off.
    """
    if on_error not in ("quarantine", "stop"):
        raise ValueError("on_error must be 'quarantine' or 'stop'")
    header = staged(file_header(lines, dialect), "header")
    if header_is_small is None:
        header_is_small = header_fits_broadcast(header)
    rows = data_rows(lines, header, dialect, header_is_small=header_is_small)
    rows = rows.withColumn("raw", F.when(F.col("err_msg").isNotNull(), F.col("raw")))
    if keep or on_error == "stop":
        rows = rows.drop(*_PARSED_FROM, *[c for c in rows.columns if c.startswith("pos_")])
        if header_is_small:
            parsed = staged(rows.drop(*_HEADER_ARRAYS), "rows")
            rows = parsed.join(F.broadcast(header.select("file_path", *_HEADER_ARRAYS)), "file_path")
        else:  # the rows have met their headers in a shuffle; a second one would move them all again
            parsed = rows = staged(rows, "rows")
        outcome = parsed.drop("f", *_HEADER_ARRAYS)
    else:
        outcome = rows.drop("f", *_HEADER_ARRAYS)
    cells = make_cells(rows)
    errs = file_errors(header, outcome)
    rejects = (outcome.where(F.col("err_msg").isNotNull())
                      .select("file_path", "csv_file", "line_no", "raw", "err_pos", "err_msg"))
    if on_error == "quarantine":
        good_rows = outcome.where(F.col("err_msg").isNull())
        good_cells = cells.where(F.col("err_msg").isNull())
        cell_rows = rows.where(F.col("err_msg").isNull())
    else:
        # one row per failed file, of which few fail: measured on its own, and met by rows, not by cells
        stops = errs.select("file_path", F.col("err_line").alias("_stop_line"))
        if not header_is_small:
            stops = staged(stops, "stops")
        small = header_is_small or measured_bytes(stops, F.octet_length("file_path") + 64) <= broadcast_limit(lines.sparkSession)
        stops = F.broadcast(stops) if small else stops.hint("shuffle_hash")
        before = F.col("_stop_line").isNull() | (F.col("line_no") < F.col("_stop_line"))
        at = (F.col("line_no") == F.col("_stop_line")) & ~F.col("bad")
        some = rows.join(stops, "file_path", "left")
        good_cells = make_cells(some).where(before | at).drop("_stop_line")
        cell_rows = some.where(F.col("_stop_line").isNull() | (F.col("line_no") <= F.col("_stop_line"))).drop("_stop_line")
        good_rows = (outcome.join(stops, "file_path", "left")
                            .where(F.col("err_msg").isNull() & before).drop("_stop_line"))
    return Parsed(header, rows, cells, good_rows, good_cells, cell_rows, errs, rejects, header_is_small)


def import_log(files: DataFrame, errors: DataFrame, with_clock: bool = True) -> DataFrame:
    """One outcome row per file: (file_name, file_path, processed_at, message, success).

    ``files`` needs file_path and csv_file (or file_name); the error table has
    at most one row per file, with messages of any length: the join is left to AQE,
    which sees their size.
    """
    if "file_name" not in files.columns:
        files = files.withColumnRenamed("csv_file", "file_name")
    f = files.select("file_path", "file_name").dropDuplicates(["file_path"])
    e = errors.select("file_path", "err_msg")
    log = f.join(e, "file_path", "left").select(
        "file_name", "file_path",
        now_text("yyyy-MM-dd HH-mm-ss").alias("processed_at"),
        F.concat(F.lit("message: "), F.coalesce(F.col("err_msg"), F.lit(""))).alias("message"),
        F.when(F.col("err_msg").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("int").alias("success"),
    )
    return log if with_clock else log.drop("processed_at")


def import_summary(log: DataFrame) -> DataFrame:
    """total / success / failure counts of an import log."""
    return log.agg(F.count(F.lit(1)).alias("total"),
                   F.coalesce(F.sum("success"), F.lit(0)).cast("long").alias("success"),
                   (F.count(F.lit(1)) - F.coalesce(F.sum("success"), F.lit(0))).cast("long")
                   .alias("failure"))
