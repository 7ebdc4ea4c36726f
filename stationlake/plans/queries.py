"""Registered queries: one per operator of the inventory, over the given tables.

Every query reads the provided Parquet tables (``lineitem`` rendered into
station files, ``events``, ``documents``) in full; the matching DuckDB SQL
lives in ``stationlake.fixtures.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.fixtures.files import (CODECS, write_mixed_files, write_named_files, write_packed_files,
                                        write_text_files, write_zip_files)
from stationlake.fixtures.render import damaged, load_lineitem, render_lines
from stationlake.functions.text import split_fields
from stationlake.operators import tables as tb
from stationlake.plans.export import archive_dir, export_station, preview, row_text, write_text
from stationlake.plans.ingest import ingest_lines, table_paths
from stationlake.plans.pipeline import Parsed, import_log, import_summary, parse_lines
from stationlake.schemas import (COMMON_COLUMNS, DISPLAY_LINE, FIRST_DATA_LINE, HEADER_LINE, LINES_SCHEMA, LOWER_LINE, MEASUREMENT_COLUMNS,
                                 MEASUREMENT_KEY, MEASUREMENT_SCHEMA, PRIORITY_LINE, RUN_META_COLUMNS, RUN_META_KEY, RUN_META_SCHEMA,
                                 SPEC_KEY, SPEC_SCHEMA, STATION_LINE, UNIT_LINE, UPPER_LINE, Dialect)
from stationlake.session import shuffles_freed, staging, staging_dir
from stationlake.sources.files import inbox_listing, read_inbox, read_lines
from stationlake.sources.tables import partition_cols_for, partition_schema, read_table

# Fixed query parameters (part of the query definition, shared with the oracle SQL).
EVENT_TYPE = "click"
EVENT_FROM = "2024-01-05 00:00:00"
EVENT_TO = "2024-01-12 12:00:00"
EXPORT_STATION = "ST3"
EXPORT_FROM = "1995-06-01 00:00:00"
EXPORT_TO = "1996-12-31 00:00:00"
ARCHIVE_ROOT = "/backup"
ARCHIVE_PHASE = "lx"
ARCHIVE_DATATYPE = "pdca"


#: What a session has rendered: (application, folder of the tables, bad) -> folder of the lines.
_RENDERED: dict[tuple[str, str, bool], str] = {}


def lines_of(spark: SparkSession, sf_dir: str, bad: bool = False) -> DataFrame:
    """The rendered files, written once in a session: every query starts from lines, as an import does."""
    key = (spark.sparkContext.applicationId, sf_dir, bad)
    if key not in _RENDERED:
        path = staging_dir(spark, "rendered")
        with staging(spark), shuffles_freed(spark):
            render_lines(load_lineitem(spark, sf_dir), bad=bad).write.option("compression", "zstd").parquet(path)
        _RENDERED[key] = path
    return spark.read.schema(LINES_SCHEMA).parquet(_RENDERED[key])


def parsed_of(spark: SparkSession, sf_dir: str, bad: bool = False,
              on_error: str = "quarantine") -> Parsed:
    return parse_lines(lines_of(spark, sf_dir, bad), on_error=on_error)


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# --- sources and line operators ---------------------------------------------------------

def _named_files(spark, sf_dir) -> str:
    """The rendered files as files of their own, ``csv_file=<name>/part-*``."""
    root = staging_dir(spark, "named-files")
    write_named_files(lines_of(spark, sf_dir), root)
    return root


def _folder_name():
    return F.regexp_extract("file_path", "csv_file=([^/]*)/", 1).alias("csv_file")


def q_inbox_listing(spark, sf_dir):
    return inbox_listing(spark, _named_files(spark, sf_dir), recursive=True).select(_folder_name(), "length")


def q_scan_lines(spark, sf_dir):
    lines = read_lines(spark, _named_files(spark, sf_dir), recursive=True)
    return lines.select(_folder_name()).groupBy("csv_file").agg(F.count(F.lit(1)).alias("n_lines"))


def q_line_number(spark, sf_dir):
    lines = read_lines(spark, _named_files(spark, sf_dir), recursive=True)
    return lines.select(_folder_name(), "line_no", "value")


def q_unreadable_files(spark, sf_dir):
    """Files of every codec, archives and plain ones, of which every tenth is broken: what each yields, and its outcome."""
    root = staging_dir(spark, "broken-files")
    write_packed_files(lines_of(spark, sf_dir), root, broken_every=10)
    lines, unreadable = read_inbox(spark, root)
    read = lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("n_lines"))
    log = import_log(inbox_listing(spark, root), unreadable, with_clock=False)
    return log.join(read, "file_path", "left").select(
        "file_name", "success", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.substring("message", 1, 24).alias("message"))


def q_split_fields(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_idx", "line"))
    f = split_fields("line")
    return lines.select("doc_id", F.col("line_idx").cast("long").alias("line_idx"),
                        F.size(f).cast("long").alias("n_fields"),
                        F.get(f, F.size(f) - 1).alias("last_field"))


def _header(spark, sf_dir):
    return parsed_of(spark, sf_dir).header


def q_file_preamble(spark, sf_dir):
    h = _header(spark, sf_dir)
    return h.select("csv_file", "station_name", "file_version",
                    F.col("has_version").cast("int").alias("has_version"),
                    F.size("common_pos").cast("long").alias("n_common"),
                    F.col("n_preamble").cast("long").alias("n_preamble"),
                    F.concat_ws("|", "upper_limits").alias("upper_limits"),
                    F.concat_ws("|", "lower_limits").alias("lower_limits"),
                    F.concat_ws("|", "units").alias("units"))


def q_header_map(spark, sf_dir):
    h = _header(spark, sf_dir)
    pos = [c for c in h.columns if c.startswith("pos_")]
    items = F.filter(F.transform(F.sequence(F.lit(0), F.size("header") - 1),
                                 lambda i: F.when(~F.array_contains("common_pos", i.cast("long")),
                                                  F.get(F.col("header"), i))),
                     lambda x: x.isNotNull())
    return h.select("csv_file", *pos, F.concat_ws("|", items).alias("header_items"))


def q_station_name(spark, sf_dir):
    return _header(spark, sf_dir).select("csv_file", "station_name")


def q_file_version(spark, sf_dir):
    return _header(spark, sf_dir).select("csv_file", "file_version",
                                         F.col("has_version").cast("int").alias("has_version"))


# --- row projections ---------------------------------------------------------------------

def _rows(spark, sf_dir):
    return parsed_of(spark, sf_dir).good_rows


def q_common_fields(spark, sf_dir):
    return _rows(spark, sf_dir).select("csv_file", "line_no", "product", "serialnumber",
                                       "station_id", "test_status", "special_build_name",
                                       "list_of_failing_tests")


def q_station_id_parts(spark, sf_dir):
    return _rows(spark, sf_dir).select("csv_file", "line_no", "station_id", "factorycode",
                                       "floor", "line_id", "machine_id")


def q_version_precedence(spark, sf_dir):
    return _rows(spark, sf_dir).select("csv_file", "line_no", "version")


def q_parse_timestamp(spark, sf_dir):
    return _rows(spark, sf_dir).select("csv_file", "line_no", "starttime", "endtime")


# --- unpivot and tables ------------------------------------------------------------------

def _cells(spark, sf_dir):
    return parsed_of(spark, sf_dir).good_cells


def q_unpivot_measurements(spark, sf_dir):
    return _cells(spark, sf_dir).select("csv_file", "line_no", "pos", "item", "value")


def q_measurement_with_limits(spark, sf_dir):
    return tb.measurement(_cells(spark, sf_dir))


def q_null_literal(spark, sf_dir):
    m = tb.measurement(_cells(spark, sf_dir), null_literal=True, keep_order=True)
    return m.select("csv_file", "line_no", "item", "phase", "npiconfig", "segment", "unit_number",
                    "special_build_name", "special_build_description", "list_of_failing_tests")


def q_archive_path(spark, sf_dir):
    h = _header(spark, sf_dir)
    d = archive_dir(ARCHIVE_ROOT, ARCHIVE_PHASE, ARCHIVE_DATATYPE, F.col("station_name"))
    return h.select("csv_file", F.concat(d, F.lit("/"), F.col("csv_file")).alias("archive_path"))


def q_run_meta(spark, sf_dir):
    p = parsed_of(spark, sf_dir)
    return tb.latest_rows(tb.run_meta(p.good_rows, keep_order=True), RUN_META_KEY).select(*RUN_META_COLUMNS)


def q_measurement_upsert(spark, sf_dir):
    m = tb.measurement(_cells(spark, sf_dir), keep_order=True)
    return tb.latest_rows(m, SPEC_KEY).select(*MEASUREMENT_COLUMNS)


def q_spec_dims(spark, sf_dir):
    return tb.spec_dims(_cells(spark, sf_dir))


def q_spec_history(spark, sf_dir):
    return tb.spec_history_rows(_cells(spark, sf_dir))


def _map_text(c: str):
    entries = F.array_sort(F.map_entries(F.col(c)))
    return F.concat_ws(";", F.transform(entries, lambda e: F.concat(
        e["key"], F.lit("="), F.date_format(e["value"], "yyyy-MM-dd HH:mm:ss")))).alias(c)


def q_spec_table(spark, sf_dir):
    s = tb.spec_table(_cells(spark, sf_dir))
    return s.select(*[c for c in s.columns if c not in tb.LIMIT_KINDS],
                    *[_map_text(k) for k in tb.LIMIT_KINDS])


# --- failures and the import log ------------------------------------------------------------

def q_import_log(spark, sf_dir):
    p = parsed_of(spark, sf_dir, bad=True)
    return import_log(p.header, p.file_errors, with_clock=False)


def q_import_summary(spark, sf_dir):
    p = parsed_of(spark, sf_dir, bad=True)
    return import_summary(import_log(p.header, p.file_errors, with_clock=False))


def q_partial_failure(spark, sf_dir):
    p = parsed_of(spark, sf_dir, bad=True, on_error="stop")
    return p.good_cells.select("csv_file", "line_no", "pos", "item", "value")


def q_rejects(spark, sf_dir):
    p = parsed_of(spark, sf_dir, bad=True)
    return p.rejects.select("csv_file", "line_no", "err_msg")


def q_file_outcomes(spark, sf_dir):
    """Files with every kind of preamble and row fault: outcome, message and rows that are kept."""
    p = parse_lines(damaged(lines_of(spark, sf_dir)))
    kept = p.good_rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows"))
    log = import_log(p.header, p.file_errors, with_clock=False)
    return log.join(kept, "file_path", "left").select("file_name", "success", "message",
                                                      F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def q_second_dialect(spark, sf_dir):
    """The same files with another separator."""
    lines = lines_of(spark, sf_dir).withColumn("value", F.translate("value", ",", "|"))
    p = parse_lines(lines, Dialect(separator="|"))
    return p.good_cells.select("csv_file", "line_no", "pos", "item", "value")


#: Another file layout: where each line of the default one stands, and what its common columns are called.
OTHER_LINES = {STATION_LINE: 5, HEADER_LINE: 4, DISPLAY_LINE: 7, PRIORITY_LINE: 6, UPPER_LINE: 3, LOWER_LINE: 2, UNIT_LINE: 1}
OTHER_NAMES = {"Product": "Model", "SerialNumber": "SN", "Station ID": "Place", "Test Pass/Fail Status": "Result",
               "StartTime": "Began", "EndTime": "Ended", "Version": "Rev"}
OTHER_DIALECT = Dialect(
    separator="|", version_header="rev",
    common_columns=tuple(({k.lower(): v.lower() for k, v in OTHER_NAMES.items()}.get(name, name), out) for name, out in COMMON_COLUMNS),
    station_line=OTHER_LINES[STATION_LINE], header_line=OTHER_LINES[HEADER_LINE], display_line=OTHER_LINES[DISPLAY_LINE],
    priority_line=OTHER_LINES[PRIORITY_LINE], upper_line=OTHER_LINES[UPPER_LINE], lower_line=OTHER_LINES[LOWER_LINE],
    unit_line=OTHER_LINES[UNIT_LINE], first_data_line=FIRST_DATA_LINE + 1)


def q_dialect_layout(spark, sf_dir):
    """The same files in another layout: preamble in another order, a remark before the data, other
    separator and other names of the common columns. A parameter of the parser says so; results are the same."""
    names = F.col("value")
    for old, new in OTHER_NAMES.items():
        names = F.regexp_replace(names, f"(^|,){old}(?=,|$)", f"$1{new}")
    line, moved = F.col("line_no"), F.col("line_no") + 1
    for old, new in OTHER_LINES.items():
        moved = F.when(line == old, F.lit(new)).otherwise(moved)
    lines = lines_of(spark, sf_dir)
    there = lines.withColumn("value", F.translate(F.when(line == HEADER_LINE, names).otherwise(F.col("value")), ",", "|")) \
        .withColumn("line_no", moved.cast("long"))
    remarks = lines.where(line == 1).withColumns({"line_no": F.lit(FIRST_DATA_LINE).cast("long"), "value": F.lit("# data | below")})
    p = parse_lines(there.unionByName(remarks), OTHER_DIALECT)
    return tb.measurement(p.good_cells, keep_order=True).select("line_no", "pos", *MEASUREMENT_COLUMNS)


def q_run_meta_latest(spark, sf_dir):
    """The last run of each product, station and version: keys that repeat many times."""
    meta = tb.run_meta(_rows(spark, sf_dir), keep_order=True)
    return tb.latest_rows(meta, ("product", "station_id", "station_name", "version")).select(*RUN_META_COLUMNS)


# --- file sources: rendered lines written as files and read back -------------------------

def q_scan_compressed(spark, sf_dir):
    lines = lines_of(spark, sf_dir)
    root = staging_dir(spark, "scan-compressed")
    bucket = F.pmod(F.hash("csv_file"), F.lit(len(CODECS)))
    for i, codec in enumerate(CODECS):
        write_text_files(lines.where(bucket == i), f"{root}/{codec}", codec)
    return read_lines(spark, [f"{root}/{c}" for c in CODECS]).select("value")


def q_scan_zip(spark, sf_dir):
    root = staging_dir(spark, "scan-zip")
    write_zip_files(lines_of(spark, sf_dir), root)
    return read_lines(spark, root).select("value")


def q_scan_all(spark, sf_dir):
    root = staging_dir(spark, "scan-all")
    write_mixed_files(lines_of(spark, sf_dir), root)
    return read_lines(spark, root).select("value")


def _imported(spark, batches) -> dict[str, str]:
    """The tables after an import of each batch of lines."""
    out = staging_dir(spark, "imports")
    with staging(spark):
        for batch in batches:
            files = batch.where(F.col("line_no") == 1).select("file_path", "csv_file")
            ingest_lines(spark, batch, files, out)
    return table_paths(out)


#: What a session has imported: (application, folder of the tables) -> paths of the tables.
_OVERLAPPING: dict[tuple[str, str], dict[str, str]] = {}


def _overlapping(spark, sf_dir) -> dict[str, str]:
    """The tables after an import of the files whose number is 2 or 3 modulo 4, then of all but those with 3;
    imported once in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OVERLAPPING:
        number = F.regexp_extract("csv_file", r"(\d+)", 1).cast("long") % 4
        lines = lines_of(spark, sf_dir)
        _OVERLAPPING[key] = _imported(spark, [lines.where(number >= 2), lines.where(number <= 2)])
    return _OVERLAPPING[key]


def _stored_measurement(spark, paths):
    return read_table(spark, paths["measurement"], partition_schema(MEASUREMENT_SCHEMA, partition_cols_for(MEASUREMENT_KEY)))


def q_table_sink(spark, sf_dir):
    """Import part of the rendered files, then all of them on top, and read the measurement table back."""
    lines = lines_of(spark, sf_dir)
    return _stored_measurement(spark, _imported(spark, [lines.where(F.hash("csv_file") % 2 == 0), lines]))


def q_run_meta_sink(spark, sf_dir):
    """Two overlapping imports, the run table read back."""
    paths = _overlapping(spark, sf_dir)
    return read_table(spark, paths["run_meta"], partition_schema(RUN_META_SCHEMA, partition_cols_for(RUN_META_KEY)))


def q_spec_sink(spark, sf_dir):
    """Two overlapping imports, the limit histories read back."""
    paths = _overlapping(spark, sf_dir)
    s = read_table(spark, paths["spec"], partition_schema(SPEC_SCHEMA, ["station_part"]))
    return s.select(*[c for c in s.columns if c not in tb.LIMIT_KINDS], *[_map_text(k) for k in tb.LIMIT_KINDS])


def q_export_stored(spark, sf_dir):
    """Two overlapping imports, then one station's months exported from the stored table."""
    stored = _stored_measurement(spark, _overlapping(spark, sf_dir))
    return export_station(stored, EXPORT_STATION, EXPORT_FROM, EXPORT_TO).select(*MEASUREMENT_COLUMNS)


# --- table scan and export -------------------------------------------------------------------

def q_table_scan(spark, sf_dir):
    return _events(spark, sf_dir).select("*")


def q_export_station(spark, sf_dir):
    return export_station(_events(spark, sf_dir), EVENT_TYPE, EVENT_FROM, EVENT_TO,
                          station_col="event_type", time_col="ts")


def q_export_measurements(spark, sf_dir):
    m = tb.measurement(_cells(spark, sf_dir))
    return export_station(m, EXPORT_STATION, EXPORT_FROM, EXPORT_TO)


def q_export_text(spark, sf_dir):
    return row_text(export_station(_events(spark, sf_dir), EVENT_TYPE, EVENT_FROM, EVENT_TO,
                                   station_col="event_type", time_col="ts"))


def q_export_text_sink(spark, sf_dir):
    """The exported rows written as text files and read back."""
    path = staging_dir(spark, "export-text")
    write_text(q_export_station(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def q_preview_top(spark, sf_dir):
    return preview(_events(spark, sf_dir), 10, ["event_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "inbox_listing": q_inbox_listing,
    "scan_lines": q_scan_lines,
    "line_number": q_line_number,
    "unreadable_files": q_unreadable_files,
    "split_fields": q_split_fields,
    "file_preamble": q_file_preamble,
    "header_map": q_header_map,
    "station_name": q_station_name,
    "file_version": q_file_version,
    "common_fields": q_common_fields,
    "station_id_parts": q_station_id_parts,
    "version_precedence": q_version_precedence,
    "parse_timestamp": q_parse_timestamp,
    "unpivot_measurements": q_unpivot_measurements,
    "measurement_with_limits": q_measurement_with_limits,
    "null_literal": q_null_literal,
    "archive_path": q_archive_path,
    "run_meta": q_run_meta,
    "measurement_upsert": q_measurement_upsert,
    "spec_dims": q_spec_dims,
    "spec_history": q_spec_history,
    "spec_table": q_spec_table,
    "import_log": q_import_log,
    "import_summary": q_import_summary,
    "partial_failure": q_partial_failure,
    "rejects": q_rejects,
    "file_outcomes": q_file_outcomes,
    "second_dialect": q_second_dialect,
    "dialect_layout": q_dialect_layout,
    "run_meta_latest": q_run_meta_latest,
    "scan_compressed": q_scan_compressed,
    "scan_zip": q_scan_zip,
    "scan_all": q_scan_all,
    "table_sink": q_table_sink,
    "run_meta_sink": q_run_meta_sink,
    "spec_sink": q_spec_sink,
    "export_stored": q_export_stored,
    "table_scan": q_table_scan,
    "export_station": q_export_station,
    "export_measurements": q_export_measurements,
    "export_text": q_export_text,
    "export_text_sink": q_export_text_sink,
    "preview_top": q_preview_top,
}
