"""Table schemas, default keys and the station-file dialect description."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the station-file format (do not edit):
# header names of the common columns (matched after trim + lower-case), and the
# output column each one feeds.
# ---------------------------------------------------------------------------
COMMON_COLUMNS: tuple[tuple[str, str], ...] = (
    ("product", "product"),
    ("serialnumber", "serialnumber"),
    ("special build name", "special_build_name"),
    ("special build description", "special_build_description"),
    ("unit number", "unit_number"),
    ("station id", "station_id"),
    ("test pass/fail status", "test_status"),
    ("starttime", "starttime"),
    ("endtime", "endtime"),
    ("list of failing tests", "list_of_failing_tests"),
    ("version", "version"),
)
# Preamble line roles (1-based line numbers) and the first data line.
STATION_LINE = 1
HEADER_LINE = 2
DISPLAY_LINE = 3
PRIORITY_LINE = 4
UPPER_LINE = 5
LOWER_LINE = 6
UNIT_LINE = 7
FIRST_DATA_LINE = 8
# Timestamp text pattern of StartTime / EndTime.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
# Station id parts, split on "_".
STATION_ID_PARTS = ("factorycode", "floor", "line_id", "machine_id")
# Columns that exist in the tables but are never filled by the parser.
PLACEHOLDER_COLUMNS = ("phase", "npiconfig", "segment")


@dataclass(frozen=True)
class Dialect:
    """Describes one station-file layout; the DataFrame functions take it as a parameter."""

    separator: str = ","
    common_columns: tuple[tuple[str, str], ...] = COMMON_COLUMNS
    version_header: str = "version"
    station_line: int = STATION_LINE
    header_line: int = HEADER_LINE
    display_line: int = DISPLAY_LINE
    priority_line: int = PRIORITY_LINE
    upper_line: int = UPPER_LINE
    lower_line: int = LOWER_LINE
    unit_line: int = UNIT_LINE
    first_data_line: int = FIRST_DATA_LINE

    @property
    def version_output(self) -> str:
        """The output column that the version header feeds."""
        return dict(self.common_columns)[self.version_header]

    @property
    def preamble_lines(self) -> int:
        return self.first_data_line - 1


DEFAULT_DIALECT = Dialect()

S = T.StringType()
TS = T.TimestampNTZType()

MEASUREMENT_COLUMNS = (
    "product", "serialnumber", "special_build_name", "special_build_description",
    "phase", "npiconfig", "segment", "unit_number", "station_id", "factorycode",
    "floor", "line_id", "machine_id", "station_name", "test_status", "starttime",
    "endtime", "list_of_failing_tests", "version", "item", "value", "upper", "lower",
    "unit", "csv_file",
)
RUN_META_COLUMNS = tuple(c for c in MEASUREMENT_COLUMNS
                         if c not in ("item", "value", "upper", "lower", "unit"))
SPEC_KEY = ("product", "station_id", "station_name", "version", "item")
SPEC_DIMS = STATION_ID_PARTS
SPEC_COLUMNS = SPEC_KEY[:2] + SPEC_DIMS + SPEC_KEY[2:] + ("upper", "lower", "unit")

# Keys of the measurement / run tables are not known from the source format;
# these defaults are an assumption and every function takes keys as a parameter.
MEASUREMENT_KEY = ("product", "station_name", "station_id", "serialnumber",
                   "starttime", "version", "item")
RUN_META_KEY = tuple(k for k in MEASUREMENT_KEY if k != "item")


def _struct(cols, ts_cols=("starttime", "endtime")) -> T.StructType:
    return T.StructType([T.StructField(c, TS if c in ts_cols else S, True) for c in cols])


MEASUREMENT_SCHEMA = _struct(MEASUREMENT_COLUMNS)
RUN_META_SCHEMA = _struct(RUN_META_COLUMNS)
SPEC_SCHEMA = T.StructType(
    [T.StructField(c, S, True) for c in SPEC_KEY[:2] + SPEC_DIMS + SPEC_KEY[2:]]
    + [T.StructField(k, T.MapType(S, TS), True) for k in ("upper", "lower", "unit")]
)
IMPORT_LOG_SCHEMA = T.StructType([
    T.StructField("file_name", S, True),
    T.StructField("file_path", S, True),
    T.StructField("processed_at", S, True),
    T.StructField("message", S, True),
    T.StructField("success", T.IntegerType(), False),
])
LINES_SCHEMA = T.StructType([
    T.StructField("file_path", S, False),
    T.StructField("csv_file", S, False),
    T.StructField("line_no", T.LongType(), False),
    T.StructField("value", S, True),
])


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE ... (<ddl>) USING parquet``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
