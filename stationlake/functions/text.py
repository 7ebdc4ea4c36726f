"""Column expressions with the exact text semantics of station files.

Everything here returns a ``Column`` built from JVM-side SQL functions, so it
stays inside whole-stage code generation -- no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters removed by Java's String.trim(): every code point <= U+0020.
_BLANK = r"[\x00-\x20]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _quoted(sep: str) -> str:
    # a literal separator inside a Java regular expression
    return r"\Q" + sep + r"\E"


def _split_pattern(sep: str) -> str:
    """Pattern for Spark's split that hits Java's String.split fast path.

    Java compiles a Pattern on every call unless the pattern is one plain char
    or a backslash-escaped non-alphanumeric char; a quoted pattern would be
    compiled once per row.
    """
    if len(sep) == 1:
        if sep not in ".$|()[{^?*+\\":
            return sep
        if not sep.isalnum():
            return "\\" + sep
    return _quoted(sep)


def _strip_trailing(v: Column, sep: str) -> Column:
    if len(sep) == 1:
        return F.rtrim(v, F.lit(sep))
    return F.regexp_replace(v, rf"(?:{_quoted(sep)})+\z", "")


# Every character Java's trim removes, as a trim set for Spark's trim(BOTH set FROM x).
_BLANK_SET = "".join(chr(i) for i in range(0x21))


def java_trim(c) -> Column:
    """String.trim(): strip every char <= U+0020 at both ends (Spark's trim() strips blanks only).

    ``trim(BOTH <set> FROM x)`` with the 33-char set: no regular expression.
    """
    return F.trim(_col(c), F.lit(_BLANK_SET))


def java_split(c, sep: str) -> Column:
    """String.split(sep): like Spark's split, but trailing empty strings are dropped.

    '' -> [''];  ',,' -> [];  'a,,b,,' -> ['a', '', 'b'];  'a, ,' -> ['a', ' ']
    """
    v = _col(c)
    stripped = _strip_trailing(v, sep)
    return (F.when(v == "", F.array(F.lit("")))
             .when(stripped == "", F.array().cast(T.ArrayType(T.StringType())))
             .otherwise(F.split(stripped, _split_pattern(sep))))


def split_fields(c, sep: str = ",") -> Column:
    """Fields of one line: Java split on ``sep`` then Java trim of every field.

    Computed on the whole line instead of per field: trailing separators are
    removed first (exactly the fields Java drops), then blanks at both ends of
    the line and around every separator, then a plain split.  '' -> [''];  ',,' -> [];  ' a , ,' -> ['a', ''].
    """
    v = _col(c)
    q = _quoted(sep)
    stripped = _strip_trailing(v, sep)
    # regexp_replace compiles its (constant) pattern once and writes the line anew, so it is left to lines
    # with a blank beside a separator; the split then takes Java's single-char fast path
    repl = sep.replace("\\", "\\\\").replace("$", "\\$")
    trimmed = java_trim(stripped)
    tight = F.when(trimmed.rlike(rf"{q}{_BLANK}|{_BLANK}{q}"),
                   F.regexp_replace(trimmed, rf"{_BLANK}*{q}{_BLANK}*", repl)).otherwise(trimmed)
    return (F.when(v == "", F.array(F.lit("")))
             .when(stripped == "", F.array().cast(T.ArrayType(T.StringType())))
             .otherwise(F.split(tight, _split_pattern(sep))))


_TS_SHAPE = r"^\d{1,4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\z"
#: The same with four digits of a year that there is: for these a cast says what the pattern would, in a fraction of its time.
_TS_PLAIN = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\z"


def parse_station_time(c) -> Column:
    """Parse 'yyyy-MM-dd HH:mm:ss' leniently on digit counts (1-2 digit parts, 1-4 digit year).

    Returns TIMESTAMP_NTZ (station clocks carry no zone); NULL when the text is
    missing, has extra text, or names an impossible date/time.
    """
    v = _col(c)
    parsed = F.try_to_timestamp(v, F.lit("y-M-d H:m:s"))
    return (F.when(v.rlike(_TS_PLAIN), v.try_cast(T.TimestampNTZType()))
             .when(v.rlike(_TS_SHAPE), parsed.cast(T.TimestampNTZType())))


def file_version_parts(c) -> tuple[Column, Column]:
    """Second field of the station line: 'Version: v1; v2' -> ('v1' text, stage flags).

    Returns ``(version, error_code)``; error_code is NULL when the field is
    well-formed, 'E2' when there is no text after ':' and 'E3' when that text is
    only ';' separators.
    """
    v = _col(c)
    after_colon = F.get(java_split(v, ":"), 1)
    first = F.get(java_split(after_colon, ";"), 0)
    err = (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(after_colon.isNull(), F.lit("E2"))
            .when(first.isNull(), F.lit("E3")))
    return java_trim(first), err


def station_id_parts(c) -> list[Column]:
    """'FXGL_C03-5FT-02B_1_AE-22' -> factorycode, floor, line_id, machine_id.

    Missing parts are '' and extra parts are ignored; a missing station id gives NULLs.
    """
    return [F.split_part(_col(c), F.lit("_"), F.lit(i)) for i in range(1, 5)]

