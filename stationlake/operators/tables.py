"""Output tables: measurement, run meta, spec limit history, and keyed upserts.

Upserts ("last write per key wins") are aggregations, not windows:
``groupBy(keys).agg(max_by(row, order))`` combines map-side, so a key holding
a third of all rows is reduced inside every map task before the shuffle and
never lands in one task whole.

``latest_rows`` does the same for rows with a place in a file, whatever their width:
only keys and places are aggregated (fixed-width buffers, a hash aggregate), and the rows
are fetched by their number.

Order of writes: ``(csv_file, line_no, pos)`` -- file name, then line, then
column.  Inside a file that is the station's own row/column order; across files
it is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.operators.joins import broadcast_limit
from stationlake.session import staged
from stationlake.schemas import (MEASUREMENT_COLUMNS, PLACEHOLDER_COLUMNS, RUN_META_COLUMNS,
                                 SPEC_DIMS, SPEC_KEY)

ORDER_COLS = ("csv_file", "line_no", "pos")
LIMIT_KINDS = ("upper", "lower", "unit")


def _placeholders(null_literal: bool) -> list[Column]:
    v = F.lit("null") if null_literal else F.lit(None).cast("string")
    return [v.alias(c) for c in PLACEHOLDER_COLUMNS]


def _render_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unset text fields as the literal text 'null' (the original tables stored them so)."""
    out = []
    for c in df.columns:
        if c in cols and dict(df.dtypes)[c] == "string":
            out.append(F.coalesce(F.col(c), F.lit("null")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def measurement(cells: DataFrame, null_literal: bool = False, keep_order: bool = False) -> DataFrame:
    """MEASUREMENT rows (25 columns) from good cells; ``keep_order`` adds line_no, pos."""
    base = cells.select(
        *[F.col(c) for c in MEASUREMENT_COLUMNS if c not in PLACEHOLDER_COLUMNS],
        *_placeholders(False), "line_no", "pos")
    cols = list(MEASUREMENT_COLUMNS) + (["line_no", "pos"] if keep_order else [])
    out = base.select(*cols)
    return _render_nulls(out, MEASUREMENT_COLUMNS) if null_literal else out


_CELL_COLUMNS = ("item", "value", "upper", "lower", "unit")
#: What a line has of its good cells, an array for each.
LINE_VALUES = "item_values"
_LINE_ARRAYS = {"pos": "item_at", "item": "item_names", "upper": "item_upper", "lower": "item_lower", "unit": "item_units", "value": LINE_VALUES}


def measurement_lines(rows: DataFrame) -> DataFrame:
    """Data lines with all that :func:`unpack_lines` makes MEASUREMENT rows of, and no other field."""
    n = F.size("f").cast("long")
    end = F.when(F.col("err_msg").isNull(), n).otherwise(F.least(n, F.col("err_pos")))  # nothing is good if -1
    values = F.transform(F.filter("item_at", lambda p: p < end), lambda p: F.get(F.col("f"), p.cast("int")))
    return rows.select(*[F.col(c) for c in MEASUREMENT_COLUMNS if c not in PLACEHOLDER_COLUMNS + _CELL_COLUMNS],
                       *_placeholders(False), "line_no", *[c for c in _LINE_ARRAYS.values() if c != LINE_VALUES], values.alias(LINE_VALUES))


def unpack_lines(lines: DataFrame) -> DataFrame:
    """The MEASUREMENT rows (and line_no, pos, whatever else ``lines`` has) of each line's good cells."""
    rest = [c for c in lines.columns if c not in _LINE_ARRAYS.values()]
    each = lines.select(*rest, *[c for c in _LINE_ARRAYS.values() if c != LINE_VALUES], F.posexplode(LINE_VALUES).alias("_at", "value"))
    out = each.select(*rest, "value", *[F.get(c, "_at").alias(k) for k, c in _LINE_ARRAYS.items() if k != "value"])
    return out.select(*MEASUREMENT_COLUMNS, *[c for c in out.columns if c not in MEASUREMENT_COLUMNS])


def pack_lines(measurements: DataFrame) -> DataFrame:
    """MEASUREMENT rows as lines of one cell each."""
    place = {"pos": F.lit(-1).cast("long")}
    return measurements.select(*[c for c in measurements.columns if c not in _CELL_COLUMNS], F.lit(-1).cast("long").alias("line_no"),
                               *[F.array(place.get(k, F.col(k))).alias(c) for k, c in _LINE_ARRAYS.items()])


def run_meta(rows: DataFrame, null_literal: bool = False, keep_order: bool = False) -> DataFrame:
    """RUN_META rows (20 columns), one per good data row."""
    base = rows.select(
        *[F.col(c) for c in RUN_META_COLUMNS if c not in PLACEHOLDER_COLUMNS],
        *_placeholders(False), "line_no", F.lit(-1).cast("long").alias("pos"))
    cols = list(RUN_META_COLUMNS) + (["line_no", "pos"] if keep_order else [])
    out = base.select(*cols)
    return _render_nulls(out, RUN_META_COLUMNS) if null_literal else out


def upsert_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER_COLS,
                  keep_order: bool = False) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (last write wins).

    ``max_by`` over a struct of all non-key columns, so the reduction is a
    partial (map-side) aggregate -- skew-safe, no sort of a whole key group.
    """
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(c) for c in rest])
    o = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*keys).agg(F.max_by(payload, o).alias("_row"))
    out = agg.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
    if not keep_order:
        out = out.drop(*[c for c in order if c not in keys and c not in MEASUREMENT_COLUMNS])
    return out.select(*[c for c in df.columns if c in out.columns])


def file_ranks(rows: DataFrame) -> DataFrame:
    """``csv_file`` -> a number that grows with the name; one row per name, ranked by ranges of names."""
    names = rows.select("csv_file").distinct().orderBy("csv_file")
    return staged(names.select(F.col("csv_file").alias("_name"), F.monotonically_increasing_id().alias("_file")), "file-ranks")


def same_key(keys: Sequence[str], prefix: str) -> Column:
    """Equality of each key with the column of that name behind ``prefix``; nulls are equal, as in a grouping."""
    out = F.lit(True)
    for k in keys:
        out &= F.col(k).eqNullSafe(F.col(prefix + k))
    return out


def with_row_number(df: DataFrame) -> DataFrame:
    """A number for each row, ``_row``; it holds once the rows are written."""
    return df.withColumn("_row", F.monotonically_increasing_id())


def latest_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the last by (csv_file, line_no, pos); any one of rows that share a place.

    The rows are written once with a number each, unless ``df`` was written :func:`with_row_number` before. Of these only key, place and number go through
    the aggregate; then the rows that lost are left out. No row is moved or sorted whole where few
    rows lost (an import) or few won; else rows are dealt by number and met by a hash join.
    """
    spark = df.sparkSession
    rows = df if "_row" in df.columns else staged(with_row_number(df), "upsert-rows")
    ranks = file_ranks(rows)
    # names of up to a few hundred bytes; their table is broadcast only where that fits
    small = ranks.count() * 256 <= broadcast_limit(spark)
    slim = rows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "csv_file", "line_no", "pos", "_row")
    slim = slim.join(F.broadcast(ranks) if small else ranks, F.col("csv_file").eqNullSafe(F.col("_name")))
    place = (F.col("_file").cast("decimal(38,0)") * F.lit(1 << 40) + F.col("line_no")) * F.lit(1 << 31) + (F.col("pos") + 1)
    won = staged(slim.groupBy(*[f"_k{i}" for i in range(len(keys))])
                     .agg(F.max_by("_row", place.cast("decimal(38,0)")).alias("_row")).select("_row"), "upsert-won")
    n, n_won = rows.count(), won.count()
    lost = n - n_won
    if lost == 0:
        return rows.drop("_row")
    if lost < n_won and lost * 16 <= broadcast_limit(spark):
        gone = staged(rows.select("_row").join(won.hint("shuffle_hash"), "_row", "left_anti"), "upsert-lost")
        return rows.join(F.broadcast(gone), "_row", "left_anti").drop("_row")
    few = n_won * 16 <= broadcast_limit(spark)
    return rows.join(F.broadcast(won) if few else won.hint("shuffle_hash"), "_row", "left_semi").drop("_row")


#: Lines whose places are compared as a 64-bit number: (line, column) in 31 bits each.
BLOCK_LINES = 1 << 31


def _line_pos() -> Column:
    """A cell's place inside its file as one number of fixed width, for any line and column."""
    return (F.col("line_no").cast("decimal(20,0)") * F.lit(1 << 31) + F.col("pos")).cast("decimal(38,0)")


def _block_pos() -> list[Column]:
    """The same place as a block of lines (0, but in files of billions) and a long inside it: no decimal per cell."""
    inside = F.pmod("line_no", F.lit(BLOCK_LINES)) * F.lit(BLOCK_LINES) + F.col("pos")
    return [F.floor(F.col("line_no") / F.lit(BLOCK_LINES)).alias("_block"), inside.alias("_lp")]


def _dims_of_station(station_id: Column) -> list[Column]:
    from stationlake.functions.text import station_id_parts
    return [p.alias(n) for p, n in zip(station_id_parts(station_id), SPEC_DIMS)]


def spec_dims(cells: DataFrame) -> DataFrame:
    """Spec key -> station-id parts (insert-if-not-exists: the first writer's parts).

    The parts are a function of ``station_id``, which is part of the key, so
    every writer of a key carries the same parts: they are derived once per
    distinct key instead of being aggregated.
    """
    keys = cells.select(*SPEC_KEY).distinct()
    return keys.select(*SPEC_KEY, *_dims_of_station(F.col("station_id")))


def limit_events(cells: DataFrame) -> DataFrame:
    """Every cell as three (kind, limit) sightings with its time and write position."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("limit_value"))
                      for k in LIMIT_KINDS])
    return (cells.select(*SPEC_KEY, "starttime", "csv_file", *_block_pos(), F.lit(1).alias("_b"), F.explode(kinds).alias("_k"))
                 .select(*SPEC_KEY, "_k.kind", "_k.limit_value", "starttime", "_b", "csv_file", "_block", "_lp"))


def _stored_events(stored: DataFrame) -> DataFrame:
    """Stored history rows as sightings that sort before every new write."""
    return stored.select(*SPEC_KEY, "kind", "limit_value", F.col("seen_at").alias("starttime"),
                         F.lit(0).alias("_b"), F.lit("").alias("csv_file"),
                         F.lit(-1).cast("long").alias("_block"), F.lit(-1).cast("long").alias("_lp"))


def merge_spec(stored: DataFrame, new: DataFrame) -> DataFrame:
    """SPEC rows of both: a limit value seen again takes its new time, all others stay.

    Each key has one row on either side, so this is one join of rows and no regrouping; the stored
    maps are not taken apart.
    """
    def merged(kind: str) -> Column:
        empty = F.create_map().cast(new.schema[kind].dataType)
        return F.map_zip_with(F.coalesce(F.col(kind), empty), F.coalesce(F.col(f"_n_{kind}"), empty),
                              lambda _, before, now: F.coalesce(now, before)).alias(kind)

    fresh = new.select(*[F.col(c).alias(f"_n_{c}") for c in stored.columns], F.lit(True).alias("_there"))
    both = stored.join(fresh.hint("shuffle_hash"), same_key(SPEC_KEY, "_n_"), "full_outer")
    # station-id parts are a function of the key, so either side's are the same; a key's columns may be null
    cols = [F.when(F.col("_there"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in stored.columns if c not in LIMIT_KINDS]
    return both.select(*cols, *[merged(k) for k in LIMIT_KINDS]).select(*stored.columns)


def _history(cells: DataFrame, stored: DataFrame | None) -> DataFrame:
    """(key, kind, limit) -> start time of its last write.

    Two steps so the heavy one is a hash aggregate: per file and block of lines, ``max_by`` over a
    long (line/position) -- fixed-width buffers, combined map-side; then across
    the few winners, ``max_by`` over (batch, file name, block).
    """
    ev = limit_events(cells)
    if stored is not None:
        ev = _stored_events(stored).unionByName(ev)
    per_file = (ev.groupBy(*SPEC_KEY, "kind", "limit_value", "_b", "csv_file", "_block")
                  .agg(F.max_by("starttime", "_lp").alias("_t")))
    return (per_file.groupBy(*SPEC_KEY, "kind", "limit_value")
                    .agg(F.max_by("_t", F.struct("_b", "csv_file", "_block")).alias("seen_at")))


def spec_history_rows(cells: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Limit history as rows: (spec key, kind, limit_value, seen_at).

    ``seen_at`` is the start time of the last write of that limit value for the
    key -- the map-union semantics of the spec table.  ``stored`` (same
    columns) holds earlier history, which any new write overrides.
    """
    return _history(cells, stored)


def spec_table(cells: DataFrame, stored_rows: DataFrame | None = None) -> DataFrame:
    """SPEC rows: key, station-id parts and the maps upper/lower/unit: limit -> seen_at.

    Second level of the aggregate: per key, the (already de-duplicated) limit
    values become map entries.  A map holds one entry per distinct limit value
    of a key -- it grows with limit changes, not with rows.
    """
    hist = _history(cells, stored_rows)

    def kind_map(k: str) -> Column:
        entries = F.collect_list(F.when(F.col("kind") == k, F.struct("limit_value", "seen_at")))
        return F.map_from_entries(entries).alias(k)

    maps = hist.groupBy(*SPEC_KEY).agg(*[kind_map(k) for k in LIMIT_KINDS])
    return maps.select(*SPEC_KEY[:2], *_dims_of_station(F.col("station_id")),
                       *SPEC_KEY[2:], *LIMIT_KINDS)


def explode_spec(spec: DataFrame) -> DataFrame:
    """SPEC maps back to history rows, station-id parts kept (for merging with new data)."""
    parts = [spec.select(*SPEC_KEY, *SPEC_DIMS, F.lit(k).alias("kind"),
                         F.explode(F.col(k)).alias("limit_value", "seen_at")) for k in LIMIT_KINDS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
