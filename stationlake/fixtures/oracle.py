"""DuckDB SQL for every registered query, computed from the raw tables.

The station-file queries are answered from ``lineitem`` columns directly with
the rendering rules of ``stationlake.fixtures.render`` -- no text is parsed, so
a parser defect cannot cancel out against the oracle.
"""

from __future__ import annotations

from stationlake.plans import queries as q

_DEC2 = "CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)"


def _dec2(c: str) -> str:
    return _DEC2.format(c=c)


def _li(bad: bool = False) -> str:
    """One row per lineitem row with every rendered field (as the parser must see it)."""
    start_ok = "l_shipdate"
    start = (f"CASE WHEN l_suppkey % 10 = 0 AND seq = 3 THEN NULL ELSE {start_ok} END"
             if bad else start_ok)
    return f"""
li0 AS (
  SELECT l.*,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS seq
  FROM lineitem l
),
li AS (
  SELECT li0.*,
         CAST(7 + seq AS BIGINT) AS line_no,
         'f' || l_suppkey || '.csv' AS csv_file,
         '/rendered/station/f' || l_suppkey || '.csv' AS file_path,
         'ST' || (l_suppkey % 5) AS station_name,
         CASE WHEN l_suppkey % 2 = 0 THEN 7 ELSE 6 END AS n_common,
         'P' || (l_partkey % 10) AS product,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey AS serialnumber,
         CASE WHEN l_suppkey % 6 = 0 THEN 'FX_F' || (l_suppkey % 5) || '_L0'
              WHEN l_suppkey % 6 = 1 THEN 'FX_F' || (l_suppkey % 5) || '_L1_M1_X9_Y'
              ELSE 'FX_F' || (l_suppkey % 5) || '_L' || (l_suppkey % 6) || '_M' || (l_suppkey % 2) END
           AS station_id,
         'FX' AS factorycode,
         'F' || (l_suppkey % 5) AS floor,
         'L' || (l_suppkey % 6) AS line_id,
         CASE WHEN l_suppkey % 6 = 0 THEN '' WHEN l_suppkey % 6 = 1 THEN 'M1'
              ELSE 'M' || (l_suppkey % 2) END AS machine_id,
         CASE WHEN l_returnflag = 'R' THEN 'FAIL' ELSE 'PASS' END AS test_status,
         {start} AS starttime,
         l_shipdate + to_minutes(l_linenumber) + to_seconds(l_orderkey % 60) AS endtime,
         CASE WHEN l_suppkey % 2 = 0
              THEN (CASE WHEN l_orderkey % 7 = 0 THEN '' ELSE 'V' || (l_orderkey % 2) END)
              ELSE 'V' || (l_suppkey % 3) END AS version,
         CAST(NULL AS VARCHAR) AS special_build_name,
         CAST(NULL AS VARCHAR) AS special_build_description,
         CAST(NULL AS VARCHAR) AS unit_number,
         CAST(NULL AS VARCHAR) AS list_of_failing_tests,
         CAST(NULL AS VARCHAR) AS phase,
         CAST(NULL AS VARCHAR) AS npiconfig,
         CAST(NULL AS VARCHAR) AS segment
  FROM li0
)"""


def _cells_cte() -> str:
    upper_q = "CASE WHEN l_suppkey % 4 = 2 THEN 'NA' ELSE CAST(45 + l_suppkey % 4 AS VARCHAR) END"
    upper_p = "CAST(100000 + 1000 * (l_suppkey % 4) AS VARCHAR)"
    upper_t = "CASE WHEN l_suppkey % 4 = 0 THEN 'NA' ELSE '0.08' END"
    lower_t = "CASE WHEN l_suppkey % 4 = 3 THEN 'NA' ELSE '0' END"
    disc = f"CASE WHEN l_discount = 0 THEN '' ELSE {_dec2('l_discount')} END"
    return f"""
cells AS (
  SELECT li.*, 'quantity' AS item, CAST(n_common AS BIGINT) AS pos, {_dec2('l_quantity')} AS value,
         {upper_q} AS upper, '1' AS lower, 'pcs' AS unit FROM li
  UNION ALL
  SELECT li.*, 'price', CAST(n_common + 1 AS BIGINT), {_dec2('l_extendedprice')},
         {upper_p}, '0', 'USD' FROM li
  UNION ALL
  SELECT li.*, 'discount', CAST(n_common + 2 AS BIGINT), {disc},
         '0.10', '0.00', 'NA' FROM li WHERE l_discount <> 0 OR l_tax <> 0
  UNION ALL
  SELECT li.*, 'tax', CAST(n_common + 3 AS BIGINT), {_dec2('l_tax')},
         {upper_t}, {lower_t}, 'pct' FROM li WHERE l_tax <> 0
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_MEAS_COLS = ", ".join([
    "product", "serialnumber", "special_build_name", "special_build_description", "phase",
    "npiconfig", "segment", "unit_number", "station_id", "factorycode", "floor", "line_id",
    "machine_id", "station_name", "test_status", "starttime", "endtime", "list_of_failing_tests",
    "version", "item", "value", "upper", "lower", "unit", "csv_file"])
_META_COLS = ", ".join([
    "product", "serialnumber", "special_build_name", "special_build_description", "phase",
    "npiconfig", "segment", "unit_number", "station_id", "factorycode", "floor", "line_id",
    "machine_id", "station_name", "test_status", "starttime", "endtime", "list_of_failing_tests",
    "version", "csv_file"])
_SPEC_KEY = "product, station_id, station_name, version, item"

_SUPP = """
supp AS (
  SELECT DISTINCT l_suppkey, 'f' || l_suppkey || '.csv' AS csv_file,
         '/rendered/station/f' || l_suppkey || '.csv' AS file_path,
         'ST' || (l_suppkey % 5) AS station_name,
         'V' || (l_suppkey % 3) AS file_version,
         CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 0 END AS has_version,
         CASE WHEN l_suppkey % 2 = 0 THEN 7 ELSE 6 END AS n_common
  FROM lineitem
)"""


def _data_line() -> str:
    product = ("CASE WHEN l_linenumber % 3 = 0 THEN ' ' || product || chr(9) ELSE product END")
    start = ("CASE WHEN l_linenumber = 7 THEN strftime(l_shipdate, '%Y-%-m-%-d %-H:%-M:%-S') "
             "ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END")
    end = "strftime(endtime, '%Y-%m-%d %H:%M:%S')"
    disc = f"CASE WHEN l_discount = 0 THEN '' ELSE {_dec2('l_discount')} END"
    tax = f"CASE WHEN l_tax = 0 THEN '' ELSE {_dec2('l_tax')} END"
    head = f"{product} || ',' || serialnumber || ',' || station_id || ',' || test_status || ',' || {start} || ',' || {end} || ','"
    items = f"{_dec2('l_quantity')} || ',' || {_dec2('l_extendedprice')} || ',' || {disc} || ',' || {tax}"
    return f"CASE WHEN l_suppkey % 2 = 0 THEN {head} || version || ',' || {items} ELSE {head} || {items} END"


def _preamble_lines() -> str:
    pad = "repeat(',', n_common)"
    up = ("(CASE WHEN l_suppkey % 4 = 2 THEN 'NA' ELSE CAST(45 + l_suppkey % 4 AS VARCHAR) END) || ',' || "
          "CAST(100000 + 1000 * (l_suppkey % 4) AS VARCHAR) || ',0.10,' || "
          "(CASE WHEN l_suppkey % 4 = 0 THEN 'NA' ELSE '0.08' END)")
    lo = "'1,0,0.00,' || (CASE WHEN l_suppkey % 4 = 3 THEN 'NA' ELSE '0' END)"
    hdr = ("CASE WHEN l_suppkey % 2 = 0 THEN 'Product,SerialNumber,Station ID,Test Pass/Fail Status,"
           "StartTime,EndTime,Version,Quantity,Price,Discount,Tax' ELSE 'Product,SerialNumber,"
           "Station ID,Test Pass/Fail Status,StartTime,EndTime,Quantity,Price,Discount,Tax' END")
    return f"""
  SELECT csv_file, CAST(1 AS BIGINT) AS line_no, station_name || ',Version: ' || file_version || '; VX' AS value FROM supp
  UNION ALL SELECT csv_file, 2, {hdr} FROM supp
  UNION ALL SELECT csv_file, 3, 'Display Name ----->' FROM supp
  UNION ALL SELECT csv_file, 4, 'PDCA Priority ----->' || {pad} || '0,0,1,1' FROM supp
  UNION ALL SELECT csv_file, 5, 'Upper Limit ----->' || {pad} || {up} FROM supp
  UNION ALL SELECT csv_file, 6, 'Lower Limit ----->' || {pad} || {lo} FROM supp
  UNION ALL SELECT csv_file, 7, 'Measurement Unit ----->' || {pad} || 'pcs,USD,NA,pct' FROM supp"""


def _good_rows(bad: bool) -> str:
    return "SELECT * FROM li" + (" WHERE starttime IS NOT NULL" if bad else "")


def _events_range() -> str:
    return (f"SELECT * FROM events WHERE event_type = '{q.EVENT_TYPE}' "
            f"AND ts >= TIMESTAMP '{q.EVENT_FROM}' AND ts <= TIMESTAMP '{q.EVENT_TO}'")


def _map_text(kind: str) -> str:
    return (f"string_agg(CASE WHEN kind = '{kind}' THEN limit_value || '=' || "
            f"strftime(seen_at, '%Y-%m-%d %H:%M:%S') END, ';' ORDER BY limit_value) AS {kind}")


#: The overlapping imports of ``plans.queries``: the second one has all files but those with 3 modulo 4.
_SECOND_IMPORT = "(l_suppkey % 4 <> 3)"


def _history_cte(before: str = "0") -> str:
    """``before``: what orders the writes ahead of file name and place."""
    return f"""
ev AS (
  SELECT product, station_id, station_name, version, item, 'upper' AS kind, upper AS limit_value,
         starttime, {before} AS before, csv_file, line_no, pos FROM cells
  UNION ALL SELECT product, station_id, station_name, version, item, 'lower', lower, starttime, {before} AS before, csv_file, line_no, pos FROM cells
  UNION ALL SELECT product, station_id, station_name, version, item, 'unit', unit, starttime, {before} AS before, csv_file, line_no, pos FROM cells
),
hist AS (
  SELECT product, station_id, station_name, version, item, kind, limit_value,
         arg_max(starttime, (before, csv_file, line_no, pos)) AS seen_at
  FROM ev GROUP BY ALL
)"""


def _rendered_values(li: str) -> str:
    return f"""{_with(_SUPP, li)}
            SELECT value FROM ({_preamble_lines()})
            UNION ALL SELECT {_data_line()} AS value FROM li"""


def oracle_sql() -> dict[str, str]:
    li, cells = _li(), _cells_cte()
    li_bad = _li(bad=True)
    pre_bad_msg = "'line ' || line_no || ': invalid StartTime \"not-a-time\"'"
    return {
        "inbox_listing": f"""{_with(_SUPP, li)}
            SELECT csv_file, CAST(sum(octet_length(encode(value)) + 1) AS BIGINT) AS length FROM (
              SELECT csv_file, value FROM ({_preamble_lines()})
              UNION ALL SELECT csv_file, {_data_line()} AS value FROM li) GROUP BY csv_file""",
        "unreadable_files": """
            SELECT 'f' || l_suppkey || '.csv' ||
                   ['.gz', '.bz2', '.deflate', '.lz4', '.snappy', '.zip', ''][1 + l_suppkey % 7] AS file_name,
                   CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE 1 END AS success,
                   CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE count(*) + 7 END AS n_lines,
                   CASE WHEN l_suppkey % 10 = 0 THEN 'message: unreadable file' ELSE 'message: ' END AS message
            FROM lineitem GROUP BY l_suppkey""",
        "scan_lines": f"SELECT 'f' || l_suppkey || '.csv' AS csv_file, count(*) + 7 AS n_lines "
                      f"FROM lineitem GROUP BY l_suppkey",
        "line_number": f"""{_with(_SUPP, li)}
            SELECT csv_file, line_no, value FROM ({_preamble_lines()})
            UNION ALL SELECT csv_file, line_no, {_data_line()} AS value FROM li""",
        "split_fields": r"""
            WITH l AS (
              SELECT doc_id, UNNEST(parts) AS line, UNNEST(range(len(parts))) AS line_idx
              FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
            SELECT doc_id, CAST(line_idx AS BIGINT) AS line_idx,
              CAST(CASE WHEN line = '' THEN 1 WHEN rtrim(line, ',') = '' THEN 0
                        ELSE len(string_split(rtrim(line, ','), ',')) END AS BIGINT) AS n_fields,
              CASE WHEN line = '' THEN ''
                   WHEN rtrim(line, ',') = '' THEN NULL
                   ELSE regexp_replace(string_split(rtrim(line, ','), ',')[-1],
                                       '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') END AS last_field
            FROM l""",
        "file_preamble": f"""{_with(_SUPP)}
            SELECT csv_file, station_name, file_version, has_version,
                   CAST(n_common AS BIGINT) AS n_common, CAST(7 AS BIGINT) AS n_preamble,
                   'Upper Limit ----->' || repeat('|', n_common) ||
                     (CASE WHEN l_suppkey % 4 = 2 THEN 'NA' ELSE CAST(45 + l_suppkey % 4 AS VARCHAR) END)
                     || '|' || CAST(100000 + 1000 * (l_suppkey % 4) AS VARCHAR) || '|0.10|' ||
                     (CASE WHEN l_suppkey % 4 = 0 THEN 'NA' ELSE '0.08' END) AS upper_limits,
                   'Lower Limit ----->' || repeat('|', n_common) || '1|0|0.00|' ||
                     (CASE WHEN l_suppkey % 4 = 3 THEN 'NA' ELSE '0' END) AS lower_limits,
                   'Measurement Unit ----->' || repeat('|', n_common) || 'pcs|USD|NA|pct' AS units
            FROM supp""",
        "header_map": f"""{_with(_SUPP)}
            SELECT csv_file,
                   CAST(0 AS BIGINT) AS pos_product, CAST(1 AS BIGINT) AS pos_serialnumber,
                   CAST(-1 AS BIGINT) AS pos_special_build_name,
                   CAST(-1 AS BIGINT) AS pos_special_build_description,
                   CAST(-1 AS BIGINT) AS pos_unit_number, CAST(2 AS BIGINT) AS pos_station_id,
                   CAST(3 AS BIGINT) AS pos_test_status, CAST(4 AS BIGINT) AS pos_starttime,
                   CAST(5 AS BIGINT) AS pos_endtime, CAST(-1 AS BIGINT) AS pos_list_of_failing_tests,
                   CAST(CASE WHEN has_version = 1 THEN 6 ELSE -1 END AS BIGINT) AS pos_version,
                   'quantity|price|discount|tax' AS header_items
            FROM supp""",
        "station_name": f"{_with(_SUPP)} SELECT csv_file, station_name FROM supp",
        "file_version": f"{_with(_SUPP)} SELECT csv_file, file_version, has_version FROM supp",
        "common_fields": f"""{_with(li)}
            SELECT csv_file, line_no, product, serialnumber, station_id, test_status,
                   special_build_name, list_of_failing_tests FROM li""",
        "station_id_parts": f"""{_with(li)}
            SELECT csv_file, line_no, station_id, factorycode, floor, line_id, machine_id FROM li""",
        "version_precedence": f"{_with(li)} SELECT csv_file, line_no, version FROM li",
        "parse_timestamp": f"{_with(li)} SELECT csv_file, line_no, starttime, endtime FROM li",
        "unpivot_measurements": f"{_with(li, cells)} SELECT csv_file, line_no, pos, item, value FROM cells",
        "measurement_with_limits": f"{_with(li, cells)} SELECT {_MEAS_COLS} FROM cells",
        "null_literal": f"""{_with(li, cells)}
            SELECT csv_file, line_no, item, 'null' AS phase, 'null' AS npiconfig, 'null' AS segment,
                   'null' AS unit_number, 'null' AS special_build_name,
                   'null' AS special_build_description, 'null' AS list_of_failing_tests FROM cells""",
        "archive_path": f"""{_with(_SUPP)}
            SELECT csv_file, '{q.ARCHIVE_ROOT}/' || upper('{q.ARCHIVE_PHASE}/{q.ARCHIVE_DATATYPE}/' || station_name)
                   || '/' || csv_file AS archive_path FROM supp""",
        "run_meta": f"""{_with(li)}
            SELECT {_META_COLS} FROM li
            QUALIFY row_number() OVER (PARTITION BY product, station_name, station_id, serialnumber,
                                       starttime, version ORDER BY csv_file DESC, line_no DESC) = 1""",
        "run_meta_latest": f"""{_with(li)}
            SELECT {_META_COLS} FROM li
            QUALIFY row_number() OVER (PARTITION BY product, station_id, station_name, version
                                       ORDER BY csv_file DESC, line_no DESC) = 1""",
        "second_dialect": f"""{_with(li, cells)}
            SELECT csv_file, line_no, pos, item, value FROM cells""",
        "dialect_layout": f"""{_with(li, cells)}
            SELECT line_no + 1 AS line_no, pos, {_MEAS_COLS} FROM cells""",
        "file_outcomes": f"""{_with(li)},
            f AS (SELECT l_suppkey, l_suppkey % 8 AS kind, any_value(n_common) AS n_common, count(*) AS cnt,
                         min(CASE WHEN l_discount <> 0 OR l_tax <> 0 THEN line_no END) AS short_line,
                         count(*) FILTER (l_discount = 0 AND l_tax = 0) AS cnt_short
                  FROM li GROUP BY l_suppkey),
            m AS (SELECT *, CASE
                    WHEN kind = 1 THEN 'station line has no fields'
                    WHEN kind = 2 THEN 'station line: no version after '':'''
                    WHEN kind = 3 THEN 'station line: empty version list'
                    WHEN kind = 5 AND cnt >= 2 THEN 'line 9, position ' || (n_common + 4) || ': more fields than the header'
                    WHEN kind = 6 AND short_line IS NOT NULL
                      THEN 'line ' || short_line || ', position ' || (n_common + 2) || ': no upper limit'
                    WHEN kind = 7 THEN 'line 8: invalid StartTime "null"' END AS err FROM f)
            SELECT 'f' || l_suppkey || '.csv' AS file_name, CASE WHEN err IS NULL THEN 1 ELSE 0 END AS success,
                   'message: ' || coalesce(err, '') AS message,
                   CASE WHEN kind IN (1, 2, 3, 4) THEN 0 WHEN kind = 6 THEN cnt_short
                        WHEN kind = 7 OR kind = 5 AND cnt >= 2 THEN cnt - 1 ELSE cnt END AS n_rows FROM m""",
        "measurement_upsert": f"""{_with(li, cells)}
            SELECT {_MEAS_COLS} FROM cells
            QUALIFY row_number() OVER (PARTITION BY {_SPEC_KEY}
                                       ORDER BY csv_file DESC, line_no DESC, pos DESC) = 1""",
        "spec_dims": f"""{_with(li, cells)}
            SELECT {_SPEC_KEY},
                   arg_min(factorycode, (csv_file, line_no, pos)) AS factorycode,
                   arg_min(floor, (csv_file, line_no, pos)) AS floor,
                   arg_min(line_id, (csv_file, line_no, pos)) AS line_id,
                   arg_min(machine_id, (csv_file, line_no, pos)) AS machine_id
            FROM cells GROUP BY ALL""",
        "spec_history": f"""{_with(li, cells, _history_cte())}
            SELECT product, station_id, station_name, version, item, kind, limit_value, seen_at FROM hist""",
        "spec_table": f"""{_with(li, cells, _history_cte())},
            dims AS (
              SELECT {_SPEC_KEY},
                     arg_min(factorycode, (csv_file, line_no, pos)) AS factorycode,
                     arg_min(floor, (csv_file, line_no, pos)) AS floor,
                     arg_min(line_id, (csv_file, line_no, pos)) AS line_id,
                     arg_min(machine_id, (csv_file, line_no, pos)) AS machine_id
              FROM cells GROUP BY ALL),
            maps AS (
              SELECT {_SPEC_KEY}, {_map_text('upper')}, {_map_text('lower')}, {_map_text('unit')}
              FROM hist GROUP BY ALL)
            SELECT m.product, m.station_id, d.factorycode, d.floor, d.line_id, d.machine_id,
                   m.station_name, m.version, m.item, m.upper, m.lower, m.unit
            FROM maps m JOIN dims d USING (product, station_id, station_name, version, item)""",
        "import_log": f"""{_with(_SUPP)}
            SELECT csv_file AS file_name, file_path,
                   CASE WHEN l_suppkey % 10 = 0 AND cnt >= 3
                        THEN 'message: line 10: invalid StartTime "not-a-time"' ELSE 'message: ' END AS message,
                   CASE WHEN l_suppkey % 10 = 0 AND cnt >= 3 THEN 0 ELSE 1 END AS success
            FROM supp JOIN (SELECT l_suppkey, count(*) AS cnt FROM lineitem GROUP BY l_suppkey) c USING (l_suppkey)""",
        "import_summary": """
            SELECT count(*) AS total, CAST(sum(ok) AS BIGINT) AS success,
                   CAST(count(*) - sum(ok) AS BIGINT) AS failure
            FROM (SELECT l_suppkey, CASE WHEN l_suppkey % 10 = 0 AND count(*) >= 3 THEN 0 ELSE 1 END AS ok
                  FROM lineitem GROUP BY l_suppkey)""",
        "partial_failure": f"""{_with(li_bad, cells)}
            SELECT csv_file, line_no, pos, item, value FROM cells
            WHERE NOT (l_suppkey % 10 = 0 AND seq >= 3)""",
        "rejects": f"""{_with(li_bad)}
            SELECT csv_file, line_no, {pre_bad_msg} AS err_msg FROM li WHERE starttime IS NULL""",
        "scan_compressed": _rendered_values(li),
        "scan_zip": _rendered_values(li),
        "scan_all": _rendered_values(li),
        "table_sink": f"""{_with(li, cells)}
            SELECT {_MEAS_COLS}, 's-' || station_name AS station_part, strftime(starttime, '%Y-%m') AS start_month FROM cells
            QUALIFY row_number() OVER (PARTITION BY product, station_name, station_id, serialnumber,
                                       starttime, version, item
                                       ORDER BY csv_file DESC, line_no DESC, pos DESC) = 1""",
        "export_stored": f"""{_with(li, cells)}
            SELECT {_MEAS_COLS} FROM cells WHERE station_name = '{q.EXPORT_STATION}'
              AND starttime >= TIMESTAMP '{q.EXPORT_FROM}' AND starttime <= TIMESTAMP '{q.EXPORT_TO}'
            QUALIFY row_number() OVER (PARTITION BY product, station_name, station_id, serialnumber,
                                       starttime, version, item
                                       ORDER BY {_SECOND_IMPORT} DESC, csv_file DESC, line_no DESC, pos DESC) = 1""",
        "run_meta_sink": f"""{_with(li)}
            SELECT {_META_COLS}, 's-' || station_name AS station_part, strftime(starttime, '%Y-%m') AS start_month FROM li
            QUALIFY row_number() OVER (PARTITION BY product, station_name, station_id, serialnumber,
                                       starttime, version
                                       ORDER BY {_SECOND_IMPORT} DESC, csv_file DESC, line_no DESC) = 1""",
        "spec_sink": f"""{_with(li, cells, _history_cte(_SECOND_IMPORT))},
            maps AS (
              SELECT {_SPEC_KEY}, {_map_text('upper')}, {_map_text('lower')}, {_map_text('unit')}
              FROM hist GROUP BY ALL),
            dims AS (
              SELECT DISTINCT {_SPEC_KEY}, factorycode, floor, line_id, machine_id FROM cells)
            SELECT m.product, m.station_id, d.factorycode, d.floor, d.line_id, d.machine_id,
                   m.station_name, m.version, m.item, m.upper, m.lower, m.unit, 's-' || m.station_name AS station_part
            FROM maps m JOIN dims d USING (product, station_id, station_name, version, item)""",
        "table_scan": "SELECT * FROM events",
        "export_station": _events_range(),
        "export_measurements": f"""{_with(li, cells)}
            SELECT {_MEAS_COLS} FROM cells WHERE station_name = '{q.EXPORT_STATION}'
              AND starttime >= TIMESTAMP '{q.EXPORT_FROM}' AND starttime <= TIMESTAMP '{q.EXPORT_TO}'""",
        "export_text": f"""
            SELECT '[' || event_id || ',' || CAST(ts AS VARCHAR) ||
                   CASE WHEN contains(CAST(ts AS VARCHAR), '.') THEN '' ELSE '.0' END || ',' || user_id || ',' ||
                   event_type || ',' || CAST(value AS VARCHAR) || ',' || props || ']' AS line
            FROM ({_events_range()})""",
        "export_text_sink": f"""
            SELECT '[' || event_id || ',' || CAST(ts AS VARCHAR) ||
                   CASE WHEN contains(CAST(ts AS VARCHAR), '.') THEN '' ELSE '.0' END || ',' || user_id || ',' ||
                   event_type || ',' || CAST(value AS VARCHAR) || ',' || props || ']' AS line
            FROM ({_events_range()})""",
        "preview_top": "SELECT * FROM events ORDER BY event_id LIMIT 10",
    }
