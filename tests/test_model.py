"""Brute force: random station files, Spark pipeline vs a small pure-Python model."""

import datetime as dt
import os
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import lines_df
from stationlake.plans.pipeline import parse_lines

COMMON = ["Product", "SerialNumber", "Station ID", "StartTime", "EndTime", "Version",
          "Unit Number", "Test Pass/Fail Status"]
_TS = re.compile(r"^\d{1,4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$")


def jsplit(s, sep):
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def jtrim(s):
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 32:
        i += 1
    while j > i and ord(s[j - 1]) <= 32:
        j -= 1
    return s[i:j]


def fields(line):
    return [jtrim(x) for x in jsplit(line, ",")]


def ts_ok(v):
    if v is None or not _TS.match(v):
        return False
    y, mo, d, h, mi, s = map(int, re.split(r"[- :]", v))
    try:
        dt.datetime(y, mo, d, h, mi, s)
        return y >= 1
    except ValueError:
        return False


def model(name, lines):
    """(cells, rejected line numbers) of one file, quarantine mode."""
    f = [fields(x) for x in lines]
    pre_err = bool(lines) and len(f[0]) == 0
    if not pre_err and len(f[0]) > 1:
        after = jsplit(f[0][1], ":")
        pre_err = len(after) < 2 or len(jsplit(after[1], ";")) == 0
    header = [x.lower() for x in f[1]] if len(f) > 1 else []
    limits = [f[k] if len(f) > k else [] for k in (4, 5, 6)]
    common = {}
    for c in (x.lower() for x in COMMON):
        if c in header:
            common[c] = header.index(c)
    cells, rejects = [], []
    m = min(len(header), *[len(x) for x in limits])
    for i in range(7, len(lines)):
        row, line_no = f[i], i + 1
        items = [p for p in range(len(row)) if p not in common.values()]

        def cell(c):
            p = common.get(c, -1)
            return row[p] if 0 <= p < len(row) else None

        bad = pre_err or any(p >= m for p in items) or not (ts_ok(cell("starttime")) and ts_ok(cell("endtime")))
        if bad:
            rejects.append(line_no)
            continue
        for p in items:
            cells.append((name, line_no, p, header[p], row[p], limits[0][p], limits[1][p], limits[2][p]))
    return cells, rejects


word = st.sampled_from(["x", "NA", "1.5", "", " 2 ", "\tq", "v,w"])
time_text = st.one_of(
    st.builds(lambda y, mo, d, h: f"{y}-{mo:02d}-{d:02d} {h}:05:00",
              st.integers(1990, 2030), st.integers(1, 13), st.integers(1, 31), st.integers(0, 24)),
    st.sampled_from(["", "bad", "2020-01-01"]))


@st.composite
def station_file(draw):
    commons = draw(st.lists(st.sampled_from(COMMON), unique=True, min_size=0, max_size=6))
    items = [f"I{k}" for k in range(draw(st.integers(0, 4)))]
    header = draw(st.permutations(commons + items))
    n = len(header)
    station = draw(st.sampled_from(["ST1,Version: a; b", "ST2", ",,", "ST3,Version", "ST4,Version:;"]))

    def limit_line(label):
        k = draw(st.integers(max(0, n - 2), n + 1))
        return ",".join([label] + [draw(st.sampled_from(["1", "NA", "0.5"])) for _ in range(k)])

    lines = [station, ",".join(header), "Display", "Prio", limit_line("U"), limit_line("L"), limit_line("M")]
    for _ in range(draw(st.integers(0, 4))):
        vals = []
        for h in header:
            if h in ("StartTime", "EndTime"):
                vals.append(draw(time_text))
            else:
                vals.append(draw(word))
        vals += [draw(word) for _ in range(draw(st.integers(0, 2)))]
        lines.append(",".join(vals))
    if draw(st.booleans()):
        lines = lines[: draw(st.integers(1, len(lines)))]
    return lines


@settings(max_examples=int(os.environ.get("MODEL_EXAMPLES", "12")), deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(station_file(), min_size=1, max_size=4))
def test_pipeline_matches_model(spark, files):
    named = {f"f{i}.csv": ls for i, ls in enumerate(files)}
    exp_cells, exp_rej = [], []
    for name, ls in named.items():
        c, r = model(name, ls)
        exp_cells += c
        exp_rej += [(name, n) for n in r]
    p = parse_lines(lines_df(spark, {k: "\n".join(v) + "\n" for k, v in named.items()}))
    got_cells = [(r.csv_file, r.line_no, r.pos, r.item, r.value, r.upper, r.lower, r.unit)
                 for r in p.good_cells.collect()]
    got_rej = [(r.csv_file, r.line_no) for r in p.rejects.collect()]
    assert sorted(got_cells) == sorted(exp_cells)
    assert sorted(got_rej) == sorted(exp_rej)


def model_stop(name, lines):
    """(cells, kept data line numbers) of one file, stop mode: nothing after the first error."""
    f = [fields(x) for x in lines]
    all_cells, rejects = model(name, lines)
    pre_err = bool(lines) and len(f[0]) == 0
    if not pre_err and len(f[0]) > 1:
        after = jsplit(f[0][1], ":")
        pre_err = len(after) < 2 or len(jsplit(after[1], ";")) == 0
    if pre_err:
        return [], []
    header = [x.lower() for x in f[1]] if len(f) > 1 else []
    limits = [f[k] if len(f) > k else [] for k in (4, 5, 6)]
    m = min(len(header), *[len(x) for x in limits])
    common = {c: header.index(c) for c in (x.lower() for x in COMMON) if c in header}
    cells, kept = [], []
    for i in range(7, len(lines)):
        row, line_no = f[i], i + 1
        if line_no not in rejects:
            cells += [c for c in all_cells if c[1] == line_no]
            kept.append(line_no)
            continue
        items = [p for p in range(len(row)) if p not in common.values()]
        bad = [p for p in items if p >= m]
        first_item = items[0] if items else None
        if bad and bad[0] != first_item:
            def cell(c):
                p = common.get(c, -1)
                return row[p] if 0 <= p < len(row) else None
            if ts_ok(cell("starttime")) and ts_ok(cell("endtime")):
                cells += [(name, line_no, p, header[p], row[p], limits[0][p], limits[1][p], limits[2][p])
                          for p in items if p < bad[0]]
        break
    return cells, kept


@settings(max_examples=int(os.environ.get("MODEL_EXAMPLES", "12")), deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(station_file(), min_size=1, max_size=4))
def test_stop_mode_matches_model(spark, files):
    named = {f"f{i}.csv": ls for i, ls in enumerate(files)}
    exp_cells, exp_rows = [], []
    for name, ls in named.items():
        c, kept = model_stop(name, ls)
        exp_cells += c
        exp_rows += [(name, n) for n in kept]
    p = parse_lines(lines_df(spark, {k: "\n".join(v) + "\n" for k, v in named.items()}),
                    on_error="stop")
    got_cells = [(r.csv_file, r.line_no, r.pos, r.item, r.value, r.upper, r.lower, r.unit)
                 for r in p.good_cells.collect()]
    got_rows = [(r.csv_file, r.line_no) for r in p.good_rows.collect()]
    assert sorted(got_cells) == sorted(exp_cells)
    assert sorted(got_rows) == sorted(exp_rows)
