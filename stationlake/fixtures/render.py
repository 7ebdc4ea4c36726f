"""Render station files from ``lineitem`` (test and bench data).

The provided tables hold no station files, so this turns every supplier into
one file: a 7-line preamble and one data line per lineitem row.  The oracle
SQL (``stationlake.fixtures.oracle``) computes the expected tables straight
from ``lineitem`` columns without parsing any text.

Layout of file ``f<s>.csv`` (s = l_suppkey):

* line 1  ``ST<s%5>,Version: V<s%3>; VX``
* line 2  ``Product,SerialNumber,Station ID,Test Pass/Fail Status,StartTime,EndTime,
  [Version,]Quantity,Price,Discount,Tax`` -- ``Version`` only for even s
* lines 3-7  display / priority / upper / lower / unit, positional
* lines 8+   one row per lineitem row ordered by (l_orderkey, l_linenumber, l_partkey)

Text details exercised on purpose: padded product field (l_linenumber % 3 = 0),
one-digit time parts (l_linenumber = 7), an empty version cell
(l_orderkey % 7 = 0), an empty Discount cell between values (l_discount = 0),
an empty trailing Tax cell (l_tax = 0: the cell disappears), station ids with
three and with six parts.  ``bad=True`` plants an unparsable StartTime on the
third data line of every file with s % 10 = 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.operators.sequence import split_groups_sequence

RENDER_ROOT = "/rendered/station"
#: Rows that one task numbers: they are sorted in its memory.
TASK_ROWS = 500_000


def _s() -> Column:
    return F.col("l_suppkey")


def _str(c: Column) -> Column:
    return c.cast("string")


def _dec2(c: str) -> Column:
    return F.col(c).cast("decimal(12,2)").cast("string")


def station_name_expr() -> Column:
    return F.concat(F.lit("ST"), _str(_s() % 5))


def station_id_expr() -> Column:
    s = _s()
    return (F.when(s % 6 == 0, F.concat(F.lit("FX_F"), _str(s % 5), F.lit("_L0")))
             .when(s % 6 == 1, F.concat(F.lit("FX_F"), _str(s % 5), F.lit("_L1_M1_X9_Y")))
             .otherwise(F.concat(F.lit("FX_F"), _str(s % 5), F.lit("_L"), _str(s % 6),
                                 F.lit("_M"), _str(s % 2))))


def _limits(kind: str) -> list[Column]:
    s = _s()
    if kind == "upper":
        return [F.when(s % 4 == 2, F.lit("NA")).otherwise(_str(F.lit(45) + s % 4)),
                _str(F.lit(100000) + F.lit(1000) * (s % 4)),
                F.lit("0.10"),
                F.when(s % 4 == 0, F.lit("NA")).otherwise(F.lit("0.08"))]
    if kind == "lower":
        return [F.lit("1"), F.lit("0"), F.lit("0.00"),
                F.when(s % 4 == 3, F.lit("NA")).otherwise(F.lit("0"))]
    return [F.lit("pcs"), F.lit("USD"), F.lit("NA"), F.lit("pct")]


_LABELS = {3: "Display Name ----->", 4: "PDCA Priority ----->", 5: "Upper Limit ----->",
           6: "Lower Limit ----->", 7: "Measurement Unit ----->"}


def _preamble(suppliers: DataFrame) -> DataFrame:
    s = _s()
    even = s % 2 == 0
    n_common = F.when(even, F.lit(7)).otherwise(F.lit(6))
    pad = F.repeat(F.lit(","), n_common)
    header_txt = F.when(
        even, F.lit("Product,SerialNumber,Station ID,Test Pass/Fail Status,StartTime,EndTime,"
                    "Version,Quantity,Price,Discount,Tax")
    ).otherwise(F.lit("Product,SerialNumber,Station ID,Test Pass/Fail Status,StartTime,EndTime,"
                      "Quantity,Price,Discount,Tax"))

    def positional(k: int, vals: list[Column]) -> Column:
        return F.concat(F.lit(_LABELS[k]), pad, F.concat_ws(",", *vals))

    lines = [
        (1, F.concat(station_name_expr(), F.lit(",Version: V"), _str(s % 3), F.lit("; VX"))),
        (2, header_txt),
        (3, F.lit(_LABELS[3])),
        (4, positional(4, [F.lit("0"), F.lit("0"), F.lit("1"), F.lit("1")])),
        (5, positional(5, _limits("upper"))),
        (6, positional(6, _limits("lower"))),
        (7, positional(7, _limits("unit"))),
    ]
    arr = F.array(*[F.struct(F.lit(n).cast("long").alias("line_no"), v.alias("value"))
                    for n, v in lines])
    return (suppliers.select("l_suppkey", F.explode(arr).alias("_l"))
                     .select("l_suppkey", "_l.line_no", "_l.value"))


def _data_value(bad: bool) -> Column:
    s = _s()
    product = F.concat(F.lit("P"), _str(F.col("l_partkey") % 10))
    product_txt = F.when(F.col("l_linenumber") % 3 == 0,
                         F.concat(F.lit(" "), product, F.lit("\t"))).otherwise(product)
    serial = F.concat_ws("-", _str(F.col("l_orderkey")), _str(F.col("l_linenumber")),
                         _str(F.col("l_partkey")))
    status = F.when(F.col("l_returnflag") == "R", F.lit("FAIL")).otherwise(F.lit("PASS"))
    start_txt = F.when(F.col("l_linenumber") == 7,
                       F.date_format("l_shipdate", "y-M-d H:m:s")
                       ).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    if bad:
        start_txt = F.when((s % 10 == 0) & (F.col("seq") == 3), F.lit("not-a-time")).otherwise(start_txt)
    end_ts = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber"),
                                                      (F.col("l_orderkey") % 60).cast("decimal(18,6)"))
    end_txt = F.date_format(end_ts, "yyyy-MM-dd HH:mm:ss")
    version = F.when(F.col("l_orderkey") % 7 == 0, F.lit("")).otherwise(
        F.concat(F.lit("V"), _str(F.col("l_orderkey") % 2)))
    disc = F.when(F.col("l_discount") == 0, F.lit("")).otherwise(_dec2("l_discount"))
    tax = F.when(F.col("l_tax") == 0, F.lit("")).otherwise(_dec2("l_tax"))
    head = [product_txt, serial, station_id_expr(), status, start_txt, end_txt]
    items = [_dec2("l_quantity"), _dec2("l_extendedprice"), disc, tax]
    return F.when(s % 2 == 0, F.concat_ws(",", *head, version, *items)).otherwise(
        F.concat_ws(",", *head, *items))


def render_lines(lineitem: DataFrame, bad: bool = False) -> DataFrame:
    """``LINES`` (file_path, csv_file, line_no, value) for one file per supplier."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                         "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    least = int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = split_groups_sequence(li, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"], "seq",
                                     num_partitions=max(least, -(-lineitem.count() // TASK_ROWS)))
    data = numbered.select("l_suppkey", (F.col("seq") + 7).alias("line_no"),
                           _data_value(bad).alias("value"))
    pre = _preamble(li.select("l_suppkey").distinct())
    both = pre.unionByName(data)
    name = F.concat(F.lit("f"), _str(_s()), F.lit(".csv"))
    return both.select(F.concat(F.lit(RENDER_ROOT + "/"), name).alias("file_path"),
                       name.alias("csv_file"), F.col("line_no").cast("long").alias("line_no"),
                       "value")


def damaged(lines: DataFrame) -> DataFrame:
    """Rendered lines with one kind of fault per file, by the number in its name modulo 8: 1 no station
    fields, 2 no version after the colon, 3 an empty version list, 4 only five lines, 5 a data line
    longer than the header, 6 a short line of upper limits, 7 a blank data line."""
    number = F.regexp_extract("csv_file", r"(\d+)", 1).cast("int")
    kind, line, value = number % 8, F.col("line_no"), F.col("value")
    kept = F.when(number % 2 == 0, 9).otherwise(8)  # the common columns and two items
    out = (F.when((line == 1) & (kind == 1), F.lit(",,,"))
            .when((line == 1) & (kind == 2), F.lit("ST,Version"))
            .when((line == 1) & (kind == 3), F.lit("ST,Version:;"))
            .when((line == 9) & (kind == 5), F.concat(value, F.lit(",more")))
            .when((line == 5) & (kind == 6), F.array_join(F.slice(F.split(value, ","), F.lit(1), kept), ","))
            .when((line == 8) & (kind == 7), F.lit(""))
            .otherwise(value))
    return lines.where((kind != 4) | (line <= 5)).withColumn("value", out)


def load_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")
