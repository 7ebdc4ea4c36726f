"""Mixing sources to target weights by capped water-filling.

Sources, in code-point order with null last, weigh ``weights`` in turn and share the
words of the whole corpus in proportion. A source whose share is above ``epochs`` times
its own words is clamped there and the excess is dealt again to the others by weight,
until none is above. A source's target is met by whole repetitions of all its documents
and one fractional repetition: in a seeded order, documents are taken once more until
the target is reached; the last one is taken in part (its first words).

The running sums of the seeded order are built from sums of small hash buckets, so a
source with a third of all documents is spread like any other. Null text has size 0
and takes 0 words; sources without words get target 0. Repeated rows count each on
their own. An empty table gives an empty result; other columns pass through ``mix`` unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import WORD_PATTERN, parts, staged, text_or_empty

WEIGHTS, EPOCHS, SEED, BUCKET = (5, 2, 1), 3, 17, 2048
_ROW_BITS = (1 << 33) - 1


def size_of(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_PATTERN)).cast("long")


def ranked(df: DataFrame, order: Column) -> DataFrame:
    """Adds ``rank`` from 0 in the given order without gathering the rows in one task:
    rows are range-partitioned, and only the partitions' counts are summed in order."""
    placed = staged(df.repartitionByRange(order).sortWithinPartitions(order).select(
        "*", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("row")), "ranked")
    counts = placed.groupBy("part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("part", before.alias("before"))  # one row for each partition
    return placed.join(F.broadcast(offsets), "part").withColumn("rank", F.col("before") + F.col("row")).drop("part", "row", "before")


def water_level(sources: DataFrame, epochs: int) -> float:
    """The words that a unit of weight gets. Only sums come to the driver."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = -1.0
    while True:
        above = F.col("weight") * F.lit(level) > F.col("source_size") * epochs
        row = sources.agg(F.sum(F.when(above, F.col("source_size") * epochs).otherwise(0)).alias("capped"),
                          F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight")).first()
        new = (total - row["capped"]) / row["weight"] if row["weight"] else level
        if new <= level:
            return max(level, 0.0)
        level = new


def targets(sized: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target and how it is met: whole repetitions and the words beyond them."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = ranked(sources, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    sources = staged(sources.select("source", "source_size", weight.alias("weight")), "sources")
    level = water_level(sources, epochs)
    target = F.least(F.col("weight") * F.lit(level), (F.col("source_size") * epochs).cast("double"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0).cast("long")
    out = sources.withColumn("target", target).withColumn("whole", whole)
    return out.select("source", "source_size", "target", "whole",
                      (F.floor("target").cast("long") - F.col("whole") * F.col("source_size")).alias("beyond"))


def mix(docs: DataFrame, sized: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, source, size and any others) with source_size, target, ``whole`` (repetitions
    of the document), ``part`` (words of it taken once more) and taken = whole * size + part.
    ``sized``: the same rows' doc_id, source and size, from which the sums are taken."""
    spark = docs.sparkSession
    buckets = parts(spark, sized.count(), BUCKET)
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    bucket = F.floor(F.conv(F.substring("mix_order", 1, 8), 16, 10).cast("long") * buckets / (1 << 32)).cast("int")

    # never null, so that the running sums and the join below share one dealing of the rows
    key = F.when(F.col("source").isNull(), F.lit("none")).otherwise(F.concat(F.lit("s-"), F.col("source"))).alias("mix_source")

    def placed(df: DataFrame) -> DataFrame:
        return df.select("*", key).withColumn("mix_order", order).withColumn("mix_bucket", bucket)

    sums = placed(sized).groupBy("mix_source", "mix_bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("mix_source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("mix_source", "mix_bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_before"))
    sums = sums.join(targets(sized, weights, epochs).select("*", key).drop("source"), "mix_source")
    inside = Window.partitionBy("mix_source", "mix_bucket").orderBy("mix_order", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    rows = placed(docs).withColumn("inside_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums, ["mix_source", "mix_bucket"])
    before = F.col("bucket_before") + F.col("inside_before")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("beyond") - before))
    return rows.withColumn("part", part).withColumn("taken", F.col("whole") * F.col("size") + F.col("part")) \
        .drop("mix_source", "mix_order", "mix_bucket", "inside_before", "bucket_before", "beyond")


def plan(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, whole, part and taken of every row of ``docs``."""
    sized = staged(docs.select("doc_id", "source", size_of(docs["text"]).alias("size")), "sizes")
    return mix(sized, sized, weights, epochs, seed)


def apply(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed corpus in the columns of ``docs``: ``whole`` copies of a row, and one of its
    first ``part`` words, with the white space before and between them, where that is above 0 (the
    whole text where it is all of them)."""
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])  # whatever its columns are called
    at = {c: F.col(f"c{names.index(c)}") for c in ("doc_id", "source", "text")}
    own = [at["doc_id"].alias("doc_id"), at["source"].alias("source"), size_of(at["text"]).alias("size")]
    mixed = mix(flat.select("*", *own), staged(flat.select(*own), "sizes"), weights, epochs, seed)
    copies = F.array_repeat(F.col("size"), F.col("whole").cast("int"))
    taken = F.when(F.col("part") > 0, F.concat(copies, F.array("part"))).otherwise(copies)
    rows = mixed.select(*flat.columns, "size", F.explode(taken).alias("words"))
    spaced = F.regexp_extract_all(at["text"], F.lit(WORD_PATTERN.replace("^", "").replace("+", "*") + WORD_PATTERN), F.lit(0))  # words with what precedes them
    first = F.array_join(F.slice(spaced, 1, F.col("words").cast("int")), "")
    cut = F.col("words") < F.col("size")
    new = {"text": F.when(cut, first).otherwise(at["text"])}
    if "n_chars" in names:
        old = F.col(f"c{names.index('n_chars')}")
        new["n_chars"] = F.when(cut, F.length(first).cast(docs.schema["n_chars"].dataType)).otherwise(old)
    return rows.select(*[new.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(names)])


def oracle_sql() -> str:
    return f"""
with recursive d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size,
    ([{', '.join(map(str, WEIGHTS))}])[((row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1)::int] as weight from d group by source),
level as (select -1::double as v, 0 as step
    union all
    select (select (sum(source_size) - sum(case when weight * v > source_size * {EPOCHS} then source_size * {EPOCHS} else 0 end))::double
            / sum(case when weight * v > source_size * {EPOCHS} then 0 else weight end) from s), step + 1
    from level where step < 50),
goal as (select source, source_size, least(weight * (select max(v) from level), (source_size * {EPOCHS})::double) as target from s),
g as (select *, case when source_size > 0 then floor(floor(target) / source_size) else 0 end::bigint as whole from goal),
o as (select d.doc_id, d.source, d.size, g.source_size, g.target, g.whole, floor(g.target)::bigint - g.whole * g.source_size as beyond,
    coalesce(sum(size) over (partition by d.source order by md5('{SEED}:' || d.doc_id), d.doc_id, size
        rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from d join g on d.source is not distinct from g.source)
select doc_id, size, source_size, target, (whole * size + greatest(0, least(size, beyond - before)))::bigint as taken from o"""
