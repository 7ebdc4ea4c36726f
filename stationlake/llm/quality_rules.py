"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over the whole text; each row of ``RULES``
becomes one comparison of the same projection, so a document is read once and no
user function runs.

Null text counts as empty. An empty or blank text has no words and fails the base
rule. Repeated rows are judged each on its own; any other input columns are ignored
by :func:`judge` unless listed in ``keep``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import WORD_PATTERN, let, text_or_empty

#: Measures that count the matches of a pattern.
COUNTED = {"n_symbols": r"[#*$%&|<>]", "n_bangs": "!", "n_capitals": r"\p{Lu}"}
#: Very frequent words of the languages the rules are meant for.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "on", "was",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "im", "ein",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "du", "est",
    "el", "los", "las", "y", "se", "por", "para", "no",
)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: (name, measure, divided by, least, most); a null bound is open.
RULES: list[tuple[str, str, str, float | None, float | None]] = [
    ("word_length", "word_chars", "n_words", 2.0, 12.0),
    ("symbol_ratio", "n_symbols", "n_words", None, 0.10),
    ("bang_ratio", "n_bangs", "n_words", None, 0.30),
    ("capital_ratio", "n_capitals", "word_chars", None, 0.40),
    ("stop_word_ratio", "n_stop_words", "n_words", 0.02, None),
    ("dup_line_ratio", "n_dup_lines", "n_lines", None, 0.50),
    ("repeat_ratio", "n_repeat_words", "n_words", None, 0.40),
]
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_bangs", "n_capitals", "n_stop_words", "n_lines")


#: Up to so many different repeated windows are looked up one by one, more by a sort with places.
FEW = 16


def _covered(places: Column) -> Column:
    """Words under the 3-word windows that start at the sorted ``places``."""
    steps = F.transform(places, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - x, F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def _sorted_places(windows: Column) -> Column:
    """Places of the hashes that stand twice or more: equal neighbours after a sort."""
    def repeated(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    return let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated)


def measured(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The measures of the threshold table over whole texts, in columns of their own.

    ``twice`` holds the hashes of the 3-word windows that stand twice or more; only
    texts that have some look for their places."""
    text = text_or_empty(docs["text"])
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    words, windows, ordered, twice = (F.col(c) for c in ("words", "windows", "ordered", "twice"))
    df = docs.select(
        *[docs[c] for c in keep],
        F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0)).alias("words"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                      (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("lines"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        *[F.regexp_count(text, F.lit(p)).cast("long").alias(c) for c, p in COUNTED.items()],
    )
    rest = [*keep, "lines", "word_chars", *COUNTED]
    df = df.select(
        *rest, F.size(words).cast("long").alias("n_words"),
        F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS, *[w.title() for w in STOP_WORDS]))).cast("long").alias("n_stop_words"),
        F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
                1, F.greatest(F.size(words) - 2, F.lit(0))).alias("windows"))
    rest += ["n_words", "n_stop_words", "windows"]
    df = df.select(*rest, F.sort_array(windows).alias("ordered"))
    df = df.select(*rest, F.array_distinct(F.filter(ordered, lambda h, i: h == F.get(ordered, i - 1))).alias("twice"))
    places = F.when(F.size(twice) <= FEW, F.filter(F.sequence(F.lit(0), F.size(windows) - 1),
                                                   lambda i: F.array_contains(twice, F.get(windows, i)))) \
        .otherwise(_sorted_places(windows))
    repeats = F.when(F.size(twice) == 0, F.lit(0).cast("long")).otherwise(let(places, _covered))
    return df.select(*keep, "lines.*", *rest[len(keep) + 1:-1], repeats.alias("n_repeat_words"))


def compiled(rules=RULES) -> Column:
    """The threshold table as one condition over the measure columns."""
    verdict = F.lit(True)
    for _, value, by, least, most in rules:
        if least is not None:
            verdict = verdict & (F.col(value) >= F.lit(least) * F.col(by))
        if most is not None:
            verdict = verdict & (F.col(value) <= F.lit(most) * F.col(by))
    return verdict


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), rules=RULES) -> DataFrame:
    """Columns ``keep``, all measures, ``base_failed`` and ``kept`` for every row of ``docs``."""
    df = measured(docs, keep)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.select(*keep, *MEASURES, failed.alias("base_failed"), (~failed & compiled(rules)).alias("kept"))


def oracle_sql(rules=RULES) -> str:
    """The same table as DuckDB SQL, windows counted by plain grouping."""
    tests = []
    for _, value, by, least, most in rules:
        if least is not None:
            tests.append(f"{value} >= {least} * {by}")
        if most is not None:
            tests.append(f"{value} <= {most} * {by}")
    stop = ", ".join(f"'{w}'" for w in (*STOP_WORDS, *[w.title() for w in STOP_WORDS]))
    counted = ", ".join(f"len(regexp_extract_all(text, '{p}'))::bigint as {c}" for c, p in COUNTED.items())
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
w as (select rid, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from d),
win as (select rid, i, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c
    from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from w)),
rep as (select rid, i from win qualify count(*) over (partition by rid, a, b, c) > 1),
cov as (select rid, count(distinct i + o) as n from rep, (values (0), (1), (2)) as t(o) group by rid),
m as (select doc_id, len(ws)::bigint as n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    {counted},
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(cov.n, 0)::bigint as n_repeat_words,
    len(list_filter(ws, lambda x: x in ({stop})))::bigint as n_stop_words,
    len(ls)::bigint as n_lines from w left join cov using (rid)),
f as (select *, (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) as base_failed from m)
select *, (not base_failed and {' and '.join(tests)}) as kept from f"""
