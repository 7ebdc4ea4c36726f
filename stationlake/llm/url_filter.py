"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` together with the literal tokens
that every match contains. Each rule is filed under the one of its tokens that the
fewest URLs have; a URL fetches the rules filed under its own tokens by an equi-join,
and only those run their regular expression. The best-ranked match of a URL wins.

Rules are given as such or as lines of a filter list (:func:`rules_of`). A rule none of whose tokens
is whole in every match is filed where each URL fetches it.

Null URLs and URLs without ``://`` have an empty host and path and no tokens, so no
rule fits them and the default verdict holds. Repeated rows are judged each on its
own; other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import ascii_lower

#: Up to so many rules are broadcast as the index; larger sets are joined by a shuffle.
BROADCAST_RULES = 100_000
#: Where rules without any whole token are filed; no URL has it of itself.
EVERY = "*"


@dataclass(frozen=True)
class Rule:
    """``name`` is reported (null for keyword rules); the highest ``rank`` wins."""

    name: str | None
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int


def host_path_rule(verdict: str, rule: str) -> Rule:
    """``example.net/en/``: that host and its subdomains, paths that start so.

    Longer rules rank higher. Keyword rules rank below all of these."""
    tokens = tuple(t for t in re.split(r"[^a-z0-9]+", rule.lower()) if t)
    host, slash, path = rule.partition("/")
    pattern = rf"^(?:[^/?#]*\.)?{re.escape(host)}{re.escape(slash + path)}"
    return Rule(rule, pattern, tokens, verdict, 1000 + len(rule))


def keyword_rule(verdict: str, keyword: str) -> Rule:
    """A host with a label that holds ``keyword`` between dots, hyphens or its ends."""
    tokens = tuple(t for t in re.split(r"[^a-z0-9]+", keyword) if t)
    return Rule(None, rf"^[^/]*?(?<![a-z0-9]){re.escape(keyword)}(?![a-z0-9])[^/]*(?:/|$)", tokens, verdict, len(keyword))


def _whole_tokens(body: str, opens: bool, closes: bool) -> tuple[str, ...]:
    """The tokens that every match of a list rule has whole: what touches a wildcard or an end
    without an anchor may be a part of a longer token."""
    found = []
    parts = body.split("*")
    for i, part in enumerate(parts):
        for m in re.finditer("[a-z0-9]+", part):
            left = m.start() > 0 or (i == 0 and opens)
            right = m.end() < len(part) or (i == len(parts) - 1 and closes)
            if left and right:
                found.append(m.group())
    return tuple(dict.fromkeys(found))


def list_rule(line: str) -> Rule | None:
    """A line of a filter list as a rule over host and path, in any case of letters:
    ``||`` begins a host or one of its subdomains, ``|`` is the start (a scheme after it is left out) or
    the end, ``*`` any text, ``^`` a separator or the end, ``@@`` before a rule an exception, which outranks
    all others; of equals the longer rule wins. Blank lines, comments (``!``, ``[``) and rules on
    elements of a page (``##``, ``#@#``) give None; options (``$``) are refused: they ask for more than a URL."""
    name = line.strip()
    if not name or name[0] in "![" or "##" in name or "#@#" in name:
        return None
    if "$" in name:
        raise ValueError(f"options of a filter rule are not supported: {name}")
    allow = name.startswith("@@")
    body = name[2 * allow:].lower()
    host, start = body.startswith("||"), body.startswith("|")
    body = re.sub("^[a-z]+://", "", body[1 + host:]) if start else body
    end = body.endswith("|")
    body = body[:-1] if end else body
    if not body.strip("*"):
        raise ValueError(f"a filter rule without text: {name}")
    pattern = "".join(".*" if c == "*" else r"(?:[^a-z0-9_.%-]|\z)" if c == "^" else re.escape(c) for c in body)
    opening = r"^(?:[^/?#]*\.)?" if host else "^" if start else ""
    closing = r"\z" if end else ""
    rank = (2_000_000 if allow else 1_000_000) + len(name)
    return Rule(name, f"(?si){opening}{pattern}{closing}", _whole_tokens(body, start, end), "allow" if allow else "block", rank)


def rules_of(lines: list[str]) -> list[Rule]:
    """The rules of a filter list, each once."""
    return list(dict.fromkeys(r for r in map(list_rule, lines) if r))


CONTRACT_RULES = [
    host_path_rule("block", "net/"),
    host_path_rule("allow", "example.net/en/"),
    host_path_rule("block", "example.com/de/"),
    host_path_rule("allow", "org/fr/"),
]
KEYWORD_RULES = [keyword_rule("block", k) for k in (
    "casino", "cheap-pills", "free-bets", "poker", "porn", "spam-farm", "viagra", "xxx")]
DEFAULT_VERDICT = "allow"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def with_parts(pages: DataFrame) -> DataFrame:
    host, path = split_url(pages["url"])
    return pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"))


def _tokens() -> Column:
    return F.array_distinct(F.split(ascii_lower(F.concat("host", "path")), "[^a-z0-9]+", -1))


def rarest_tokens(urls: DataFrame, rules: list[Rule]) -> dict[Rule, str]:
    """Counts only tokens that some rule has: at most one row for each comes back."""
    spark = urls.sparkSession
    wanted = sorted({t for r in rules for t in r.tokens})
    known = spark.createDataFrame([(t,) for t in wanted], "token string")
    found = urls.select(F.explode(_tokens()).alias("token")).join(_small(known, wanted), "token") \
        .groupBy("token").count().collect()
    count = {r["token"]: r["count"] for r in found}
    return {r: min(r.tokens, key=lambda t: (count.get(t, 0), t), default=EVERY) for r in rules}


def _small(df: DataFrame, rows: list) -> DataFrame:
    return F.broadcast(df) if len(rows) <= BROADCAST_RULES else df


def judge(pages: DataFrame, rules: list[Rule] = CONTRACT_RULES + KEYWORD_RULES,
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url)."""
    spark = pages.sparkSession
    urls = with_parts(pages)
    token = rarest_tokens(urls, rules)
    ranked = sorted(rules, key=lambda r: (r.rank, r.pattern))
    index = spark.createDataFrame([(token[r], i, r.pattern) for i, r in enumerate(ranked)],
                                  "token string, rule_no int, pattern string")
    outcome = spark.createDataFrame([(i, r.name, r.verdict) for i, r in enumerate(ranked)],
                                    "rule_no int, rule string, verdict string")
    # rules without a whole token are filed under one that every URL has
    tokens = F.array_append(_tokens(), F.lit(EVERY)) if EVERY in token.values() else _tokens()
    fits = F.when(F.expr("concat(host, path) rlike pattern"), F.col("rule_no"))
    best = urls.withColumn("row", F.monotonically_increasing_id()) \
        .select("*", F.explode(tokens).alias("token")) \
        .join(_small(index, ranked), "token", "left") \
        .groupBy("row", "page_id", "host", "path").agg(F.max(fits).alias("rule_no"))
    return best.join(_small(outcome, ranked), "rule_no", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def oracle_sql() -> str:
    """DuckDB SQL: every rule tried on every URL, without an index."""
    hp = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    hp.sort(key=lambda r: -len(r[0] + r[1]))
    fit = {r: f"((host = '{r[0]}' or ends_with(host, '.{r[0]}')) and starts_with(path, '{r[1]}'))" for r in hp}
    rule = " ".join(f"when {fit[r]} then '{r[0] + r[1]}'" for r in hp)
    verdict = " ".join(f"when {fit[r]} then '{r[2]}'" for r in hp)
    words = "|".join(r"cheap-pills free-bets spam-farm casino poker porn viagra xxx".split())
    spam = f"regexp_matches(lower(host), '(^|[^a-z0-9])({words})([^a-z0-9]|$)')"
    return f"""
with r as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
u as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r)
select page_id, host, path, case {rule} end as rule,
    case {verdict} when {spam} then 'block' else '{DEFAULT_VERDICT}' end as verdict from u"""
