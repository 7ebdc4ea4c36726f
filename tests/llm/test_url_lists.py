import re

import pytest

from stationlake.llm import url_filter

LINES = ["! a comment", "", "[List 1.0]", "example.com##.ad", "||ads.example.com^", "@@||ads.example.com/allowed/", "/banner/*/img^",
         "|http://start.net/x", "swf|", "||shop.example.net^*promo", "track", "@@|https://start.net/x/fine|", "||UPPER.org/Path", "ads.example.com^",
         "/ad-1.", "||ads.example.com^"]
URLS = ["http://ads.example.com/", "http://ads.example.com", "https://m.ads.example.com:80/z", "http://badads.example.com/", "http://ads.example.com.evil.net/",
        "http://ads.example.com/allowed/1", "http://a.net/banner/foo/img", "http://a.net/banner/foo/img?x", "http://a.net/banner/foo/imgs",
        "http://a.net/banner/img", "http://start.net/xyz", "http://a.start.net/x", "https://start.net/x/fine", "https://start.net/x/finer",
        "http://a.net/movie.swf", "http://a.net/movie.swfx", "http://shop.example.net/a/PROMOtion", "http://shop.example.net/promo", "http://a.net/mytracker.js",
        "http://upper.org/path/1", "http://upper.org/PATH", "http://a.net/ad-1.gif", "http://a.net/bad-1.gif", "http://a.net/ad-1", "http://clean.net/",
        "no scheme track", None, "", "http://a.net/\nswf", "http://é.net/é/track"]


def _split(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    whole = re.split("[?#]", rest)[0]
    host, slash, path = whole.partition("/")
    return host.lower() + slash + path


def _fits(line, text):
    """One rule on one URL by trying every start, without an index or the rule's own expression."""
    body, text = line.removeprefix("@@").lower(), text.lower()
    starts = range(len(text) + 1)
    if body.startswith("||"):
        body, host = body[2:], text.split("/")[0]
        starts = [0] + [i + 1 for i, c in enumerate(host) if c == "."]
    elif body.startswith("|"):
        body, starts = body[1:].split("://", 1)[-1], [0]
    end, body = body.endswith("|"), body.removesuffix("|")

    def read(b, t):
        if not b:
            return not end or not t
        if b[0] == "*":
            return any(read(b[1:], t[i:]) for i in range(len(t) + 1))
        if b[0] == "^":
            if not t:
                return read(b[1:], t)
            return not re.match(r"[a-z0-9_.%-]", t[0]) and read(b[1:], t[1:]) or False
        return t[:1] == b[0] and read(b[1:], t[1:])

    return any(read(body, text[i:]) for i in starts)


def test_a_filter_list_against_every_rule_on_every_url(spark):
    rules = url_filter.rules_of(LINES)
    names = [r.name for r in rules]
    assert len(names) == len(set(names)) == 11
    assert any(not r.tokens for r in rules) and any(r.tokens for r in rules)
    pages = spark.createDataFrame(list(enumerate(URLS + URLS[:4])), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    assert len(got) == len(URLS) + 4
    for i, url in enumerate(URLS + URLS[:4]):
        fit = [r for r in rules if _split(url) and _fits(r.name, _split(url))]
        best = max(fit, key=lambda r: (r.rank, r.pattern), default=None)
        assert got[i] == ((best.name, best.verdict) if best else (None, "allow")), url
    assert {r for r, _ in got.values()} > {"||ads.example.com^", "track", "swf|", "/ad-1.", None}


def test_tokens_of_a_list_rule_are_whole_in_every_match():
    tokens = {line: url_filter.list_rule(line).tokens for line in LINES if url_filter.list_rule(line)}
    assert tokens["||ads.example.com^"] == ("ads", "example", "com")
    assert tokens["/banner/*/img^"] == ("banner", "img") and tokens["track"] == () and tokens["swf|"] == ()
    assert tokens["||shop.example.net^*promo"] == ("shop", "example", "net")
    assert tokens["ads.example.com^"] == ("example", "com")
    assert tokens["|http://start.net/x"] == ("start", "net")


@pytest.mark.parametrize("line", ["||a.com^$third-party", "*", "|", "@@||"])
def test_lines_that_are_no_rule_of_urls_are_refused(line):
    with pytest.raises(ValueError):
        url_filter.list_rule(line)
