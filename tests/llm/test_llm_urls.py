import re

import pytest
from brute_llm import lower
from ebbline.llm import urls
from ebbline.llm.urls import HOST_RULES, PATTERN_RULES, HostRule, PatternRule

URLS = [
    "http://a.example.net/en/1", "https://example.net/en/", "http://example.net/de/", "http://net/", "http://net",
    "http://x.NET/y?z#f", "http://www.example.com/de/x", "http://www.example.com/en/x", "http://example.org/fr/1",
    "http://spam-farm.example.org/en/1", "http://spam-farm.example.org/fr/1", "http://notspam-farm.org/x", "http://a.spam-farm.b/",
    "http://e.org/x/robots.txt", "http://e.org/spam/wp-login.php", "http://e.org/a?sessionid=3", "http://e.org/a&sessionid=3",
    "http://e.org/setup.EXE", "http://e.org/setup.exe?x=1", "http://e.org/%00", "http://e.org/100%0012", "no scheme", "", None, None,
    "http://", "://net/x", "http://a://net/x", "http://e.org/cgi-bin/x\ny", "HTTP://WP-LOGIN.org/WP-LOGIN.PHP",
    "http://casino.e.org/robots.txt", "http://e.org/" + "x" * 20000, "http://e.net.org/", "http://fakenet/", "http://example.com/desk",
]


def judged(url, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = lower(host)
    fits = [
        r for r in host_rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ] if url is not None else []
    best = max(fits, key=lambda r: (len(r.name), r.name), default=None)
    hits = [r for r in pattern_rules if url is not None and re.search(r.regex(), lower(url))]
    method = min((r.verdict for r in hits), default="allow")
    return host, path, best and best.name, best.verdict if best else method


def pages(spark, values):
    rows = [(None if i % 9 == 8 else i, url, "<html>", "clash", "clash") for i, url in enumerate(values)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, key string")


def sortable(rows):
    return sorted(tuple("" if v is None else str(v) for v in row) for row in rows)


def test_odd_urls(spark):
    found = urls.judge_urls(pages(spark, URLS * 2)).collect()
    expected = [(None if i % 9 == 8 else i, *judged(u)) for i, u in enumerate(URLS * 2)]
    assert sortable((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found) == sortable(expected)


def test_other_rules_and_none(spark):
    rules = (HostRule("org", "/", "allow"),), (PatternRule("|http://e."), PatternRule("*e*net*"), PatternRule("^x^"))
    for hosts, patterns in (rules, ((), rules[1]), (rules[0], ()), ((), ())):
        found = urls.judge_urls(pages(spark, URLS), hosts, patterns).collect()
        expected = [(None if i % 9 == 8 else i, *judged(u, hosts, patterns)) for i, u in enumerate(URLS)]
        assert sortable((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found) == sortable(expected)


def test_empty_table(spark):
    assert urls.judge_urls(pages(spark, [])).collect() == []


def test_tokens_are_whole_runs():
    assert PatternRule("||spam-farm.").tokens() == {"spam", "farm"}
    assert PatternRule("/wp-login.php*foo^bar").tokens() == {"wp", "login", "bar"} - {"bar"}
    assert PatternRule("banner").tokens() == set()
    assert PatternRule("|http://ad.").tokens() == {"http", "ad"}


def test_rules_are_filed_under_their_rarest_token(spark):
    frame = pages(spark, ["http://spam.org/farm", "http://spam.org/x", "http://spam-farm.org/"])
    counts = urls.token_counts(frame, "url", {"spam", "farm", "none"})
    assert counts == {"spam": 3, "farm": 2}
    index = urls.rule_index(spark, [], [PatternRule("||spam-farm."), PatternRule("banner")], counts).collect()
    assert [(r["key"], r["rule"]) for r in index] == [("farm", "||spam-farm."), (urls.ANY, "banner")]


@pytest.mark.parametrize("limit", [0, 4_000_000])
def test_index_is_broadcast_only_while_small(spark, monkeypatch, limit):
    monkeypatch.setattr(urls, "BROADCAST_BYTES", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = urls.judge_urls(pages(spark, URLS))
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (limit > 0)
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
        assert len(frame.collect()) == len(URLS)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
