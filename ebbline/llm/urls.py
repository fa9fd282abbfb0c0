"""URL filters: host rules by longest fit, and pattern rules indexed by their rarest token.

A host rule (host, path prefix) fits its host and all subdomains; the longest rule that fits decides.
Other URLs are left to pattern rules in the notation of public ad-block lists: ``||`` starts at the
host or one of its subdomains, ``|`` is an end of the URL, ``*`` any characters and ``^`` a separator
or the end. Every pattern has literal tokens that any matching URL must hold as whole runs of letters
and digits. The rule is filed under the one that is rarest among the URLs at hand; the tokens of a URL
fetch the rules filed under them, and only those run their regular expression. Patterns without such
a token are filed under a key that every URL has. ``allow`` patterns are exceptions to ``block`` ones.

The rules are configuration and small; their index is broadcast only while its size stays below
``BROADCAST_BYTES``. URLs are judged once each and joined back to their pages.

A null URL, or one without ``://``, has an empty host and path and fits no rule with a host. Repeated
pages get a row each. Empty tables and empty rule lists are fine.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbline.llm.text import lower_ascii, plain

BROADCAST_BYTES = 4_000_000
# Filed under this key: rules without a token. No URL token can be like it.
ANY = "*"
TOKEN = "[a-z0-9]+"
INDEX = "key string, rule string, kind string, host string, path string, regex string, verdict string"


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    pattern: str
    verdict: str = "block"

    def regex(self) -> str:
        body, start, end = self.pattern, "", ""
        if body.startswith("||"):
            body, start = body[2:], "^[a-z][a-z0-9+.-]*://([^/?#]*[.])?"
        elif body.startswith("|"):
            body, start = body[1:], "^"
        if body.endswith("|"):
            body, end = body[:-1], "$"
        special = {"*": ".*", "^": "([^a-z0-9_.%-]|$)"}
        return "(?s)" + start + "".join(special.get(c) or re.escape(c) for c in body) + end

    def tokens(self) -> set[str]:
        """Runs of letters and digits with a fixed border on both sides."""
        return set(re.findall(rf"(?<![a-z0-9*]){TOKEN}(?![a-z0-9*])", "*" + self.pattern + "*"))


HOST_RULES = (
    HostRule("net", "/", "block"),
    HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"),
    HostRule("org", "/fr/", "allow"),
)
PATTERN_RULES = (
    PatternRule("||spam-farm."),
    PatternRule("||casino."),
    PatternRule("/wp-login."),
    PatternRule("/cgi-bin/"),
    PatternRule("?sessionid="),
    PatternRule("&sessionid="),
    PatternRule(".exe|"),
    PatternRule("%00"),
    PatternRule("/robots.txt|", "allow"),
)


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(plain(url), "://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(plain(url), "://[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower_ascii(plain(url)), F.lit(f"({TOKEN})"), 1))


def token_counts(urls: DataFrame, url: str, wanted: set[str]) -> dict[str, int]:
    """In how many rows each wanted token occurs; as many rows at most as there are wanted tokens."""
    if not wanted:
        return {}
    listed = urls.sparkSession.createDataFrame([(t,) for t in sorted(wanted)], "token string")
    held = urls.select(F.explode(url_tokens(F.col(url))).alias("token")).join(_small(listed, wanted), "token")
    return {row["token"]: row["n"] for row in held.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}


def _small(df: DataFrame, rows) -> DataFrame:
    return F.broadcast(df) if sum(len(str(row).encode()) for row in rows) <= BROADCAST_BYTES else df


def rule_index(
    spark: SparkSession, host_rules: list[HostRule], pattern_rules: list[PatternRule], counts: dict[str, int]
) -> DataFrame:
    """One row per rule under its key: the host, or the rarest token by ``counts`` (ties: first in order)."""
    rows = [("host " + r.host, r.name, "host", r.host, r.path, None, r.verdict) for r in host_rules]
    for rule in pattern_rules:
        key = min(rule.tokens(), key=lambda token: (counts.get(token, 0), token), default=ANY)
        rows.append((key, rule.pattern, "pattern", None, None, rule.regex(), rule.verdict))
    return _small(spark.createDataFrame(rows, INDEX), rows)


def judge_urls(
    pages: DataFrame,
    host_rules: tuple[HostRule, ...] = HOST_RULES,
    pattern_rules: tuple[PatternRule, ...] = PATTERN_RULES,
    page: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: host, path, the host rule that decides (else null), the pattern, the verdict."""
    rows = pages.select(F.col(page).alias("page_id"), F.col(url).cast("string").alias("url"))
    wanted = set().union(*[r.tokens() for r in pattern_rules])
    index = rule_index(
        pages.sparkSession, list(host_rules), list(pattern_rules), token_counts(rows, "url", wanted)
    )
    labels = "split(host, '[.]')"
    suffixes = F.expr(f"transform(sequence(1, size({labels})), i -> 'host ' || array_join(slice({labels}, i, size({labels})), '.'))")
    urls = rows.select("url").where("url IS NOT NULL").distinct()
    keys = F.concat(suffixes, url_tokens(F.col("url")), F.array(F.lit(ANY)))
    keyed = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    keyed = keyed.select("url", "path", F.explode(F.array_distinct(keys)).alias("key"))
    candidates = keyed.join(index.withColumnRenamed("path", "prefix"), "key")
    fits = F.when(F.col("kind") == "host", F.startswith("path", "prefix")).otherwise(
        F.regexp_like(lower_ascii(F.col("url")), F.col("regex"))
    )
    by_host, by_pattern = F.col("kind") == "host", F.col("kind") == "pattern"
    ranked = F.struct(F.char_length("rule").alias("length"), "rule", "verdict")
    # 'allow' sorts before 'block', so the smallest pattern verdict is the exception if there is one.
    decided = (
        candidates.where(fits)
        .groupBy("url")
        .agg(
            F.max(F.when(by_host, ranked)).alias("by_host"),
            F.min(F.when(by_pattern, F.struct("verdict", "rule"))).alias("by_pattern"),
        )
    )
    return rows.join(decided, "url", "left").select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("by_host.rule").alias("rule"),
        F.coalesce("by_host.verdict", "by_pattern.verdict", F.lit("allow")).alias("verdict"),
        F.col("by_pattern.rule").alias("pattern"),
    )
