"""URL filter: rules indexed by their rarest literal token (DataFrame functions only).

Every rule names the literal tokens (runs of a-z and 0-9, in lower case) that stand whole in any URL
it fits. It is indexed under the one that the table's URLs contain least; a rule without such a token
is indexed under ANY, which every URL has. A URL's tokens fetch its candidate rules by an equi-join,
and only those run their regular expression, on host and path.

Defined cases: a null URL or one without "://" has an empty host and path, fits no rule and is
allowed; repeated URLs are judged once and each row gets the verdict; an empty table gives an empty
result; extra columns are kept unless they bear a result's name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.session import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ANY = "*"
BROADCAST_RULES = 20_000  # index entries; each is some hundred bytes, so a few MB at most
RESULTS = ("host", "path", "rule", "verdict", "word_rule")


@dataclass(frozen=True)
class Rule:
    name: str
    action: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool  # a site rule (the longest decides) or a word rule (decides where no site rule fits)


def site_rule(action: str, rule: str) -> Rule:
    """host/path: fits the host and its subdomains where the path starts with the rule's; only a host: all its paths."""
    lower = str.maketrans(UPPER, LOWER)
    host, slash, path = rule.partition("/")
    host = host.translate(lower)
    # the path's last run of letters and digits may go on in a URL, so that it is no whole token there
    whole = re.findall("[a-z0-9]+", host) + re.findall("[a-z0-9]+(?=[^a-z0-9])", (slash + path).translate(lower))
    return Rule(rule, action, rf"^(?:[^/]*\.)?{_quoted(host)}{_quoted(slash + path) or '(?:/|$)'}", tuple(whole), True)


def word_rule(action: str, name: str, pattern: str, *tokens: str) -> Rule:
    return Rule(name, action, pattern, tokens, False)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


#: The five site rules of the contract, and the word rules that judge the rest.
SITE_RULES = (
    site_rule("block", "com/en/"), site_rule("allow", "example.com/en/7"), site_rule("allow", "net/de/"),
    site_rule("block", "example.net/de/8"), site_rule("block", "org/es/"),
)
WORD_RULES = (
    word_rule("block", "casino", r"(^|[.-])casino(-[a-z0-9-]+)?\.[^/]*", "casino"),
    word_rule("block", "spam-farm", r"(^|\.)spam-farm\.[^/]*", "spam", "farm"),
    word_rule("block", "adult", r"(^|[.-])adult(-[a-z0-9-]+)?\.[^/]*", "adult"),
    word_rule("block", "login page", r"^[^/]*/(.*/)?login(/|$)", "login"),
    word_rule("block", "sign-in page", r"^[^/]*/(.*/)?signin(/|$)", "signin"),
    word_rule("block", "cart page", r"^[^/]*/(.*/)?cart(/|$)", "cart"),
    word_rule("block", "archive file", r"\.zip$", "zip"),
    word_rule("block", "program file", r"\.exe$", "exe"),
)


def host_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.length(rest) + 4, F.length(url))).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.length(rest) + 4, F.length(url))).otherwise("")
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(target: Column) -> Column:
    return F.array_union(F.split(F.translate(target, UPPER, LOWER), "[^a-z0-9]+"), F.array(F.lit(ANY)))


def rule_frame(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """rule, action, pattern, tokens, site: rules as a table."""
    rows = [(r.name, r.action, r.pattern, list(r.tokens), r.site) for r in rules]
    return spark.createDataFrame(rows, "rule string, action string, pattern string, tokens array<string>, site boolean")


def rule_index(urls: DataFrame, rules: DataFrame, small: bool) -> DataFrame:
    """The rules under their rarest token in urls (column target); ties go to the first token by name."""
    side = F.broadcast if small else (lambda df: df)
    tokens = F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit(ANY)))
    named = rules.select("rule", "action", "pattern", "site", F.explode(tokens).alias("token"))
    seen = urls.select(F.explode(_tokens(F.col("target"))).alias("token")).join(side(named.select("token").distinct()), "token", "left_semi").groupBy("token").count()
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)), "token"))
    best = named.join(seen, "token", "left").groupBy("rule", "action", "pattern", "site").agg(rarest.alias("rarest"))
    return best.select("rule", "action", "pattern", "site", F.length("rule").alias("length"), F.col("rarest.token").alias("token"))


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] | DataFrame = SITE_RULES + WORD_RULES, default: str = "allow") -> DataFrame:
    """pages (url, ...) with host, path, rule (the site rule that decides, else null), verdict and word_rule.

    rules: some rules, or a table of them as rule_frame makes it, for lists of any length.
    """
    small = not isinstance(rules, DataFrame) and len(rules) <= BROADCAST_RULES
    table = rules if isinstance(rules, DataFrame) else rule_frame(pages.sparkSession, rules)
    own = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in RESULTS]
    base = pages.select(F.struct(*own).alias("row"), F.col("url").alias("url"))
    hold = Scratch(pages.sparkSession)
    urls = hold.write(base.select("url").distinct().select("url", F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("target")), "urls")
    index = rule_index(urls, table, small)
    found = urls.select("url", "target", F.explode(_tokens(F.col("target"))).alias("token"))
    found = found.join(F.broadcast(index) if small else index, "token").filter(F.rlike(F.col("target"), F.col("pattern")))
    best = found.groupBy("url").agg(
        F.max(F.when(F.col("site"), F.struct("length", "rule", "action"))).alias("site"),
        F.min(F.when(~F.col("site"), F.struct("rule", "action"))).alias("word"),
    )
    best = hold.write(best, "verdicts")  # a written table on either side, so that a hot URL's rows can be split
    hold.drop(urls)
    judged = base.join(best, "url", "left")
    return judged.select(
        "row.*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("site.rule").alias("rule"),
        F.coalesce("site.action", "word.action", F.lit(default)).alias("verdict"), F.col("word.rule").alias("word_rule"),
    )
