"""Pattern rules for URLs, indexed by their rarest literal token.

A rule is a regular expression over the URL's host and path joined, with the literal
tokens (runs of letters and digits) that any match must contain whole. Each rule is
filed under the token that the fewest URLs have, counted over all URLs; a URL's tokens
fetch the rules filed under them, and only those rules' expressions run. The rules are a
parameter of at most ``MOST_RULES``, held in the plan as a map; URLs are judged row by
row with column functions, without a join or a shuffle.

Rules of kind ``listed`` (a host with its subdomains, and a path prefix) come first: the
longest that fits decides. Otherwise a URL that any ``pattern`` rule fits is blocked,
and the rest is allowed. A null URL or one without ``://`` has an empty host and path, no
tokens, and is allowed. Repeated rows and null ids need no special care.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sentiseries.llm.common import free_name

MOST_RULES = 10_000
_TOKEN = r"[A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    listed: bool


def listed(host: str, path: str, verdict: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    if not path.startswith("/"):
        raise ValueError("a listed path starts with a slash")
    # the path's last token may go on in the URL, unless something ends it
    whole = re.findall(rf"{_TOKEN}(?![A-Za-z0-9]|$)", path)
    pattern = rf"^(?:[^/]*\.)?{_quoted(host)}{_quoted(path)}"
    return Rule(host + path, verdict, pattern, (*re.findall(_TOKEN, host), *whole), True)


def host_word(*words: str) -> Rule:
    """Blocks hosts that have these words next to each other, at the borders of words."""
    return Rule("-".join(words), "block", rf"^(?:[^/]*[^A-Za-z0-9/])?{'[-_.]'.join(words)}(?:[^A-Za-z0-9]|$)", words, False)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", text)


LISTED = (
    listed("com", "/", "allow"),
    listed("example.com", "/en/", "block"),
    listed("www.example.com", "/en/", "allow"),
    listed("net", "/es/", "block"),
    listed("net", "/fr/", "block"),
)
PATTERNS = (
    host_word("spam", "farm"), host_word("cheap", "pills"), host_word("casino"), host_word("free", "bets"),
    host_word("adult"), host_word("ads", "track"), host_word("porn"), host_word("xxx"), host_word("viagra"),
    host_word("payday", "loans"), host_word("link", "farm"),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``, empty without one."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)", 1), F.lit(""))


def host(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, number sign or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, up to a question mark, number sign or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*(/[^?#]*)", 1)


def tokens(site: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(site, F.lit(f"({_TOKEN})"), F.lit(1)))


def frequencies(sites: DataFrame, site: str, rules: tuple[Rule, ...]) -> dict[str, int]:
    """How many URLs have each of the rules' tokens."""
    wanted = sorted({t for r in rules for t in r.tokens})
    counted = sites.select(F.explode(F.array_intersect(tokens(F.col(site)), F.array(*map(F.lit, wanted)))).alias("token"))
    return dict.fromkeys(wanted, 0) | {r["token"]: r["n"] for r in counted.groupBy("token").agg(F.count("*").alias("n")).collect()}


def _entry(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.listed).alias("listed"), F.lit(len(rule.name) if rule.listed else 0).alias("length"),
        F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"), F.lit(rule.pattern).alias("pattern"),
    )


def judge(pages: DataFrame, url: str = "url", rules: tuple[Rule, ...] = LISTED + PATTERNS) -> DataFrame:
    """All columns and host, path, rule (of the list, else null) and verdict; replaces columns of those names."""
    if not 0 < len(rules) <= MOST_RULES or any(not r.tokens for r in rules):
        raise ValueError(f"between 1 and {MOST_RULES} rules, each with a literal token")
    sites = pages.select(F.concat(host(F.col(url)), path(F.col(url))).alias("site"))
    often = frequencies(sites, "site", rules)
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        index.setdefault(min(rule.tokens, key=lambda t: (often[t], t)), []).append(rule)
    filed = F.create_map(*(c for token, under in index.items() for c in (F.lit(token), F.array(*map(_entry, under)))))
    site, fetched, fits = (free_name(pages, n) for n in ("site", "fetched", "fits"))
    out = pages.withColumn(site, F.concat(host(F.col(url)), path(F.col(url)))).withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    keys = F.array_intersect(tokens(F.col(site)), F.array(*map(F.lit, index)))
    out = out.withColumn(fetched, F.flatten(F.transform(keys, lambda t: F.element_at(filed, t))))
    out = out.withColumn(fits, F.filter(fetched, lambda r: F.regexp_like(F.col(site), r["pattern"])))
    best = F.array_max(F.filter(fits, lambda r: r["listed"]))
    return out.withColumns({
        "rule": best["name"],
        "verdict": F.coalesce(best["verdict"], F.when(F.size(fits) > 0, "block").otherwise("allow")),
    }).drop(site, fetched, fits)
