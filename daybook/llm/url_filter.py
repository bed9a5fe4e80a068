"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule is stored under one of the tokens that any URL it fits must contain: the
one found in the fewest URLs of the input. A URL fetches the rules stored under
its own tokens, and only those run their regular expressions.

Two kinds of rules:

- site rules, a verdict and `host/path`: fit the host and its subdomains where the
  URL's path starts with the rule's. The longest wins.
- patterns, consulted where no site rule fits: `||` stands for the start of a host
  label, `^` for a separator or the end, `*` for anything; the rest is literal. A URL
  that fits any pattern is blocked, all others are allowed.
"""

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import column, ship_library

SITE_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
PATTERNS = (
    "||cheap-pills.",
    "||spam-farm.",
    "||casino.",
    "||casino-win.",
    "||adserver.",
    "||doubleclick.",
    "/banner-ads/",
    "/popunder/",
    "/phishing/",
)
# Rules are broadcast with the code; a larger list should be refused, not shipped.
MAX_RULES = 100_000

_TOKEN = re.compile("[a-z0-9]+")
_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
# Any character that can't be part of a token, as the border of a token.
_BORDER = "\x00"


@dataclass(frozen=True)
class Rule:
    """expression runs on host + path of a site rule, on the URL of a pattern."""

    name: str
    verdict: str
    is_site: bool

    @cached_property
    def expression(self) -> re.Pattern:
        if self.is_site:
            return re.compile(r"\A(?:[^/]*\.)?" + re.escape(self.name), re.DOTALL)
        parts = {"||": r"\A[^/?#]*://(?:[^/?#]*[.@])?", "*": ".*", "^": r"(?:[^A-Za-z0-9_.%-]|\Z)"}
        split = re.split(r"(\|\||\*|\^)", self.name)
        return re.compile("".join(parts.get(x, re.escape(x)) for x in split), re.DOTALL)

    @cached_property
    def tokens(self) -> list[str]:
        """Tokens that stand whole in every URL that fits."""
        literal = self.name.translate(_UPPER)
        if self.is_site:
            literal = _BORDER + literal
        else:
            # What a star stands for may continue the token beside it.
            literal = literal.replace("||", _BORDER).replace("^", _BORDER).replace("*", "\x01")
        found = []
        for match in _TOKEN.finditer(literal):
            before = literal[match.start() - 1 : match.start()]
            after = literal[match.end() : match.end() + 1]
            if before not in ("", "\x01") and after not in ("", "\x01"):
                found.append(match.group())
        return found


def make_rules(
    site_rules: Iterable[tuple[str, str]] = SITE_RULES, patterns: Iterable[str] = PATTERNS
) -> list[Rule]:
    rules = [Rule(name, verdict, True) for verdict, name in site_rules]
    rules += [Rule(name, "block", False) for name in patterns]
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} can be broadcast")
    return rules


def split_url(url: str) -> tuple[str, str]:
    """Host (A-Z in lower case) and path; both empty without `://`."""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return host.translate(_UPPER), path


class RuleIndex:
    """Rules by their rarest token; those without a usable token are always tried."""

    def __init__(self, rules: Sequence[Rule], frequency: dict[str, int]):
        self.by_token: dict[str, list[Rule]] = {}
        self.always: list[Rule] = []
        for rule in rules:
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (frequency.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append(rule)
            else:
                self.always.append(rule)

    def candidates(self, url: str) -> Iterator[Rule]:
        yield from self.always
        for token in set(_TOKEN.findall(url.translate(_UPPER))) & self.by_token.keys():
            yield from self.by_token[token]

    def judge(self, url: str | None) -> tuple[str, str, str | None, str]:
        """Host, path, the site rule that decides (if any) and the verdict."""
        url = url or ""
        host, path = split_url(url)
        best, blocked = None, False
        for rule in self.candidates(url):
            if rule.is_site:
                if rule.expression.search(host + path) and (
                    best is None or (len(rule.name), rule.name) > (len(best.name), best.name)
                ):
                    best = rule
            elif rule.expression.search(url.translate(_UPPER)):
                blocked = True
        if best is not None:
            return host, path, best.name, best.verdict
        return host, path, None, "block" if blocked else "allow"


def token_frequency(urls: DataFrame, tokens: Sequence[str], url: str = "url") -> dict[str, int]:
    """URLs of the whole input that hold each of these tokens."""
    if not tokens:
        return {}
    words = F.array_distinct(F.split(F.lower(column(url)), "[^a-z0-9]+"))
    counted = (
        urls.select(F.explode(words).alias("token"))
        .where(F.col("token").isin(list(tokens)))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    return {row.token: row.n for row in counted.collect()}  # one row per token of the rules


def judge_urls(
    pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[Rule] | None = None
) -> DataFrame:
    """Per row: the key, host, path, rule (of the site rules, else null), verdict.

    A null URL, or one without `://`, has neither host nor path, and only patterns
    can block it. Repeated rows are judged each; an empty table gives an empty
    result; other columns are ignored.
    """
    rules = make_rules() if rules is None else list(rules)
    tokens = sorted({token for rule in rules for token in rule.tokens})
    index = RuleIndex(rules, token_frequency(pages, tokens, url))

    ship_library(pages.sparkSession)

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judged(urls: pd.Series) -> pd.DataFrame:
        rows = [index.judge(value) for value in urls]
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    return pages.select(column(key).alias(key), judged(column(url)).alias("found")).select(
        column(key), "found.*"
    )
