"""URL rules, found through their rarest literal token.

Every rule is a regular expression over ``host + path`` with the literal tokens
that any match must hold. Of these, the one that fewest URLs hold becomes the
rule's key. A URL's tokens fetch the rules kept under them, and only those
regular expressions run.

Two kinds of rule: host rules (``example.com/en/``: the host and its subdomains,
paths that start so; the longest that fits wins) and patterns, which decide where
no host rule fits. Where nothing matches, the verdict is allow.

A null URL, or one without ``://``, has empty host and path, and so no rule.
Repeated rows are judged one by one; an empty table gives an empty result; columns
besides id and URL are not read. The rules are configuration that travels with
the plan: their number, not that of the pages, sets its size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lurewatch.llm.common import lower_ascii

TOKEN = r"[a-z0-9]+"
_SMALL = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    regex: str
    host_rule: bool

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that a matching URL holds as whole tokens, in lower case.

        A path is a prefix, so what it ends in may go on in the URL; a rule may have none.
        """
        name = self.name.translate(_SMALL)
        if self.host_rule and "/" in name:
            name = re.sub(r"[a-z0-9]+\Z", "", name)
        return sorted(set(re.findall(TOKEN, name)))


def host_rule(verdict: str, name: str) -> Rule:
    host, slash, path = name.partition("/")
    # the host is compared in lower case; without a path the rule holds for the whole host
    rest = re.escape(slash + path) if slash else r"(?:/|\Z)"
    return Rule(name, verdict, rf"^(?:[^/]*\.)?{re.escape(host.translate(_SMALL))}{rest}", True)


def word_rule(verdict: str, word: str) -> Rule:
    """A whole token anywhere in host or path."""
    return Rule(word, verdict, rf"(?:^|[^a-z0-9]){re.escape(word)}(?:[^a-z0-9]|$)", False)


HOST_RULES = [
    host_rule("allow", "com/"),
    host_rule("block", "example.com/en/"),
    host_rule("allow", "www.example.com/en/"),
    host_rule("block", "net/es/"),
    host_rule("block", "net/fr/"),
]
#: Sites whose name says that they hold no prose worth keeping.
PATTERN_RULES = [word_rule("block", w) for w in ("casino", "poker", "betting", "jackpot", "viagra", "xxx", "porn")]


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _tokens(host: Column, path: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.concat(host, lower_ascii(path)), F.lit(f"({TOKEN})")))


def _rarest(parts: DataFrame, rules: list[Rule]) -> dict[Rule, str]:
    """The token of each rule that fewest URLs hold; ties by name."""
    rules = [r for r in rules if r.tokens]
    wanted = sorted({t for r in rules for t in r.tokens})
    if not rules:
        return {}
    held = F.array_intersect(_tokens(F.col("host"), F.col("path")), F.array(*map(F.lit, wanted)))
    # one row for each token that a rule names
    counts = dict(parts.select(F.explode(held).alias("token")).groupBy("token").count().collect())
    return {r: min(r.tokens, key=lambda t: (counts.get(t, 0), t)) for r in rules}


def _slot(token: Column, slots: int) -> Column:
    return F.pmod(F.crc32(token), F.lit(slots))


def _index(df: DataFrame, keys: dict[Rule, str]) -> tuple[Column, int]:
    """Rules by slot of their key: one lookup a token, however many rules there are."""
    import zlib

    slots = max(8, 2 * len(keys))
    table: list[list[tuple[Rule, str]]] = [[] for _ in range(slots)]
    for rule, token in keys.items():
        table[zlib.crc32(token.encode()) % slots].append((rule, token))

    return F.array(*[F.array(*[_entry(*x) for x in row]).cast(_KIND) for row in table]), slots


_KIND = "array<struct<token:string,host_rule:boolean,length:int,name:string,verdict:string,regex:string>>"


def _entry(rule: Rule, token: str) -> Column:
    return F.struct(
        F.lit(token).alias("token"), F.lit(rule.host_rule).alias("host_rule"),
        F.lit(len(rule.name)).alias("length"), F.lit(rule.name).alias("name"),
        F.lit(rule.verdict).alias("verdict"), F.lit(rule.regex).alias("regex"),
    )


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    host_rules: list[Rule] = HOST_RULES,
    pattern_rules: list[Rule] = PATTERN_RULES,
) -> DataFrame:
    """Per row: id, host, path, rule (of a host rule, else null), verdict."""
    rules = [*host_rules, *pattern_rules]
    parts = pages.select(
        pages[id_col].alias(id_col), host_of(pages[url_col]).alias("host"), path_of(pages[url_col]).alias("path")
    )
    if not rules:
        return parts.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    index, slots = _index(parts, _rarest(parts, rules))
    fetched = F.flatten(
        F.transform(
            _tokens(F.col("host"), F.col("path")),
            lambda t: F.filter(F.get(index, _slot(t, slots).cast("int")), lambda r: r["token"] == t),
        )
    )
    keyless = [_entry(r, "") for r in rules if not r.tokens]
    if keyless:  # rules without a literal token run on every URL
        fetched = F.concat(fetched, F.array(*keyless).cast(_KIND))
    subject = F.concat("host", "path")
    # host rules are matched as written; patterns ignore the case of A-Z
    fits = F.filter(
        fetched,
        lambda r: F.when(r["host_rule"], F.regexp_like(subject, r["regex"])).otherwise(
            F.regexp_like(lower_ascii(subject), r["regex"])
        ),
    )
    # host rules come before patterns, then the longest, then by name
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["host_rule"], r["length"], r["name"], r["verdict"])))
    return parts.withColumn("best", best).select(
        id_col, "host", "path",
        F.when(F.col("best.host_rule"), F.col("best.name")).alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit("allow")).alias("verdict"),
    )


SQL = r"""
WITH p AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(rule, rule_host, rule_path, verdict) AS (
    VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
        ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
        ('net/fr/', 'net', '/fr/', 'block')
), fits AS (
    SELECT p.page_id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
    FROM p JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
    GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, f.rule,
    coalesce(f.verdict, CASE WHEN regexp_matches(p.host || translate(p.path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '(?:^|[^a-z0-9])(?:casino|poker|betting|jackpot|viagra|xxx|porn)(?:[^a-z0-9]|$)')
        THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits f USING (page_id)
"""
