"""URL filters: pattern rules behind an index of their rarest literal token.

A rule is a regular expression over host and path, with the literal tokens (runs of a-z and 0-9) that every match has
as whole tokens. The index holds each rule once, under that token of its own which the fewest rules have. A url is cut
into tokens; its tokens fetch the candidate rules, and only those run their expressions. A host rule such as
``net/es/`` is a rule of the same kind: its expression fits the host and its subdomains and the beginning of the path.

The rules are a list in the program, of any length, so the index is one constant of the plan: a hash table, as an array of
buckets by the CRC-32 of the token, where a token of a url costs one look-up however many rules there are. The judging is one
projection over the column of urls, without a shuffle, a join or Python.

Defined results: a null url, or one without ``://``, has an empty host and path and no candidates; null ids pass
through; repeated rows are judged alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_TOKEN = re.compile("[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host and path (case as in the url); ``tokens``: literal tokens of every match."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    host_rule: bool = False


def host_rule(name: str, verdict: str) -> Rule:
    """``host/path``: the host and all its subdomains, paths that begin with the rule's."""
    literal = re.sub(r"([^A-Za-z0-9/])", r"\\\1", name)
    tokens = _TOKEN.findall(name.lower())
    if tokens and re.search("[A-Za-z0-9]$", name):
        tokens.pop()  # the url's token may go on where the rule ends
    return Rule(name, rf"^(?:[^/]*\.)?{literal}", tuple(tokens), verdict, True)


# The rules of the contract.
BASE_RULES = (
    host_rule("com/", "allow"),
    host_rule("example.com/en/", "block"),
    host_rule("www.example.com/en/", "allow"),
    host_rule("net/es/", "block"),
    host_rule("net/fr/", "block"),
)
# Where no host rule fits: hosts and paths that crawls are better off without.
PATTERN_RULES = (
    Rule("spam-farm", r"(?:^|[./-])spam-farms?[./-]", ("spam",), "block"),
    Rule("cheap-pills", r"(?:^|[./-])cheap-(?:pills|meds)[./-]", ("cheap",), "block"),
    Rule("casino", r"(?:^|[./-])casino(?:[./-]|$)", ("casino",), "block"),
    Rule("poker", r"(?:^|[./-])poker(?:[./-]|$)", ("poker",), "block"),
    Rule("xxx", r"(?:^|[./-])xxx(?:[./-]|$)", ("xxx",), "block"),
    Rule("porn", r"(?:^|[./-])porn(?:[./-]|$)", ("porn",), "block"),
    Rule("viagra", r"(?:^|[./-])viagra(?:[./-]|$)", ("viagra",), "block"),
    Rule("payday-loans", r"(?:^|[./-])payday-loans?(?:[./-]|$)", ("payday",), "block"),
    Rule("click-bait", r"(?:^|[./-])click-?bait-[a-z0-9]+[./-]", (), "block"),
    Rule("login page", r"/login(?:/|$)", ("login",), "block"),
    Rule("cart page", r"/cart(?:/|$)", ("cart",), "block"),
)


def index_rules(rules: tuple[Rule, ...]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; of equally rare ones the longest, then the first by name. The empty token holds
    rules without a literal: they are candidates for every url."""
    spread = Counter(t for r in rules for t in set(r.tokens))
    index: dict[str, list[Rule]] = defaultdict(list)
    for rule in rules:
        index[min(rule.tokens, key=lambda t: (spread[t], -len(t), t), default="")].append(rule)
    return dict(index)


def hash_table(index: dict[str, list[Rule]]) -> list[list[dict]]:
    """Rules in buckets by the CRC-32 of their token; the number of buckets is a power of two, twice that of tokens at least."""
    table: list[list[dict]] = [[] for _ in range(1 << (2 * len(index)).bit_length())]
    for token, held in index.items():
        table[zlib.crc32(token.encode()) & (len(table) - 1)] += [
            {"token": token, "h": r.host_rule, "b": r.verdict == "block", "n": len(r.name), "name": r.name, "verdict": r.verdict, "pattern": r.pattern}
            for r in held
        ]
    return table


def url_part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, group), F.lit(""))


def judge_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...] = BASE_RULES + PATTERN_RULES,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, pattern_rule``.

    The longest host rule that fits decides; else a pattern rule that fits (block before allow, then the longest
    name), told in ``pattern_rule``; else ``default``.
    """
    table = hash_table(index_rules(rules))
    known = F.from_json(
        F.lit(json.dumps(table)),
        "array<array<struct<token: string, h: boolean, b: boolean, n: int, name: string, verdict: string, pattern: string>>>",
    )

    def held_under(token: Column) -> Column:
        place = F.crc32(token.cast("binary")).bitwiseAND(F.lit(len(table) - 1)).cast("int")
        return F.filter(F.get(known, place), lambda r: r["token"] == token)

    parts = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url")).select(
        "page_id",
        F.translate(url_part(F.col("url"), 1), UPPER, LOWER).alias("host"),
        url_part(F.col("url"), 2).alias("path"),
    )
    subject = F.concat("host", "path")
    # Splitting leaves an empty token at most once; it fetches the rules without a literal.
    tokens = F.array_union(F.split(F.translate(subject, UPPER, LOWER), "[^a-z0-9]+"), F.array(F.lit("")))
    candidates = F.flatten(F.transform(tokens, held_under))
    fitting = F.filter(candidates, lambda r: F.regexp_like(F.col("subject"), r["pattern"]))
    judged = parts.withColumn("subject", subject).withColumn("fitting", fitting)
    of_hosts = F.array_max(F.transform(F.filter("fitting", lambda r: r["h"]), lambda r: F.struct(r["n"], r["name"], r["verdict"])))
    of_patterns = F.array_max(
        F.transform(F.filter("fitting", lambda r: ~r["h"]), lambda r: F.struct(r["b"], r["n"], r["name"], r["verdict"]))
    )
    return judged.withColumns({"first": of_hosts, "second": of_patterns}).select(
        "page_id",
        "host",
        "path",
        F.col("first.name").alias("rule"),
        F.coalesce("first.verdict", "second.verdict", F.lit(default)).alias("verdict"),
        F.when(F.col("first.name").isNull(), F.col("second.name")).alias("pattern_rule"),
    )


def oracle(rules: tuple[Rule, ...] = BASE_RULES + PATTERN_RULES) -> str:
    """Every rule tried on every url, host rules by comparing strings."""
    hosts = ", ".join(
        f"('{r.name}', '{r.name.split('/', 1)[0]}', '/{r.name.split('/', 1)[1]}', '{r.verdict}')" for r in rules if r.host_rule
    )
    patterns = ", ".join(f"('{r.name}', '{r.pattern}', '{r.verdict}')" for r in rules if not r.host_rule)
    return f"""
WITH parts AS (
  SELECT page_id, row_number() OVER () AS line,
         translate(coalesce(regexp_extract(url, '{PARTS}', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '{PARTS}', 2), '') AS path
  FROM pages
), hosts(rule, rule_host, rule_path, verdict) AS (VALUES {hosts}),
patterns(rule, pattern, verdict) AS (VALUES {patterns}),
by_host AS (
  SELECT line, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM parts JOIN hosts ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY line
), by_pattern AS (
  SELECT line, max_by(rule, lpad(CAST(length(rule) AS VARCHAR), 9, '0') || rule) AS rule, 'block' AS verdict
  FROM parts JOIN patterns ON regexp_matches(host || path, pattern) GROUP BY line
)
SELECT page_id, host, path, h.rule, coalesce(h.verdict, p.verdict, 'allow') AS verdict,
       CASE WHEN h.rule IS NULL THEN p.rule END AS pattern_rule
FROM parts LEFT JOIN by_host h USING (line) LEFT JOIN by_pattern p USING (line)
"""
