"""Operator 7: URL filters by pattern rules, indexed by their rarest literal token.

A rule is a regular expression over ``host + path``.  Of the literal tokens
(runs of ASCII letters and digits) that every match holds whole, as they follow
from the expression (``literals.whole_tokens``), the one that
the fewest pages have becomes the rule's key.  A URL's tokens fetch the rules
filed under them, and only those run their expression.  Rules without such a
token are tried on every URL, all in one pass.

Host rules (``host, path``) fit their host and all subdomains when the path
starts with the rule's; the longest fitting one wins.  Where none fits, the
pattern rules decide: ``block`` if one matches, else ``allow``.

Cases: a null url or one without ``://`` has an empty host and path, fits no
rule and is allowed; a url without a path has an empty one; rows with equal id
and url are judged alike, once for each row; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import row_key
from tidewatch.llm.literals import whole_tokens

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    name: str
    verdict: str
    #: Expression over ``host + path``, for Java and RE2 alike.
    pattern: str
    #: Whether ``name`` is a host rule's; among these the longest wins.
    hosted: bool = False

    @property
    def tokens(self) -> tuple[str, ...]:
        """Tokens that every match holds whole."""
        return whole_tokens(self.pattern)


def host_rule(verdict: str, host: str, path: str) -> UrlRule:
    """A rule for a host, its subdomains and the paths that start with ``path``."""
    quoted = re.sub(r"([^A-Za-z0-9/])", r"\\\1", host + path)
    return UrlRule(host + path, verdict, rf"^(?:[^/]*\.)?{quoted}", True)


# The host rules of the contract, then the words of spam hosts that this operator blocks.
HOST_RULES = (
    host_rule("allow", "org", "/"),
    host_rule("block", "example.org", "/es/"),
    host_rule("block", "example.org", "/en/1"),
    host_rule("allow", "com", "/fr/"),
    host_rule("block", "com", "/de/"),
)
SPAM_HOSTS = ("spam-farm", "cheap-pills", "free-casino", "win-prize", "adult-cams", "link-exchange")
PATTERN_RULES = tuple(
    UrlRule(words, "block", rf"^(?:[^/]*[.-])?{words}(?:[.-][^/]*)?(?:/|$)") for words in SPAM_HOSTS)


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(address: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(address, F.lit("[A-Za-z0-9]+"), F.lit(0)))


def rarest_tokens(addresses: DataFrame, rules: tuple[UrlRule, ...]) -> dict[str, str | None]:
    """Each rule's key: its literal token with the least document frequency."""
    words = sorted({t for r in rules for t in r.tokens})
    held = addresses.select(F.explode(F.array_intersect(_tokens(F.col("address")), F.array(*map(F.lit, words)))).alias("t"))
    counts = {r["t"]: r["count"] for r in held.groupBy("t").count().collect()} if words else {}   # at most the rules' tokens
    return {r.name: min(r.tokens, key=lambda t: (counts.get(t, 0), t)) if r.tokens else None for r in rules}


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
          rules: tuple[UrlRule, ...] = HOST_RULES + PATTERN_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of every row.

    ``rule``: the host rule that wins, else null; ``pattern``: the pattern rule
    that matches (the first by name), else null.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), row_key(F.col(id_col), url).alias("url_key"),
                        host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("address", F.concat("host", "path"))
    spark = pages.sparkSession
    keys = rarest_tokens(rows, rules)
    filed = spark.createDataFrame([(keys[r.name], i, r.pattern) for i, r in enumerate(rules) if keys[r.name]],
                                  "token string, number int, pattern string")
    everywhere = [i for i, r in enumerate(rules) if not keys[r.name]]
    distinct = rows.select("url_key", "address").distinct()
    # the rule list is the caller's; Spark broadcasts it while it is small
    fetched = (distinct.select("url_key", "address", F.explode(_tokens(F.col("address"))).alias("token"))
               .join(filed, "token").where(F.expr("regexp_like(address, pattern)")).select("url_key", "number"))
    if everywhere:
        tried = [F.when(F.regexp_like("address", F.lit(rules[i].pattern)), F.lit(i)) for i in everywhere]
        fetched = fetched.unionByName(distinct.select("url_key", F.explode(F.array_compact(F.array(*tried))).alias("number")))
    facts = spark.createDataFrame([(i, r.name, r.verdict, r.hosted, len(r.name)) for i, r in enumerate(rules)],
                                  "number int, name string, verdict string, hosted boolean, size int")
    hits = fetched.join(facts, "number").groupBy("url_key").agg(
        F.max(F.when(F.col("hosted"), F.struct("size", "name", "verdict"))).alias("best"),
        F.min(F.when(~F.col("hosted"), F.struct("name", "verdict"))).alias("other"))
    return rows.join(hits, "url_key", "left").select(
        "page_id", "host", "path", F.col("best.name").alias("rule"),
        F.coalesce("best.verdict", "other.verdict", F.lit("allow")).alias("verdict"), F.col("other.name").alias("pattern"))


def oracle_sql() -> str:
    """The judgement in DuckDB SQL, every rule tried on every page."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    fit = lambda r: f"regexp_matches(host || path, {quote(r.pattern)})"
    hosted = sorted(HOST_RULES, key=lambda r: (-len(r.name), r.name))
    rule = "CASE " + " ".join(f"WHEN {fit(r)} THEN {quote(r.name)}" for r in hosted) + " END"
    other = "CASE " + " ".join(f"WHEN {fit(r)} THEN {quote(r.name)}" for r in sorted(PATTERN_RULES, key=lambda r: r.name)) + " END"
    verdicts = " ".join(f"WHEN rule = {quote(r.name)} THEN {quote(r.verdict)}" for r in HOST_RULES)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r AS (SELECT page_id, host, path, {rule} AS rule, {other} AS pattern FROM p)
SELECT page_id, host, path, rule,
  CASE {verdicts} WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, pattern FROM r"""
