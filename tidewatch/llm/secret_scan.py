"""Operator 10: secret scans over a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression.  From the expression itself follows a Boolean query
over trigrams, lower-cased, that every match satisfies (``literals.trigram_query``): an
OR over alternatives of an AND over their trigrams.  The inverted index holds
a posting (trigram, document) for every trigram that some query asks for.
Intersecting postings gives the candidates, and only their texts meet the
regular expression.  Rules without a mandatory trigram (runs of hexadecimal
digits) scan every text.

Matches are leftmost and non-overlapping for each rule; a match that fails the
rule's least length is dropped after it has been consumed.  Offsets are code
points, end exclusive.

Cases: null text counts as empty; an empty text has no spans; rows with equal id
and text share their postings and get equal results, once for each row; null
ids are kept; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewatch.llm.common import fresh, materialise, row_key
from tidewatch.llm.literals import trigram_query


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: Least number of code points of what ``measured`` (a regex group) matches.
    least: int = 0
    measured: int = 0

    def query(self) -> tuple[tuple[str, ...], ...]:
        """The Boolean trigram query: an OR of ANDs; empty when nothing is mandatory."""
        return trigram_query(self.pattern)


# The base rules of the contract, then the rules that this operator adds.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
    # A run shorter than the least length holds no longer one, so the length can stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}"),
)


def _scan(rows: DataFrame, rules: list[tuple[int, Rule]]) -> DataFrame:
    """``doc_id, row_key, s`` for every span that one of the rules finds."""
    def matches(order: int, rule: Rule) -> Column:
        pattern = F.lit(rule.pattern)
        found = F.regexp_extract_all("text", pattern, F.lit(0))
        kept = F.regexp_extract_all("text", pattern, F.lit(rule.measured)) if rule.measured else found
        each = F.transform(
            F.arrays_zip(found.alias("m"), F.split("text", rule.pattern, -1).alias("gap"), kept.alias("k")),
            lambda x, i: F.struct(F.lit(order).alias("ord"), i.alias("nth"), F.length(x["gap"]).alias("gap"),
                                  F.length(x["m"]).alias("n"), F.length(x["k"]).alias("measured")))
        return F.when(F.regexp_like("text", pattern), F.filter(each, lambda x: x["n"].isNotNull()))

    none = F.expr("array()").cast("array<struct<ord:int,nth:int,gap:int,n:int,measured:int>>")
    hits = rows.select("doc_id", "row_key", F.explode(F.concat(*[
        F.coalesce(matches(i, r), none) for i, r in rules])).alias("x")).select("doc_id", "row_key", "x.*").distinct()
    # the text between two matches and the matches themselves add up to the offset
    walk = W.partitionBy("row_key", "doc_id", "ord").orderBy("nth")
    ends = hits.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(walk).cast("int"))
    least = F.get(F.array(*[F.lit(r.least) for _, r in rules]), F.array_position(
        F.array(*[F.lit(i) for i, _ in rules]), F.col("ord")).cast("int") - 1)
    kind = F.get(F.array(*[F.lit(r.kind) for _, r in rules]), F.array_position(
        F.array(*[F.lit(i) for i, _ in rules]), F.col("ord")).cast("int") - 1)
    return ends.where(F.col("measured") >= least).select(
        "doc_id", "row_key", F.struct((F.col("end") - F.col("n")).alias("start"), "ord", "end", kind.alias("kind")).alias("s"))


def trigram_index(rows: DataFrame, grams: list[str]) -> DataFrame:
    """Postings ``gram, doc_id, row_key`` of the given trigrams."""
    lowered = rows.select("doc_id", "row_key", F.lower("text").alias("low"))   # once, not for each trigram
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return lowered.select(F.explode(held).alias("gram"), "doc_id", "row_key").distinct()


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """Documents that satisfy the trigram query of at least one rule."""
    queries = [q for r in rules for q in r.query()]
    wanted = sorted({g for q in queries for g in q})
    held = (index.where(F.col("gram").isin(wanted)).groupBy("doc_id", "row_key")
            .agg(F.collect_set("gram").alias("grams")))   # at most the queries' trigrams
    hit = F.lit(False)
    for q in queries:
        hit = hit | (F.size(F.array_intersect("grams", F.array(*map(F.lit, q)))) == len(q))
    return held.where(hit).select("doc_id", "row_key")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """``doc_id, row_key, spans`` for every distinct row with a span.

    ``spans``: array of struct (start, ord, end, kind), by start, then by the
    order of ``rules``.  ``row_key`` is :func:`secret_key` of the row.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row_key", secret_key(F.col("doc_id"), F.col("text")))
    numbered = list(enumerate(rules))
    indexed = [(i, r) for i, r in numbered if r.query()]
    whole = [(i, r) for i, r in numbered if not r.query()]
    parts = []
    if indexed:
        grams = sorted({g for _, r in indexed for q in r.query() for g in q})
        index = materialise(trigram_index(rows, grams), "postings")
        # a stored table of known size: joined without a shuffle of the texts where it is small enough
        chosen = materialise(candidates(index, [r for _, r in indexed]).select("row_key").distinct(), "candidates")
        parts.append(_scan(rows.join(chosen, "row_key", "left_semi"), indexed))
    if whole:
        parts.append(_scan(rows, whole))
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    return (hits.groupBy("doc_id", "row_key")   # bounded by one text
            .agg(F.array_sort(F.collect_list("s")).alias("spans")))


def secret_key(doc_id: Column, text: Column) -> Column:
    """The key under which :func:`scan` reports a row."""
    return row_key(doc_id, F.coalesce(text, F.lit("")))


def with_spans(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               name: str = "secret_spans") -> DataFrame:
    """``docs`` with a column ``name`` of spans (null where nothing was found)."""
    key = fresh("secret_key", docs.columns)
    keyed = docs.withColumn(key, secret_key(F.col(id_col), F.col(text_col).cast("string")))
    right = found.select(F.col("row_key").alias(key), F.col("spans").alias(name))
    return keyed.join(right, key, "left").drop(key)


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every run of overlapping or touching spans replaced by ``mark``."""
    walked = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] <= acc["at"], F.when((acc["at"] == 0) & (s["start"] == 0) & (acc["out"] == ""), F.lit(mark))
                   .otherwise(acc["out"]))
            .otherwise(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).alias("out")))
    end = F.struct(walked["at"].alias("at"), walked["out"].alias("out"))
    return F.when(F.size(spans) > 0, F.concat(end["out"], F.substring(text, end["at"] + 1, F.length(text)))).otherwise(text)
