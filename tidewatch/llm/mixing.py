"""Operator 9: mixing sources to target weights by a time-varying curriculum, in DataFrame functions only.

Targets.  Sources in code-point order, null last, weigh ``weights`` in turn.
They share ``share`` times all sizes in proportion to their weights; a target
stops at ``cap`` times its source's size, and what is left over goes to the
others by weight until none is above (solved in closed form over the sources
sorted by size for weight).

Taking.  A source's documents stand in the order of a hash.  A target of ``f``
whole passes and a rest takes every document ``f`` times and those of the first
``rest`` words once more (a document that straddles the end is taken when more
than half of it lies before).  The running sums are two-level: sums by slice of
the hash first, then inside a slice, so a source with a third of all rows is
spread over many tasks.

Positions.  A source's weight changes linearly over training, from ``a`` to
``b``.  Its integral up to time t is its cumulative demand; a document that
starts at the share q of its source's taken words is read at the t at which the
demand reaches q.  Documents are range-sorted by that position.

The windows over the sources (ranks, water filling) run in one task, with one row a
source; sources are few against documents (some hundred thousand are no burden).

Cases: null text has size 0; a document of size 0 is taken 0 words and has no
position (sorted last); null sources are one source; repeated rows are rows like
any other; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewatch.llm.common import WORD_RE, materialise, row_key

#: Start and end of the weight schedule, by position in ``weights``.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def sized_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long").alias("size"),
        mix_key(F.col(id_col), text).alias("mix_key"))


def mix_key(doc_id: Column, text: Column) -> Column:
    """The hash that orders a source's documents."""
    return row_key(doc_id, text)


def source_targets(sized: DataFrame, share: float = 1.5, cap: float = 2.0, weights=(5, 2, 1)) -> DataFrame:
    """One row a source: ``source, rank, weight, source_size, target``."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sums.withColumn("rank", rank).withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("rank") % len(weights)))
    by_ratio = W.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before, after = by_ratio.rowsBetween(W.unboundedPreceding, -1), by_ratio.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    most = F.lit(cap) * F.col("source_size")
    levels = ranked.withColumn(
        "level", (F.lit(share) * F.sum("source_size").over(everything)
                  - F.coalesce(F.sum(most).over(before), F.lit(0.0))) / F.sum("weight").over(after))
    fits = F.when(F.col("level") * F.col("weight") <= most, F.col("level"))
    return levels.withColumn("fit", F.max(fits).over(everything)).select(
        "source", "rank", "weight", "source_size",
        F.coalesce(F.least(most, F.col("fit") * F.col("weight")), most).alias("target"))


def _time(q: Column, a: Column, b: Column) -> Column:
    """The t in [0, 1] at which a weight going linearly from a to b has spent the share q."""
    return F.when(a == b, q).otherwise((F.sqrt(a * a + (b - a) * (a + b) * q) - a) / F.when(a != b, b - a) + F.lit(0.0))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        share: float = 1.5, cap: float = 2.0, weights=(5, 2, 1), schedules=SCHEDULES, slices: int = 4096) -> DataFrame:
    """``doc_id, mix_key, source, size, source_size, target, copies, taken,
    positions`` of every row, sorted by first position.

    ``positions``: training position in [0, 1) of each copy taken.
    """
    sized = materialise(sized_rows(docs, id_col, text_col, source_col), "sizes")
    targets = materialise(source_targets(sized, share, cap, weights), "targets")
    bits = (slices - 1).bit_length()
    rows = sized.withColumn("slice", F.shiftrightunsigned("mix_key", 64 - bits))
    key = [F.col("s.source").eqNullSafe(F.col("t.source"))]
    rows = rows.alias("s").join(targets.alias("t"), key).select(
        "s.*", "t.rank", "t.source_size", "t.target")
    sums = rows.groupBy("rank", "slice").agg(F.sum("size").alias("words"))
    offsets = sums.select("rank", "slice", F.coalesce(F.sum("words").over(
        W.partitionBy("rank").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    inside = W.partitionBy("rank", "slice").orderBy("mix_key", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(offsets, ["rank", "slice"]).withColumn("start", F.col("offset") + F.col("inside"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - whole * F.col("source_size")
    once_more = (F.col("size") > 0) & (F.col("start") + F.col("size") / 2 <= rest)
    copies = F.when(F.col("size") > 0, whole + once_more.cast("int")).otherwise(F.lit(0)).cast("int")
    pick = lambda k: F.get(F.array(*[F.lit(float(s[k])) for s in schedules]), F.col("rank") % len(schedules))
    rows = rows.withColumn("copies", copies).withColumn("a", pick(0)).withColumn("b", pick(1))
    spent = lambda i: F.least(F.lit(1.0), (F.col("start") + i * F.col("source_size")) / F.col("target"))
    positions = F.when(F.col("copies") > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("copies") - 1, F.lit(0))), lambda i: _time(spent(i), F.col("a"), F.col("b"))))
    return rows.select(
        "doc_id", "mix_key", "source", "size", "source_size", F.col("target").cast("double").alias("target"), "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), positions.alias("positions"),
    ).orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")
