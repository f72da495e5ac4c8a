"""Exact medians of a stream (RW-5, D4): counted values instead of a sketch.

The state is one row for each (window, value) with its count, so it spreads on the
value, a window with most of the rows included, and holds as many rows as a
window has distinct values.  A micro-batch writes the counts that it changed; the
median is chosen when the table is read, by slices of the value's bits
(``exact_median``), and is a member of the window, the lower middle value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import sat_to_coin
from tidewatch.operators.kpi import DAILY_NAMES, exact_median, measures
from tidewatch.streaming.kpi_stream import TS, read_live


def daily_value_counts_stream(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """``jour, out_sat, c``: how often each output value occurs on each day; rows
    without a value keep their day (``out_sat`` NULL)."""
    rows = measures(stream.withWatermark(TS, watermark), keep=(F.window(TS, "1 day").alias("w"),))
    counts = rows.groupBy("w", "out_sat").agg(F.count(F.lit(1)).alias("c"))
    return counts.select(F.to_date("w.start").alias("jour"), "out_sat", "c")


def read_median_daily(spark: SparkSession, path: str) -> DataFrame:
    """``jour, valeur_mediane_transaction_jour`` from a ``write_live`` table of value
    counts: every day seen, NULL for a day without a value."""
    counts = read_live(spark, path, ["jour", "out_sat"])
    medians = exact_median(counts.where("out_sat IS NOT NULL"), ["jour"])
    return counts.select("jour").distinct().join(medians, "jour", "left").select(
        "jour", sat_to_coin(F.col("med_sat")).alias(DAILY_NAMES["median"]))
