"""Rolling-window bounds and the state row (RW-1, SNK-4, SNK-5, LM-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import as_date, month_of, ts_lower, ts_upper
from tidewatch.operators.extract import filter_month
from tidewatch.schema import RAW_TS, SLIDE_DAYS


def state_from_data(raw: DataFrame, month) -> DataFrame:
    """SNK-4: the initial state ``(start_date, end_date, version=0)`` = first
    and last UTC day with transactions in the base month.  An empty month
    gives ``(NULL, NULL, 0)``."""
    m = month_of(as_date(month))
    base = filter_month(raw, month).filter(
        (F.col(RAW_TS) >= m.cast("timestamp"))
        & (F.col(RAW_TS) < F.add_months(m, 1).cast("timestamp")))
    day = F.to_date(RAW_TS)
    return base.agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"),
                    F.lit(0).alias("version"))


def state_row(spark: SparkSession, start_day, end_day, version: int = 0) -> DataFrame:
    """A state row from known dates."""
    return spark.range(1).select(as_date(start_day).alias("start_date"),
                                 as_date(end_day).alias("end_date"),
                                 F.lit(version).alias("version"))


def advance_state(state: DataFrame, step_days: int = SLIDE_DAYS, times: int = 1) -> DataFrame:
    """SNK-5: both bounds shifted by ``step_days * times``; version + times.
    NULL bounds stay NULL."""
    shift = step_days * times
    return state.select(F.date_add("start_date", shift).alias("start_date"),
                        F.date_add("end_date", shift).alias("end_date"),
                        (F.col("version") + times).alias("version"))


def latest_state(history: DataFrame) -> DataFrame:
    """LM-1 / SRC-3: the row of the highest version (deterministic, unlike
    ``LIMIT 1``)."""
    top = F.max_by(F.struct("start_date", "end_date"), "version")
    return (history.agg(top.alias("s"), F.max("version").alias("version"))
            .select("s.start_date", "s.end_date", "version"))


def window_list(state: DataFrame, n_slides: int | Column, step_days: int = SLIDE_DAYS,
                first: int = 1) -> DataFrame:
    """RW-1 for slides ``first..n``: ``slide, new_start, new_end, m_start,
    m_end, ts_lo, ts_hi`` (days inclusive, timestamps half-open).  Slide 0
    is the state itself and is not emitted."""
    n = n_slides if isinstance(n_slides, Column) else F.lit(n_slides)
    seq = F.when(n >= first, F.sequence(F.lit(first), n.cast("int"))).otherwise(
        F.array().cast("array<int>"))
    slides = state.select("start_date", "end_date", F.explode(seq).alias("slide"))
    ns = F.date_add("start_date", F.col("slide") * step_days)
    ne = F.date_add("end_date", F.col("slide") * step_days)
    return slides.select(
        "slide", ns.alias("new_start"), ne.alias("new_end"),
        month_of(ns).alias("m_start"), month_of(ne).alias("m_end"),
        ts_lower(ns).alias("ts_lo"), ts_upper(ne).alias("ts_hi"))


def state_bounds(state: DataFrame):
    """``(start, end)`` of a one-row state as Columns backed by a single
    scalar subquery (one job, reused wherever the bounds appear)."""
    b = state.select(F.struct("start_date", "end_date").alias("b")).scalar()
    return b.getField("start_date"), b.getField("end_date")


def slides_until(raw_or_window: DataFrame, state: DataFrame, step_days: int = SLIDE_DAYS,
                 ts_col: str = RAW_TS) -> Column:
    """Number of slides whose window starts on or before the last day with
    data: ``floor((max_day - start) / step)``, as a scalar subquery."""
    last = raw_or_window.agg(F.max(F.to_date(ts_col)).alias("d")).scalar()
    start = state_bounds(state)[0]
    return F.floor(F.datediff(last, start) / F.lit(step_days)).cast("int")
