"""Data checks (CK-1..CK-4): does a stored window match the state it claims?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewatch.functions.columns import slide_range
from tidewatch.operators.kpi import measures
from tidewatch.plans.windows import state_bounds, state_row, window_list
from tidewatch.schema import SLIDE_DAYS


def check_state(history: DataFrame) -> DataFrame:
    """CK-1: the current state plus ``n_rows`` of the highest version, which
    must be exactly 1 (``ok``)."""
    top = history.agg(F.max("version").alias("v"))
    cur = history.filter(F.col("version") == top.scalar())
    return (cur.groupBy("version")
            .agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
                 F.count(F.lit(1)).alias("n_rows"))
            .select("start_date", "end_date", "version", "n_rows",
                    (F.col("n_rows") == 1).alias("ok")))


def check_window_contents(window: DataFrame) -> DataFrame:
    """CK-2: first day, last day and row count actually in a window table."""
    day = measures(window).select("jour")
    return day.agg(F.min("jour").alias("min_date_table"), F.max("jour").alias("max_date_table"),
                   F.count(F.lit(1)).alias("nb_lignes"))


def _verdict(df: DataFrame, start: str, end: str) -> list:
    return [
        F.datediff("min_date_table", start).alias("start_gap_days"),
        F.datediff(end, "max_date_table").alias("end_gap_days"),
        (F.col("nb_lignes") > 0).alias("non_empty"),
        (F.coalesce((F.col("min_date_table") >= F.col(start))
                    & (F.col("max_date_table") <= F.col(end)), F.lit(True))).alias("in_bounds"),
    ]


def verdict_columns(contents: DataFrame) -> list:
    """The columns of CK-3 behind bounds and contents, ``start_date, end_date,
    min_date_table, max_date_table, nb_lignes``."""
    return _verdict(contents, "start_date", "end_date")


def check_window_verdict(window: DataFrame, state: DataFrame) -> DataFrame:
    """CK-3: contents against the state bounds.  Gaps are reported in days
    (a sparse first or last day is legitimate); ``non_empty`` and
    ``in_bounds`` are the pass conditions."""
    start, end = state_bounds(state)
    c = check_window_contents(window).select(start.alias("start_date"), end.alias("end_date"), "*")
    return c.select("*", *_verdict(c, "start_date", "end_date"))


def check_slides(window: DataFrame, state, n_slides, step_days: int = SLIDE_DAYS) -> DataFrame:
    """CK-2 + CK-3 for every slide 1..n of a (multi-slide) window table, in
    one job: day counts expanded to slides, then one row per slide.

    Rows that lie in no slide's window are counted in ``rows_outside`` (the
    same on every row, days without a date included); none may be there for
    ``in_bounds``.  ``state`` is a one-row state DataFrame or a ``(start, end)``
    pair."""
    return check_slide_days(measures(window).groupBy("jour").agg(F.count(F.lit(1)).alias("n")),
                            state, n_slides, step_days)


def check_slide_days(days: DataFrame, state, n_slides, step_days: int = SLIDE_DAYS) -> DataFrame:
    """``check_slides`` from row counts per day, ``(jour, n)``."""
    if not isinstance(state, DataFrame):
        state = state_row(days.sparkSession, state[0], state[1])
    start, end = state_bounds(state)
    slides = F.coalesce(slide_range(F.col("jour"), start, end, step_days, 1, n_slides),
                        F.array().cast("array<int>"))
    placed = days.select("jour", "n", slides.alias("slides"))
    outside = placed.where(F.size("slides") == 0).agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n"))
    per = (placed.select(F.explode("slides").alias("slide"), "jour", "n")
           .groupBy("slide").agg(F.min("jour").alias("min_date_table"),
                                 F.max("jour").alias("max_date_table"),
                                 F.sum("n").alias("nb_lignes")))
    wins = window_list(state, n_slides, step_days).select(
        "slide", F.col("new_start").alias("start_date"), F.col("new_end").alias("end_date"))
    c = wins.join(per, "slide", "left").select(
        "slide", "start_date", "end_date", "min_date_table", "max_date_table",
        F.coalesce("nb_lignes", F.lit(0).cast("bigint")).alias("nb_lignes"),
        outside.scalar().alias("rows_outside"))
    verdict = _verdict(c, "start_date", "end_date")
    return c.select("*", *verdict[:-1],
                    ((F.col("rows_outside") == 0) & verdict[-1]).alias("in_bounds"))


def check_window_advanced(history: DataFrame, step_days: int = SLIDE_DAYS) -> DataFrame:
    """CK-4: each state version against the one stored before it; both bounds
    must have moved by ``step_days`` for every version between the two."""
    w = W.orderBy("version")   # one row per version
    j = history.select("version", "start_date", "end_date",
                       F.lag("version").over(w).alias("prev_version"),
                       F.lag("start_date").over(w).alias("prev_start"),
                       F.lag("end_date").over(w).alias("prev_end")).where("prev_version is not null")
    ds = F.datediff("start_date", "prev_start")
    de = F.datediff("end_date", "prev_end")
    due = step_days * (F.col("version") - F.col("prev_version"))
    return j.select("version", "start_date", "end_date", ds.alias("start_shift_days"),
                    de.alias("end_shift_days"),
                    F.coalesce((ds == due) & (de == due), F.lit(False)).alias("advanced_ok"))
