"""Many slides in one job (RW-3), the event-time sliding form (RW-4).

Instead of re-reading the source once per slide, days are expanded into the
slides whose window contains them (``slide_range``: at most ceil(width/step)
slides per day, pure arithmetic, no range join, nothing broadcast):

* counts and satoshi sums: one row per day, expanded and summed per slide;
* median: counts of each day's values, selected by slices per slide;
* distinct addresses: one shuffle keyed by address carrying the set of
  days each address is active (bounded by the calendar).  The sorted days become
  disjoint runs of slides that hold the address; a run adds 1 at its first slide
  and takes 1 off behind its last, and the running sum over the slides is
  their count (``address_changes``, ``sweep``).  An address has two rows a run,
  however many slides a run spans.

Empty windows are kept by a left join from the window list (one row per
slide).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewatch.functions.columns import as_date, slide_range
from tidewatch.operators.extract import extract_window, project_window
from tidewatch.operators.kpi import (
    global_columns, kpi_daily, kpi_daily_from, measures, merge_partials, partial_aggs, value_counts, with_median,
)
from tidewatch.plans.windows import slides_until, state_bounds, state_row, window_list
from tidewatch.schema import RAW_MONTH, RAW_TS, SLIDE_DAYS, WHALE_THRESHOLD_SAT


def _bounds(state):
    """Bounds as Columns: literals for a ``(start, end)`` pair (pushed to the
    Parquet scan and constant-folded into month pruning), one scalar
    subquery for a state DataFrame (pruned at run time)."""
    if isinstance(state, DataFrame):
        return state_bounds(state)
    return as_date(state[0]), as_date(state[1])


def _state_df(state, spark) -> DataFrame:
    if isinstance(state, DataFrame):
        return state
    return state_row(spark, state[0], state[1])


def slides_window(raw: DataFrame, state, n_slides: int | None,
                  step_days: int = SLIDE_DAYS) -> DataFrame:
    """The union of the windows of slides 1..n, extracted once.  With
    ``n_slides=None`` every slide up to the end of the data.  ``state`` is
    a one-row state DataFrame or a ``(start, end)`` pair of dates."""
    start, end = _bounds(state)
    lo = F.date_add(start, step_days)
    if n_slides is None:
        pred = (F.col(RAW_MONTH) >= F.trunc(lo, "MM")) & (F.col(RAW_TS) >= lo.cast("timestamp"))
        return project_window(raw.filter(pred))
    return extract_window(raw, lo, F.date_add(end, step_days * n_slides))


def _n(window: DataFrame, state, n_slides, step_days) -> Column:
    if n_slides is None:
        return slides_until(window, _state_df(state, window.sparkSession), step_days,
                            ts_col="horodatage_bloc")
    return F.lit(n_slides)


def address_days(w: DataFrame) -> DataFrame:
    """``adresse, days``: the days on which each address is active."""
    day = F.col("jour_bloc") if "jour_bloc" in w.columns else F.to_date("horodatage_bloc")
    pairs = w.select(day.alias("jour"),
                     F.explode(F.array_union("input_addresses", "output_addresses")).alias("adresse"))
    # De-duplicated per day before the shuffle by address; whoever counts
    # addresses of longer windows reuses that partitioning.
    return pairs.groupBy("adresse").agg(F.collect_set("jour").alias("days"))   # bounded by the calendar


def day_addresses(w: DataFrame) -> DataFrame:
    """Distinct ``(jour, adresse)``, dealt out by address."""
    return address_days(w).select("adresse", F.explode("days").alias("jour"))


def address_changes(days: DataFrame, start: Column, end: Column, step_days: int, n: Column | None) -> DataFrame:
    """``slide, change`` from ``address_days`` rows: +1 at the first slide of each run
    of slides whose windows hold the address, -1 behind the last one.

    Day d lies in the slides from ceil((d - end) / step) to floor((d - start) /
    step), cut to 1..n (with ``n=None`` not cut); both ends rise with the day, so in day order a run ends
    where the next day's first slide is not the one behind the last day's, nor
    before it."""
    # the bounds may be subqueries, which lambdas do not take
    bounded = days.select("days", start.alias("_start"), end.alias("_end"), *([] if n is None else [n.alias("_n")]))
    first = lambda d: F.ceil(F.datediff(d, F.col("_end")) / F.lit(step_days)).cast("int")
    last = lambda d: F.floor(F.datediff(d, F.col("_start")) / F.lit(step_days)).cast("int")
    ends = F.transform(F.array_sort("days"), lambda d: F.struct(
        (first(d) if n is None else F.greatest(first(d), F.lit(1))).alias("first"),
        (last(d) if n is None else F.least(last(d), F.col("_n"))).alias("last")))
    rows = bounded.select(F.filter(ends, lambda s: s["first"] <= s["last"]).alias("ends"))
    before = lambda i: F.get("ends", i - 1)["last"]
    after = lambda i: F.get("ends", i + 1)["first"]
    starts = F.filter("ends", lambda s, i: before(i).isNull() | (s["first"] > before(i) + 1))
    stops = F.filter("ends", lambda s, i: after(i).isNull() | (after(i) > s["last"] + 1))
    one = F.lit(1).cast("bigint")
    changes = F.concat(F.transform(starts, lambda s: F.struct(s["first"].alias("slide"), one.alias("change"))),
                       F.transform(stops, lambda s: F.struct((s["last"] + 1).alias("slide"), (-one).alias("change"))))
    return rows.select(F.inline(changes))


def sweep(changes: DataFrame, n: Column | None) -> DataFrame:
    """``slide, n_addr``: the running sum of the changes at each slide that has one,
    held until the next (the last one until ``n``).  The sums per slide are partial in every task; what the
    window runs over is one row a slide."""
    sums = changes.groupBy("slide").agg(F.sum("change").alias("change"))
    order = W.orderBy("slide")
    held = sums.select("slide", F.sum("change").over(order).alias("n_addr"), F.lead("slide").over(order).alias("next"))
    upto = F.col("next") - 1 if n is None else F.least(F.coalesce(F.col("next") - 1, n), n)
    return held.where(F.col("slide") <= upto).select(F.explode(F.sequence("slide", upto)).alias("slide"), "n_addr")


def active_addresses_slides(days: DataFrame, start: Column, end: Column, step_days: int, n: Column | None) -> DataFrame:
    """G9 of slides 1..n, or with ``n=None`` of all, from ``address_days`` rows: ``slide,
    n_addr`` (none for a slide before the first or behind the last with an address)."""
    return sweep(address_changes(days, start, end, step_days, n), n)


def day_tables(w: DataFrame, whale_sat: int = WHALE_THRESHOLD_SAT) -> list[DataFrame]:
    """What the KPIs of any set of whole days follow from: partials per day,
    counts of each day's values, distinct (day, address)."""
    rows = measures(w)
    return [rows.groupBy("jour").agg(*partial_aggs(whale_sat=whale_sat)),
            value_counts(rows, ["jour"]), day_addresses(w)]


def _slide_kpis(days: DataFrame, values: DataFrame, slides_of, keys: list) -> DataFrame:
    """Per-slide partials + median.

    ``slides_of(df)`` adds the slide columns ``keys`` to rows with a day, one
    row for each slide whose window holds it: one row per day, and one per
    distinct value of a day, are what is expanded."""
    partials = merge_partials(slides_of(days), keys)
    return with_median(partials, slides_of(values).select(*keys, "out_sat", "c"), keys)


def kpi_global_slides(raw: DataFrame, state, n_slides: int | None = 15,
                      step_days: int = SLIDE_DAYS, whale_sat: int = WHALE_THRESHOLD_SAT,
                      window: DataFrame | None = None, tables: list | None = None) -> DataFrame:
    """Global KPIs (G1..G9) of slides 1..n in one job: one row per slide,
    ``slide, new_start, new_end`` + the nine KPI columns.

    ``window`` may be an already materialised ``slides_window`` table and
    ``tables`` its ``day_tables``; with both, ``raw`` is not read."""
    w = window if window is not None else slides_window(raw, state, n_slides, step_days)
    start, end = _bounds(state)
    n = _n(w, state, n_slides, step_days)
    slides_of = lambda df: df.select("*", F.explode(
        slide_range(F.col("jour"), start, end, step_days, 1, n)).alias("slide"))
    days, values, *addresses = tables or day_tables(w, whale_sat)[:2]
    kpis = _slide_kpis(days, values, slides_of, ["slide"])
    active = addresses[0].groupBy("adresse").agg(F.collect_set("jour").alias("days")) if addresses else address_days(w)
    addrs = active_addresses_slides(active, start, end, step_days, n)
    wins = window_list(_state_df(state, w.sparkSession), n, step_days).select(
        "slide", "new_start", "new_end")
    return (wins.join(kpis, "slide", "left").join(addrs, "slide", "left")
            .select("slide", "new_start", "new_end", *global_columns(),
                    F.coalesce("n_addr", F.lit(0).cast("bigint")).alias("adresses_actives_global")))


def kpi_daily_slides(raw: DataFrame, state, n_slides: int | None = 15,
                     step_days: int = SLIDE_DAYS, whale_sat: int = WHALE_THRESHOLD_SAT,
                     window: DataFrame | None = None, tables: list | None = None) -> DataFrame:
    """Daily KPI tables of slides 1..n: ``slide`` + the ten daily columns.

    A day's KPIs do not depend on the window, so they are computed once per
    day and the one-row-per-day result is expanded to its slides."""
    w = window if window is not None else slides_window(raw, state, n_slides, step_days)
    start, end = _bounds(state)
    n = _n(w, state, n_slides, step_days)
    daily = kpi_daily_from(*tables) if tables else kpi_daily(w, whale_sat)
    expand = F.explode(slide_range(F.col("jour"), start, end, step_days, 1, n)).alias("slide")
    return daily.select(expand, *daily.columns)


def kpi_sliding_eventtime(window: DataFrame, start_day, end_day, step_days: int = SLIDE_DAYS,
                          whale_sat: int = WHALE_THRESHOLD_SAT) -> DataFrame:
    """RW-4: the same windows through Spark's ``window()`` (width
    ``end-start+1`` days, slide ``step`` days, aligned on ``start``).

    Every window that holds at least one transaction is emitted, including
    the ones that start before ``start``; ``slide`` numbers them relative to
    the state (0 = the state window).  ``start_day``/``end_day`` must be
    Python dates or ISO strings: ``window()`` takes literal durations.
    Days and values of a day are counted before ``window()`` expands them;
    an address's days become runs of slides (``active_addresses_slides``), so
    that a day of an address is not expanded."""
    s = _dt.date.fromisoformat(str(start_day))
    e = _dt.date.fromisoformat(str(end_day))
    width = (e - s).days + 1
    offset = (s - _dt.date(1970, 1, 1)).days % step_days

    win = F.window(F.col("jour").cast("timestamp"), f"{width} days",
                   f"{step_days} days", f"{offset} days").alias("w")
    slides_of = lambda df: df.select("*", win)
    days, values, _ = day_tables(window, whale_sat)
    kpis = _slide_kpis(days, values, slides_of, ["w"])
    addrs = active_addresses_slides(address_days(window), as_date(s), as_date(e), step_days, None)
    ws = F.to_date(F.col("w.start"))
    slide = (F.datediff(ws, as_date(s)) / F.lit(step_days)).cast("int").alias("slide")
    return kpis.select("*", slide).join(addrs, "slide", "left").select(
        "slide", ws.alias("new_start"), F.date_sub(F.to_date(F.col("w.end")), 1).alias("new_end"),
        *global_columns(),
        F.coalesce("n_addr", F.lit(0).cast("bigint")).alias("adresses_actives_global"))


__all__ = ["slides_window", "kpi_global_slides", "kpi_daily_slides", "kpi_sliding_eventtime"]
