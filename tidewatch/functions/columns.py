"""Column expressions shared by the operators (all JVM built-ins, no UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.schema import RAW_MONTH, RAW_TS, SAT_PER_COIN


def as_date(value) -> Column:
    """A DATE column from a Column, ``datetime.date``, ISO string or None."""
    if isinstance(value, Column):
        return value.cast("date")
    if value is None:
        return F.lit(None).cast("date")
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value).cast("date")


def sat_to_coin(c: Column) -> Column:
    """Satoshi → coin as DOUBLE; NULL stays NULL (``SAFE_DIVIDE(x, 1e8)``)."""
    return F.try_divide(c, F.lit(float(SAT_PER_COIN)))


def sat_of_coin(c: Column) -> Column:
    """Coin DOUBLE → exact satoshi BIGINT (inverse of ``sat_to_coin``)."""
    return F.round(c * F.lit(float(SAT_PER_COIN))).cast("bigint")


def day_of(ts: Column) -> Column:
    """UTC calendar day of a timestamp (session time zone must be UTC)."""
    return F.to_date(ts)


def month_of(d: Column) -> Column:
    """First day of the month as DATE (``trunc``, not ``date_trunc``)."""
    return F.trunc(d, "MM")


def distinct_addresses(nested: Column) -> Column:
    """De-nested, NULL-free, de-duplicated addresses of an array of structs
    with an ``addresses`` array field.

    ``nested.addresses`` keeps nested-column pruning (only that leaf is read
    from Parquet).  The inner ``array_compact`` is needed because ``flatten``
    returns NULL when any sub-array is NULL.  A NULL or empty input yields
    an empty array, never NULL.
    """
    flat = F.flatten(F.array_compact(nested.getField("addresses")))
    return F.coalesce(F.array_distinct(F.array_compact(flat)),
                      F.array().cast("array<string>"))


def safe_ratio(num: Column, den: Column) -> Column:
    """``SAFE_DIVIDE`` on doubles: NULL on a NULL operand or a zero divisor."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ts_lower(start_day: Column) -> Column:
    """Inclusive lower timestamp bound: ``start`` at 00:00 UTC."""
    return start_day.cast("timestamp")


def ts_upper(end_day: Column) -> Column:
    """Exclusive upper timestamp bound: the day after ``end`` at 00:00 UTC."""
    return F.date_add(end_day, 1).cast("timestamp")


def window_predicate(start_day, end_day, ts_col: str = RAW_TS,
                     month_col: str | None = RAW_MONTH) -> Column:
    """Rows whose timestamp lies in the days ``[start, end]`` (both inclusive).

    The month predicate is redundant with the timestamp predicate but is
    what prunes month partitions: Spark does not derive the month from a
    timestamp filter.  With literal bounds it is constant-folded to a
    static partition filter; with scalar subqueries it prunes at run time.
    """
    s, e = as_date(start_day), as_date(end_day)
    ts = F.col(ts_col)
    pred = (ts >= ts_lower(s)) & (ts < ts_upper(e))
    if month_col:
        pred = F.col(month_col).between(month_of(s), month_of(e)) & pred
    return pred


def slide_range(day: Column, start_day, end_day, step_days: int,
                first: int = 1, last: Column | int | None = None) -> Column:
    """Array of the slide numbers ``i`` whose window
    ``[start + step*i, end + step*i]`` contains ``day``.

    Integer arithmetic on day offsets, so a day is expanded into at most
    ``ceil(width / step)`` rows and no range join is needed.
    """
    s, e = as_date(start_day), as_date(end_day)
    off = F.datediff(day, s)
    width = F.datediff(e, s)
    lo = F.greatest(F.ceil((off - width) / F.lit(step_days)), F.lit(first))
    hi = F.floor(off / F.lit(step_days))
    if last is not None:
        hi = F.least(hi, last if isinstance(last, Column) else F.lit(last))
    lo, hi = lo.cast("int"), hi.cast("int")
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
