"""Distinct addresses of sliding windows with one state entry an address (RW-7, G9).

A day lies in a range of slides.  The slides that hold an address are disjoint runs;
its state has those runs that a row of today or later can still lengthen or
join.  When rows change an address's runs, the stream emits the difference at their
ends: +1 where a run starts, -1 behind its end, and the opposite for ends that are
no longer there.  All emitted changes of a slide added up, and then a running sum
over the slides, are the counts (``slide_counts``), at any moment and in any order of
arrival within the watermark.

A (window, address) state has some width / 7 rows an address and a shuffle of as
many; here a row is sent once, and a run that goes on for a year is one pair of
numbers.

Addresses are dealt by hash into ``groups``, and a state row has the runs of all
addresses of a group: Python is called once a group and batch, and works on the arrays
of all its addresses at once.  With fewer addresses than groups nearly each has a row
of its own.  Runs that the watermark has passed leave the state when rows of their
group arrive, and a group without any run leaves with its last one.
"""

from __future__ import annotations

import datetime as _dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window as W

from tidewatch.session import ship_package
from tidewatch.streaming.kpi_stream import TS

#: What the stream emits, and a group's state: addresses with the first and last slides of their runs.
CHANGES = "slide int, change bigint"
STATE = "adresse array<string>, first array<int>, last array<int>"
#: State rows at most.
GROUPS = 4096
_EPOCH = _dt.date(1970, 1, 1)
_APART = 1 << 32   # more than any two slides differ


def merged_runs(code: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of slides of addresses (numbered from 0) as disjoint runs of each, none of
    which ends right before another.  In one order of all: addresses lie far apart."""
    lo = code * _APART + first
    order = np.argsort(lo, kind="stable")
    lo, upto = lo[order], np.maximum.accumulate((code * _APART + last)[order])
    starts = np.ones(len(lo), bool)
    starts[1:] = lo[1:] > upto[:-1] + 1
    code = code[order][starts]
    return code, lo[starts] - code * _APART, upto[np.append(starts[1:], True)[:len(lo)]] - code * _APART


def run_changes(old: tuple[np.ndarray, np.ndarray], new: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Slides and changes that turn the ends of the old runs into those of the new ones."""
    slides, at = np.unique(np.concatenate([new[0], old[1] + 1, old[0], new[1] + 1]), return_inverse=True)
    total = np.zeros(len(slides), "int64")
    np.add.at(total, at, np.repeat([1, -1], len(old[0]) + len(new[0])))
    return slides[total != 0], total[total != 0]


def _arrays(runs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array(runs, "int64").reshape(-1, 2).T)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``merged_runs`` of one address."""
    first, last = _arrays(runs)
    return list(zip(*(a.tolist() for a in merged_runs(np.zeros(len(runs), "int64"), first, last)[1:])))


def changes(old: list[tuple[int, int]], new: list[tuple[int, int]]) -> dict[int, int]:
    """``run_changes`` of runs given as pairs."""
    return dict(zip(*(a.tolist() for a in run_changes(_arrays(old), _arrays(new)))))


def _update(start: int, width: int, step: int):
    """``start``: first day of slide 0, in days since 1970."""
    def first_slide(day):
        return -((start + width - 1 - day) // step)

    def run(key, batches, state: GroupState):
        held, *runs = state.get if state.exists else ([], [], [])
        old = tuple(np.array(r, "int64") for r in runs)
        names, firsts, lasts = [np.array(held, object)], [old[0]], [old[1]]
        if not state.hasTimedOut:
            for rows in batches:
                seen = rows[["adresse", "day"]].drop_duplicates()
                day = seen["day"].to_numpy("int64")
                first, last = first_slide(day), (day - start) // step
                some = first <= last
                names.append(seen["adresse"].to_numpy(object)[some])
                firsts.append(first[some])
                lasts.append(last[some])
        code, names = pd.factorize(np.concatenate(names), use_na_sentinel=False)
        code, first, last = merged_runs(code.astype("int64"), np.concatenate(firsts), np.concatenate(lasts))
        slides, change = run_changes(old, (first, last))
        open_from = first_slide(state.getCurrentWatermarkMs() // 86_400_000)   # the first slide that a row may still be in
        kept = last + 1 >= open_from
        if kept.any():
            state.update((names[code[kept]].tolist(), first[kept].tolist(), last[kept].tolist()))
            # the day on which the last run can no longer be joined
            done = start + width - 1 + (int(last[kept].max()) + 1) * step + 1
            state.setTimeoutTimestamp(max(done * 86_400_000, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if len(slides):
            yield pd.DataFrame({"slide": slides.astype("int32"), "change": change})
    return run


def sliding_address_runs(stream: DataFrame, width_days: int, step_days: int, start_day, watermark: str = "1 day",
                         groups: int = GROUPS) -> DataFrame:
    """``slide, change`` of every address's runs of ``width``-day windows that slide by
    ``step`` days; slide 0 starts on ``start_day``.  An append-mode stream.  ``groups``
    is fixed at the first start, as the number of state partitions is."""
    start = (_dt.date.fromisoformat(str(start_day)) - _EPOCH).days
    ship_package(stream.sparkSession)
    rows = stream.withWatermark(TS, watermark).where(F.col(TS).isNotNull()).select(
        TS, F.unix_date(F.to_date(TS)).alias("day"), F.explode(F.array_union("input_addresses", "output_addresses")).alias("adresse"))
    return rows.withColumn("_group", F.pmod(F.xxhash64("adresse"), F.lit(groups)).cast("int")).groupBy("_group").applyInPandasWithState(
        _update(start, width_days, step_days), CHANGES, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def slide_counts(emitted: DataFrame, width_days: int, step_days: int, start_day, name: str = "adresses_actives_global") -> DataFrame:
    """``slide, new_start, new_end, <name>`` of every slide that holds an address, from the sink of the stream."""
    sums = emitted.groupBy("slide").agg(F.sum("change").alias("change"))
    order = W.orderBy("slide")   # one row a slide
    held = sums.select("slide", F.sum("change").over(order).alias(name), F.lead("slide").over(order).alias("next")).where(F.col(name) > 0)
    slides = held.select(F.explode(F.sequence("slide", F.col("next") - 1)).alias("slide"), name)
    first = F.date_add(F.lit(str(start_day)).cast("date"), F.col("slide") * step_days)
    return slides.select("slide", first.alias("new_start"), F.date_add(first, width_days - 1).alias("new_end"), name)
