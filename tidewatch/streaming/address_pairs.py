"""Each (slide, address) of sliding windows once, as soon as it is seen (RW-7, G9).

A row for each pair in a state store is read and written alone, and found again alone
when its window closes.  Here the addresses are dealt by hash into ``groups``, and two
slides that follow each other are one longer window of Spark's ``window()``: a state row
has the addresses of a group in such a pair of slides, with the slides each was seen in.
Python is called once for each of them and batch, and works on arrays.

A row is sent once for each pair of slides that holds it.  It counts as late when both of
them have closed.
"""

from __future__ import annotations

import datetime as _dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewatch.session import ship_package
from tidewatch.streaming.kpi_stream import TS

#: What the stream emits (a slide by its first day, in days since 1970), and a state row:
#: addresses, each with its slides as bits.
SEEN = "first_day int, adresse string"
STATE = "adresse array<string>, slides array<int>"
#: Slides of a state row; groups of addresses.
SLIDES, GROUPS = 2, 128


def _update(width: int, step: int, slides: int):
    def run(key, batches, state: GroupState):
        start = int(key[0])
        if state.hasTimedOut:
            state.remove()
            return
        held, bits = state.get if state.exists else ([], [])
        names, days = [np.array(held, object)], []
        for rows in batches:
            names.append(rows["adresse"].to_numpy(object))
            days.append(rows["day"].to_numpy("int64"))
        code, names = pd.factorize(np.concatenate(names), use_na_sentinel=False)
        code, days = code[len(held):], np.concatenate(days) - start   # the held ones are numbered first
        known = np.zeros(len(names), "int64")
        known[:len(held)] = bits
        firsts, fresh = [], []
        for k in range(slides):
            seen = np.zeros(len(names), bool)
            seen[code[(days >= k * step) & (days < k * step + width)]] = True
            new = names[seen & (known >> k & 1 == 0)]
            known |= seen.astype("int64") << k
            firsts.append(np.full(len(new), start + k * step, "int32"))
            fresh.append(new)
        state.update((names.tolist(), known.tolist()))
        end = start + (slides - 1) * step + width
        state.setTimeoutTimestamp(max(end * 86_400_000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"first_day": np.concatenate(firsts), "adresse": np.concatenate(fresh)})
    return run


def sliding_address_stream(stream: DataFrame, width_days: int, step_days: int, offset_days: int,
                           start_day, watermark: str = "1 day", groups: int = GROUPS) -> DataFrame:
    """Each ``(slide, new_start, new_end, adresse)`` once, when it is first seen.  An
    append-mode stream.  ``groups`` is fixed at the first start, as the number of state
    partitions is."""
    ship_package(stream.sparkSession)
    block = F.window(TS, f"{width_days + (SLIDES - 1) * step_days} days", f"{SLIDES * step_days} days", f"{offset_days} days")
    rows = stream.withWatermark(TS, watermark).select(
        block.alias("w"), F.unix_date(F.to_date(TS)).alias("day"),
        F.explode(F.array_union("input_addresses", "output_addresses")).alias("adresse"))
    keyed = rows.select(F.unix_date(F.to_date("w.start")).alias("_block"), F.pmod(F.xxhash64("adresse"), F.lit(groups)).cast("int").alias("_group"),
                        F.window_time("w").alias("_end"), "day", "adresse")
    seen = keyed.groupBy("_block", "_group").applyInPandasWithState(
        _update(width_days, step_days, SLIDES), SEEN, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    first = F.date_from_unix_date("first_day")
    zero = F.lit(str(_dt.date.fromisoformat(str(start_day)))).cast("date")
    return seen.select((F.datediff(first, zero) / F.lit(step_days)).cast("int").alias("slide"),
                       first.alias("new_start"), F.date_add(first, width_days - 1).alias("new_end"), "adresse")
