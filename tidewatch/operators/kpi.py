"""Daily and global KPIs of a window table.

Every additive measure is kept as an exact partial (counts, and satoshi
sums as DECIMAL(38,0)): partial aggregates merge exactly across tasks,
days and slides, and results do not depend on the order of a
floating-point sum.  Coins are produced once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewatch.functions.columns import safe_ratio, sat_of_coin, sat_to_coin
from tidewatch.operators.addresses import active_addresses_daily, active_addresses_global
from tidewatch.schema import (
    DAILY_KPIS, GLOBAL_KPIS, IN_SAT, MEDIAN_ACCURACY, MEDIAN_SHIFTS, OUT_SAT, WHALE_THRESHOLD_SAT,
    WINDOW_DAY,
)

DEC = "decimal(38,0)"

# name → aggregate over transaction rows (see ``measures``), given the whale threshold.
PARTIALS = {
    "n": lambda whale: F.count(F.lit(1)),
    "sum_out": lambda whale: F.sum(F.col("out_sat").cast(DEC)),
    "cnt_out": lambda whale: F.count("out_sat"),
    "sum_in": lambda whale: F.sum(F.col("in_sat").cast(DEC)),
    "n_cb": lambda whale: F.count_if(F.col("cb")),
    "sum_whale": lambda whale: F.sum(F.when(F.col("out_sat") >= whale, F.col("out_sat"))
                                     .otherwise(F.lit(0)).cast(DEC)),
    "sum_cnt_in": lambda whale: F.sum("cnt_in"),
    "sum_cnt_out": lambda whale: F.sum("cnt_out"),
}


def _col_or(window: DataFrame, name: str, fallback: Column) -> Column:
    return F.col(name) if name in window.columns else fallback


def measures(window: DataFrame, keep=()) -> DataFrame:
    """The per-transaction columns the KPIs read (column-pruned scan);
    ``keep`` passes extra columns through (e.g. the event time of a stream)."""
    return window.select(
        *keep,
        _col_or(window, WINDOW_DAY, F.to_date("horodatage_bloc")).alias("jour"),
        _col_or(window, OUT_SAT, sat_of_coin(F.col("valeur_sorties"))).alias("out_sat"),
        _col_or(window, IN_SAT, sat_of_coin(F.col("valeur_entrees"))).alias("in_sat"),
        F.col("est_coinbase").alias("cb"),
        F.col("compte_entrees").alias("cnt_in"),
        F.col("compte_sorties").alias("cnt_out"),
    )


def partial_aggs(names=None, whale_sat: int = WHALE_THRESHOLD_SAT) -> list[Column]:
    return [PARTIALS[n](whale_sat).alias(n) for n in (names or PARTIALS)]


def median_agg(accuracy: int = MEDIAN_ACCURACY) -> Column:
    """Streaming median of output values in satoshi (one ``percentile_approx``
    sketch per open window in the state store): an actual member of the
    group, NULLs skipped, exact up to about ``accuracy`` values."""
    return F.percentile_approx("out_sat", 0.5, accuracy).alias("med_sat")


def value_counts(rows: DataFrame, keys: list) -> DataFrame:
    """How often each output value occurs per ``keys``: ``(keys..., out_sat, c)``.

    Counted before the shuffle, which spreads on (keys, value): a key with a
    third of all rows reaches every task."""
    return (rows.where(F.col("out_sat").isNotNull()).groupBy(*keys, "out_sat")
            .agg(F.count(F.lit(1)).alias("c")))


def exact_median(counts: DataFrame, keys: list) -> DataFrame:
    """The lower middle value per key, ``(keys..., med_sat)``, by slices.

    ``counts`` holds ``(keys..., out_sat, c)``.  Values are counted by their
    high bits, the slice that holds the middle rank is kept, and its values are
    counted by the next bits, down to single values.  Every round is a
    partially aggregated count with one small row per (key, slice); the counts
    are shuffled once and that exchange is reused.  Exact for any group size
    and independent of the order and partitioning of the rows.  Keys without
    a value have no row."""
    names = keys or ["_all"]
    if not keys:
        counts = counts.withColumn("_all", F.lit(0))
    picked, above = None, None
    for shift in MEDIAN_SHIFTS:
        slice_of = F.shiftright("out_sat", shift).alias("_slice")
        if picked is None:
            hist = counts.groupBy(*names, slice_of).agg(F.sum("c").alias("_n"))
            rank = F.ceil(F.sum("_n").over(W.partitionBy(*names)) / 2)
        else:
            p = picked.select(*[F.col(k).alias(f"_p_{k}") for k in names], "_kept", "_rank")
            same = [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in names]
            hist = (counts.join(p, same + [F.shiftright("out_sat", above) == F.col("_kept")])
                    .groupBy(*names, slice_of).agg(F.sum("c").alias("_n"), F.first("_rank").alias("_rank")))
            rank = F.col("_rank")
        upto = F.sum("_n").over(W.partitionBy(*names).orderBy("_slice"))
        ranked = hist.select(*names, "_slice", "_n", upto.alias("_upto"), rank.alias("_at"))
        picked = (ranked.where((F.col("_upto") >= F.col("_at")) & (F.col("_upto") - F.col("_n") < F.col("_at")))
                  .select(*names, F.col("_slice").alias("_kept"),
                          (F.col("_at") - (F.col("_upto") - F.col("_n"))).alias("_rank")))
        above = shift
    return picked.select(*keys, F.col("_kept").alias("med_sat"))


def with_median(partials: DataFrame, counts: DataFrame, keys: list) -> DataFrame:
    """Partial rows with their median; NULL for a key without a value."""
    med = exact_median(counts, keys)
    if not keys:   # one row on either side
        return partials.select("*", F.coalesce(med.scalar(), F.lit(None).cast("bigint")).alias("med_sat"))
    m = med.select(*[F.col(k).alias(f"_m_{k}") for k in keys], "med_sat")
    on = [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys]
    return partials.join(m, on, "left").drop(*[f"_m_{k}" for k in keys])


def aggregate_kpis(rows: DataFrame, keys: list, whale_sat: int = WHALE_THRESHOLD_SAT) -> DataFrame:
    """All partials plus the exact median per ``keys``.

    The partials are one aggregation with a map-side combine: a task sends one
    row per key, however many rows the key has."""
    partials = rows.groupBy(*keys).agg(*partial_aggs(whale_sat=whale_sat))
    return with_median(partials, value_counts(rows, keys), keys).select(*keys, *PARTIALS, "med_sat")


# KPI name → expression over the partial columns.
def finishers() -> dict[str, Column]:
    n, so, co = F.col("n"), F.col("sum_out"), F.col("cnt_out")
    return {
        "count": F.coalesce(n, F.lit(0).cast("bigint")),   # 0 for an empty window
        "volume": sat_to_coin(so.cast("double")),
        "mean": sat_to_coin(F.try_divide(so.cast("double"), co)),
        "median": sat_to_coin(F.col("med_sat")),
        "complexity": safe_ratio(F.col("sum_cnt_in"), F.col("sum_cnt_out")),
        "velocity": safe_ratio(so, F.col("sum_in")),
        "coinbase": safe_ratio(F.col("n_cb"), n),
        "whale_volume": sat_to_coin(F.col("sum_whale").cast("double")),
        "whale_ratio": safe_ratio(F.col("sum_whale"), so),
    }


DAILY_NAMES = dict(zip(
    ["count", "volume", "mean", "median", "complexity", "velocity", "coinbase", "whale_ratio"],
    DAILY_KPIS[1:9]))
GLOBAL_NAMES = dict(zip(
    ["count", "volume", "mean", "median", "velocity", "coinbase", "whale_volume", "whale_ratio"],
    GLOBAL_KPIS[:8]))


def daily_columns(keys=DAILY_NAMES) -> list[Column]:
    fin = finishers()
    return [fin[k].alias(name) for k, name in keys.items()]


def global_columns(keys=GLOBAL_NAMES) -> list[Column]:
    fin = finishers()
    return [fin[k].alias(name) for k, name in keys.items()]


def merge_partials(days: DataFrame, keys: list) -> DataFrame:
    """Partials of larger groups from those of their parts (all are sums)."""
    return days.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in PARTIALS])


def day_partials(window: DataFrame, whale_sat: int = WHALE_THRESHOLD_SAT) -> DataFrame:
    """Additive partials per day: ``(jour, n, sum_out, ...)``."""
    return measures(window).groupBy("jour").agg(*partial_aggs(whale_sat=whale_sat))


def kpi_daily(window: DataFrame, whale_sat: int = WHALE_THRESHOLD_SAT) -> DataFrame:
    """The daily KPI table (D1..D9), one row per day that has transactions.

    Two aggregations keyed by day (both partial before the shuffle) and a
    left join on day; both sides are one row per day, so AQE broadcasts
    the address side once its measured size allows it."""
    rows = measures(window)
    return _daily(rows.groupBy("jour").agg(*partial_aggs(whale_sat=whale_sat)),
                  value_counts(rows, ["jour"]), active_addresses_daily(window))


def kpi_daily_from(days: DataFrame, values: DataFrame, addresses: DataFrame) -> DataFrame:
    """The daily KPI table from day partials, counts of each day's values and
    distinct (jour, adresse)."""
    return _daily(days, values, addresses.groupBy("jour").agg(
        F.count("adresse").alias("adresses_actives_jour")))


def _daily(days: DataFrame, values: DataFrame, addrs: DataFrame) -> DataFrame:
    a = addrs.select(F.col("jour").alias("_day"), "adresses_actives_jour")
    return (with_median(days, values, ["jour"])
            .join(a, F.col("jour").eqNullSafe(F.col("_day")), "left")
            .select("jour", *daily_columns(),
                    F.coalesce(F.col("adresses_actives_jour"), F.lit(0).cast("bigint"))
                     .alias("adresses_actives_jour")))


def kpi_global(window: DataFrame, whale_sat: int = WHALE_THRESHOLD_SAT) -> DataFrame:
    """The global KPI table (G1..G9): exactly one row, also on an empty
    window.  G9 is an uncorrelated scalar subquery (the distinct count over
    the whole window, not a sum of daily counts)."""
    g = aggregate_kpis(measures(window), [], whale_sat)
    addr = active_addresses_global(window)
    return g.select(*global_columns(), addr.scalar().alias("adresses_actives_global"))


# -- single-KPI operators (each plans only the aggregates it needs) --------

def _daily_one(window: DataFrame, key: str, names) -> DataFrame:
    return (measures(window).groupBy("jour").agg(*partial_aggs(names))
            .select("jour", finishers()[key].alias(DAILY_NAMES[key])))


def tx_count_daily(window: DataFrame) -> DataFrame:
    return _daily_one(window, "count", ["n"])


def volume_daily(window: DataFrame) -> DataFrame:
    return _daily_one(window, "volume", ["sum_out"])


def avg_value_daily(window: DataFrame) -> DataFrame:
    return _daily_one(window, "mean", ["sum_out", "cnt_out"])


def median_value_daily(window: DataFrame) -> DataFrame:
    rows = measures(window)
    days = rows.groupBy("jour").agg(*partial_aggs(["n"]))   # days without a value keep a row
    return (with_median(days, value_counts(rows, ["jour"]), ["jour"])
            .select("jour", finishers()["median"].alias(DAILY_NAMES["median"])))


def complexity_daily(window: DataFrame) -> DataFrame:
    return _daily_one(window, "complexity", ["sum_cnt_in", "sum_cnt_out"])


def velocity_daily(window: DataFrame) -> DataFrame:
    return _daily_one(window, "velocity", ["sum_out", "sum_in"])


def coinbase_share_daily(window: DataFrame) -> DataFrame:
    return _daily_one(window, "coinbase", ["n_cb", "n"])


def whale_ratio_daily(window: DataFrame) -> DataFrame:
    return _daily_one(window, "whale_ratio", ["sum_whale", "sum_out"])


def whale_volume_global(window: DataFrame) -> DataFrame:
    return (measures(window).agg(*partial_aggs(["sum_whale"]))
            .select(finishers()["whale_volume"].alias("whale_volume_global")))


def whale_transactions(window: DataFrame, whale_sat: int = WHALE_THRESHOLD_SAT) -> DataFrame:
    """FLT-6: transactions whose output is at least the whale threshold."""
    m = window.select("hachage_transaction", "valeur_sorties",
                      _col_or(window, OUT_SAT, sat_of_coin(F.col("valeur_sorties"))).alias("out_sat"))
    return (m.filter(F.col("out_sat") >= whale_sat)
            .select("hachage_transaction", "valeur_sorties"))
