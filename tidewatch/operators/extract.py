"""Window extraction: filter the raw table to a day range and flatten it.

PRJ-1 (renames), PRJ-2 (satoshi → coin), PRJ-4 (address arrays) and
FLT-1..4 (month partition filter + half-open timestamp filter).  Row-local:
no shuffle, no UDF; only the needed raw columns (and only the
``addresses`` leaf of the nested arrays) are read from Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import (
    as_date, day_of, distinct_addresses, month_of, sat_to_coin, window_predicate,
)
from tidewatch.schema import IN_SAT, OUT_SAT, RAW_MONTH, RAW_TS, WINDOW_DAY


def project_window(raw: DataFrame) -> DataFrame:
    """Raw rows → window-table rows (14 contract columns + 3 additions)."""
    return raw.select(
        F.col("hash").alias("hachage_transaction"),
        F.col("block_number").alias("numero_bloc"),
        F.col(RAW_TS).alias("horodatage_bloc"),
        F.col("size").alias("taille_bytes"),
        F.col("virtual_size").alias("taille_virtuelle_bytes"),
        F.col("version").alias("version_protocole"),
        F.col("input_count").alias("compte_entrees"),
        F.col("output_count").alias("compte_sorties"),
        F.col("fee").alias("frais_transaction"),
        F.col("is_coinbase").alias("est_coinbase"),
        sat_to_coin(F.col("input_value")).alias("valeur_entrees"),
        sat_to_coin(F.col("output_value")).alias("valeur_sorties"),
        distinct_addresses(F.col("inputs")).alias("input_addresses"),
        distinct_addresses(F.col("outputs")).alias("output_addresses"),
        day_of(F.col(RAW_TS)).alias(WINDOW_DAY),
        F.col("input_value").cast("bigint").alias(IN_SAT),
        F.col("output_value").cast("bigint").alias(OUT_SAT),
    )


def filter_month(raw: DataFrame, month) -> DataFrame:
    """FLT-1: one month partition (``month`` is any day of it)."""
    return raw.filter(F.col(RAW_MONTH) == month_of(as_date(month)))


def filter_month_range(raw: DataFrame, first_month, last_month) -> DataFrame:
    """FLT-2: months ``first..last`` inclusive."""
    return raw.filter(F.col(RAW_MONTH).between(month_of(as_date(first_month)),
                                               month_of(as_date(last_month))))


def filter_ts_halfopen(raw: DataFrame, lower_ts, upper_ts, month_col: str | None = RAW_MONTH) -> DataFrame:
    """FLT-3: ``lower <= ts < upper`` with explicit timestamps, plus the
    redundant month predicate that prunes partitions."""
    lo = lower_ts if isinstance(lower_ts, Column) else F.lit(lower_ts).cast("timestamp")
    hi = upper_ts if isinstance(upper_ts, Column) else F.lit(upper_ts).cast("timestamp")
    pred = (F.col(RAW_TS) >= lo) & (F.col(RAW_TS) < hi)
    if month_col:
        # the upper bound is exclusive: its month is the month of (hi - 1 µs)
        last = F.to_date(hi - F.expr("INTERVAL 1 MICROSECOND"))
        pred = F.col(month_col).between(month_of(F.to_date(lo)), month_of(last)) & pred
    return raw.filter(pred)


def extract_window(raw: DataFrame, start_day, end_day) -> DataFrame:
    """FLT-2 + FLT-4 + projection: transactions of days ``[start, end]``.

    ``start_day``/``end_day`` may be dates, ISO strings or Columns (for
    instance scalar subqueries on the state table).
    """
    return project_window(raw.filter(window_predicate(start_day, end_day)))
