"""Column names of the output contract and the fixed constants.

Fixed values (they must stay equal to the semantics being reproduced):
  1 coin = 100,000,000 satoshi; whale threshold = 100 coins (inclusive);
  slide step = 7 days.
"""

from __future__ import annotations

SAT_PER_COIN = 100_000_000
WHALE_THRESHOLD_COINS = 100
WHALE_THRESHOLD_SAT = WHALE_THRESHOLD_COINS * SAT_PER_COIN
SLIDE_DAYS = 7

# Median, batch: exact selection by slices of the satoshi value, from these
# bit positions down (the first slice holds all bits above).
MEDIAN_SHIFTS = (32, 16, 0)

# Median, streaming: percentile_approx accuracy (state per open window).
MEDIAN_ACCURACY = 100_000

# Raw transaction table (source).
RAW_TS = "block_timestamp"
RAW_MONTH = "block_timestamp_month"

# Window table: day partition column and exact satoshi values.
WINDOW_DAY = "jour_bloc"
IN_SAT = "valeur_entrees_sat"
OUT_SAT = "valeur_sorties_sat"

# Daily KPI table (10 columns, in order).
DAILY_KPIS = [
    "jour", "nombre_transactions_jour", "volume_transactions_jour",
    "valeur_moyenne_transaction_jour", "valeur_mediane_transaction_jour",
    "complexite_moyenne_input_sur_output", "vitesse_circulation_proxy_day",
    "coinbase_inflat", "whale_ratio_day", "adresses_actives_jour",
]

# Global KPI table (9 columns, in order).
GLOBAL_KPIS = [
    "nombre_transactions_total", "volume_transactions_total", "valeur_moyenne_transaction",
    "valeur_mediane_transaction_total", "vitesse_circulation_proxy_global",
    "coinbase_inflat_global", "whale_volume_global", "whale_ratio_global",
    "adresses_actives_global",
]
