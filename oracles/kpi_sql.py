"""DuckDB SQL text shared by the oracle queries of ``__spark_entry__``.

The finishing expressions turn exact integer partials into the KPI values
with the same operation order as ``tidewatch.operators.kpi``.
"""

from __future__ import annotations

from tidewatch.schema import WHALE_THRESHOLD_SAT

# Partials over a relation of transactions ``t`` (columns of the fixture ``tx``).
PARTIALS_SQL = f"""count(*) AS n, sum(output_value) AS so, count(output_value) AS co,
  sum(input_value) AS si, count(*) FILTER (WHERE is_coinbase) AS ncb,
  sum(CASE WHEN output_value >= {WHALE_THRESHOLD_SAT} THEN output_value ELSE 0 END) AS sw,
  sum(input_count) AS sci, sum(output_count) AS sco,
  quantile_disc(output_value, 0.5) AS med"""

FIN = {
    "count": "coalesce(n, 0)",
    "volume": "CAST(so AS DOUBLE) / 1e8",
    "mean": "CAST(so AS DOUBLE) / NULLIF(co, 0) / 1e8",
    "median": "med / 1e8",
    "complexity": "CAST(sci AS DOUBLE) / NULLIF(CAST(sco AS DOUBLE), 0)",
    "velocity": "CAST(so AS DOUBLE) / NULLIF(CAST(si AS DOUBLE), 0)",
    "coinbase": "CAST(ncb AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0)",
    "whale_volume": "CAST(sw AS DOUBLE) / 1e8",
    "whale_ratio": "CAST(sw AS DOUBLE) / NULLIF(CAST(so AS DOUBLE), 0)",
}

DAILY = [("count", "nombre_transactions_jour"), ("volume", "volume_transactions_jour"),
         ("mean", "valeur_moyenne_transaction_jour"), ("median", "valeur_mediane_transaction_jour"),
         ("complexity", "complexite_moyenne_input_sur_output"),
         ("velocity", "vitesse_circulation_proxy_day"), ("coinbase", "coinbase_inflat"),
         ("whale_ratio", "whale_ratio_day")]
GLOBAL = [("count", "nombre_transactions_total"), ("volume", "volume_transactions_total"),
          ("mean", "valeur_moyenne_transaction"), ("median", "valeur_mediane_transaction_total"),
          ("velocity", "vitesse_circulation_proxy_global"), ("coinbase", "coinbase_inflat_global"),
          ("whale_volume", "whale_volume_global"), ("whale_ratio", "whale_ratio_global")]


def finish(cols) -> str:
    return ",\n  ".join(f"{FIN[k]} AS {name}" for k, name in cols)


# Distinct (k, addr) over inputs ∪ outputs.
ADDR_UNION = "(SELECT k, addr FROM tx_in_a UNION SELECT k, addr FROM tx_out_a)"


def base_state_cte(month: str) -> str:
    """``st(s, e)``: first and last day with data in the base month."""
    return f"""st AS (
  SELECT min(day) AS s, max(day) AS e FROM tx
  WHERE block_timestamp_month = DATE '{month}'
    AND block_timestamp >= CAST(DATE '{month}' AS TIMESTAMP)
    AND block_timestamp < CAST(DATE '{month}' + INTERVAL 1 MONTH AS TIMESTAMP))"""


def all_slides_cte(month: str, step: int) -> str:
    """``st`` plus ``wins(slide, ws, we)`` for slides 1..n, n = last slide
    whose window starts on or before the last day with data."""
    return base_state_cte(month) + f""",
nn AS (SELECT CAST(floor(date_diff('day', st.s, (SELECT max(day) FROM tx)) / {step}) AS BIGINT) AS n FROM st),
sl AS (SELECT unnest(generate_series(1, nn.n)) AS slide FROM nn),
wins AS (SELECT CAST(sl.slide AS INTEGER) AS slide, st.s + {step} * CAST(sl.slide AS INTEGER) AS ws,
                st.e + {step} * CAST(sl.slide AS INTEGER) AS we FROM sl, st)"""
