"""Stream inputs: mapping of ``events`` and raw transactions to stream rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.extract import project_window
from tidewatch.schema import IN_SAT, OUT_SAT, SAT_PER_COIN, WINDOW_DAY

# Fixed value: ``events.value`` is a coin amount with two decimals.
CENTS_PER_COIN = 100

EVENT_TX_SCHEMA = (
    "hachage_transaction string, horodatage_bloc timestamp, jour_bloc date, "
    "valeur_sorties double, valeur_sorties_sat bigint, valeur_entrees_sat bigint, "
    "est_coinbase boolean, compte_entrees bigint, compte_sorties bigint, "
    "input_addresses array<string>, output_addresses array<string>")


def events_as_tx(events: DataFrame) -> DataFrame:
    """``events`` as transaction rows (FIXTURES.md §5): ``ts`` is the event
    time, ``'A' || user_id`` the (input) address, ``value`` the output value.
    Fields an event does not carry (input value, coinbase flag, input and
    output counts) are NULL, so the KPIs built on them are NULL too."""
    ts = F.col("ts").cast("timestamp")
    sat = F.round(F.col("value") * CENTS_PER_COIN).cast("bigint") * (SAT_PER_COIN // CENTS_PER_COIN)
    addr = F.concat(F.lit("A"), F.col("user_id").cast("string"))
    return events.select(
        F.col("event_id").cast("string").alias("hachage_transaction"),
        ts.alias("horodatage_bloc"), F.to_date(ts).alias(WINDOW_DAY),
        F.try_divide(sat, F.lit(float(SAT_PER_COIN))).alias("valeur_sorties"),
        sat.alias(OUT_SAT), F.lit(None).cast("bigint").alias(IN_SAT),
        F.lit(None).cast("boolean").alias("est_coinbase"),
        F.lit(None).cast("bigint").alias("compte_entrees"),
        F.lit(None).cast("bigint").alias("compte_sorties"),
        F.when(addr.isNull(), F.array().cast("array<string>")).otherwise(F.array(addr))
         .alias("input_addresses"),
        F.array().cast("array<string>").alias("output_addresses"))


def tx_as_stream_rows(raw: DataFrame) -> DataFrame:
    """Raw transactions as flat window rows (the stream carries the window
    table's shape)."""
    return project_window(raw)
