"""Address operators: de-nesting, exploding and distinct address sets.

Distinct counts are planned by Spark as a de-duplication keyed by
(group, address) — partial de-duplication before the shuffle, a shuffle
that spreads on the address — followed by a small count per group, so a
heavy day or a hot address does not land whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.schema import WINDOW_DAY


def address_edges(raw: DataFrame) -> DataFrame:
    """JN-2: one row per non-NULL address slot of the raw nested arrays,
    ``(hachage_transaction, side, slot_index, adresse)``; duplicates kept.

    One pass: both arrays become one array of slots tagged with their side,
    then two chained generators (Spark allows one generator per select)."""
    def tagged(col: str, name: str):
        return F.transform(F.coalesce(F.col(col), F.array().cast(raw.schema[col].dataType)),
                           lambda s: F.struct(F.lit(name).alias("side"), s["index"].alias("slot_index"),
                                              s["addresses"].alias("addresses")))
    slots = raw.select(F.col("hash").alias("hachage_transaction"),
                       F.explode(F.concat(tagged("inputs", "in"), tagged("outputs", "out"))).alias("slot"))
    return (slots.select("hachage_transaction", "slot.side", "slot.slot_index",
                         F.explode("slot.addresses").alias("adresse"))
            .filter(F.col("adresse").isNotNull()))


def explode_addresses(window: DataFrame, column: str = "input_addresses") -> DataFrame:
    """JN-3: ``FROM T, UNNEST(col) AS addr`` (an empty array yields no row)."""
    return window.select("hachage_transaction", F.col(WINDOW_DAY).alias("jour"),
                         F.explode(column).alias("adresse"))


def _day_address_pairs(window: DataFrame) -> DataFrame:
    # one scan: inputs ∪ outputs per transaction, then one row per address
    return window.select(F.col(WINDOW_DAY).alias("jour"),
                         F.explode(F.array_union("input_addresses", "output_addresses"))
                          .alias("adresse"))


def daily_address_set(window: DataFrame) -> DataFrame:
    """SET-1: distinct ``(jour, adresse)`` over inputs ∪ outputs."""
    return _day_address_pairs(window).filter(F.col("adresse").isNotNull()).distinct()


def window_address_set(window: DataFrame) -> DataFrame:
    """SET-2: distinct ``adresse`` over inputs ∪ outputs of the whole window."""
    return (window.select(F.explode(F.array_union("input_addresses", "output_addresses"))
                          .alias("adresse"))
            .filter(F.col("adresse").isNotNull()).distinct())


def active_addresses_daily(window: DataFrame) -> DataFrame:
    """AG-11 / D9 without the zero fill: ``(jour, adresses_actives_jour)``."""
    return (_day_address_pairs(window).groupBy("jour")
            .agg(F.count_distinct("adresse").alias("adresses_actives_jour")))


def active_addresses_global(window: DataFrame) -> DataFrame:
    """AG-12 / G9: one row ``adresses_actives_global`` (0 on an empty window)."""
    return (window.select(F.explode(F.array_union("input_addresses", "output_addresses"))
                          .alias("adresse"))
            .agg(F.count_distinct("adresse").alias("adresses_actives_global")))
