import datetime as dt

import pytest
from conftest import SF0001, make_raw, slot
from pyspark.sql import functions as F

from tidewatch.operators import kpi_daily, kpi_global, project_window
from tidewatch.schema import DAILY_KPIS, GLOBAL_KPIS
from tidewatch.sources import tx

D1 = dt.datetime(2020, 5, 1, 10)
D2 = dt.datetime(2020, 5, 2, 10)
D3 = dt.datetime(2020, 5, 3, 10)
COIN = 100_000_000


@pytest.fixture(scope="module")
def small(spark):
    return project_window(make_raw(spark, [
        # day 1: whale exactly at 100 coins, a NULL value, shared addresses
        {"ts": D1, "out_sat": 100 * COIN, "in_sat": 101 * COIN, "inputs": [slot("A", "B")],
         "outputs": [slot("B"), slot("C")]},
        {"ts": D1, "out_sat": 50 * COIN, "in_sat": 50 * COIN, "inputs": [slot("A")], "outputs": [slot("D")]},
        {"ts": D1, "out_sat": None, "in_sat": 1 * COIN, "inputs": [slot("E")], "outputs": [slot(None)]},
        # day 2: coinbase only, no input value, no addresses at all
        {"ts": D2, "cb": True, "out_sat": 10 * COIN, "in_sat": None, "inputs": [], "outputs": [slot(None)]},
        # day 3: zero outputs
        {"ts": D3, "out_sat": 0, "in_sat": 0, "inputs": [slot("Z")], "outputs": [], "output_count": 0},
    ]))


def test_daily_kpis_by_hand(small):
    rows = {r["jour"]: r for r in kpi_daily(small).collect()}
    assert list(kpi_daily(small).columns) == DAILY_KPIS
    r1 = rows[dt.date(2020, 5, 1)]
    assert r1["nombre_transactions_jour"] == 3
    assert r1["volume_transactions_jour"] == 150.0
    assert r1["valeur_moyenne_transaction_jour"] == 75.0          # NULL skipped, not 150/3
    assert r1["valeur_mediane_transaction_jour"] == 50.0          # member, lower middle
    assert r1["complexite_moyenne_input_sur_output"] == 3 / 4
    assert r1["vitesse_circulation_proxy_day"] == 150 / 152
    assert r1["coinbase_inflat"] == 0.0
    assert r1["whale_ratio_day"] == 100 / 150                     # 100 coins counts as whale
    assert r1["adresses_actives_jour"] == 5                      # A B C D E
    r2 = rows[dt.date(2020, 5, 2)]
    assert r2["vitesse_circulation_proxy_day"] is None           # coinbase-only day
    assert r2["coinbase_inflat"] == 1.0
    assert r2["adresses_actives_jour"] == 0                      # LEFT JOIN + COALESCE
    r3 = rows[dt.date(2020, 5, 3)]
    assert r3["complexite_moyenne_input_sur_output"] is None     # Σ outputs = 0
    assert r3["whale_ratio_day"] is None                         # Σ values = 0


def test_global_kpis_by_hand(small):
    g = kpi_global(small).collect()
    assert len(g) == 1 and list(kpi_global(small).columns) == GLOBAL_KPIS
    g = g[0]
    assert g["nombre_transactions_total"] == 5
    assert g["volume_transactions_total"] == 160.0
    assert g["valeur_moyenne_transaction"] == 40.0
    assert g["valeur_mediane_transaction_total"] == 10.0          # of 0,10,50,100
    assert g["whale_volume_global"] == 100.0
    assert g["whale_ratio_global"] == 100 / 160
    assert g["coinbase_inflat_global"] == 1 / 5
    assert g["adresses_actives_global"] == 6                      # A B C D E Z


def test_empty_window_gives_one_row(small):
    empty = small.filter(F.lit(False))
    g = kpi_global(empty).collect()
    assert len(g) == 1
    assert g[0]["nombre_transactions_total"] == 0
    assert g[0]["adresses_actives_global"] == 0
    assert all(g[0][c] is None for c in GLOBAL_KPIS[1:8])
    assert kpi_daily(empty).count() == 0


def test_invariants_on_fixture(spark):
    w = project_window(tx(spark, SF0001))
    d = kpi_daily(w)
    g = kpi_global(w).first()
    s = d.agg(F.sum("nombre_transactions_jour"), F.sum("volume_transactions_jour"),
              F.max("adresses_actives_jour"), F.sum("adresses_actives_jour")).first()
    assert s[0] == g["nombre_transactions_total"]
    assert abs(s[1] - g["volume_transactions_total"]) <= 1e-6 * g["volume_transactions_total"]
    assert s[2] <= g["adresses_actives_global"] <= s[3]
    assert g["whale_ratio_global"] == pytest.approx(g["whale_volume_global"] / g["volume_transactions_total"])
    bad = d.filter((F.col("whale_ratio_day") > 1) | (F.col("coinbase_inflat") > 1)
                   | (F.col("whale_ratio_day") < 0)).count()
    assert bad == 0


def _median_rows(spark, parts, order):
    """Group 0: 60,000 odd values, group 1: 60,001 even ones, group 2: no value,
    group 3: negative, huge and repeated values; group NULL: three values."""
    big = (spark.range(0, 120001, numPartitions=16)
           .select((F.col("id") % 2).alias("g"), ((F.col("id") * 7919) % 120011 + 2_100_000_000_000_000).alias("out_sat")))
    some = spark.createDataFrame(
        [(2, None), (3, -5), (3, -5), (3, 2**62), (3, 1), (3, None), (None, 7), (None, 9), (None, 8)], "g long, out_sat long")
    rows = big.union(some).select("g", "out_sat", F.col("out_sat").alias("in_sat"), F.lit(False).alias("cb"),
                                  F.lit(1).cast("bigint").alias("cnt_in"), F.lit(1).cast("bigint").alias("cnt_out"))
    return rows.repartition(parts, order) if order else rows.repartition(parts)


def test_median_is_exact_and_repeatable(spark):
    from tidewatch.operators.kpi import aggregate_kpis
    values = {0: [], 1: []}
    for i in range(120001):
        values[i % 2].append(i * 7919 % 120011 + 2_100_000_000_000_000)
    want = {g: sorted(v)[(len(v) - 1) // 2] for g, v in values.items()} | {2: None, 3: -5, None: 8}
    seen = []
    for parts, order in ((1, None), (7, "out_sat"), (16, "g"), (5, None), (5, None)):
        got = {r["g"]: r.asDict() for r in aggregate_kpis(_median_rows(spark, parts, order), ["g"]).collect()}
        assert {g: r["med_sat"] for g, r in got.items()} == want
        seen.append(got)
    assert all(s == seen[0] for s in seen)
    assert seen[0][0]["n"] == 60001 and seen[0][0]["sum_out"] == sum(values[0])
    whole = aggregate_kpis(_median_rows(spark, 8, None), []).first()
    all_values = sorted(values[0] + values[1] + [-5, -5, 2**62, 1, 7, 8, 9])
    assert whole["med_sat"] == all_values[(len(all_values) - 1) // 2]
    none = aggregate_kpis(_median_rows(spark, 2, None).where("g = 2"), []).first()
    assert none["med_sat"] is None and none["n"] == 1


def test_whale_threshold_is_a_parameter(spark):
    from conftest import make_raw
    w = project_window(make_raw(spark, [{"out_sat": 5}, {"out_sat": 10}]))
    assert kpi_global(w, whale_sat=10).first()["whale_ratio_global"] == pytest.approx(10 / 15)
    assert kpi_global(w).first()["whale_ratio_global"] == 0.0
