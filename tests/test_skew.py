"""Skewed input: one day holds a third of the rows and one address appears
in a third of the transactions.  Results must equal a brute-force
computation over the same rows (whole results, nothing dropped)."""

import datetime as dt
import random

import pytest
from conftest import make_raw, slot

from tidewatch.operators import kpi_daily, kpi_global, project_window
from tidewatch.plans import kpi_global_slides, state_row

HOT_DAY = dt.date(2021, 3, 10)
N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(N):
        day = HOT_DAY if i % 3 == 0 else dt.date(2021, 3, 1) + dt.timedelta(days=rnd.randrange(40))
        ins = [slot("HOT")] if i % 3 == 1 else [slot(f"U{rnd.randrange(500)}")]
        outs = [slot(f"U{rnd.randrange(500)}"), slot(None)]
        rows.append({"hash": f"t{i}", "ts": dt.datetime.combine(day, dt.time(rnd.randrange(24))),
                     "out_sat": None if i % 97 == 0 else rnd.randrange(1, 300) * 10**8,
                     "in_sat": rnd.randrange(1, 300) * 10**8, "inputs": ins, "outputs": outs})
    return rows, project_window(make_raw(spark, rows))


def _brute(rows, days):
    sel = [r for r in rows if r["ts"].date() in days]
    vals = sorted(r["out_sat"] for r in sel if r["out_sat"] is not None)
    addrs = {a for r in sel for s in r["inputs"] + r["outputs"] if s[1] for a in s[1] if a}
    return {"n": len(sel), "vol": sum(vals) / 1e8, "addr": len(addrs),
            "med": vals[(len(vals) - 1) // 2] / 1e8 if vals else None,
            "whale": sum(v for v in vals if v >= 100 * 10**8) / 1e8}


def test_hot_day_daily(skewed):
    rows, w = skewed
    got = {r["jour"]: r for r in kpi_daily(w).collect()}
    b = _brute(rows, {HOT_DAY})
    r = got[HOT_DAY]
    assert r["nombre_transactions_jour"] == b["n"] and b["n"] >= N // 3
    assert r["volume_transactions_jour"] == pytest.approx(b["vol"])
    assert r["valeur_mediane_transaction_jour"] == b["med"]
    assert r["adresses_actives_jour"] == b["addr"]
    assert sum(x["nombre_transactions_jour"] for x in got.values()) == N


def test_hot_address_global(skewed):
    rows, w = skewed
    g = kpi_global(w).first()
    b = _brute(rows, {r["ts"].date() for r in rows})
    assert g["nombre_transactions_total"] == N
    assert g["adresses_actives_global"] == b["addr"]
    assert g["valeur_mediane_transaction_total"] == b["med"]
    assert g["whale_volume_global"] == pytest.approx(b["whale"])


def test_hot_day_in_every_slide(spark, skewed):
    rows, w = skewed
    st = state_row(spark, "2021-03-01", "2021-03-14")
    got = {r["slide"]: r for r in kpi_global_slides(None, st, 3, window=w).collect()}
    for i in (1, 2, 3):
        lo = dt.date(2021, 3, 1) + dt.timedelta(days=7 * i)
        days = {lo + dt.timedelta(days=k) for k in range(14)}
        b = _brute(rows, days)
        assert got[i]["nombre_transactions_total"] == b["n"], i
        assert got[i]["adresses_actives_global"] == b["addr"], i
        assert got[i]["valeur_mediane_transaction_total"] == b["med"], i
