import datetime as dt

import pytest
from conftest import SF0001, make_raw
from pyspark.sql import functions as F

from tidewatch.operators import extract_window, kpi_daily, kpi_global
from tidewatch.plans import (
    kpi_daily_slides, kpi_global_slides, kpi_sliding_eventtime, state_from_data, state_row,
    window_list,
)
from tidewatch.schema import GLOBAL_KPIS
from tidewatch.sources import tx


def _rows(df, cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.fixture(scope="module")
def fixture_raw(spark):
    return tx(spark, SF0001).cache()


def test_slides_equal_repeated_single_slides(spark, fixture_raw):
    st = state_from_data(fixture_raw, "1995-01-01")
    s = st.first()
    multi = {r["slide"]: r for r in kpi_global_slides(fixture_raw, st, 6).collect()}
    assert sorted(multi) == [1, 2, 3, 4, 5, 6]
    for i in (1, 3, 6):
        w = extract_window(fixture_raw, s["start_date"] + dt.timedelta(days=7 * i),
                           s["end_date"] + dt.timedelta(days=7 * i))
        one = kpi_global(w).first()
        for c in GLOBAL_KPIS:
            assert multi[i][c] == pytest.approx(one[c]), (i, c)


def test_daily_slides_equal_per_window_daily(spark, fixture_raw):
    st = state_from_data(fixture_raw, "1995-01-01")
    s = st.first()
    multi = kpi_daily_slides(fixture_raw, st, 4).filter(F.col("slide") == 4).drop("slide")
    w = extract_window(fixture_raw, s["start_date"] + dt.timedelta(days=28),
                       s["end_date"] + dt.timedelta(days=28))
    cols = multi.columns
    assert sorted(_rows(multi, cols)) == sorted(_rows(kpi_daily(w), cols))


def test_empty_windows_are_kept(spark):
    raw = make_raw(spark, [{"ts": dt.datetime(2020, 1, 2, 5)}, {"ts": dt.datetime(2020, 3, 1, 5)}])
    st = state_row(spark, "2020-01-01", "2020-01-07")
    got = {r["slide"]: r for r in kpi_global_slides(raw, st, 10).collect()}
    assert sorted(got) == list(range(1, 11))
    assert got[2]["nombre_transactions_total"] == 0
    assert got[2]["adresses_actives_global"] == 0
    assert got[2]["volume_transactions_total"] is None
    # 2020-03-01 is day 60 from 2020-01-01: slide 8 covers days 56..62
    assert got[8]["nombre_transactions_total"] == 1


def test_window_list_numbering_and_months(spark):
    st = state_row(spark, "2020-01-25", "2020-01-31")
    rows = window_list(st, 3).orderBy("slide").collect()
    assert [r["slide"] for r in rows] == [1, 2, 3]
    assert rows[0]["new_start"] == dt.date(2020, 2, 1) and rows[0]["new_end"] == dt.date(2020, 2, 7)
    assert rows[0]["m_start"] == dt.date(2020, 2, 1)
    assert rows[0]["ts_hi"] == dt.datetime(2020, 2, 8)


def test_eventtime_windows_match_slides(spark, fixture_raw):
    st = state_from_data(fixture_raw, "1995-01-01")
    s = st.first()
    from tidewatch.operators import project_window
    ev = kpi_sliding_eventtime(project_window(fixture_raw), s["start_date"], s["end_date"])
    ev = {r["slide"]: r for r in ev.filter(F.col("slide").between(1, 8)).collect()}
    multi = {r["slide"]: r for r in kpi_global_slides(fixture_raw, st, 8).collect()}
    for i, r in ev.items():
        for c in GLOBAL_KPIS:
            assert r[c] == pytest.approx(multi[i][c]), (i, c)
