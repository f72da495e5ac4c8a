import datetime as dt

from conftest import make_raw
from pyspark.sql import functions as F

from tidewatch.operators import project_window
from tidewatch.plans import (
    check_slides, check_state, check_window_advanced, check_window_contents,
    check_window_verdict, state_row,
)


def _w(spark, days):
    return project_window(make_raw(spark, [{"ts": dt.datetime(2020, 1, d, 3)} for d in days]))


def test_contents(spark):
    c = check_window_contents(_w(spark, [3, 5, 9])).first()
    assert (c["min_date_table"], c["max_date_table"], c["nb_lignes"]) == (
        dt.date(2020, 1, 3), dt.date(2020, 1, 9), 3)


def test_verdict_good_sparse_broken_empty(spark):
    st = state_row(spark, "2020-01-02", "2020-01-10")
    good = check_window_verdict(_w(spark, [3, 9]), st).first()
    assert good["in_bounds"] and good["non_empty"]
    assert (good["start_gap_days"], good["end_gap_days"]) == (1, 1)
    broken = check_window_verdict(_w(spark, [1, 5]), st).first()
    assert not broken["in_bounds"]
    empty = check_window_verdict(_w(spark, [3]).filter(F.lit(False)), st).first()
    assert not empty["non_empty"] and empty["nb_lignes"] == 0


def test_per_slide_checks(spark):
    st = state_row(spark, "2020-01-01", "2020-01-03")
    rows = {r["slide"]: r for r in check_slides(_w(spark, [9, 10, 24]), st, 4).collect()}
    assert rows[1]["nb_lignes"] == 2 and rows[1]["in_bounds"]   # Jan 8-10 holds days 9, 10
    assert rows[2]["nb_lignes"] == 0 and not rows[2]["non_empty"]
    assert rows[3]["nb_lignes"] == 1
    assert all(r["rows_outside"] == 0 and r["in_bounds"] for r in rows.values())


def test_per_slide_checks_see_rows_outside_all_windows(spark):
    st = state_row(spark, "2020-01-01", "2020-01-03")
    rows = check_slides(_w(spark, [9, 10, 11, 11, 24]), st, 4).collect()   # Jan 11 lies between two windows
    assert all(r["rows_outside"] == 2 and not r["in_bounds"] for r in rows)
    # a table of a month checked as two slides of three days
    rows = check_slides(_w(spark, list(range(1, 31))), st, 2).collect()
    assert all(r["rows_outside"] == 24 and not r["in_bounds"] for r in rows)


def test_advanced_and_state_checks(spark):
    h = (state_row(spark, "2020-01-01", "2020-01-30", 0)
         .unionByName(state_row(spark, "2020-01-08", "2020-02-06", 1))
         .unionByName(state_row(spark, "2020-01-16", "2020-02-13", 2)))
    adv = {r["version"]: r["advanced_ok"] for r in check_window_advanced(h).collect()}
    assert adv == {1: True, 2: False}
    gap = (state_row(spark, "2020-01-01", "2020-01-30", 0)
           .unionByName(state_row(spark, "2020-01-22", "2020-02-20", 3))
           .unionByName(state_row(spark, "2020-01-29", "2020-02-28", 5)))
    assert {r["version"]: r["advanced_ok"] for r in check_window_advanced(gap).collect()} == {3: True, 5: False}
    ok = check_state(h).first()
    assert ok["version"] == 2 and ok["ok"]
    dup = check_state(h.unionByName(state_row(spark, "2020-01-15", "2020-02-13", 2))).first()
    assert not dup["ok"] and dup["n_rows"] == 2
