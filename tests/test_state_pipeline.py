import datetime as dt

import pytest
from conftest import SF0001

import tidewatch.plans.pipeline as PL
from tidewatch.plans import Pipeline, StateStore, check_window_advanced, state_row
from tidewatch.schema import DAILY_KPIS, GLOBAL_KPIS
from tidewatch.session import scratch_path
from tidewatch.sources import read_raw, tx, write_raw


@pytest.fixture(scope="module")
def raw(spark):
    path = scratch_path(spark, "raw")
    write_raw(tx(spark, SF0001), path)
    return read_raw(spark, path)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_state_store_versions(spark, raw):
    store = StateStore(spark, scratch_path(spark, "st"))
    assert store.current_version() is None
    with pytest.raises(ValueError, match="run setup first"):
        store.bounds()
    store.init(raw, "1995-01-01")
    s0 = store.bounds()
    assert s0[2] == 0 and s0[0] == dt.date(1995, 1, 1)
    store.advance()
    store.advance()
    s2 = store.bounds()
    assert s2 == (s0[0] + dt.timedelta(days=14), s0[1] + dt.timedelta(days=14), 2)
    assert store.history().count() == 3
    with pytest.raises(FileExistsError):
        store.commit(state_row(spark, "2000-01-01", "2000-01-31", 2))
    assert store.bounds() == s2 and store.history().count() == 3


def test_state_store_raises_on_a_broken_store(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "000000000").write_text("not a row\n")
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader raises, not an empty store
        StateStore(spark, str(tmp_path)).history().collect()


def test_sequential_slides_equal_one_job(spark, raw):
    seq = Pipeline(spark, raw)
    seq.setup("1995-01-01")
    assert seq.run(3) == 3
    one = Pipeline(spark, raw)
    one.setup("1995-01-01")
    assert one.run_slides(3) == 3
    assert one.state.bounds() == seq.state.bounds()
    for v in (1, 2, 3):   # every slide is a version of its own
        assert _rows(one.read("kpi_global", v), GLOBAL_KPIS) == _rows(seq.read("kpi_global", v), GLOBAL_KPIS)
        assert _rows(one.read("kpi_daily", v), DAILY_KPIS) == _rows(seq.read("kpi_daily", v), DAILY_KPIS)
        cols = [c for c in seq.read("window", v).columns if not c.endswith("addresses")]
        assert _rows(one.read("window", v), cols) == _rows(seq.read("window", v), cols)
        row = one.verdict(v).first()
        assert row["in_bounds"] and row["non_empty"]
    checks = one.slide_checks().collect()
    assert len(checks) == 3 and all(r["in_bounds"] and r["non_empty"] and r["rows_outside"] == 0 for r in checks)
    moved = check_window_advanced(one.state.history()).collect()
    assert len(moved) == 3 and all(r["advanced_ok"] for r in moved)


class _Fault(RuntimeError):
    pass


def test_a_failing_write_leaves_the_last_version(spark, raw, monkeypatch):
    p = Pipeline(spark, raw)
    p.setup("1995-01-01")
    p.slide_once()
    tables = ("window", "kpi_daily", "kpi_global")
    before = {t: p.read(t).count() for t in tables}
    bounds = p.state.bounds()

    def fail(*a, **k):
        raise _Fault("injected")

    jobs = {"setup": lambda: p.setup("1995-03-01"), "slide_once": p.slide_once,
            "run_slides": lambda: p.run_slides(2), "refresh_kpis": p.refresh_kpis}
    writes = {"setup": ("write_window_table", "write_kpi_daily", "write_kpi_global", "commit"),
              "slide_once": ("write_window_table", "write_kpi_daily", "write_kpi_global", "commit"),
              "run_slides": ("write_window_table", "commit"),
              "refresh_kpis": ("write_kpi_daily", "write_kpi_global", "commit")}
    for job, run in jobs.items():
        for write in writes[job]:
            with monkeypatch.context() as m:
                m.setattr(*((StateStore, "commit", fail) if write == "commit" else (PL, write, fail)))
                with pytest.raises(_Fault):
                    run()
            assert p.state.bounds() == bounds, (job, write)
            assert all(p.read(t, 1).count() == before[t] for t in tables), (job, write)
    for run in jobs.values():   # and the jobs go through afterwards
        v = run()
        assert p.state.bounds()[2] == v and p.verdict().first()["in_bounds"]


def test_setup_on_a_used_root_starts_a_new_version(spark, raw):
    p = Pipeline(spark, raw)
    assert p.setup("1995-01-01") == 0
    p.run(2)
    old = _rows(p.read("kpi_daily", 0), DAILY_KPIS)
    assert p.setup("1996-03-01") == 3
    start, end, version = p.state.bounds()
    assert version == 3 and (start.year, start.month, end.month) == (1996, 3, 3)
    assert {r["jour_bloc"].month for r in p.read("window").select("jour_bloc").distinct().collect()} == {3}
    assert _rows(p.read("kpi_daily", 0), DAILY_KPIS) == old


def test_two_writers_of_one_version(spark, raw, monkeypatch):
    a = Pipeline(spark, raw)
    a.setup("1995-01-01")
    b = Pipeline(spark, raw, a.root)
    real = StateStore.commit

    def late(self, states):   # the other job commits first
        monkeypatch.setattr(StateStore, "commit", real)
        a.slide_once()
        real(self, states)

    monkeypatch.setattr(StateStore, "commit", late)
    with pytest.raises(FileExistsError):
        b.slide_once()
    assert a.state.bounds()[2] == 1 and a.verdict().first()["in_bounds"]


def test_jobs_need_a_state(spark, raw):
    p = Pipeline(spark, raw)
    for job in (p.slide_once, lambda: p.run_slides(2), p.refresh_kpis, p.verdict, lambda: p.run(1)):
        with pytest.raises(ValueError, match="run setup first"):
            job()


def test_empty_base_month_gives_null_state_and_empty_window(spark):
    from conftest import make_raw
    raw = make_raw(spark, [{"ts": dt.datetime(2020, 3, 5, 1)}])
    p = Pipeline(spark, raw)
    p.setup("2020-01-01")
    assert p.state.bounds() == (None, None, 0)
    assert p.read("window").count() == 0
    assert p.read("kpi_daily").count() == 0
    g = p.read("kpi_global").collect()
    assert len(g) == 1 and g[0]["nombre_transactions_total"] == 0
    assert p.slide_once() == 1
    assert p.state.bounds() == (None, None, 1)
    v = p.verdict().first()
    assert not v["non_empty"] and v["nb_lignes"] == 0


def test_one_job_with_empty_windows(spark):
    from conftest import make_raw
    raw = make_raw(spark, [{"ts": dt.datetime(2020, 1, d, 1)} for d in (2, 3, 20)])
    p = Pipeline(spark, raw)
    p.setup("2020-01-01")
    assert p.state.bounds()[:2] == (dt.date(2020, 1, 2), dt.date(2020, 1, 20))
    assert p.run_slides(4) == 4
    assert [p.read("kpi_daily", v).count() for v in range(5)] == [3, 1, 1, 0, 0]
    assert [p.read("kpi_global", v).first()["nombre_transactions_total"] for v in range(5)] == [3, 1, 1, 0, 0]


def test_refresh_kpis_is_a_new_version_of_the_same_window(spark, raw):
    p = Pipeline(spark, raw)
    p.setup("1995-01-01")
    before = _rows(p.read("kpi_daily"), DAILY_KPIS)
    g_before = p.read("kpi_global").first()
    assert p.refresh_kpis() == 1
    assert p.state.bounds()[:2] == (p.state.row(0)["start_date"], p.state.row(0)["end_date"])
    assert _rows(p.read("kpi_daily"), DAILY_KPIS) == before
    assert p.read("kpi_global").first() == g_before
    assert p.read("window").count() == p.read("window", 0).count()


def test_published_views_and_retention(spark, raw):
    p = Pipeline(spark, raw, publish="live_", keep=2)
    p.setup("1995-01-01")
    first = spark.table("live_kpi_global").first()
    p.run(2)
    assert spark.table("live_kpi_global").first() == p.read("kpi_global", 2).first() != first
    assert spark.table("live_window").count() == p.read("window").count()
    assert p.read("window", 1).count() > 0            # the last two versions stay
    with pytest.raises(Exception):  # noqa: B017 - its files are gone
        p.read("window", 0).count()
    p.refresh_kpis()                                  # shares the window of version 2
    p.refresh_kpis()
    assert p.read("window").count() == spark.table("live_window").count()
