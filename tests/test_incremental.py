import datetime as dt
import json
import random

import pytest
from conftest import make_raw, slot

from tidewatch.operators import extract_window, kpi_daily, kpi_global
from tidewatch.plans.incremental import IncrementalPipeline
from tidewatch.schema import DAILY_KPIS, GLOBAL_KPIS
from tidewatch.session import remove_path, scratch_path
from tidewatch.sources import read_raw

FIRST = dt.datetime(2020, 1, 1)


def rows(days, tag, seed=0):
    rng = random.Random(seed)
    return [{"ts": FIRST + dt.timedelta(days=d, hours=rng.randrange(24)), "hash": f"{tag}{d}-{i}", "out_sat": rng.randrange(1, 10**11),
             "inputs": [slot(f"I{rng.randrange(20)}")], "outputs": [slot(f"O{rng.randrange(20)}")]} for d in days for i in range(2)]


def add(spark, path, some):
    make_raw(spark, some).coalesce(1).write.mode("append").partitionBy("block_timestamp_month").parquet(path)


def same(spark, p, path):
    """The current version equals a full computation from the files as they are."""
    start, end, _ = p.state.bounds()
    full = extract_window(read_raw(spark, path), start, end)
    rows = lambda df, cols: sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    flat = [c for c in p.read("window").columns if not c.endswith("addresses")]
    assert rows(p.read("window"), flat) == rows(full, flat)
    assert rows(p.read("kpi_daily"), DAILY_KPIS) == rows(kpi_daily(full), DAILY_KPIS)
    assert rows(p.read("kpi_global"), GLOBAL_KPIS) == rows(kpi_global(full), GLOBAL_KPIS)


@pytest.fixture
def source(spark):
    """A file for each week of January to March 2020."""
    path = scratch_path(spark, "raw")
    for week in range(13):
        add(spark, path, rows(range(7 * week, 7 * week + 7), "w", week))
    return path


def test_a_slide_reads_the_new_days_only(spark, source):
    p = IncrementalPipeline(spark, source)
    p.setup("2020-01-01")
    same(spark, p, source)
    assert len(p.rebuilt_days) == 31
    for week in range(2):
        p.slide_once()
        assert [d.toordinal() - FIRST.toordinal() for d in p.rebuilt_days] == list(range(31 + 7 * week, 38 + 7 * week))
        assert len(p.files_read) <= 4          # the weeks that hold the new days, cut at the month; 6 or more files are in the window
        same(spark, p, source)
    assert p.verdict().first()["in_bounds"]
    folders = set(json.loads(p.state.row()["window_days"]).values())
    assert len(folders) == 3                   # days of all three builds


def test_late_changed_and_removed_files(spark, source):
    p = IncrementalPipeline(spark, source)
    p.setup("2020-01-01")
    p.slide_once()
    add(spark, source, rows([20, 21], "late", 50) + rows([3], "outside", 51))    # day 3 has left the window
    p.slide_once()
    days = {d.toordinal() - FIRST.toordinal() for d in p.rebuilt_days}
    assert days == {20, 21, *range(38, 45)}
    same(spark, p, source)
    gone = [r["path"] for r in spark.read.parquet(p.state.row()["files_path"]).collect()
            if any(d.toordinal() - FIRST.toordinal() == 25 for d in r["days"])]
    assert gone
    remove_path(spark, gone[0])
    assert p.refresh_window() == 3
    assert {d.toordinal() - FIRST.toordinal() for d in p.rebuilt_days} <= set(range(21, 28)) and p.rebuilt_days
    same(spark, p, source)
    assert p.refresh_window() == 4
    assert p.rebuilt_days == [] and p.files_read == []                           # nothing changed
    same(spark, p, source)


def test_kpis_again_many_slides_and_an_empty_month(spark, source):
    p = IncrementalPipeline(spark, source, keep=2)
    p.setup("2020-01-01")
    p.run(2)
    p.refresh_kpis()
    same(spark, p, source)                      # the day folders of removed versions are still there
    add(spark, source, rows([50], "later", 60))
    p.run_slides(2)                             # a window of the other kind: the next slide starts over
    same(spark, p, source)
    p.slide_once()
    assert len(p.rebuilt_days) == 31
    same(spark, p, source)
    empty = IncrementalPipeline(spark, source)
    empty.setup("2021-05-01")
    assert empty.state.bounds()[:2] == (None, None) and empty.read("window").count() == 0
    assert empty.slide_once() == 1 and empty.read("kpi_daily").count() == 0


def test_a_failing_build_is_not_committed(spark, source, monkeypatch):
    import tidewatch.plans.incremental as I

    p = IncrementalPipeline(spark, source)
    p.setup("2020-01-01")
    before = p.state.bounds()
    for write in ("write_window_table", "write_kpi_daily", "write_kpi_global"):
        with monkeypatch.context() as m:
            m.setattr(I, write, lambda *a: (_ for _ in ()).throw(RuntimeError("injected")))
            with pytest.raises(RuntimeError):
                p.slide_once()
        assert p.state.bounds() == before
    p.slide_once()
    same(spark, p, source)
