import datetime as dt
import threading

import pytest

from tidewatch.plans import StateStore, state_row
from tidewatch.plans.commit_log import CommitLog, create_exclusively
from tidewatch.session import scratch_path


def test_a_file_is_created_once_and_whole(spark):
    path = scratch_path(spark, "log") + "/entry"
    create_exclusively(spark, path, "one\n")
    with pytest.raises(FileExistsError):
        create_exclusively(spark, path, "two\n")
    assert [r[0] for r in spark.read.text(path).collect()] == ["one"]
    assert spark.read.text(path.rsplit("/", 1)[0]).count() == 1      # nothing is left beside it


def test_stores_that_rename_and_stores_that_create(spark, monkeypatch):
    """The ways of the other stores, tried on local files under another scheme."""
    import tidewatch.plans.commit_log as CL

    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.commits.link./top", "file:/tmp")
    base = "viewfs://commits/top" + scratch_path(spark, "log").split("file:")[-1].removeprefix("/tmp")
    for name, stores in (("renamed", CL.OBJECT_STORES), ("created", ("viewfs",))):
        monkeypatch.setattr(CL, "OBJECT_STORES", stores)
        create_exclusively(spark, f"{base}/{name}", "one\n")
        with pytest.raises(FileExistsError):
            create_exclusively(spark, f"{base}/{name}", "two\n")
        assert [r[0] for r in spark.read.text(f"{base}/{name}").collect()] == ["one"]


def test_writers_that_pass_the_check_together_commit_once(spark, monkeypatch):
    """All writers look, wait for one another, and only then write: one wins each version."""
    store = StateStore(spark, scratch_path(spark, "st"))
    store.commit(state_row(spark, "2020-01-01", "2020-01-31", 0))
    writers = 4
    barrier = threading.Barrier(writers)
    claim = CommitLog.claim
    first = threading.local()

    def paused(self, number, rows):
        if not getattr(first, "done", False):
            first.done = True
            barrier.wait(timeout=120)
        return claim(self, number, rows)

    monkeypatch.setattr(CommitLog, "claim", paused)
    won, lost = [], []

    def write(k):
        try:
            StateStore(spark, store.root).commit(state_row(spark, f"2020-02-0{k + 1}", "2020-03-01", 1))
            won.append(k)
        except FileExistsError:
            lost.append(k)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(writers)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == writers - 1
    rows = store.rows().where("version = 1").collect()
    assert len(rows) == 1 and rows[0]["start_date"] == dt.date(2020, 2, won[0] + 1)


def test_writers_that_retry_all_get_a_version(spark, monkeypatch):
    store = StateStore(spark, scratch_path(spark, "st"))
    store.commit(state_row(spark, "2020-01-01", "2020-01-31", 0))
    got = []
    threads = [threading.Thread(target=lambda: got.append(StateStore(spark, store.root).advance(retries=9))) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [1, 2, 3]
    assert store.bounds() == (dt.date(2020, 1, 22), dt.date(2020, 2, 21), 3)
    assert [(r["commit"], r["version"]) for r in store.commits().orderBy("commit").collect()] == [(k, k) for k in range(4)]


def test_commits_of_other_versions_do_not_get_in_the_way(spark, monkeypatch):
    """A lost number is no lost version: the writer looks again and takes the next number."""
    store = StateStore(spark, scratch_path(spark, "st"))
    claim = CommitLog.claim

    def overtaken(self, number, rows):
        monkeypatch.setattr(CommitLog, "claim", claim)
        store.commit(state_row(spark, "2020-01-08", "2020-02-07", 7))
        return claim(self, number, rows)

    monkeypatch.setattr(CommitLog, "claim", overtaken)
    assert store.commit(state_row(spark, "2020-01-01", "2020-01-31", 5)) == 1
    assert sorted((r["commit"], r["version"]) for r in store.commits().collect()) == [(0, 7), (1, 5)]
    with pytest.raises(FileExistsError):
        store.commit(state_row(spark, "2020-01-01", "2020-01-31", 7))


def test_null_bounds_and_many_rows_in_one_commit(spark):
    store = StateStore(spark, scratch_path(spark, "st"))
    store.commit(state_row(spark, "2020-01-01", "2020-01-31", 0).unionByName(state_row(spark, "2020-01-08", "2020-02-07", 1)))
    store.commit(spark.sql("SELECT CAST(NULL AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date, 2 AS version"))
    assert store.bounds() == (None, None, 2)
    assert {r["commit"] for r in store.commits().where("version < 2").collect()} == {0}
