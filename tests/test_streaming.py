import datetime as dt
import os

import pytest
from conftest import SF0001, make_raw
from pyspark.sql import functions as F

import __spark_entry__ as E
import tidewatch.streaming as ST
from tidewatch.operators import kpi_daily, project_window
from tidewatch.operators.addresses import active_addresses_daily
from tidewatch.session import scratch_path
from tidewatch.sources import load_table


@pytest.fixture(scope="module")
def events(spark):
    return ST.events_as_tx(load_table(spark, SF0001, "events"))


def test_stream_daily_equals_batch_on_all_days(spark, events):
    got = {r["jour"]: r for r in E.q_stream_kpi_daily(spark, SF0001).collect()}
    batch = {r["jour"]: r for r in kpi_daily(events).collect()}
    assert len(got) == len(batch) == 30      # the last days are open behind the watermark, and there
    for d, r in got.items():
        for c in r.asDict():
            assert r[c] == pytest.approx(batch[d][c]), (d, c)


def test_stream_distinct_addresses_exact(spark, events):
    got = dict(E.q_stream_active_addresses(spark, SF0001).collect())
    assert len(got) == 30 and got == dict(active_addresses_daily(events).collect())


def test_closed_days_only_in_append_mode(spark, events):
    src, sink = scratch_path(spark, "src"), scratch_path(spark, "sink")
    events.write.parquet(src)
    stream = ST.read_file_stream(spark, src, events.schema)
    ST.run_available_now(ST.active_addresses_stream(stream), sink, scratch_path(spark, "ck"))
    got, batch = dict(spark.read.parquet(sink).collect()), dict(active_addresses_daily(events).collect())
    assert 0 < len(got) < 30 and all(batch[d] == n for d, n in got.items())


def _live(spark, rows, table, ckpt):
    stream = ST.read_file_stream(spark, rows, E_SCHEMA)
    q = ST.write_live(ST.daily_kpis_stream(stream), table, ckpt)
    q.awaitTermination()
    return q


E_SCHEMA = None


def test_live_table_over_restarts_and_replays(spark):
    """Two runs from one checkpoint; a replayed batch; a row without a time; a late row."""
    global E_SCHEMA
    day = lambda d, h: {"ts": dt.datetime(2020, 1, d, h)}
    parts = [[day(1, 1), day(1, 2), day(2, 1)], [day(2, 5), day(3, 1)]]
    src, table, ckpt = (scratch_path(spark, n) for n in ("src", "live", "ck"))
    for part in parts:
        rows = project_window(make_raw(spark, part))
        if part is parts[1]:
            rows = rows.unionByName(rows.limit(1).withColumn("horodatage_bloc", F.lit(None).cast("timestamp")))
            assert ST.rows_without_event_time(rows).first()[0] == 1
        E_SCHEMA = rows.schema
        rows.write.mode("append").parquet(src)
        q = _live(spark, src, table, ckpt)
    assert sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for s in p["stateOperators"]) == 0
    n = {r["jour"].day: r["nombre_transactions_jour"] for r in ST.read_live(spark, table, ["jour"]).collect()}
    assert n == {1: 2, 2: 2, 3: 1}
    again = spark.read.parquet(table).where("epoch = 0").drop("epoch").cache()
    again.count()
    again.repartition(1).write.mode("overwrite").parquet(f"{table}/epoch=0")   # what a replay does
    assert {r["jour"].day: r["nombre_transactions_jour"] for r in ST.read_live(spark, table, ["jour"]).collect()} == n


def test_replay_moves_rows_instead_of_writing_them_again(spark, monkeypatch):
    """Periods arrive in order, a row without a time first; each row once, in one file."""
    paths, upto = [], []
    monkeypatch.setattr(E, "scratch_path", lambda s, name: paths.append(scratch_path(s, name)) or paths[-1])
    rows = project_window(make_raw(spark, [{"ts": dt.datetime(y, 1, d, 5), "hash": f"{y}-{d}"} for y in (2021, 2019, 2020) for d in (1, 2)]))
    rows = rows.unionByName(rows.limit(1).withColumn("horodatage_bloc", F.lit(None).cast("timestamp")).withColumn("hachage_transaction", F.lit("none")))
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ck")

    def run(stream):
        ST.run_available_now(stream.select("hachage_transaction"), sink, ckpt)
        upto.append(sorted(r[0] for r in spark.read.parquet(sink).collect()))

    E._replay(spark, rows, "year", run)
    names = ["none", *(f"{y}-{d}" for y in (2019, 2020, 2021) for d in (1, 2))]
    assert upto == [sorted(names[:n]) for n in (1, 3, 5, 7)]
    assert not [f for _, _, fs in os.walk(paths[0]) for f in fs if f.endswith(".parquet")]


def test_sketches_come_from_a_task_a_core_however_many_files(spark):
    """A window's sketches are merged by one task: there are no more of them than cores."""
    rows = project_window(make_raw(spark, [{"ts": dt.datetime(2020, 1, 1 + i % 5, 1), "out_sat": i} for i in range(40)]))
    src, cores = scratch_path(spark, "src"), spark.sparkContext.defaultParallelism
    rows.repartition(3 * cores).write.parquet(src)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")   # a split a file
    try:
        for make, key in ((lambda s: ST.daily_kpis_stream(s), "jour"),
                          (lambda s: ST.sliding_kpis_stream(s, 3, 1, 0, dt.date(2020, 1, 1)), "slide")):
            table = scratch_path(spark, "live")
            stream = ST.read_file_stream(spark, src, rows.schema)
            q = ST.write_live(make(stream), table, scratch_path(spark, "ck"), cores)
            q.awaitTermination()
            tracker = spark.sparkContext.statusTracker()
            stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(str(q.runId))
                      for s in tracker.getJobInfo(j).stageIds]
            assert stages and max(s.numTasks for s in stages if s) <= cores
            got = ST.read_live(spark, table, [key])
            assert got.where("nombre_transactions_%s IS NULL" % ("jour" if key == "jour" else "total")).count() == 0
            assert got.count() == (5 if key == "jour" else 7)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
