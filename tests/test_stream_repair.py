import datetime as dt
import random

import pytest
from conftest import SF0001, make_raw, slot
from pyspark.sql import functions as F

import __spark_entry__ as E
import tidewatch.streaming as ST
from tidewatch.operators import kpi as K
from tidewatch.operators import kpi_daily, project_window
from tidewatch.plans import kpi_global_slides, state_row
from tidewatch.session import scratch_path
from tidewatch.sources import load_table
from tidewatch.streaming import address_runs as AR

FIRST = dt.datetime(2020, 1, 1)


def rows_of(spark, active, hour=6):
    """One transaction for each (day, address or value)."""
    return project_window(make_raw(spark, [{
        "ts": FIRST + dt.timedelta(days=d, hours=hour), "hash": f"{i}", "inputs": [slot(a)], "outputs": [slot(a)], "out_sat": 10**8 * (i + 1)}
        for i, (d, a) in enumerate(active)]))


def feed(spark, parts, run):
    """Each part's rows arrive together; ``run`` gets the stream after each."""
    src = scratch_path(spark, "src")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(src)
        run(ST.read_file_stream(spark, src, part.schema))


# -- late rows -------------------------------------------------------------------

def repaired(spark, parts):
    live, ckpt = scratch_path(spark, "live"), scratch_path(spark, "ckpt")
    intake = ST.Intake(spark, scratch_path(spark, "intake"), parts[0].schema)
    repairs = ST.daily_repairs(intake, live, ["jour"], lambda own: kpi_daily(own).select("jour", *K.DAILY_NAMES.values()))
    seen = []

    def run(stream):
        intake.run(stream)
        q = ST.write_live(ST.daily_kpis_stream(intake.stream()), live, ckpt)
        q.awaitTermination()
        dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for s in p["stateOperators"])
        seen.append((dropped, repairs.run()))

    feed(spark, parts, run)
    return intake, repairs, seen


def same_as_batch(repairs, parts):
    everything = parts[0]
    for p in parts[1:]:
        everything = everything.unionByName(p)
    cols = ["jour", *K.DAILY_NAMES.values()]
    want = {r["jour"]: r for r in kpi_daily(everything.where("horodatage_bloc IS NOT NULL")).select(*cols).collect()}
    got = {r["jour"]: r for r in repairs.read().collect()}
    assert set(got) == set(want)
    assert all(tuple(got[d][c] for c in cols) == tuple(want[d][c] for c in cols) for d in want)


def test_late_rows_are_kept_and_repaired(spark):
    parts = [rows_of(spark, [(0, "a"), (0, "b"), (1, "c")]), rows_of(spark, [(5, "d"), (6, "e")], 7),
             rows_of(spark, [(0, "late"), (1, "late"), (6, "f")], 8), rows_of(spark, [(9, "g"), (0, "later")], 9)]
    nameless = parts[3].limit(1).withColumn("horodatage_bloc", F.lit(None).cast("timestamp"))
    parts[3] = parts[3].unionByName(nameless)
    intake, repairs, seen = repaired(spark, parts)
    assert [n for _, n in seen] == [0, 0, 2, 1] and seen[2][0] == 2 and seen[3][0] == 1
    same_as_batch(repairs, parts)
    late = sorted((r["epoch"], r["horodatage_bloc"].day) for r in intake.late().collect())
    assert late == [(2, 1), (2, 2), (3, 1)]
    assert intake.rows().count() == 11 and repairs.run() == 0


def test_a_replayed_epoch_is_stored_once(spark):
    parts = [rows_of(spark, [(0, "a"), (3, "b")]), rows_of(spark, [(0, "c"), (4, "d")])]
    intake, repairs, _ = repaired(spark, parts)
    before = intake.rows().count(), intake.watermark_us()
    for epoch, part in enumerate(parts):   # what a query does that failed before its commit
        intake._store(part, epoch)
    assert (intake.rows().count(), intake.watermark_us()) == before == (4, intake.watermark_us())
    assert intake.log.rows().count() == 2
    same_as_batch(repairs, parts)
    # a failure between the rename and the log: the log is completed from what is stored
    part = rows_of(spark, [(9, "z")])
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(intake.log), "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("injected")))
        with pytest.raises(RuntimeError):
            intake._store(part, 2)
    intake._store(part, 2)
    assert intake.rows().count() == 5 and intake.log.rows().count() == 3


def test_windows_repaired_by_the_same_means(spark):
    """Sliding windows: those that a late row finds closed are computed again, the open ones have it already."""
    width, step = 14, 7
    parts = [rows_of(spark, [(k, "a") for k in range(0, 12)]), rows_of(spark, [(30, "b"), (24, "c")]),
             rows_of(spark, [(8, "late"), (22, "late"), (31, "d")], 9)]
    offset = (FIRST.date() - dt.date(1970, 1, 1)).days % step
    live, ckpt = scratch_path(spark, "live"), scratch_path(spark, "ckpt")
    intake = ST.Intake(spark, scratch_path(spark, "intake"), parts[0].schema)
    names = list(K.GLOBAL_NAMES.values())
    state = state_row(spark, "2019-11-20", "2019-12-03")   # slides from 1: every window with a row

    def windows(days):
        first = F.lit("2020-01-01").cast("date")
        off = F.datediff("jour", first)
        lo, hi = F.ceil((off - (width - 1)) / step).cast("int"), F.floor(off / F.lit(step)).cast("int")
        return days.select(F.explode(F.sequence(lo, hi)).alias("slide")).select(
            "slide", F.date_add(first, F.col("slide") * step + width - 1).alias("end_day"))

    def compute(rows, touched):
        all_slides = kpi_global_slides(None, state, 20, step, window=rows)
        moved = all_slides.withColumn("slide", F.col("slide") - 6)   # slide 6 of that state starts on 2020-01-01
        return moved.join(touched, "slide", "left_semi").select("slide", "new_start", "new_end", *names)

    repairs = ST.Repairs(intake, live, ["slide"], windows, compute)
    done = []

    def run(stream):
        intake.run(stream)
        ST.write_live(ST.sliding_kpis_stream(intake.stream(), width, step, offset, "2020-01-01"), live, ckpt).awaitTermination()
        done.append(repairs.run())

    feed(spark, parts, run)
    assert done[-1] > 0
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    want = {r["slide"] - 6: r for r in kpi_global_slides(None, state, 20, step, window=whole).collect() if r["nombre_transactions_total"]}
    got = {r["slide"]: r for r in repairs.read().collect()}
    assert set(got) == set(want)
    assert all(got[s][c] == want[s][c] for s in want for c in ("new_start", "new_end", *names))


def test_out_of_order_events_equal_batch(spark):
    events = ST.events_as_tx(load_table(spark, SF0001, "events"))
    names = [K.DAILY_NAMES[k] for k in ST.EVENT_DAILY_KEYS]
    got = {r["jour"]: tuple(r[c] for c in names) for r in E.q_stream_kpi_daily_repaired(spark, SF0001).collect()}
    assert got == {r["jour"]: tuple(r[c] for c in names) for r in kpi_daily(events).collect()}


def test_a_repair_reads_the_touched_days(spark):
    from tidewatch.streaming.repair import in_days

    rows = rows_of(spark, [(d, "a") for d in range(20)])
    days = [(FIRST + dt.timedelta(days=d)).date() for d in (3, 4, 5, 9, 9, 12)]
    assert sorted(r["horodatage_bloc"].day - 1 for r in in_days(rows, days).collect()) == [3, 4, 5, 9, 12]
    assert in_days(rows, []).count() == 0
    path = scratch_path(spark, "rows")
    rows.write.parquet(path)
    plan = in_days(spark.read.parquet(path), days)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(Or(And(GreaterThanOrEqual(horodatage_bloc,2020-01-04" in plan   # three ranges


# -- exact medians ---------------------------------------------------------------

def test_median_of_more_values_than_a_sketch_holds(spark):
    """150,000 distinct values on one day in shuffled order, none on another; a small sketch is off, the counts are not."""
    n = 150_001
    spread = (F.col("id") * 7919) % n
    window = spark.range(n).select(F.lit(FIRST).alias("horodatage_bloc"), (spread * spread).alias("valeur_sorties_sat"))
    window = window.unionByName(spark.createDataFrame([(FIRST + dt.timedelta(days=1), None)], window.schema))
    for c, t in (("valeur_sorties", "double"), ("valeur_entrees_sat", "bigint"), ("valeur_entrees", "double"), ("est_coinbase", "boolean"),
                 ("compte_entrees", "bigint"), ("compte_sorties", "bigint")):
        window = window.withColumn(c, F.lit(None).cast(t))
    table, ckpt, rough = (scratch_path(spark, x) for x in ("values", "ckpt", "rough"))
    feed(spark, [window.where("horodatage_bloc < '2020-01-02'").repartition(4), window.where("horodatage_bloc >= '2020-01-02'")],
         lambda s: ST.write_live(ST.daily_value_counts_stream(s), table, ckpt, 8, files=None).awaitTermination())
    got = {r["jour"].day: r[1] for r in ST.read_median_daily(spark, table).collect()}
    middle = sorted((i * 7919 % n) ** 2 for i in range(n))[(n + 1) // 2 - 1]
    assert got == {1: middle / 1e8, 2: None}
    feed(spark, [window], lambda s: ST.write_live(
        ST.daily_kpis_stream(s, keys=["median"], median_accuracy=20), rough, scratch_path(spark, "ckpt"), 8).awaitTermination())
    assert {r[1] for r in ST.read_live(spark, rough, ["jour"]).collect() if r["jour"].day == 1} != {middle / 1e8}


# -- runs of slides --------------------------------------------------------------

def test_changes_turn_one_set_of_runs_into_another():
    rng = random.Random(1)
    for _ in range(200):
        runs, total = [], {}
        for _ in range(rng.randrange(1, 8)):
            a = rng.randrange(30)
            after = AR.merged(runs + [(a, a + rng.randrange(4))])
            for s, c in AR.changes(runs, after).items():
                total[s] = total.get(s, 0) + c
            runs = after
        covered = {s for a, b in runs for s in range(a, b + 1)}
        held = 0
        for s in range(40):
            held += total.get(s, 0)
            assert held == (s in covered)
        assert all(b + 1 < c for (_, b), (c, _) in zip(runs, runs[1:]))


def run_sliding(spark, parts, width, step, start):
    sink, ckpt, done = scratch_path(spark, "sink"), scratch_path(spark, "ckpt"), []

    def run(stream):
        ST.run_available_now(ST.sliding_address_runs(stream, width, step, start), sink, ckpt, "append", 4)

    feed(spark, parts, run)
    counts = ST.slide_counts(spark.read.parquet(sink), width, step, start).collect()
    return {r["slide"]: r["adresses_actives_global"] for r in counts}, done


@pytest.mark.parametrize("width, step", [(31, 7), (3, 7)])
def test_runs_equal_brute_force_in_any_order(spark, width, step):
    """Rows out of order within the watermark, addresses that pause and come back after their state has gone."""
    rng = random.Random(width)
    active = sorted({(rng.randrange(200), f"a{rng.randrange(12)}") for _ in range(150)} | {(d, "daily") for d in range(0, 200, 2)} | {(0, "old"), (190, "old")})
    chunks = [[r for r in active if k * 70 <= r[0] < k * 70 + 70] for k in range(3)]
    for c in chunks:
        rng.shuffle(c)
    got, _ = run_sliding(spark, [rows_of(spark, c) for c in chunks], width, step, "2020-01-01")
    want = {}
    for s in range(-10, 40):
        n = len({a for d, a in active if step * s <= d <= step * s + width - 1})
        if n:
            want[s] = n
    assert got == want


def test_one_state_row_an_address(spark):
    """Against a row for each window of an address: about a fifth for windows of 31 days."""
    active = [(d, f"a{k}") for d in range(0, 31) for k in range(20)]
    src = scratch_path(spark, "src")
    rows = rows_of(spark, active)
    rows.write.parquet(src)

    def state_rows(df):
        q = (df.writeStream.format("parquet").outputMode("append").option("path", scratch_path(spark, "sink"))
             .option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
        return max(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"])

    runs = state_rows(ST.sliding_address_runs(ST.read_file_stream(spark, src, rows.schema), 31, 7, "2020-01-01"))
    pairs = state_rows(ST.sliding_address_stream(ST.read_file_stream(spark, src, rows.schema), 31, 7, 0, "2020-01-01"))
    assert runs == 20 and pairs >= 5 * runs


def test_a_group_of_addresses_is_one_call_and_one_state_row(spark):
    """Many addresses in few groups: the same counts as one address at a time, and as many state rows as groups."""
    rng = random.Random(5)
    active = sorted({(rng.randrange(60), f"a{rng.randrange(300)}") for _ in range(1500)})
    src, sink = scratch_path(spark, "src"), scratch_path(spark, "sink")
    rows = rows_of(spark, active)
    rows.write.parquet(src)
    q = (ST.sliding_address_runs(ST.read_file_stream(spark, src, rows.schema), 31, 7, "2020-01-01", groups=3)
         .writeStream.format("parquet").outputMode("append").option("path", sink)
         .option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert max(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]) == 3
    got = {r["slide"]: r["adresses_actives_global"] for r in ST.slide_counts(spark.read.parquet(sink), 31, 7, "2020-01-01").collect()}
    want = {s: len({a for d, a in active if 7 * s <= d <= 7 * s + 30}) for s in range(-4, 9)}
    assert got == {s: n for s, n in want.items() if n}


@pytest.mark.parametrize("width, step", [(31, 7), (9, 4)])
def test_pairs_of_sliding_windows_once_with_few_state_rows(spark, width, step):
    """Two runs from one checkpoint, rows out of order: each pair once; a state row holds a group of addresses."""
    rng = random.Random(width)
    active = sorted({(rng.randrange(90), f"a{rng.randrange(200)}") for _ in range(1500)})
    chunks = [[r for r in active if k * 45 <= r[0] < k * 45 + 45] for k in range(2)]
    for c in chunks:
        rng.shuffle(c)
    sink, ckpt, held = scratch_path(spark, "sink"), scratch_path(spark, "ckpt"), []
    offset = (dt.date(2020, 1, 1) - dt.date(1970, 1, 1)).days % step

    def run(stream):
        q = (ST.sliding_address_stream(stream, width, step, offset, "2020-01-01", groups=3).writeStream.format("parquet")
             .option("path", sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        held.extend(s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"])

    feed(spark, [rows_of(spark, c) for c in chunks], run)
    got = [tuple(r) for r in spark.read.parquet(sink).collect()]
    day = lambda d: dt.date(2020, 1, 1) + dt.timedelta(days=d)
    want = {(s, day(s * step), day(s * step + width - 1), a) for d, a in active for s in range(-20, 40) if s * step <= d < s * step + width}
    assert sorted(got) == sorted(want)
    assert max(held) < len(want) / 20 and held[-1] < max(held)
