import datetime as dt
import random

import pytest
from conftest import make_raw, slot
from pyspark.sql import functions as F

from tidewatch.functions.columns import as_date, slide_range
from tidewatch.operators import project_window
from tidewatch.plans import slides as SL
from tidewatch.plans.address_bitmaps import AddressBitmaps


def raw_of(spark, active):
    """One transaction for each (day number from 2020-01-01, address)."""
    first = dt.datetime(2020, 1, 1, 6)
    return make_raw(spark, [{"ts": first + dt.timedelta(days=d), "inputs": [slot(a, None)] if d % 2 else [slot(None)],
                             "outputs": [slot(a)]} for d, a in active])


def brute_slides(active, width, step, n):
    return {s: k for s in range(1, n + 1)
            if (k := len({a for d, a in active if step * s <= d <= step * s + width - 1}))}


def day(k):
    return as_date(str(dt.date(2020, 1, 1) + dt.timedelta(days=k)))


@pytest.mark.parametrize("width, step, n", [(31, 7, 12), (7, 7, 9), (3, 7, 14), (1, 1, 40), (10, 3, 4), (31, 7, 1), (90, 7, 11)])
def test_sweep_equals_brute_force(spark, width, step, n):
    """Windows that overlap, touch or leave gaps; days outside all of them; runs that end at the last slide."""
    rng = random.Random(width * 100 + step)
    active = {(rng.randrange(100), f"a{rng.randrange(25)}") for _ in range(120)} | {(d, "hot") for d in range(100)} | {(0, "early"), (99, "late")}
    days = SL.address_days(project_window(raw_of(spark, sorted(active))))
    got = SL.active_addresses_slides(days, day(0), day(width - 1), step, F.lit(n)).collect()
    assert {r["slide"]: r["n_addr"] for r in got if r["n_addr"]} == brute_slides(active, width, step, n)
    assert len({r["slide"] for r in got}) == len(got) and all(1 <= r["slide"] <= n for r in got)


def test_two_rows_a_run_whatever_the_number_of_slides(spark):
    """No row for each (address, slide): an address of every day changes twice in 40 slides."""
    active = [(d, a) for d in range(310) for a in ("x", "y")] + [(12, "z"), (290, "z")]
    days = SL.address_days(project_window(raw_of(spark, active)))
    changes = SL.address_changes(days, day(0), day(30), 7, F.lit(40))
    assert changes.count() == 2 + 2 + 4
    expanded = days.select("adresse", F.explode("days").alias("jour")).select(
        "adresse", F.explode(slide_range(F.col("jour"), day(0), day(30), 7, 1, 40)).alias("slide")).distinct()
    assert expanded.count() > 80
    plan = SL.active_addresses_slides(days, day(0), day(30), 7, F.lit(40))._jdf.queryExecution().toString()
    assert "partial_sum" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def counts(df, key):
    return {r[key]: r["n_addr"] for r in df.collect()}


def test_bitmaps_over_appends(spark):
    rng = random.Random(3)
    january = sorted({(rng.randrange(31), f"a{rng.randrange(300)}") for _ in range(900)})
    february = sorted({(31 + rng.randrange(29), f"a{rng.randrange(500)}") for _ in range(900)} | {(4, "late"), (4, january[0][1])})
    store = AddressBitmaps(spark)
    assert store.dictionary().count() == 0 and counts(store.daily(), "jour") == {}
    n1 = store.append(project_window(raw_of(spark, january)))
    first = {r["adresse"]: r["number"] for r in store.dictionary().collect()}
    assert sorted(first.values()) == list(range(1, n1 + 1)) and list(first) and n1 == len({a for _, a in january})
    bits = {(r["jour"], r["bucket"]): bytes(r["bits"]) for r in store.bitmaps().collect()}
    n2 = store.append(project_window(raw_of(spark, february)))
    both = set(january) | set(february)
    second = {r["adresse"]: r["number"] for r in store.dictionary().collect()}
    assert {a: second[a] for a in first} == first                       # nothing is renumbered
    assert sorted(second.values()) == list(range(1, n2 + 1)) and n2 == len({a for _, a in both})
    after = [(r["jour"], r["bucket"], bytes(r["bits"])) for r in store.bitmaps().collect()]
    assert all((j, b, x) in after for (j, b), x in bits.items())        # nor rewritten
    base = dt.date(2020, 1, 1)
    assert counts(store.daily(), "jour") == {base + dt.timedelta(days=d): len({a for e, a in both if e == d}) for d, _ in both}
    assert counts(store.slides(day(0), day(30), 7, 8), "slide") == brute_slides(both, 31, 7, 8)
    assert store.between(day(2), day(40)).first()[0] == len({a for d, a in both if 2 <= d <= 40})
    assert {r[0] for r in store.addresses(day(2), day(40)).collect()} == {a for d, a in both if 2 <= d <= 40}
    assert store.append(project_window(raw_of(spark, january))) == n2   # known rows change no count
    assert counts(store.slides(day(0), day(30), 7, 8), "slide") == brute_slides(both, 31, 7, 8)


def test_numbers_over_several_buckets(spark):
    """More addresses than one bitmap holds, a hot day with all of them."""
    n = 70_000
    window = spark.range(n).select(F.lit(dt.datetime(2020, 1, 1, 5)).alias("horodatage_bloc"), F.array(F.concat(F.lit("a"), "id")).alias("input_addresses"),
                                   F.array().cast("array<string>").alias("output_addresses"))
    window = window.unionByName(window.limit(100).withColumn("horodatage_bloc", F.lit(dt.datetime(2020, 1, 2, 5))))
    store = AddressBitmaps(spark)
    assert store.append(window) == n
    assert counts(store.daily(), "jour") == {dt.date(2020, 1, 1): n, dt.date(2020, 1, 2): 100}
    assert store.bitmaps().select("bucket").distinct().count() == 3
    assert store.addresses(day(0), day(0)).count() == n


def test_two_appends_at_once_cannot_both_commit(spark, monkeypatch):
    a = AddressBitmaps(spark)
    b = AddressBitmaps(spark, a.root)
    rows = project_window(raw_of(spark, [(0, "x"), (1, "y")]))
    write = AddressBitmaps._write

    def late(self, *args):   # the other append commits first
        monkeypatch.setattr(AddressBitmaps, "_write", write)
        a.append(rows)
        return write(self, *args)

    monkeypatch.setattr(AddressBitmaps, "_write", late)
    with pytest.raises(FileExistsError):
        b.append(rows)
    assert {r["adresse"] for r in a.dictionary().collect()} == {"x", "y"} and counts(a.slides(day(0), day(0), 1, 1), "slide") == {1: 1}


def test_all_slides_without_bounds_equal_brute_force(spark):
    """Slides before the first window too; address days are not expanded into their windows."""
    rng = random.Random(11)
    active = {(rng.randrange(150), f"a{rng.randrange(20)}") for _ in range(120)} | {(0, "old"), (149, "old")}
    raw = make_raw(spark, [{"ts": dt.datetime(2020, 1, 1, 6) + dt.timedelta(days=d), "inputs": [slot(a)], "outputs": []} for d, a in sorted(active)])
    out = SL.kpi_sliding_eventtime(project_window(raw), "2020-01-01", "2020-01-31", 7)
    got = {r["slide"]: r["adresses_actives_global"] for r in out.collect()}
    want = {s: len({a for d, a in active if 7 * s <= d <= 7 * s + 30}) for s in range(-6, 30)}
    assert got == {s: n for s, n in want.items() if n} and min(got) < 0
    runs = SL.active_addresses_slides(SL.address_days(project_window(raw)), F.lit("2020-01-01").cast("date"),
                                      F.lit("2020-01-31").cast("date"), 7, None)
    assert {r["slide"]: r["n_addr"] for r in runs.collect() if r["n_addr"]} == {s: n for s, n in want.items() if n}
