import datetime as dt
import json

import pytest
from conftest import SF0001, make_raw
from pyspark.sql import functions as F

import tidewatch.plans.pipeline as PL
from tidewatch.operators import extract_window
from tidewatch.plans import Pipeline
from tidewatch.plans.lookup import LIST, lookup_by_hash
from tidewatch.plans.pipeline import BrokenWindow, write_window_table
from tidewatch.session import scratch_path
from tidewatch.sources import read_raw, refresh_raw, register_raw, tx, write_raw


def scanned_rows(df):
    """Rows that the scans of a plan gave out, that is, those of the row groups they opened."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.length())
               if "Scan" in leaves.apply(i).nodeName())


@pytest.fixture(scope="module")
def stored(spark):
    """60,000 transactions on 3 days, in many small row groups whose ranges of the hash overlap from file to file."""
    rows = spark.range(60_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("hachage_transaction"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("jour_bloc"),
        F.col("id").alias("numero_bloc"))
    path = scratch_path(spark, "window")
    conf = spark._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(64 * 1024))
    conf.set("parquet.page.row.count.limit", "500")
    try:
        seen = write_window_table(rows.repartition(4), path)
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.page.row.count.limit")
    assert seen == {"min_day": dt.date(2020, 1, 1), "max_day": dt.date(2020, 1, 3), "rows": 60_000}
    return spark.read.parquet(path)


def test_a_lookup_opens_the_row_groups_that_hold_a_hash(spark, stored):
    import hashlib

    sha = lambda k: hashlib.sha256(str(k).encode()).hexdigest()
    one = lookup_by_hash(stored, [sha(17)])
    assert [r["numero_bloc"] for r in one.collect()] == [17]
    assert 0 < scanned_rows(one) < 6_000
    wanted = [3, 44_000, 59_999]
    some = lookup_by_hash(stored, [sha(k) for k in wanted] * 2 + [None, "unknown", sha("no")])
    assert sorted(r["numero_bloc"] for r in some.collect()) == wanted
    assert scanned_rows(some) < 20_000
    # no row group has it, though its value lies inside the range of every file: the Bloom filters say so
    assert scanned_rows(lookup_by_hash(stored, [sha("no")])) < scanned_rows(one)
    many = [sha(k) for k in range(LIST + 20)]
    assert lookup_by_hash(stored, many).count() == LIST + 20
    assert lookup_by_hash(stored, []).count() == 0 and lookup_by_hash(stored, [None]).count() == 0


def test_every_file_is_sorted_by_hash(spark, stored):
    import pyarrow.parquet as pq

    files = [f.removeprefix("file://") for f in stored.inputFiles()]
    assert len(files) >= 3
    for f in files:
        own = pq.ParquetFile(f)
        hashes = own.read(columns=["hachage_transaction"]).column(0).to_pylist()
        assert hashes == sorted(hashes) and own.num_row_groups > 1


def test_files_without_a_bloom_filter_are_searched_too(spark, stored):
    path = scratch_path(spark, "plain")
    write_window_table(stored.limit(1000), path, bloom=False)
    plain = spark.read.parquet(path)
    h = plain.first()["hachage_transaction"]
    assert [r["hachage_transaction"] for r in lookup_by_hash(plain, [h]).collect()] == [h]


@pytest.fixture(scope="module")
def raw(spark):
    path = scratch_path(spark, "raw")
    write_raw(tx(spark, SF0001), path)
    return read_raw(spark, path)


def test_observed_checks_equal_those_of_a_scan(spark, raw):
    p = Pipeline(spark, raw)
    p.setup("1995-01-01")
    p.slide_once()
    for v in (0, 1):
        assert p.observed(v).first() == p.verdict(v).first()
    h = p.read("window").first()["hachage_transaction"]
    assert [r["hachage_transaction"] for r in p.lookup([h]).collect()] == [h]
    p.refresh_kpis()
    assert p.observed().first() == p.verdict().first()
    p.run_slides(1)
    with pytest.raises(ValueError, match="not observed"):
        p.observed()


def test_a_window_with_days_outside_is_not_committed(spark, raw, monkeypatch):
    p = Pipeline(spark, raw)
    p.setup("1995-01-01")
    before = p.state.bounds()
    wide = lambda df, a, b: extract_window(df, a, b + dt.timedelta(days=3))
    with monkeypatch.context() as m:
        m.setattr(PL, "extract_window", wide)
        with pytest.raises(BrokenWindow):
            p.slide_once()
    with monkeypatch.context() as m:
        m.setattr(PL, "slides_window", lambda df, s, n, step: extract_window(df, "1995-01-01", "1996-01-01"))
        with pytest.raises(BrokenWindow):
            p.run_slides(2)
    assert p.state.bounds() == before
    assert p.slide_once() == 1


def test_an_empty_window_is_observed_as_one(spark):
    p = Pipeline(spark, make_raw(spark, [{"ts": dt.datetime(2020, 3, 5, 1)}]))
    p.setup("2020-01-01")
    assert json.loads(p.state.row()["observed"])["rows"] == 0
    row = p.observed().first()
    assert row["nb_lignes"] == 0 and not row["non_empty"] and row["in_bounds"]


def test_a_catalog_table_prunes_its_months(spark):
    path = scratch_path(spark, "raw")
    all_rows = tx(spark, SF0001)
    early = F.col("block_timestamp_month") < F.lit("1997-01-01").cast("date")
    write_raw(all_rows.where(early), path)
    name = "raw_" + path.rsplit("-", 1)[-1]
    table = register_raw(spark, path, name)
    assert table.count() == all_rows.where(early).count()
    window = extract_window(table, "1996-02-03", "1996-03-04")
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(2 paths)" in plan and "PartitionFilters: [isnotnull(block_timestamp_month" in plan, plan
    assert spark.sql(f"SHOW PARTITIONS {name}").count() > 20
    assert window.count() == extract_window(all_rows, "1996-02-03", "1996-03-04").count()
    write_raw(all_rows.where(~early), path, mode="append")
    assert refresh_raw(spark, name).count() == all_rows.count()
    p = Pipeline(spark, read_raw(spark, table=name))
    p.setup("1995-01-01")
    assert p.verdict().first()["in_bounds"]
    spark.sql(f"DROP TABLE {name}")
