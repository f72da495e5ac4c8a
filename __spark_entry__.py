"""

Every query reads the driver tables through the ``tx`` fixture
(``orders`` + ``lineitem``, see FIXTURES.md) or ``events``, over the whole
tables.  Multi-window queries run every 7-day slide from the base window
(the first month with data) until the windows pass the last day with data.

Outputs are compared in a canonical form: timestamps as
``yyyy-MM-dd HH:mm:ss`` strings, booleans as 0/1 integers, address arrays
as sorted comma-joined strings.
"""

from __future__ import annotations

import datetime as _dt
import importlib.util
import os
import sys
from collections.abc import Callable

# importable when this file is loaded by path from another working directory
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import addresses as addr_ops
from tidewatch.operators import extract as ex
from tidewatch.operators import kpi as K
from tidewatch.plans import checks as CK
from oracles import kpi_sql as O
from tidewatch.plans import slides as SL
from tidewatch.plans import windows as WN
from tidewatch.plans.address_bitmaps import AddressBitmaps
from tidewatch.plans.incremental import IncrementalPipeline
from tidewatch.plans.lookup import lookup_by_hash
from tidewatch.plans.pipeline import (
    Pipeline, read_kpi_daily, write_kpi_daily, write_kpi_global, write_window_table,
)
from tidewatch.plans.state import StateStore
from tidewatch.schema import SLIDE_DAYS
from tidewatch.session import configure, default_parallelism, scratch_path
from tidewatch.sources import load_table as _tbl
from tidewatch.sources import read_raw, register_raw, tx, write_raw
from tidewatch import streaming as ST
from oracles.fixture_sql import with_tx

SMOKE_DIR = "/root/testdata/sf0.001"
BASE_MONTH = "1995-01-01"   # first month of the fixture (the base window)
STEP = SLIDE_DAYS


# -- helpers -----------------------------------------------------------------

def _tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return tx(spark, sf_dir)


def _window(spark, sf_dir) -> DataFrame:
    """The whole raw table flattened (PRJ-1..4, no window filter)."""
    return ex.project_window(_tx(spark, sf_dir))


def _state(raw: DataFrame) -> DataFrame:
    return WN.state_from_data(raw, BASE_MONTH)


def _ts_str(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _addr_str(c):
    return F.concat_ws(",", F.sort_array(c))


def _canonical(w: DataFrame) -> DataFrame:
    return w.select(
        "hachage_transaction", "numero_bloc", _ts_str("horodatage_bloc").alias("horodatage_bloc"),
        "taille_bytes", "taille_virtuelle_bytes", "version_protocole", "compte_entrees",
        "compte_sorties", "frais_transaction", F.col("est_coinbase").cast("int").alias("est_coinbase"),
        "valeur_entrees", "valeur_sorties", _addr_str("input_addresses").alias("input_addresses"),
        _addr_str("output_addresses").alias("output_addresses"), "jour_bloc")


def _flags(df: DataFrame, *names) -> DataFrame:
    return df.select(*[F.col(c).cast("int").alias(c) if c in names else F.col(c) for c in df.columns])


# -- flagship ----------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Daily KPIs (D1..D9) of the base window of sf0.001."""
    configure(spark)
    raw = _tx(spark, SMOKE_DIR)
    window = ex.extract_window(raw, *WN.state_bounds(_state(raw)))
    return K.kpi_daily(window)


# -- queries -----------------------------------------------------------------

def q_tx_window(spark, d):
    return _canonical(_window(spark, d))


def q_tx_value_bch(spark, d):
    return _window(spark, d).select("hachage_transaction", "valeur_entrees", "valeur_sorties")


def q_tx_input_addresses(spark, d):
    w = _window(spark, d)
    return w.select("hachage_transaction", F.size("input_addresses").alias("n_addresses"),
                    _addr_str("input_addresses").alias("input_addresses"))


def q_tx_output_addresses(spark, d):
    w = _window(spark, d)
    return w.select("hachage_transaction", F.size("output_addresses").alias("n_addresses"),
                    _addr_str("output_addresses").alias("output_addresses"))


def _raw_rows(df: DataFrame) -> DataFrame:
    return df.select(F.col("hash").alias("hachage_transaction"),
                     _ts_str("block_timestamp").alias("horodatage_bloc"), "block_timestamp_month")


def q_filter_month(spark, d):
    return _raw_rows(ex.filter_month(_tx(spark, d), "1996-02-01"))


def q_filter_month_range(spark, d):
    return _raw_rows(ex.filter_month_range(_tx(spark, d), "1996-11-01", "1997-02-01"))


def q_filter_ts_halfopen(spark, d):
    return _raw_rows(ex.filter_ts_halfopen(_tx(spark, d), "1996-12-25 00:00:00", "1997-01-08 00:00:00"))


def q_window_extract(spark, d):
    """RW-2: slide 1 from the state, bounds as scalar subqueries."""
    raw = _tx(spark, d)
    w = ex.extract_window(raw, *WN.state_bounds(WN.advance_state(_state(raw), STEP)))
    return _canonical(w)


def q_whale_transactions(spark, d):
    return K.whale_transactions(_window(spark, d))


def q_tx_address_edges(spark, d):
    return addr_ops.address_edges(_tx(spark, d))


def q_explode_input_addresses(spark, d):
    return addr_ops.explode_addresses(_window(spark, d), "input_addresses")


def q_explode_output_addresses(spark, d):
    return addr_ops.explode_addresses(_window(spark, d), "output_addresses")


def q_daily_address_set(spark, d):
    return addr_ops.daily_address_set(_window(spark, d))


def q_window_address_set(spark, d):
    return addr_ops.window_address_set(_window(spark, d))


def q_active_addresses_daily(spark, d):
    return addr_ops.active_addresses_daily(_window(spark, d))


def q_active_addresses_global(spark, d):
    return addr_ops.active_addresses_global(_window(spark, d))


def q_kpi_daily(spark, d):
    return K.kpi_daily(_window(spark, d))


def q_kpi_global(spark, d):
    return K.kpi_global(_window(spark, d))


def _one(fn):
    return lambda spark, d: fn(_window(spark, d))


def q_kpi_global_slides(spark, d):
    raw = _tx(spark, d)
    return SL.kpi_global_slides(raw, _state(raw), None, STEP)


def q_kpi_daily_slides(spark, d):
    raw = _tx(spark, d)
    return SL.kpi_daily_slides(raw, _state(raw), None, STEP)


def q_kpi_sliding_eventtime(spark, d):
    raw = _tx(spark, d)
    s = _state(raw).first()   # window() needs literal durations: one 1-row read
    return SL.kpi_sliding_eventtime(ex.project_window(raw), s["start_date"], s["end_date"], STEP)


def q_window_bounds(spark, d):
    raw = _tx(spark, d)
    st = _state(raw)
    n = WN.slides_until(raw, st, STEP)
    b = WN.window_list(st, n, STEP)
    return b.select("slide", "new_start", "new_end", "m_start", "m_end",
                    F.unix_seconds("ts_lo").alias("ts_lo_epoch"),
                    F.unix_seconds("ts_hi").alias("ts_hi_epoch"))


def q_window_state_init(spark, d):
    return _state(_tx(spark, d))


def q_window_state_advance(spark, d):
    return WN.advance_state(_state(_tx(spark, d)), STEP)


def q_window_state(spark, d):
    """SNK-4 + SNK-5 through the versioned store, then CK-1 on its history."""
    store = StateStore(spark, scratch_path(spark, "state"))
    store.init(_tx(spark, d), BASE_MONTH)
    store.advance(STEP)
    store.advance(STEP)
    return _flags(CK.check_state(store.history()), "ok")


def _checks(spark, d):
    raw = _tx(spark, d)
    st = _state(raw)
    w = SL.slides_window(raw, st, None, STEP)
    n = WN.slides_until(w, st, STEP, ts_col="horodatage_bloc")
    return CK.check_slides(w, st, n, STEP)


def q_check_slides_contents(spark, d):
    return _checks(spark, d).select("slide", "min_date_table", "max_date_table", "nb_lignes")


def q_check_slides_verdict(spark, d):
    return _flags(_checks(spark, d), "non_empty", "in_bounds")


def q_check_slides_outside(spark, d):
    """The whole table checked as three slides: the rows outside them show."""
    raw = _tx(spark, d)
    return _flags(CK.check_slides(ex.project_window(raw), _state(raw), 3, STEP), "non_empty", "in_bounds")


def q_window_table_roundtrip(spark, d):
    path = scratch_path(spark, "window")
    write_window_table(_window(spark, d), path)
    return _canonical(spark.read.parquet(path))


def q_kpi_daily_roundtrip(spark, d):
    path = scratch_path(spark, "kpi_daily")
    write_kpi_daily(K.kpi_daily(_window(spark, d)), path)
    return read_kpi_daily(spark, path)


# -- streaming ---------------------------------------------------------------

def _replay(spark, rows, period, run, arrival=None):
    """Feed a table to a stream in the order of event time (or of another time of
    ``arrival``): ``run`` is called with the file stream each time another period
    (a truncated time) has arrived, and goes on from its checkpoint.  A period's
    files are written once, by all tasks, and moved into the stream's folder when it
    arrives; rows without an event time arrive first."""
    whole, src = scratch_path(spark, "replay-rows"), scratch_path(spark, "replay-src")
    rows.withColumn("_period", F.date_trunc(
        period, "horodatage_bloc" if arrival is None else arrival)).write.partitionBy("_period").parquet(whole)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(whole).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(src))
    periods = sorted((f.getPath().getName() for f in fs.listStatus(path(whole)) if f.isDirectory()),
                     key=lambda name: (not name.endswith("__HIVE_DEFAULT_PARTITION__"), name))   # a handful
    for k, name in enumerate(periods):
        for f in fs.listStatus(path(whole, name)):
            if not fs.rename(f.getPath(), path(src, f"{k:04d}-{f.getPath().getName()}")):   # a task's files share a name
                raise OSError(f"could not move {f.getPath()}")
        run(ST.read_file_stream(spark, src, rows.schema))


def _state_partitions(spark) -> int:
    """State-store partitions of the stream queries: one per core."""
    return default_parallelism(spark)


def _live(spark, rows, period, make, keys):
    """All windows of an aggregating stream, the open ones included."""
    table, ckpt = scratch_path(spark, "live"), scratch_path(spark, "ckpt")

    def run(stream):
        ST.write_live(make(stream), table, ckpt, _state_partitions(spark)).awaitTermination()

    _replay(spark, rows, period, run)
    return ST.read_live(spark, table, keys)


def _pairs(spark, rows, period, make):
    """The sink of an address stream."""
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    _replay(spark, rows, period, lambda stream: ST.run_available_now(
        make(stream), sink, ckpt, "append", _state_partitions(spark)))
    return spark.read.parquet(sink)


def _event_rows(spark, d):
    return ST.events_as_tx(_tbl(spark, d, "events"))


def q_stream_kpi_daily(spark, d):
    """RW-5 on ``events``, a week at a time."""
    return _live(spark, _event_rows(spark, d), "week",
                 lambda s: ST.daily_kpis_stream(s, "1 day", ST.EVENT_DAILY_KEYS), ["jour"])


def q_stream_active_addresses(spark, d):
    """RW-6 on ``events``."""
    pairs = _pairs(spark, _event_rows(spark, d), "week", ST.daily_address_stream)
    return ST.count_addresses(pairs, "adresses_actives_jour")


def q_stream_kpi_daily_live(spark, d):
    """RW-8 on ``events``: the whole table in one go."""
    rows = _event_rows(spark, d)
    src, table = scratch_path(spark, "src"), scratch_path(spark, "live")
    rows.write.parquet(src)
    stream = ST.daily_kpis_stream(ST.read_file_stream(spark, src, rows.schema), "1 day", ST.EVENT_DAILY_KEYS)
    ST.write_live(stream, table, scratch_path(spark, "ckpt"), _state_partitions(spark)).awaitTermination()
    return ST.read_live(spark, table, ["jour"])


def q_stream_kpi_daily_tx(spark, d):
    """RW-5 with every daily KPI (D1..D8) on the ``tx`` stream, a year at a time."""
    return _live(spark, ST.tx_as_stream_rows(_tx(spark, d)), "year",
                 lambda s: ST.daily_kpis_stream(s, "1 day"), ["jour"])


def _sliding_args(raw):
    s = _state(raw).first()   # window() needs literal durations
    width = (s["end_date"] - s["start_date"]).days + 1
    offset = (s["start_date"] - _dt.date(1970, 1, 1)).days % STEP
    return width, STEP, offset, s["start_date"]


def q_stream_kpi_sliding(spark, d):
    """RW-7 on the ``tx`` stream."""
    raw = _tx(spark, d)
    args = _sliding_args(raw)
    return _live(spark, ST.tx_as_stream_rows(raw), "year",
                 lambda s: ST.sliding_kpis_stream(s, *args, "1 day"), ["slide"])


def q_stream_active_addresses_sliding(spark, d):
    """RW-7 / G9 on the ``tx`` stream."""
    raw = _tx(spark, d)
    args = _sliding_args(raw)
    pairs = _pairs(spark, ST.tx_as_stream_rows(raw), "year",
                   lambda s: ST.sliding_address_stream(s, *args, "1 day"))
    return ST.count_addresses(pairs, "adresses_actives_global")


def q_stream_median_daily(spark, d):
    """RW-5 / D4 on ``tx``, a year at a time: the exact median of every day."""
    rows = ST.tx_as_stream_rows(_tx(spark, d))
    table, ckpt = scratch_path(spark, "values"), scratch_path(spark, "ckpt")
    _replay(spark, rows, "year", lambda stream: ST.write_live(
        ST.daily_value_counts_stream(stream), table, ckpt, _state_partitions(spark), files=None).awaitTermination())
    return ST.read_median_daily(spark, table)


def q_stream_active_addresses_runs(spark, d):
    """RW-7 / G9 on the ``tx`` stream, one state row an address."""
    raw = _tx(spark, d)
    width, step, _, start = _sliding_args(raw)
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    _replay(spark, ST.tx_as_stream_rows(raw), "year", lambda stream: ST.run_available_now(
        ST.sliding_address_runs(stream, width, step, start), sink, ckpt, "append", _state_partitions(spark)))
    return ST.slide_counts(spark.read.parquet(sink), width, step, start)


def q_stream_kpi_daily_repaired(spark, d):
    """RW-5, RW-8 on ``events`` out of order: a tenth of the rows comes two weeks late,
    far behind the watermark of a day; every week is taken in, streamed and repaired."""
    rows = _event_rows(spark, d)
    late = F.col("hachage_transaction").endswith("7")
    arrival = F.when(late, F.col("horodatage_bloc") + F.expr("INTERVAL 14 DAYS")).otherwise(F.col("horodatage_bloc"))
    live, ckpt = scratch_path(spark, "live"), scratch_path(spark, "ckpt")
    intake = ST.Intake(spark, scratch_path(spark, "intake"), rows.schema)
    repairs = ST.daily_repairs(intake, live, ["jour"], lambda own: K.kpi_daily(own).select(
        "jour", *[K.DAILY_NAMES[k] for k in ST.EVENT_DAILY_KEYS]))

    def week(stream):
        intake.run(stream)
        ST.write_live(ST.daily_kpis_stream(intake.stream(), "1 day", ST.EVENT_DAILY_KEYS), live, ckpt,
                      _state_partitions(spark)).awaitTermination()
        repairs.run()

    _replay(spark, rows, "week", week, arrival)
    return repairs.read()


# -- the pipeline on a stored raw table -----------------------------------------

def _stored_raw(spark, d):
    """The fixture as a month-partitioned table, read back (SRC-1)."""
    path = scratch_path(spark, "raw")
    write_raw(_tx(spark, d), path)
    return read_raw(spark, path)


def q_raw_month_reader(spark, d):
    """SRC-1, JN-5: slide 1 from the stored table, bounds from the state."""
    raw = _stored_raw(spark, d)
    return _canonical(ex.extract_window(raw, *WN.state_bounds(WN.advance_state(_state(raw), STEP))))


def q_kpi_global_roundtrip(spark, d):
    """SNK-3."""
    path = scratch_path(spark, "kpi_global")
    write_kpi_global(K.kpi_global(_window(spark, d)), path)
    return spark.read.parquet(path)


def _pipeline(spark, d):
    p = Pipeline(spark, _stored_raw(spark, d))
    p.setup(BASE_MONTH)
    return p


def q_pipeline_slide(spark, d):
    """PL-1, PL-2, RW-2: setup and one slide; every stored daily table."""
    p = _pipeline(spark, d)
    p.slide_once()
    tables = [p.read("kpi_daily", v).select(F.lit(v).alias("slide"), "*") for v in (0, 1)]
    return tables[0].unionByName(tables[1])


def q_pipeline_run_slides(spark, d):
    """PL-3: the global KPI tables of the versions of 15 slides."""
    p = _pipeline(spark, d)
    out = None
    for v in range(1, p.run_slides(15) + 1):
        row = p.state.row(v)
        one = p.read("kpi_global", v).select(F.lit(v).alias("slide"), F.lit(row["start_date"]).alias("new_start"),
                                             F.lit(row["end_date"]).alias("new_end"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def q_pipeline_refresh(spark, d):
    """PL-4: the daily table recomputed from the stored window of slide 1."""
    p = _pipeline(spark, d)
    p.slide_once()
    p.refresh_kpis()
    return p.read("kpi_daily")


def q_check_window_contents(spark, d):
    """CK-2 on the stored window of slide 1."""
    p = _pipeline(spark, d)
    p.slide_once()
    return CK.check_window_contents(p.read("window"))


def q_check_window_verdict(spark, d):
    """CK-3 on the stored window of slide 1 against its own state, and against
    that of the base window, which it does not fit."""
    p = _pipeline(spark, d)
    p.slide_once()
    base = p.state.row(0)
    broken = CK.check_window_verdict(p.read("window"), WN.state_row(spark, base["start_date"], base["end_date"]))
    out = p.verdict().select(F.lit("own").alias("against"), "*").unionByName(
        broken.select(F.lit("base").alias("against"), "*"))
    return _flags(out, "non_empty", "in_bounds")


def q_check_window_advanced(spark, d):
    """CK-4 on the real history of a store: three slides, then two more that were
    committed as one step, then a step that is a day short."""
    p = _pipeline(spark, d)
    p.run_slides(3)
    p.state.advance(STEP, 2)
    start, end, version = p.state.bounds()
    day = _dt.timedelta(days=STEP - 1)
    p.state.commit(WN.state_row(spark, start + day, end + day, version + 1))
    return _flags(CK.check_window_advanced(p.state.history(), STEP), "advanced_ok")


# -- many slides by runs and bitmaps, commits, rebuilds of what changed -----------

def q_active_addresses_slides_sweep(spark, d):
    """RW-3 / G9: every slide's distinct addresses from the runs of slides of each address."""
    raw = _tx(spark, d)
    st = _state(raw)
    w = SL.slides_window(raw, st, None, STEP)
    n = WN.slides_until(w, st, STEP, ts_col="horodatage_bloc")
    counts = SL.active_addresses_slides(SL.address_days(w), *WN.state_bounds(st), STEP, n)
    return WN.window_list(st, n, STEP).join(counts, "slide", "left").select(
        "slide", F.coalesce("n_addr", F.lit(0).cast("bigint")).alias("adresses_actives_global"))


def q_active_addresses_bitmap(spark, d):
    """AG-11, AG-12: the whole table in two appends; every day, then every slide."""
    raw = _tx(spark, d)
    window, st = ex.project_window(raw), _state(raw)
    bitmaps = AddressBitmaps(spark)
    early = F.col("horodatage_bloc") < F.lit("1996-07-01").cast("timestamp")
    bitmaps.append(window.where(early))
    bitmaps.append(window.where(~early))
    n = WN.slides_until(raw, st, STEP)
    slides = WN.window_list(st, n, STEP).join(bitmaps.slides(*WN.state_bounds(st), STEP, n), "slide", "left")
    days = bitmaps.daily().select(F.lit("jour").alias("periode"), "jour", F.lit(None).cast("int").alias("slide"),
                                  F.col("n_addr").alias("adresses_actives"))
    return days.unionByName(slides.select(
        F.lit("slide").alias("periode"), F.lit(None).cast("date").alias("jour"), "slide",
        F.coalesce("n_addr", F.lit(0).cast("bigint")).alias("adresses_actives")))


def q_state_commit_log(spark, d):
    """SNK-5: which commit added which version; a late writer of version 1 adds none."""
    store = StateStore(spark, scratch_path(spark, "state"))
    store.init(_tx(spark, d), BASE_MONTH)
    stale = WN.advance_state(store.read(), STEP)
    store.advance(STEP)
    try:
        store.commit(stale)
    except FileExistsError:
        pass
    store.advance(STEP, 2)
    return store.commits()


def q_window_incremental(spark, d):
    """RW-2: a table that gets half of the rows of some days later.  Setup and a slide
    see the first part; then the rest arrives, and the daily KPIs of the next slide, and
    of the same window looked at again, are those of the whole table."""
    path = scratch_path(spark, "raw")
    raw = _tx(spark, d)
    late = F.dayofmonth("block_timestamp").between(8, 24) & (F.col("block_number") % 2 == 1)
    write_raw(raw.where(~late), path)
    p = IncrementalPipeline(spark, path)
    p.setup(BASE_MONTH)
    p.slide_once()
    write_raw(raw.where(late), path, mode="append")
    p.slide_once()
    p.refresh_window()
    tables = [p.read("kpi_daily", v).select(F.lit(v).alias("version"), "*") for v in (2, 3)]
    return tables[0].unionByName(tables[1])


def q_tx_lookup_by_hash(spark, d):
    """SNK-1: the stored table of all transactions, looked up by the first hash of each month."""
    path = scratch_path(spark, "window")
    write_window_table(_window(spark, d), path)
    table = spark.read.parquet(path)
    months = table.groupBy(F.trunc("jour_bloc", "MM").alias("m")).agg(F.min("hachage_transaction").alias("h"))
    return _canonical(lookup_by_hash(table, [r["h"] for r in months.collect()] + ["unknown"]))   # a row a month


def q_check_window_observed(spark, d):
    """CK-2, CK-3 of the windows of setup and slide 1, from what their writes have seen."""
    p = _pipeline(spark, d)
    p.slide_once()
    seen = [p.observed(v).select(F.lit(v).alias("version"), "*") for v in (0, 1)]
    return _flags(seen[0].unionByName(seen[1]), "non_empty", "in_bounds")


def q_raw_catalog_reader(spark, d):
    """SRC-1: slide 1 from a catalog table, its months pruned in the catalog."""
    path = scratch_path(spark, "raw")
    write_raw(_tx(spark, d), path)
    name = "raw_" + path.rsplit("-", 1)[-1]
    raw = register_raw(spark, path, name)
    s = _state(raw).first()
    step = _dt.timedelta(days=STEP)
    return _canonical(ex.extract_window(raw, s["start_date"] + step, s["end_date"] + step))


def q_stream_kpi_daily_compacted(spark, d):
    """RW-8 on ``events``, a week at a time; the live table is compacted every two micro-batches."""
    live, ckpt = scratch_path(spark, "live"), scratch_path(spark, "ckpt")
    _replay(spark, _event_rows(spark, d), "week", lambda stream: ST.write_live(
        ST.daily_kpis_stream(stream, "1 day", ST.EVENT_DAILY_KEYS), live, ckpt, _state_partitions(spark),
        keys=["jour"], compact_every=2).awaitTermination())
    return ST.read_live(spark, live, ["jour"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "tx_window": q_tx_window,
        "tx_value_bch": q_tx_value_bch,
        "tx_input_addresses": q_tx_input_addresses,
        "tx_output_addresses": q_tx_output_addresses,
        "filter_month": q_filter_month,
        "filter_month_range": q_filter_month_range,
        "filter_ts_halfopen": q_filter_ts_halfopen,
        "window_extract": q_window_extract,
        "whale_transactions": q_whale_transactions,
        "tx_address_edges": q_tx_address_edges,
        "explode_input_addresses": q_explode_input_addresses,
        "explode_output_addresses": q_explode_output_addresses,
        "daily_address_set": q_daily_address_set,
        "window_address_set": q_window_address_set,
        "active_addresses_daily": q_active_addresses_daily,
        "active_addresses_global": q_active_addresses_global,
        "tx_count_daily": _one(K.tx_count_daily),
        "volume_daily": _one(K.volume_daily),
        "avg_value_daily": _one(K.avg_value_daily),
        "median_value_daily": _one(K.median_value_daily),
        "complexity_daily": _one(K.complexity_daily),
        "velocity_daily": _one(K.velocity_daily),
        "coinbase_share_daily": _one(K.coinbase_share_daily),
        "whale_ratio_daily": _one(K.whale_ratio_daily),
        "whale_volume_global": _one(K.whale_volume_global),
        "kpi_daily": q_kpi_daily,
        "kpi_global": q_kpi_global,
        "kpi_global_slides": q_kpi_global_slides,
        "kpi_daily_slides": q_kpi_daily_slides,
        "kpi_sliding_eventtime": q_kpi_sliding_eventtime,
        "window_bounds": q_window_bounds,
        "window_state_init": q_window_state_init,
        "window_state_advance": q_window_state_advance,
        "window_state": q_window_state,
        "check_slides_contents": q_check_slides_contents,
        "check_slides_verdict": q_check_slides_verdict,
        "check_slides_outside": q_check_slides_outside,
        "raw_month_reader": q_raw_month_reader,
        "kpi_global_roundtrip": q_kpi_global_roundtrip,
        "pipeline_slide": q_pipeline_slide,
        "pipeline_run_slides": q_pipeline_run_slides,
        "pipeline_refresh": q_pipeline_refresh,
        "check_window_contents": q_check_window_contents,
        "check_window_verdict": q_check_window_verdict,
        "check_window_advanced": q_check_window_advanced,
        "window_table_roundtrip": q_window_table_roundtrip,
        "kpi_daily_roundtrip": q_kpi_daily_roundtrip,
        "active_addresses_slides_sweep": q_active_addresses_slides_sweep,
        "active_addresses_bitmap": q_active_addresses_bitmap,
        "state_commit_log": q_state_commit_log,
        "window_incremental": q_window_incremental,
        "tx_lookup_by_hash": q_tx_lookup_by_hash,
        "check_window_observed": q_check_window_observed,
        "raw_catalog_reader": q_raw_catalog_reader,
    }
    q.update({
        "stream_kpi_daily": q_stream_kpi_daily,
        "stream_active_addresses": q_stream_active_addresses,
        "stream_kpi_sliding": q_stream_kpi_sliding,
        "stream_kpi_daily_live": q_stream_kpi_daily_live,
        "stream_kpi_daily_tx": q_stream_kpi_daily_tx,
        "stream_active_addresses_sliding": q_stream_active_addresses_sliding,
        "stream_median_daily": q_stream_median_daily,
        "stream_active_addresses_runs": q_stream_active_addresses_runs,
        "stream_kpi_daily_repaired": q_stream_kpi_daily_repaired,
        "stream_kpi_daily_compacted": q_stream_kpi_daily_compacted,
    })
    q.update(_llm()[0])
    return {name: _configured(fn) for name, fn in q.items()}


def _llm() -> tuple[dict, dict]:
    """Queries and oracles of the training-data operators, where they are installed."""
    if importlib.util.find_spec("tidewatch.llm") is None:
        return {}, {}
    from tidewatch.llm import queries as llm

    found, sql = dict(llm.QUERIES), dict(llm.ORACLE_SQL)
    if importlib.util.find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def _configured(fn):
    """Apply the session settings the semantics rely on (UTC days, AQE)
    before building the plan, whatever session the caller passes."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


# -- oracle SQL (DuckDB) -----------------------------------------------------

_CANON_SQL = """
SELECT t.hash AS hachage_transaction, t.block_number AS numero_bloc,
  strftime(t.block_timestamp, '%Y-%m-%d %H:%M:%S') AS horodatage_bloc,
  t.size AS taille_bytes, t.virtual_size AS taille_virtuelle_bytes, t.version AS version_protocole,
  t.input_count AS compte_entrees, t.output_count AS compte_sorties, t.fee AS frais_transaction,
  CAST(t.is_coinbase AS INTEGER) AS est_coinbase,
  t.input_value / 1e8 AS valeur_entrees, t.output_value / 1e8 AS valeur_sorties,
  coalesce(i.a, '') AS input_addresses, coalesce(o.a, '') AS output_addresses, t.day AS jour_bloc
FROM {src} t
LEFT JOIN (SELECT k, array_to_string(list_sort(list(addr)), ',') AS a FROM tx_in_a GROUP BY k) i ON i.k = t.k
LEFT JOIN (SELECT k, array_to_string(list_sort(list(addr)), ',') AS a FROM tx_out_a GROUP BY k) o ON o.k = t.k
"""

_RAW_ROWS_SQL = """
SELECT hash AS hachage_transaction, strftime(block_timestamp, '%Y-%m-%d %H:%M:%S') AS horodatage_bloc,
  block_timestamp_month FROM tx WHERE {pred}
"""

_DAILY_PARTS = f"SELECT day AS jour, {O.PARTIALS_SQL} FROM tx GROUP BY day"
_DAILY_ADDR = f"""SELECT t.day AS jour, count(DISTINCT x.addr) AS na
FROM tx t JOIN {O.ADDR_UNION} x ON x.k = t.k GROUP BY t.day"""

_KPI_DAILY = with_tx(f"""
SELECT d.jour, {O.finish(O.DAILY)}, coalesce(a.na, 0) AS adresses_actives_jour
FROM d LEFT JOIN a ON a.jour = d.jour""", f"d AS ({_DAILY_PARTS}),\na AS ({_DAILY_ADDR})")


def _daily_one(key: str) -> str:
    name = dict(O.DAILY)[key]
    return with_tx(f"SELECT jour, {O.FIN[key]} AS {name} FROM d", f"d AS ({_DAILY_PARTS})")


_SLIDES = O.all_slides_cte(BASE_MONTH, STEP)

_KPI_GLOBAL_SLIDES = with_tx(f"""
SELECT w.slide, w.ws AS new_start, w.we AS new_end, {O.finish(O.GLOBAL)},
  coalesce(ad.na, 0) AS adresses_actives_global
FROM wins w LEFT JOIN g ON g.slide = w.slide LEFT JOIN ad ON ad.slide = w.slide""", _SLIDES + f""",
g AS (SELECT w.slide, {O.PARTIALS_SQL} FROM wins w JOIN tx t ON t.day BETWEEN w.ws AND w.we GROUP BY w.slide),
ad AS (SELECT w.slide, count(DISTINCT x.addr) AS na FROM wins w JOIN tx t ON t.day BETWEEN w.ws AND w.we
       JOIN {O.ADDR_UNION} x ON x.k = t.k GROUP BY w.slide)""")

_KPI_DAILY_SLIDES = with_tx(f"""
SELECT w.slide, d.jour, {O.finish(O.DAILY)}, coalesce(a.na, 0) AS adresses_actives_jour
FROM wins w JOIN d ON d.jour BETWEEN w.ws AND w.we LEFT JOIN a ON a.jour = d.jour""",
    _SLIDES + f",\nd AS ({_DAILY_PARTS}),\na AS ({_DAILY_ADDR})")

_EVENTTIME = with_tx(f"""
SELECT CAST(g.slide AS INTEGER) AS slide, st.s + {STEP} * CAST(g.slide AS INTEGER) AS new_start,
  st.e + {STEP} * CAST(g.slide AS INTEGER) AS new_end, {O.finish(O.GLOBAL)},
  coalesce(ad.na, 0) AS adresses_actives_global
FROM g JOIN st ON TRUE LEFT JOIN ad ON ad.slide = g.slide""", O.base_state_cte(BASE_MONTH) + f""",
ks AS (SELECT t.*, unnest(generate_series(
          CAST(ceil((date_diff('day', st.s, t.day) - date_diff('day', st.s, st.e)) / {STEP}.0) AS BIGINT),
          CAST(floor(date_diff('day', st.s, t.day) / {STEP}.0) AS BIGINT))) AS slide
       FROM tx t JOIN st ON TRUE),
g AS (SELECT slide, {O.PARTIALS_SQL} FROM ks GROUP BY slide),
ad AS (SELECT ks.slide, count(DISTINCT x.addr) AS na FROM ks JOIN {O.ADDR_UNION} x ON x.k = ks.k
       GROUP BY ks.slide)""")

_CHECKS = with_tx("""
SELECT w.slide, w.ws AS start_date, w.we AS end_date, c.mn AS min_date_table, c.mx AS max_date_table,
  coalesce(c.cnt, 0) AS nb_lignes, CAST(0 AS BIGINT) AS rows_outside,
  CAST(date_diff('day', w.ws, c.mn) AS INTEGER) AS start_gap_days,
  CAST(date_diff('day', c.mx, w.we) AS INTEGER) AS end_gap_days,
  CAST(coalesce(c.cnt, 0) > 0 AS INTEGER) AS non_empty,
  CAST(coalesce(c.mn >= w.ws AND c.mx <= w.we, TRUE) AS INTEGER) AS in_bounds
FROM wins w LEFT JOIN c ON c.slide = w.slide""", _SLIDES + """,
c AS (SELECT w.slide, min(t.day) AS mn, max(t.day) AS mx, count(*) AS cnt
      FROM wins w JOIN tx t ON t.day BETWEEN w.ws AND w.we GROUP BY w.slide)""")


# the whole table against three slides
_OUTSIDE = with_tx(f"""
SELECT w.slide, w.ws AS start_date, w.we AS end_date, c.mn AS min_date_table, c.mx AS max_date_table,
  coalesce(c.cnt, 0) AS nb_lignes, o.cnt AS rows_outside,
  CAST(date_diff('day', w.ws, c.mn) AS INTEGER) AS start_gap_days,
  CAST(date_diff('day', c.mx, w.we) AS INTEGER) AS end_gap_days,
  CAST(coalesce(c.cnt, 0) > 0 AS INTEGER) AS non_empty, CAST(o.cnt = 0 AS INTEGER) AS in_bounds
FROM three w LEFT JOIN c ON c.slide = w.slide CROSS JOIN o""", _SLIDES + """,
three AS (SELECT * FROM wins WHERE slide <= 3),
c AS (SELECT w.slide, min(t.day) AS mn, max(t.day) AS mx, count(*) AS cnt
      FROM three w JOIN tx t ON t.day BETWEEN w.ws AND w.we GROUP BY w.slide),
o AS (SELECT count(*) AS cnt FROM tx t WHERE NOT EXISTS (SELECT 1 FROM three w WHERE t.day BETWEEN w.ws AND w.we))""")

# the base window (slide 0) and slide 1, day by day
_KPI_DAILY_PIPELINE = with_tx(f"""
SELECT w.slide, d.jour, {O.finish(O.DAILY)}, coalesce(a.na, 0) AS adresses_actives_jour
FROM two w JOIN d ON d.jour BETWEEN w.ws AND w.we LEFT JOIN a ON a.jour = d.jour""", O.base_state_cte(BASE_MONTH) + f""",
two AS (SELECT CAST(k AS INTEGER) AS slide, st.s + {STEP} * CAST(k AS INTEGER) AS ws, st.e + {STEP} * CAST(k AS INTEGER) AS we
        FROM st, (SELECT unnest([0, 1]) AS k)),
d AS ({_DAILY_PARTS}),
a AS ({_DAILY_ADDR})""")

# the window of slide 1 against the bounds of slides 1 and 0
_VERDICTS = with_tx(f"""
SELECT b.against, b.ws AS start_date, b.we AS end_date, c.mn AS min_date_table, c.mx AS max_date_table, c.cnt AS nb_lignes,
  CAST(date_diff('day', b.ws, c.mn) AS INTEGER) AS start_gap_days, CAST(date_diff('day', c.mx, b.we) AS INTEGER) AS end_gap_days,
  CAST(c.cnt > 0 AS INTEGER) AS non_empty, CAST(c.mn >= b.ws AND c.mx <= b.we AS INTEGER) AS in_bounds
FROM b CROSS JOIN c""", O.base_state_cte(BASE_MONTH) + f""",
b AS (SELECT 'own' AS against, s + {STEP} AS ws, e + {STEP} AS we FROM st UNION ALL SELECT 'base', s, e FROM st),
c AS (SELECT min(day) AS mn, max(day) AS mx, count(*) AS cnt FROM tx, st WHERE day BETWEEN st.s + {STEP} AND st.e + {STEP})""")

# versions 1 to 3, then 5 (two steps at once), then 6 (a day short)
_ADVANCED = with_tx(f"""
SELECT CAST(v.version AS INTEGER) AS version, CAST(st.s + CAST(v.days AS INTEGER) AS DATE) AS start_date,
  CAST(st.e + CAST(v.days AS INTEGER) AS DATE) AS end_date, CAST(v.moved AS INTEGER) AS start_shift_days,
  CAST(v.moved AS INTEGER) AS end_shift_days, CAST(v.moved = {STEP} * v.versions AS INTEGER) AS advanced_ok
FROM st, (VALUES (1, {STEP}, {STEP}, 1), (2, {2 * STEP}, {STEP}, 1), (3, {3 * STEP}, {STEP}, 1),
  (5, {5 * STEP}, {2 * STEP}, 2), (6, {6 * STEP - 1}, {STEP - 1}, 1)) v(version, days, moved, versions)""",
    O.base_state_cte(BASE_MONTH))

_EV = """ev AS (
  SELECT CAST(CAST(ts AS TIMESTAMP) AS DATE) AS day, CAST(ROUND(value * 100) AS BIGINT) * 1000000 AS output_value,
    CAST(NULL AS BIGINT) AS input_value, CAST(NULL AS BOOLEAN) AS is_coinbase,
    CAST(NULL AS BIGINT) AS input_count, CAST(NULL AS BIGINT) AS output_count, user_id
  FROM events)"""
_EV_KEYS = [(k, dict(O.DAILY)[k]) for k in ["count", "volume", "mean", "median", "whale_ratio"]]
_STREAM_DAILY = ("WITH " + _EV + f"""
SELECT day AS jour, {O.finish(_EV_KEYS)} FROM (SELECT day, {O.PARTIALS_SQL} FROM ev GROUP BY day)""")
_STREAM_ADDR = "WITH " + _EV + """
SELECT day AS jour, count(DISTINCT 'A' || CAST(user_id AS VARCHAR)) AS adresses_actives_jour FROM ev
GROUP BY day"""
_STREAM_SLIDING = with_tx(f"""
SELECT CAST(g.slide AS INTEGER) AS slide, st.s + {STEP} * CAST(g.slide AS INTEGER) AS new_start,
  st.e + {STEP} * CAST(g.slide AS INTEGER) AS new_end, {O.finish(O.GLOBAL)}
FROM g JOIN st ON TRUE""", O.base_state_cte(BASE_MONTH) + f""",
ks AS (SELECT t.*, unnest(generate_series(
          CAST(ceil((date_diff('day', st.s, t.day) - date_diff('day', st.s, st.e)) / {STEP}.0) AS BIGINT),
          CAST(floor(date_diff('day', st.s, t.day) / {STEP}.0) AS BIGINT))) AS slide
       FROM tx t JOIN st ON TRUE),
g AS (SELECT slide, {O.PARTIALS_SQL} FROM ks GROUP BY slide)""")


_STREAM_SLIDING_ADDR = with_tx(f"""
SELECT CAST(ad.slide AS INTEGER) AS slide, st.s + {STEP} * CAST(ad.slide AS INTEGER) AS new_start,
  st.e + {STEP} * CAST(ad.slide AS INTEGER) AS new_end, ad.na AS adresses_actives_global
FROM ad JOIN st ON TRUE""", O.base_state_cte(BASE_MONTH) + f""",
ks AS (SELECT t.k, unnest(generate_series(
          CAST(ceil((date_diff('day', st.s, t.day) - date_diff('day', st.s, st.e)) / {STEP}.0) AS BIGINT),
          CAST(floor(date_diff('day', st.s, t.day) / {STEP}.0) AS BIGINT))) AS slide
       FROM tx t JOIN st ON TRUE),
ad AS (SELECT ks.slide, count(DISTINCT x.addr) AS na FROM ks JOIN {O.ADDR_UNION} x ON x.k = ks.k
       GROUP BY ks.slide)""")


def oracle_sql() -> dict[str, str]:
    daily_keys = {"tx_count_daily": "count", "volume_daily": "volume", "avg_value_daily": "mean",
                  "median_value_daily": "median", "complexity_daily": "complexity",
                  "velocity_daily": "velocity", "coinbase_share_daily": "coinbase",
                  "whale_ratio_daily": "whale_ratio"}
    canon_all = with_tx(_CANON_SQL.format(src="tx"))
    sql = {
        "tx_window": canon_all,
        "window_table_roundtrip": canon_all,
        "tx_value_bch": with_tx("SELECT hash AS hachage_transaction, input_value / 1e8 AS valeur_entrees, "
                                "output_value / 1e8 AS valeur_sorties FROM tx"),
        "tx_input_addresses": with_tx(
            "SELECT t.hash AS hachage_transaction, CAST(coalesce(i.n, 0) AS INTEGER) AS n_addresses, "
            "coalesce(i.a, '') AS input_addresses FROM tx t LEFT JOIN (SELECT k, count(*) AS n, "
            "array_to_string(list_sort(list(addr)), ',') AS a FROM tx_in_a GROUP BY k) i ON i.k = t.k"),
        "tx_output_addresses": with_tx(
            "SELECT t.hash AS hachage_transaction, CAST(coalesce(i.n, 0) AS INTEGER) AS n_addresses, "
            "coalesce(i.a, '') AS output_addresses FROM tx t LEFT JOIN (SELECT k, count(*) AS n, "
            "array_to_string(list_sort(list(addr)), ',') AS a FROM tx_out_a GROUP BY k) i ON i.k = t.k"),
        "filter_month": with_tx(_RAW_ROWS_SQL.format(pred="block_timestamp_month = DATE '1996-02-01'")),
        "filter_month_range": with_tx(_RAW_ROWS_SQL.format(
            pred="block_timestamp_month BETWEEN DATE '1996-11-01' AND DATE '1997-02-01'")),
        "filter_ts_halfopen": with_tx(_RAW_ROWS_SQL.format(
            pred="block_timestamp >= TIMESTAMP '1996-12-25 00:00:00' "
                 "AND block_timestamp < TIMESTAMP '1997-01-08 00:00:00'")),
        "window_extract": with_tx(_CANON_SQL.format(
            src="(SELECT tx.* FROM tx, st WHERE tx.day BETWEEN st.s + 7 AND st.e + 7)"),
            O.base_state_cte(BASE_MONTH)),
        "whale_transactions": with_tx(
            "SELECT hash AS hachage_transaction, output_value / 1e8 AS valeur_sorties FROM tx "
            f"WHERE output_value >= {K.WHALE_THRESHOLD_SAT}"),
        "tx_address_edges": with_tx(
            "SELECT t.hash AS hachage_transaction, 'in' AS side, e.idx AS slot_index, e.addr AS adresse "
            "FROM tx_in_e e JOIN tx t ON t.k = e.k UNION ALL "
            "SELECT t.hash, 'out', e.idx, e.addr FROM tx_out_e e JOIN tx t ON t.k = e.k"),
        "explode_input_addresses": with_tx(
            "SELECT t.hash AS hachage_transaction, t.day AS jour, a.addr AS adresse "
            "FROM tx_in_a a JOIN tx t ON t.k = a.k"),
        "explode_output_addresses": with_tx(
            "SELECT t.hash AS hachage_transaction, t.day AS jour, a.addr AS adresse "
            "FROM tx_out_a a JOIN tx t ON t.k = a.k"),
        "daily_address_set": with_tx(
            f"SELECT DISTINCT t.day AS jour, x.addr AS adresse FROM tx t JOIN {O.ADDR_UNION} x ON x.k = t.k"),
        "window_address_set": with_tx(f"SELECT DISTINCT addr AS adresse FROM {O.ADDR_UNION} x"),
        "active_addresses_daily": with_tx(
            "SELECT jour, na AS adresses_actives_jour FROM a", f"a AS ({_DAILY_ADDR})"),
        "active_addresses_global": with_tx(
            f"SELECT count(DISTINCT addr) AS adresses_actives_global FROM {O.ADDR_UNION} x"),
        "whale_volume_global": with_tx(
            f"SELECT {O.FIN['whale_volume']} AS whale_volume_global FROM (SELECT {O.PARTIALS_SQL} FROM tx)"),
        "kpi_daily": _KPI_DAILY,
        "kpi_daily_roundtrip": _KPI_DAILY,
        "kpi_global": with_tx(f"""
SELECT {O.finish(O.GLOBAL)},
  (SELECT count(DISTINCT addr) FROM {O.ADDR_UNION} x) AS adresses_actives_global
FROM (SELECT {O.PARTIALS_SQL} FROM tx)"""),
        "kpi_global_slides": _KPI_GLOBAL_SLIDES,
        "kpi_daily_slides": _KPI_DAILY_SLIDES,
        "kpi_sliding_eventtime": _EVENTTIME,
        "window_bounds": with_tx(f"""
SELECT slide, ws AS new_start, we AS new_end, CAST(date_trunc('month', ws) AS DATE) AS m_start,
  CAST(date_trunc('month', we) AS DATE) AS m_end,
  CAST(epoch(CAST(ws AS TIMESTAMP)) AS BIGINT) AS ts_lo_epoch,
  CAST(epoch(CAST(we + 1 AS TIMESTAMP)) AS BIGINT) AS ts_hi_epoch FROM wins""", _SLIDES),
        "window_state_init": with_tx("SELECT s AS start_date, e AS end_date, 0 AS version FROM st",
                                     O.base_state_cte(BASE_MONTH)),
        "window_state_advance": with_tx(
            f"SELECT s + {STEP} AS start_date, e + {STEP} AS end_date, 1 AS version FROM st",
            O.base_state_cte(BASE_MONTH)),
        "window_state": with_tx(
            f"SELECT s + {2 * STEP} AS start_date, e + {2 * STEP} AS end_date, 2 AS version, "
            "CAST(1 AS BIGINT) AS n_rows, 1 AS ok FROM st", O.base_state_cte(BASE_MONTH)),
        "check_slides_contents": f"SELECT slide, min_date_table, max_date_table, nb_lignes FROM ({_CHECKS})",
        "check_slides_verdict": _CHECKS,
        "check_slides_outside": _OUTSIDE,
        "raw_month_reader": None,
        "kpi_global_roundtrip": None,
        "pipeline_slide": _KPI_DAILY_PIPELINE,
        "pipeline_run_slides": f"SELECT * FROM ({_KPI_GLOBAL_SLIDES}) WHERE slide <= 15",
        "pipeline_refresh": f"SELECT * EXCLUDE (slide) FROM ({_KPI_DAILY_PIPELINE}) WHERE slide = 1",
        "check_window_contents": with_tx(f"SELECT min(day) AS min_date_table, max(day) AS max_date_table, "
                                         f"count(*) AS nb_lignes FROM tx, st WHERE day BETWEEN st.s + {STEP} AND st.e + {STEP}",
                                         O.base_state_cte(BASE_MONTH)),
        "check_window_verdict": _VERDICTS,
        "check_window_advanced": _ADVANCED,
    }
    sql["raw_month_reader"] = sql["window_extract"]
    sql["raw_catalog_reader"] = sql["window_extract"]
    sql["tx_lookup_by_hash"] = with_tx(_CANON_SQL.format(src="(SELECT * FROM tx WHERE hash IN ("
                                       "SELECT min(hash) FROM tx GROUP BY date_trunc('month', day)))"))
    sql["check_window_observed"] = with_tx("""
SELECT b.version, b.ws AS start_date, b.we AS end_date, c.mn AS min_date_table, c.mx AS max_date_table, c.cnt AS nb_lignes,
  CAST(date_diff('day', b.ws, c.mn) AS INTEGER) AS start_gap_days, CAST(date_diff('day', c.mx, b.we) AS INTEGER) AS end_gap_days,
  CAST(c.cnt > 0 AS INTEGER) AS non_empty, CAST(c.mn >= b.ws AND c.mx <= b.we AS INTEGER) AS in_bounds
FROM b JOIN c ON c.version = b.version""", O.base_state_cte(BASE_MONTH) + f""",
b AS (SELECT 0 AS version, s AS ws, e AS we FROM st UNION ALL SELECT 1, s + {STEP}, e + {STEP} FROM st),
c AS (SELECT b.version, min(day) AS mn, max(day) AS mx, count(*) AS cnt FROM tx JOIN b ON day BETWEEN b.ws AND b.we GROUP BY b.version)""")
    sql["active_addresses_slides_sweep"] = f"SELECT slide, adresses_actives_global FROM ({_KPI_GLOBAL_SLIDES})"
    sql["active_addresses_bitmap"] = with_tx("""
SELECT 'jour' AS periode, jour, CAST(NULL AS INTEGER) AS slide, na AS adresses_actives FROM a
UNION ALL SELECT 'slide', CAST(NULL AS DATE), w.slide, coalesce(ad.na, 0)
FROM wins w LEFT JOIN ad ON ad.slide = w.slide""", _SLIDES + f""",
a AS ({_DAILY_ADDR}),
ad AS (SELECT w.slide, count(DISTINCT x.addr) AS na FROM wins w JOIN tx t ON t.day BETWEEN w.ws AND w.we
       JOIN {O.ADDR_UNION} x ON x.k = t.k GROUP BY w.slide)""")
    sql["state_commit_log"] = with_tx(f"""
SELECT CAST(v.number AS INTEGER) AS "commit", CAST(v.version AS INTEGER) AS version,
  CAST(st.s + {STEP} * CAST(v.version AS INTEGER) AS DATE) AS start_date,
  CAST(st.e + {STEP} * CAST(v.version AS INTEGER) AS DATE) AS end_date
FROM st, (VALUES (0, 0), (1, 1), (2, 3)) v(number, version)""", O.base_state_cte(BASE_MONTH))
    sql["window_incremental"] = with_tx(f"""
SELECT v.version, d.jour, {O.finish(O.DAILY)}, coalesce(a.na, 0) AS adresses_actives_jour
FROM (SELECT unnest([2, 3]) AS version) v, st JOIN d ON d.jour BETWEEN st.s + {2 * STEP} AND st.e + {2 * STEP}
LEFT JOIN a ON a.jour = d.jour""", O.base_state_cte(BASE_MONTH) + f""",
d AS ({_DAILY_PARTS}),
a AS ({_DAILY_ADDR})""")
    sql["kpi_global_roundtrip"] = sql["kpi_global"]
    for key, k in daily_keys.items():
        sql[key] = _daily_one(k)
    sql.update({
        "stream_kpi_daily": _STREAM_DAILY,
        "stream_kpi_daily_live": _STREAM_DAILY,
        "stream_active_addresses": _STREAM_ADDR,
        "stream_kpi_sliding": _STREAM_SLIDING,
        "stream_active_addresses_sliding": _STREAM_SLIDING_ADDR,
        "stream_active_addresses_runs": _STREAM_SLIDING_ADDR,
        "stream_median_daily": _daily_one("median"),
        "stream_kpi_daily_repaired": _STREAM_DAILY,
        "stream_kpi_daily_compacted": _STREAM_DAILY,
        "stream_kpi_daily_tx": with_tx(f"""
SELECT day AS jour, {O.finish(O.DAILY)} FROM (SELECT day, {O.PARTIALS_SQL} FROM tx GROUP BY day)"""),
    })
    sql.update(_llm()[1])
    return sql
