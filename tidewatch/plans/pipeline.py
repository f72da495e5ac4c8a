"""End-to-end jobs (PL-1 setup, PL-2 one slide, PL-3 many slides, PL-4 refresh).

Layout under ``root`` (a shared folder; by default inside the session's
``spark.checkpoint.dir``)::

    state/log/                one entry a commit: bounds of its versions and where their tables are
    build-ID/window/          day-partitioned window table
    build-ID/kpi_daily/       daily KPI table, by month (one slide) or by slide
    build-ID/kpi_global/      one row (one row per slide)
    build-ID/days|values|addresses|checks/   what a many-slide job reads once

Every job writes a build folder of its own and then commits state rows that
point into it.  Folders that a state points to are never written again, so a
job that fails, or loses the race for a version, leaves the committed versions
readable; its folder is removed when it fails in an orderly way.  Every KPI job
reads the written window table back, which cuts lineage: a lost executor
recomputes from Parquet, not from the raw scan.

With ``publish``, views of fixed names show the current version: they are
repointed after each commit.  With ``keep``, builds that none of the last
``keep`` versions points to are removed after each commit.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import as_date
from tidewatch.operators.extract import extract_window, project_window
from tidewatch.operators.kpi import kpi_daily, kpi_global
from tidewatch.plans.checks import check_slide_days, check_window_verdict, verdict_columns
from tidewatch.plans.lookup import lookup_by_hash
from tidewatch.plans.slides import day_tables, kpi_daily_slides, kpi_global_slides, slides_window
from tidewatch.plans.state import StateStore
from tidewatch.plans.windows import state_row
from tidewatch.schema import DAILY_KPIS, SLIDE_DAYS, WHALE_THRESHOLD_SAT, WINDOW_DAY
from tidewatch.session import remove_path, scratch_path, set_initial_shuffle_partitions


def write_window_table(window: DataFrame, path: str, bloom: bool = True) -> dict:
    """SNK-1: day-partitioned, hash-clustered window table.

    ``rebalance`` on the day lets AQE split a heavy day over several tasks
    (and merge light days) instead of one task per day; sorting by hash
    inside each file gives row-group min/max skipping on the hash, and a Bloom
    filter on it (sized by what a row group holds) tells the files that have a hash
    from those that do not (``plans.lookup``).

    Returns what was written, as the write has seen it: ``min_day``, ``max_day``
    and ``rows``.  They are observed in the last stage, whose tasks count once
    however often one is tried."""
    seen = Observation()
    # observed below the sort, which the writer then finds as it needs it
    rows = window.hint("rebalance", F.col(WINDOW_DAY)).observe(
        seen, F.min(WINDOW_DAY).alias("min_day"), F.max(WINDOW_DAY).alias("max_day"), F.count(F.lit(1)).alias("rows"))
    writer = rows.sortWithinPartitions(WINDOW_DAY, "hachage_transaction").write.mode("overwrite").partitionBy(WINDOW_DAY)
    if bloom:
        writer = writer.option("parquet.bloom.filter.enabled#hachage_transaction", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)
    return {"min_day": None, "max_day": None, "rows": 0} | dict(seen.get)   # an empty plan observes nothing


class BrokenWindow(ValueError):
    """A window table holds days outside its bounds; it is not committed."""


def checked(seen: dict, start, end) -> str:
    """What a write has seen, as a JSON column of the state; raises when days lie
    outside ``[start, end]`` (CK-3 on the way, without a scan)."""
    if seen["rows"] and (start is None or seen["min_day"] is None or not start <= seen["min_day"] <= seen["max_day"] <= end):
        raise BrokenWindow(f"days {seen['min_day']} to {seen['max_day']} in a window of {start} to {end}")
    return json.dumps(seen, default=str)


def write_kpi_daily(daily: DataFrame, path: str) -> None:
    """SNK-2: the daily KPI table, partitioned by month (``mois``) and
    sorted by ``jour`` inside each file.

    The table holds one row per day, so day folders would be one-row files
    (thousands of them over a long history); month folders keep files few
    while a filter on ``jour`` still skips row groups by min/max.  The
    shuffle by month moves at most 31 rows per key."""
    (daily.withColumn("mois", F.trunc("jour", "MM")).repartition("mois")
     .sortWithinPartitions("jour").write.mode("overwrite").partitionBy("mois").parquet(path))


def read_kpi_daily(spark: SparkSession, path: str) -> DataFrame:
    """Read back a daily KPI table with the contract columns only."""
    return spark.read.parquet(path).select(*DAILY_KPIS)


def write_kpi_global(glob: DataFrame, path: str) -> None:
    """SNK-3: a few rows; one file."""
    glob.repartition(1).write.mode("overwrite").parquet(path)


class Pipeline:
    def __init__(self, spark: SparkSession, raw: DataFrame, root: str | None = None,
                 step_days: int = SLIDE_DAYS, whale_sat: int = WHALE_THRESHOLD_SAT,
                 shuffle_partitions: int | None = None, publish: str | None = None,
                 keep: int | None = None):
        """``shuffle_partitions``: AQE's initial shuffle partition count for
        the pipeline's jobs (see ``session.set_initial_shuffle_partitions``);
        None keeps the session's setting.  ``publish``: prefix of the views
        ``<prefix>window``, ``<prefix>kpi_daily`` and ``<prefix>kpi_global`` of
        the current version.  ``keep``: versions whose tables stay (at least
        the current one); None keeps all."""
        if keep is not None and keep < 1:
            raise ValueError("keep must be at least 1")
        set_initial_shuffle_partitions(spark, shuffle_partitions)
        self.spark = spark
        self.raw = raw
        self.root = (root or scratch_path(spark, "pipeline")).rstrip("/")
        self.step = step_days
        self.whale_sat = whale_sat
        self.publish = publish
        self.keep = keep
        self.state = StateStore(spark, f"{self.root}/state")

    # -- tables -----------------------------------------------------------
    def _schema(self, table: str):
        """Schema of a stored table, derived from the plan (no job).  Reads
        use it, so an empty window (NULL state, month without data) reads
        back as an empty table instead of failing schema inference."""
        w = project_window(self.raw)
        if table == "kpi_daily":
            return kpi_daily(w).schema
        return kpi_global(w).schema if table == "kpi_global" else w.schema

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """``window``, ``kpi_daily`` or ``kpi_global`` of a version, the
        current one by default."""
        return self._table(table, self.state.row(version))

    def _table(self, table: str, row) -> DataFrame:
        rows = self._load(table, row[f"{table}_path"])
        if table == "window":   # a many-slide build holds the union of its windows
            rows = rows.where(F.col(WINDOW_DAY).between(F.lit(row["start_date"]).cast("date"),
                                                        F.lit(row["end_date"]).cast("date")))
        return rows

    def _load(self, table: str, path: str) -> DataFrame:
        schema = self._schema(table)
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)

    def _build_folder(self) -> str:
        return f"{self.root}/build-{uuid.uuid4().hex}"

    @contextlib.contextmanager
    def _building(self):
        """A new build folder; removed again when the job fails."""
        folder = self._build_folder()
        try:
            yield folder
        except BaseException:
            remove_path(self.spark, folder)
            raise

    def _commit(self, states: DataFrame) -> None:
        self.state.commit(states)
        row = self.state.row()
        if self.publish is not None:
            for t in ("window", "kpi_daily", "kpi_global"):
                self._table(t, row).createOrReplaceTempView(f"{self.publish}{t}")
        if self.keep is not None:
            self._retain(row["version"])

    def _retain(self, current: int) -> None:
        """Remove the builds that only versions before the last ``keep`` use."""
        paths = F.array("window_path", "kpi_daily_path", "kpi_global_path", "files_path")
        days = F.coalesce(F.map_values(F.from_json("window_days", "map<string,string>")), F.array().cast("array<string>"))
        rows = self.state.rows().select("version", F.concat(paths, days).alias("paths"))   # a window's days at most
        top = [r[0] for r in rows.select("version").orderBy(F.desc("version")).limit(self.keep).collect()]
        build = F.regexp_extract(F.col("path"), r"/(build-[0-9a-f]+)(?:/|$)", 1)
        used = rows.select("version", F.explode("paths").alias("path")) \
            .select("version", build.alias("build")).where("build <> ''")
        for r in used.groupBy("build").agg(F.max("version").alias("last")).where(
                F.col("last") < min(top)).collect():   # one row a build
            remove_path(self.spark, f"{self.root}/{r['build']}")

    # -- one window -------------------------------------------------------
    def _write_window(self, folder: str, start, end) -> tuple[DataFrame, str]:
        """The window table as written, and what its write has seen."""
        seen = write_window_table(extract_window(self.raw, start, end), f"{folder}/window")
        return self._load("window", f"{folder}/window"), checked(seen, start, end)

    def _write_kpis(self, folder: str, window: DataFrame) -> None:
        write_kpi_daily(kpi_daily(window, self.whale_sat), f"{folder}/kpi_daily")
        write_kpi_global(kpi_global(window, self.whale_sat), f"{folder}/kpi_global")

    def _one_state(self, start, end, version: int, folder: str, observed: str | None = None,
                   window_path: str | None = None) -> DataFrame:
        return state_row(self.spark, start, end, version).select(
            "*", F.lit(window_path or f"{folder}/window").alias("window_path"), F.lit(observed).alias("observed"),
            F.lit(f"{folder}/kpi_daily").alias("kpi_daily_path"),
            F.lit(f"{folder}/kpi_global").alias("kpi_global_path"))

    # -- PL-1 -------------------------------------------------------------
    def setup(self, month) -> int:
        """Base window = the month's days with data, as a new version: the
        first one, or the next on a root that has been used."""
        last = self.state.current_version()
        version = 0 if last is None else last + 1
        first = _dt.date.fromisoformat(str(month)[:10]).replace(day=1)
        after = (first + _dt.timedelta(days=32)).replace(day=1)
        with self._building() as folder:
            window, observed = self._write_window(folder, first, after - _dt.timedelta(days=1))
            start, end = (None if d is None else _dt.date.fromisoformat(d) for d in map(json.loads(observed).get, ("min_day", "max_day")))
            self._write_kpis(folder, window)
            self._commit(self._one_state(start, end, version, folder, observed))
        return version

    # -- PL-2 -------------------------------------------------------------
    def slide_once(self, retries: int = 0) -> int:
        """Shift by ``step`` days, rebuild the window and both KPI tables,
        then commit the new state.  A job that loses its version to another
        removes its build and, at most ``retries`` times, slides the newest state."""
        try:
            return self._slide()
        except FileExistsError:
            if retries < 1:
                raise
        return self.slide_once(retries - 1)

    def _slide(self) -> int:
        start, end, version = self.state.bounds()
        # the new bounds are two dates: shift them on the driver (NULL stays NULL)
        shift = _dt.timedelta(days=self.step)
        new_start = start + shift if start is not None else None
        new_end = end + shift if end is not None else None
        with self._building() as folder:
            window, observed = self._write_window(folder, new_start, new_end)
            self._write_kpis(folder, window)
            self._commit(self._one_state(new_start, new_end, version + 1, folder, observed))
        return version + 1

    def run(self, iterations: int) -> int:
        """The sequential loop: ``iterations`` slides, each its own jobs."""
        v = self.state.row()["version"]
        for _ in range(iterations):
            v = self.slide_once()
        return v

    # -- PL-3 (RW-3) ------------------------------------------------------
    def run_slides(self, n_slides: int) -> int:
        """Slides 1..n of the current state in one pass.

        The union of the windows is extracted and written once and reduced in
        three scans to day partials, counts of each day's values and the days
        of each address; daily and global KPIs and checks of all slides come
        from these.  One commit adds the versions of all n slides: each points
        to the shared window table (read within its bounds) and to its own
        slide's KPI folders."""
        if n_slides < 1:
            raise ValueError("n_slides must be at least 1")
        start, end, version = self.state.bounds()
        bounds = (start, end)          # literals: pushed to the scan
        with self._building() as out:
            seen = write_window_table(slides_window(self.raw, bounds, n_slides, self.step), f"{out}/window")
            shift = lambda day, k: None if day is None else day + _dt.timedelta(days=self.step * k)
            checked(seen, shift(start, 1), shift(end, n_slides))
            w = self._load("window", f"{out}/window")
            tables = []
            for name, t in zip(("days", "values", "addresses"), day_tables(w, self.whale_sat)):
                t.write.parquet(f"{out}/{name}")
                tables.append(self.spark.read.schema(t.schema).parquet(f"{out}/{name}"))
            glob = kpi_global_slides(None, bounds, n_slides, self.step, window=w, tables=tables)
            glob.repartition(1).write.partitionBy("slide").parquet(f"{out}/kpi_global")
            daily = kpi_daily_slides(None, bounds, n_slides, self.step, window=w, tables=tables)
            daily.repartition("slide").sortWithinPartitions("slide", "jour").write.partitionBy("slide") \
                .parquet(f"{out}/kpi_daily")
            check_slide_days(tables[0].select("jour", "n"), bounds, n_slides, self.step) \
                .repartition(1).write.parquet(f"{out}/checks")
            # a slide without days has no folder in the daily table
            self._empty_folders(daily, f"{out}/kpi_daily", start, n_slides)
            slide = F.col("id").cast("int")
            states = self.spark.range(1, n_slides + 1).select(
                F.date_add(as_date(start), slide * self.step).alias("start_date"),
                F.date_add(as_date(end), slide * self.step).alias("end_date"),
                (slide + version).alias("version"), F.lit(f"{out}/window").alias("window_path"),
                *[F.concat(F.lit(f"{out}/{t}/slide="), slide.cast("string")).alias(f"{t}_path")
                  for t in ("kpi_daily", "kpi_global")])
            self._commit(states)
        return version + n_slides

    def _empty_folders(self, daily: DataFrame, path: str, start, n_slides: int) -> None:
        """Empty daily tables for the slides that hold no day."""
        there = set()
        if start is not None:
            there = {r[0] for r in self.spark.read.schema(daily.schema).parquet(path)
                     .select("slide").distinct().collect()}   # one row a slide
        none = daily.drop("slide").limit(0)
        for k in range(1, n_slides + 1):
            if k not in there:
                none.write.mode("overwrite").parquet(f"{path}/slide={k}")

    # -- PL-4 -------------------------------------------------------------
    def refresh_kpis(self, version: int | None = None) -> int:
        """Recompute both KPI tables from a stored window table, without
        sliding (for instance after a correction of the KPI definitions), as a
        new version with the same window."""
        row = self.state.row(version)
        nxt = self.state.row()["version"] + 1
        with self._building() as folder:
            self._write_kpis(folder, self._table("window", row))
            self._commit(self._one_state(row["start_date"], row["end_date"], nxt, folder, row["observed"], row["window_path"]))
        return nxt

    # -- checks -----------------------------------------------------------
    def verdict(self, version: int | None = None) -> DataFrame:
        """CK-3 on a version's window table, as stored."""
        row = self.state.row(version)
        return check_window_verdict(self._table("window", row), state_row(
            self.spark, row["start_date"], row["end_date"], row["version"]))

    def observed(self, version: int | None = None) -> DataFrame:
        """CK-3 of a version's window from what its write has seen: no table is read.
        Windows of a many-slide build share a table; ``slide_checks`` has theirs."""
        row = self.state.row(version)
        if row["observed"] is None:
            raise ValueError(f"version {row['version']} was not observed when it was written")
        seen = json.loads(row["observed"])
        contents = self.spark.range(1).select(
            F.lit(row["start_date"]).cast("date").alias("start_date"), F.lit(row["end_date"]).cast("date").alias("end_date"),
            F.lit(seen["min_day"]).cast("date").alias("min_date_table"), F.lit(seen["max_day"]).cast("date").alias("max_date_table"),
            F.lit(seen["rows"]).cast("bigint").alias("nb_lignes"))
        return contents.select("*", *verdict_columns(contents))

    def lookup(self, hashes: list[str], version: int | None = None) -> DataFrame:
        """The transactions of a version's window with these hashes (``plans.lookup``)."""
        return lookup_by_hash(self.read("window", version), hashes)

    def slide_checks(self, version: int | None = None) -> DataFrame:
        """The checks that the many-slide job of a version has written."""
        path = self.state.row(version)["window_path"].rsplit("/", 1)[0]
        return self.spark.read.parquet(f"{path}/checks")
