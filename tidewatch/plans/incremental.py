"""Window rebuilds that cost what changed (RW-2, PL-2): a manifest of source files.

Every version stores, for each source file of its window's months, path, size, time
and the days that it holds.  A slide lists the files again (one distributed listing,
no data read), reads the day column of those that are new or changed, and rebuilds

* the days that came into the window, and
* the days that a new, changed or removed file holds or held,

from the files that hold such a day.  The other days stay where they are: a version
of the window is a list of day folders, most of them in builds of earlier versions.
Daily KPIs are computed for rebuilt days only.  The result is that of a full rebuild,
late rows and corrected files included.

A listing is taken once for a slide, and only listed files are read, so files that
arrive meanwhile are new to the next slide.
"""

from __future__ import annotations

import datetime as _dt
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import as_date
from tidewatch.operators.kpi import kpi_daily, kpi_global
from tidewatch.operators.extract import project_window
from tidewatch.plans.pipeline import Pipeline, checked, read_kpi_daily, write_kpi_daily, write_kpi_global, write_window_table
from tidewatch.plans.state import PATHS
from tidewatch.schema import DAILY_KPIS, RAW_MONTH, RAW_TS, WINDOW_DAY
from tidewatch.sources import read_raw

MANIFEST = "path string, size bigint, modified timestamp, days array<date>"


def list_files(spark: SparkSession, root: str, start, end) -> DataFrame:
    """``path, size, modified`` of the data files of the months of two days; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    months = F.col(RAW_MONTH).cast("date").between(F.trunc(as_date(start), "MM"), F.trunc(as_date(end), "MM"))
    return files.where(months).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def _plain(path: str) -> str:
    """A path with one form of its scheme (``file:/a`` and ``file:///a`` are one)."""
    return re.sub(r"^([a-z0-9]+):/+", r"\1:/", path)


class IncrementalPipeline(Pipeline):
    """A pipeline over a month-partitioned folder that rebuilds what changed."""

    def __init__(self, spark: SparkSession, raw_root: str, root: str | None = None, **kw):
        super().__init__(spark, read_raw(spark, raw_root), root, **kw)
        self.raw_root = raw_root.rstrip("/")
        #: What the last build rebuilt: days, and source files read for them.
        self.rebuilt_days: list[_dt.date] = []
        self.files_read: list[str] = []

    # -- the manifest --------------------------------------------------------------

    def _source(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.raw.limit(0)
        return self.spark.read.schema(self.raw.schema).option("basePath", self.raw_root).parquet(*paths)

    def _manifest(self, start, end, before: list) -> tuple[list, set]:
        """The files now, as rows of the manifest, and the days that changes touch."""
        known = {(r["path"], r["size"], r["modified"]): r for r in before}
        now = list_files(self.spark, self.raw_root, start, end).collect()   # one row a file of the window's months
        changed = [r for r in now if (r["path"], r["size"], r["modified"]) not in known]
        days = {}
        if changed:
            found = self._source([r["path"] for r in changed]).select(
                F.col("_metadata.file_path").alias("path"), F.to_date(RAW_TS).alias("day"))
            held = {_plain(r["path"]): r["days"] for r in found.groupBy("path").agg(
                F.collect_set("day").alias("days")).collect()}   # 31 days a file at most
            every = [start + _dt.timedelta(days=i) for i in range((end - start).days + 1)]
            # a file that shows no rows may be one that is named otherwise there: it counts for every day
            days = {r["path"]: held.get(_plain(r["path"]), every) for r in changed}
        same = {(r["path"], r["size"], r["modified"]) for r in now} & set(known)
        rows = [(*f, known[f]["days"]) for f in sorted(same)]
        rows += [(r["path"], r["size"], r["modified"], sorted(days[r["path"]])) for r in changed]
        gone = [known[f]["days"] for f in known if f not in same]
        touched = {d for own in gone for d in own} | {d for own in days.values() for d in own}
        return rows, touched

    # -- one build -----------------------------------------------------------------

    def _build(self, folder: str, start, end, row) -> dict:
        """Write the tables of the window [start, end]; ``row`` is the state to start
        from (None: none).  Returns the state columns that name them."""
        self.rebuilt_days, self.files_read = [], []
        names = {f"{t}_path": f"{folder}/{t}" for t in ("window", "kpi_daily", "kpi_global")}
        if start is None:
            empty = project_window(self.raw.limit(0))
            names["observed"] = checked(write_window_table(empty, f"{folder}/window"), start, end)
            self._write_kpis(folder, empty)
            return names
        folders = json.loads(row["window_days"]) if row is not None and row["window_days"] else {}
        usable = row is not None and row["files_path"] is not None
        before = self.spark.read.schema(MANIFEST).parquet(row["files_path"]).collect() if usable else []
        files, touched = self._manifest(start, end, before)
        days = [start + _dt.timedelta(days=i) for i in range((end - start).days + 1)]
        covered = set() if not usable else {
            row["start_date"] + _dt.timedelta(days=i) for i in range((row["end_date"] - row["start_date"]).days + 1)}
        self.rebuilt_days = [d for d in days if d in touched or d not in covered]
        wanted = set(self.rebuilt_days)
        self.files_read = [f[0] for f in files if wanted.intersection(f[3])]
        self.spark.createDataFrame(files, MANIFEST).coalesce(1).write.parquet(f"{folder}/files")
        day = F.to_date(RAW_TS)
        rows = self._source(self.files_read).where(day.isin(self.rebuilt_days) if wanted else F.lit(False))
        checked(write_window_table(project_window(rows), f"{folder}/window"), start, end)
        schema = self._schema("window")
        new = self.spark.read.schema(schema).parquet(f"{folder}/window").select(*schema.names)
        written = {r[0] for r in new.select(WINDOW_DAY).distinct().collect()}   # a window's days at most
        index = {str(d): f"{folder}/window" for d in days if d in written}
        index |= {str(d): folders[str(d)] for d in days if d not in wanted and str(d) in folders}
        window = self._days(index)
        daily = kpi_daily(new, self.whale_sat)
        if usable:
            old = read_kpi_daily(self.spark, row["kpi_daily_path"])
            keep = [d for d in days if d not in wanted]
            daily = daily.unionByName(old.where(F.col("jour").isin(keep) if keep else F.lit(False)))
        write_kpi_daily(daily.select(*DAILY_KPIS), f"{folder}/kpi_daily")
        write_kpi_global(kpi_global(window, self.whale_sat), f"{folder}/kpi_global")
        return names | {"window_days": json.dumps(index), "files_path": f"{folder}/files"}

    def _days(self, index: dict[str, str]) -> DataFrame:
        """The window table of a day -> folder list."""
        schema = self._schema("window")
        out = None
        for base in sorted(set(index.values())):   # the builds that the window's days lie in
            paths = [f"{base}/{WINDOW_DAY}={d}" for d, b in sorted(index.items()) if b == base]
            part = self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)
            out = part if out is None else out.unionByName(part)
        return self.spark.createDataFrame([], schema) if out is None else out

    def _table(self, table: str, row) -> DataFrame:
        if table == "window" and row["window_days"]:
            return self._days(json.loads(row["window_days"]))
        return super()._table(table, row)

    def _state_of(self, start, end, version: int, names: dict) -> DataFrame:
        return self.spark.createDataFrame(
            [(start, end, version, *map(names.get, PATHS))],
            "start_date date, end_date date, version int, " + ", ".join(f"{c} string" for c in PATHS))

    # -- jobs ------------------------------------------------------------------------

    def setup(self, month) -> int:
        last = self.state.current_version()
        first = _dt.date.fromisoformat(str(month)[:10]).replace(day=1)
        after = (first + _dt.timedelta(days=32)).replace(day=1)
        with self._building() as folder:
            names = self._build(folder, first, after - _dt.timedelta(days=1), None)
            there = sorted(json.loads(names["window_days"]))
            start, end = (_dt.date.fromisoformat(d) for d in (there[0], there[-1])) if there else (None, None)
            self._commit(self._state_of(start, end, 0 if last is None else last + 1, names))
        return 0 if last is None else last + 1

    def _slide(self) -> int:
        row = self.state.row()
        shift = _dt.timedelta(days=self.step)
        start, end = (d + shift if d is not None else None for d in (row["start_date"], row["end_date"]))
        with self._building() as folder:
            names = self._build(folder, start, end, row)
            self._commit(self._state_of(start, end, row["version"] + 1, names))
        return row["version"] + 1

    def run_slides(self, n_slides: int) -> int:
        self.raw = read_raw(self.spark, self.raw_root)   # the files as they are now
        return super().run_slides(n_slides)

    def refresh_window(self) -> int:
        """The same window again from the files as they are now, as a new version:
        days with late rows and corrected files are rebuilt, the others stay."""
        row = self.state.row()
        with self._building() as folder:
            names = self._build(folder, row["start_date"], row["end_date"], row)
            self._commit(self._state_of(row["start_date"], row["end_date"], row["version"] + 1, names))
        return row["version"] + 1

    def refresh_kpis(self, version: int | None = None) -> int:
        row = self.state.row(version)
        nxt = self.state.row()["version"] + 1
        with self._building() as folder:
            self._write_kpis(folder, self._table("window", row))
            self._commit(self._state_of(row["start_date"], row["end_date"], nxt, {
                "window_path": row["window_path"], "window_days": row["window_days"], "files_path": row["files_path"],
                "kpi_daily_path": f"{folder}/kpi_daily", "kpi_global_path": f"{folder}/kpi_global"}))
        return nxt
