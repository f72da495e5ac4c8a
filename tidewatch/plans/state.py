"""Versioned rolling state on a commit log (SNK-4, SNK-5, SRC-3).

Parquet has no UPDATE and a path cannot be overwritten while it is read, so
states are rows of a log, ``<root>/log``, one entry a commit.  Writing the entry is
the commit point of a job: its tables are written first, the state rows last, all
rows of one commit at once.  A version that exists is never written again: of
two jobs that built the same version, however close, one commits; the other
fails at its commit and leaves nothing that readers see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.plans.commit_log import CommitLog
from tidewatch.plans.windows import advance_state, latest_state, state_from_data, state_row
from tidewatch.schema import SLIDE_DAYS

#: Where a version's tables are (NULL in a store that only keeps bounds).  Windows
#: built from changes also have the folder of each day (JSON) and the manifest of
#: the source files; ``observed`` is what the write of the window has seen (JSON).
PATHS = ("window_path", "kpi_daily_path", "kpi_global_path", "window_days", "files_path", "observed")
#: A state row: the window's bounds and these.
STATE_SCHEMA = "start_date date, end_date date, " + ", ".join(f"{c} string" for c in PATHS) + ", version int"


class StateStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log", STATE_SCHEMA)

    def rows(self) -> DataFrame:
        """All stored rows; empty when nothing is stored yet.  Any other fault
        of the store is raised."""
        return self.log.rows().drop("commit")

    def history(self) -> DataFrame:
        """All versions ``(start_date, end_date, version)``; empty when nothing is stored."""
        return self.rows().select("start_date", "end_date", "version")

    def commits(self) -> DataFrame:
        """``commit, version, start_date, end_date``: which commit added which versions."""
        return self.log.rows().select("commit", "version", "start_date", "end_date")

    def current_version(self) -> int | None:
        return self.history().agg(F.max("version")).first()[0]

    def read(self) -> DataFrame:
        """The current state: the row of the highest version."""
        return latest_state(self.history())

    def row(self, version: int | None = None):
        """One stored row, the current one by default."""
        rows = self.rows() if version is None else self.rows().where(F.col("version") == version)
        found = rows.orderBy(F.desc("version")).first()
        if found is None:
            what = "no state" if version is None else f"no version {version}"
            raise ValueError(f"{what} under {self.root}; run setup first")
        return found

    def commit(self, states: DataFrame) -> int:
        """Add state rows (``start_date, end_date, version`` and, if there are
        any, the table paths) as new versions, all in one commit, whose number is
        returned; fails when one of the versions exists."""
        rows = [r.asDict() for r in states.select(
            F.col("start_date").cast("date"), F.col("end_date").cast("date"),
            *[F.col(c) if c in states.columns else F.lit(None).cast("string").alias(c) for c in PATHS],
            F.col("version").cast("int")).collect()]   # one row a version
        versions = [r["version"] for r in rows]

        def check() -> None:
            taken = self.history().where(F.col("version").isin(versions)).select("version").first()
            if taken is not None:
                raise FileExistsError(f"version {taken[0]} exists under {self.root}")

        return self.log.commit(rows, check)

    def init(self, raw: DataFrame, month) -> int:
        """SNK-4: the first version, from the base month of the data."""
        self.commit(state_from_data(raw, month))
        return 0

    def advance(self, step_days: int = SLIDE_DAYS, times: int = 1, retries: int = 0) -> int:
        """SNK-5: write version n+times computed from version n.  A writer that
        loses that version to another starts again from the newest state, at most
        ``retries`` times."""
        while True:
            cur = self.row()
            state = state_row(self.spark, cur["start_date"], cur["end_date"], cur["version"])
            try:
                self.commit(advance_state(state, step_days, times))
                return cur["version"] + times
            except FileExistsError:
                if retries < 1:
                    raise
                retries -= 1

    def bounds(self):
        """``(start_date, end_date, version)`` of the current state as Python
        values (one row; used to build plans with literal bounds)."""
        row = self.row()
        return row["start_date"], row["end_date"], row["version"]
