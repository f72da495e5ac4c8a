"""Late rows of a stream: kept, and repaired in the live table (RW-5..RW-8).

A stateful stream drops the rows of windows that its watermark has closed.  Here
the source is taken in first (``Intake``): every micro-batch is stored as an epoch,
parted into rows on time and rows behind the watermark that the epochs before
it commit to, and recorded in a log.  The KPI stream reads the stored epochs;
whatever it drops is among the late rows, since its own watermark never runs ahead
of the log's.  ``Repairs`` computes the closed windows that late rows fall into again,
from the stored rows of just those windows, and adds them to the live table:
a reader takes each window's newest values, repaired or streamed.  Windows that are
still open have their late rows by the stream itself.

An epoch becomes visible by one rename of its folder.  A batch that is replayed
after a failure finds its epoch stored and only completes the log, so no row is stored
twice; a repair is one entry of a log, and a second one of the same rows gives the
same values.  (Object stores without an atomic rename need a committer that has one.)
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.plans.commit_log import CommitLog
from tidewatch.session import remove_path
from tidewatch.streaming.kpi_stream import TS, _start, live_rows

DAY = _dt.timedelta(days=1)


class Intake:
    """Stored epochs of a stream under ``root``: ``epochs/epoch=N/late=false|true``, ``log``."""

    def __init__(self, spark: SparkSession, root: str, schema, delay: _dt.timedelta = DAY):
        self.spark, self.root, self.schema, self.delay = spark, root.rstrip("/"), schema, delay
        self.log = CommitLog(spark, f"{self.root}/log", "epoch bigint, max_us bigint, late_rows bigint")

    def watermark_us(self, epoch: int | None = None) -> int | None:
        """What the epochs before ``epoch`` (by default all) commit to, in microseconds."""
        rows = self.log.rows() if epoch is None else self.log.rows().where(F.col("epoch") < epoch)
        top = rows.agg(F.max("max_us")).first()[0]
        return None if top is None else top - self.delay // _dt.timedelta(microseconds=1)

    def _store(self, batch: DataFrame, epoch: int) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(f"{self.root}/epochs/epoch={epoch}")
        fs = target.getFileSystem(conf)
        if not fs.exists(target):
            mark = self.watermark_us(epoch)
            ends = F.unix_micros((F.date_trunc("day", TS) + F.expr("INTERVAL 1 DAY")))
            late = F.coalesce(ends <= F.lit(mark), F.lit(False)) if mark is not None else F.lit(False)
            attempt = f"{self.root}/attempt-{uuid.uuid4().hex}"
            batch.select(*self.schema.names, late.alias("late")).write.partitionBy("late").parquet(attempt)
            fs.mkdirs(target.getParent())
            if not fs.rename(jvm.org.apache.hadoop.fs.Path(attempt), target):
                remove_path(self.spark, attempt)
                raise OSError(f"could not store epoch {epoch}")
        if self.log.rows().where(F.col("epoch") == epoch).first() is None:
            stored = self.spark.read.schema(f"{TS} timestamp, late boolean").parquet(target.toString())
            top, n = stored.agg(F.max(F.unix_micros(TS)), F.count_if("late")).first()
            self.log.commit([{"epoch": epoch, "max_us": top, "late_rows": n}], lambda: None)

    def run(self, stream: DataFrame) -> None:
        """Take in everything available."""
        w = (stream.writeStream.foreachBatch(self._store).option("checkpointLocation", f"{self.root}/checkpoint")
             .trigger(availableNow=True))
        q = _start(stream, w, None, None)
        q.awaitTermination()

    def stream(self) -> DataFrame:
        """All stored rows as a stream, on time or late."""
        return self.spark.readStream.schema(self.schema).parquet(f"{self.root}/epochs/epoch=*/late=*")

    def rows(self) -> DataFrame:
        """All stored rows."""
        return self.spark.read.schema(self.schema).option("basePath", f"{self.root}/epochs").parquet(
            f"{self.root}/epochs").select(*self.schema.names)

    def late(self, after: int = -1) -> DataFrame:
        """The late rows of the epochs behind one, with their ``epoch``."""
        read = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/epochs").parquet(f"{self.root}/epochs")
        return read.where(F.col("late").cast("boolean") & (F.col("epoch") > after)).select("epoch", *self.schema.names)


class Repairs:
    """Repaired windows beside a ``write_live`` table.  ``compute`` should narrow the
    stored rows by time (``in_days``), so that a repair reads what it repairs.

    ``windows(rows)``: the distinct windows (columns ``keys`` and ``end_day``, their
    last day) that rows with a day column ``jour`` fall into.  ``compute(rows, windows)``: the live table's
    columns for those windows, from all stored rows."""

    def __init__(self, intake: Intake, live: str, keys: list[str], windows: Callable, compute: Callable):
        self.intake, self.live, self.keys, self.windows, self.compute = intake, live, keys, windows, compute
        self.spark = intake.spark
        self.log = CommitLog(self.spark, f"{intake.root}/repairs", "path string, live_epoch bigint, late_upto bigint")

    def run(self) -> int:
        """Repair what the late rows since the last repair touch; the number of windows."""
        done = self.log.rows().agg(F.max("late_upto")).first()[0]
        upto = self.intake.log.rows().agg(F.max("epoch")).first()[0]
        if upto is None or (done is not None and done >= upto):
            return 0
        late = self.intake.late(-1 if done is None else done).where(F.col("epoch") <= upto)
        days = late.select(F.to_date(TS).alias("jour")).where("jour IS NOT NULL").distinct()
        closed = F.date_add("end_day", 1).cast("timestamp") <= F.timestamp_micros(F.lit(self.intake.watermark_us()))
        touched = self.windows(days).where(closed).select(*self.keys).distinct()
        epoch = live_rows(self.spark, self.live).agg(F.max("epoch")).first()[0]
        path = f"{self.intake.root}/repaired-{uuid.uuid4().hex}"
        self.compute(self.intake.rows(), touched).repartition(1).write.parquet(path)   # a row a window
        self.log.commit([{"path": path, "live_epoch": epoch, "late_upto": upto}], lambda: None)
        return self.spark.read.parquet(path).count()

    def read(self) -> DataFrame:
        """The newest values of each window, streamed or repaired."""
        live = live_rows(self.spark, self.live)
        cols = [c for c in live.columns if c != "epoch"]
        rows = live.select(F.struct(F.col("epoch").cast("bigint").alias("epoch"), F.lit(-1).alias("commit")).alias("at"), *cols)
        for r in self.log.rows().collect():   # one row a repair
            done = self.spark.read.schema(live.select(*cols).schema).parquet(r["path"])
            rows = rows.unionByName(done.select(F.struct(F.lit(r["live_epoch"]).cast("bigint").alias("epoch"),
                                                         F.lit(r["commit"]).alias("commit")).alias("at"), *cols))
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*cols), "at").alias("last"))
        return last.select("last.*")


def in_days(rows: DataFrame, days: list[_dt.date]) -> DataFrame:
    """The rows of some days, by ranges of the event time that reach the scan: files
    and row groups of other times are not read."""
    at, wanted = F.col(TS), F.lit(False)
    days = sorted(set(days))
    first = None
    for k, day in enumerate(days):
        first = first or day
        if k + 1 == len(days) or days[k + 1] != day + DAY:
            start, end = (F.lit(str(d)).cast("timestamp") for d in (first, day + DAY))
            wanted = wanted | ((at >= start) & (at < end))
            first = None
    return rows.where(wanted)


def daily_repairs(intake: Intake, live: str, keys: list[str], kpis: Callable[[DataFrame], DataFrame]) -> Repairs:
    """Repairs of a daily KPI table: ``kpis(rows)`` gives its columns by day."""
    def compute(rows: DataFrame, days: DataFrame) -> DataFrame:
        return kpis(in_days(rows, [r["jour"] for r in days.select("jour").collect()]))   # touched days, at most the calendar's

    return Repairs(intake, live, keys, lambda days: days.select("jour", F.col("jour").alias("end_day")), compute)
