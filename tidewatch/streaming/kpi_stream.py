"""Structured Streaming forms of the KPIs (RW-5..RW-8).

* ``daily_kpis_stream``: tumbling 1-day event-time windows with a
  watermark; the partials live in the state store.  The median of a stream is
  approximate: one ``percentile_approx`` sketch per open window, exact up to
  about ``median_accuracy`` values and within a rank of 1/accuracy beyond (the
  batch KPIs are exact for any size).
* ``sliding_kpis_stream``: W-day windows sliding by 7 days.
* ``daily_address_stream``: each (window, address) once, as soon as it is seen
  (state keyed by both, so it spreads; of sliding windows: ``address_pairs``);
  ``count_addresses`` counts them per window from the sink, exactly.
  ``active_addresses_stream`` chains the count on the stream, for closed
  windows only.
* ``write_live``: RW-8, an update-mode sink.  A micro-batch writes the current
  values of the windows it changed under its batch number, a replayed batch
  the same rows again; ``read_live`` shows each window's latest values, open
  windows included, so the last ones are there when a source ends.

Append mode emits a window once the watermark (max event time − delay) passes
its end.  Rows older than the watermark are dropped by the stream (Spark counts
them as ``numRowsDroppedByWatermark``) and rows without an event time belong to
no window (``rows_without_event_time``); both are covered by the next batch
rebuild or its checks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.kpi import (
    DAILY_NAMES, GLOBAL_NAMES, finishers, measures, median_agg, partial_aggs,
)
from tidewatch.plans.commit_log import CommitLog
from tidewatch.schema import MEDIAN_ACCURACY
from tidewatch.session import default_parallelism, remove_path

TS = "horodatage_bloc"

# Daily KPIs an ``events`` stream can carry (no input side, no coinbase flag).
EVENT_DAILY_KEYS = ["count", "volume", "mean", "median", "whale_ratio"]


def read_file_stream(spark: SparkSession, path: str, schema: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _partials(stream: DataFrame, watermark: str, win: Column, median_accuracy: int) -> DataFrame:
    """Partials and median sketch per window, from at most one task a core.

    Every task sends a sketch of up to about ``median_accuracy`` values for each window,
    and one task merges a window's sketches: with as many tasks as a batch has file
    splits, that would grow with the splits."""
    few = stream.coalesce(default_parallelism(stream.sparkSession))
    m = measures(few.withWatermark(TS, watermark), keep=(win.alias("w"),))
    return m.groupBy("w").agg(*partial_aggs(), median_agg(median_accuracy))


def daily_kpis_stream(stream: DataFrame, watermark: str = "1 day", keys=None,
                      median_accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """RW-5: daily KPIs (D1..D8, or the subset ``keys``) per closed day."""
    keys = keys or list(DAILY_NAMES)
    agg = _partials(stream, watermark, F.window(TS, "1 day"), median_accuracy)
    fin = finishers()
    return agg.select(F.to_date("w.start").alias("jour"),
                      *[fin[k].alias(DAILY_NAMES[k]) for k in keys])


def _address_pairs(stream: DataFrame, watermark: str, win: Column) -> DataFrame:
    rows = stream.withWatermark(TS, watermark).select(
        win.alias("w"), "input_addresses", "output_addresses")
    return rows.select("w", F.explode(F.array_union("input_addresses", "output_addresses")).alias("adresse")
                       ).dropDuplicates(["w", "adresse"])


def daily_address_stream(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Each ``(jour, adresse)`` once, inputs ∪ outputs, when it is first seen."""
    return _address_pairs(stream, watermark, F.window(TS, "1 day")).select(
        F.to_date("w.start").alias("jour"), "adresse")


def count_addresses(pairs: DataFrame, name: str) -> DataFrame:
    """RW-6 / G9 from the sink of an address stream: addresses per window."""
    keys = [c for c in pairs.columns if c != "adresse"]
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def active_addresses_stream(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """RW-6 on the stream alone: exact distinct addresses per closed day."""
    firsts = _address_pairs(stream, watermark, F.window(TS, "1 day"))
    return (firsts.groupBy("w").agg(F.count(F.lit(1)).alias("adresses_actives_jour"))
            .select(F.to_date("w.start").alias("jour"), "adresses_actives_jour"))


def _slide_columns(start_day, step_days: int) -> list[Column]:
    ws = F.to_date("w.start")
    return [(F.datediff(ws, F.lit(str(start_day)).cast("date")) / F.lit(step_days)).cast("int").alias("slide"),
            ws.alias("new_start"), F.date_sub(F.to_date("w.end"), 1).alias("new_end")]


def rows_without_event_time(rows: DataFrame) -> DataFrame:
    """One row: how many rows no window can hold."""
    return rows.agg(F.count_if(F.col(TS).isNull()).alias("rows_without_event_time"))


def sliding_kpis_stream(stream: DataFrame, width_days: int, step_days: int, offset_days: int,
                        start_day, watermark: str = "1 day", keys=None,
                        median_accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """RW-7: global KPIs (G1..G8) of ``width``-day windows sliding by
    ``step`` days, numbered by slide relative to ``start_day``."""
    keys = keys or list(GLOBAL_NAMES)
    win = F.window(TS, f"{width_days} days", f"{step_days} days", f"{offset_days} days")
    agg = _partials(stream, watermark, win, median_accuracy)
    fin = finishers()
    return agg.select(
        *_slide_columns(start_day, step_days),
        *[fin[k].alias(GLOBAL_NAMES[k]) for k in keys])


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(df: DataFrame, writer, state_partitions: int | None, state_store: str | None = ROCKSDB):
    """Start a stream with ``state_partitions`` state-store partitions and
    the RocksDB state store (state off the JVM heap, spilled to local disk
    and checkpointed incrementally, so large per-day address sets fit).

    Both are fixed at the first start and kept in the checkpoint; a query
    snapshots the session settings when it starts, so they are applied
    only around ``start()``."""
    conf = df.sparkSession.conf
    settings = {}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store:
        settings["spark.sql.streaming.stateStore.providerClass"] = state_store
    old = {k: conf.get(k, None) for k in settings}
    for k, v in settings.items():
        conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in old.items():
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)


def sliding_active_addresses_stream(stream: DataFrame, width_days: int, step_days: int,
                                    offset_days: int, start_day,
                                    watermark: str = "1 day") -> DataFrame:
    """RW-7 / G9: exact distinct addresses of ``width``-day windows sliding
    by ``step`` days, closed windows only: each row goes to its ≤
    ceil(width/step) windows, (window, address) is de-duplicated in state, then
    counted per window."""
    win = F.window(TS, f"{width_days} days", f"{step_days} days", f"{offset_days} days")
    counts = _address_pairs(stream, watermark, win).groupBy("w").agg(
        F.count(F.lit(1)).alias("adresses_actives_global"))
    return counts.select(*_slide_columns(start_day, step_days), "adresses_actives_global")


def run_available_now(df: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                      state_partitions: int | None = None) -> str:
    """Drain everything available into a Parquet sink and stop.  The
    checkpoint (offsets, commits and state) makes a restart resume where it
    stopped instead of re-emitting."""
    w = (df.writeStream.format("parquet").outputMode(mode)
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    q = _start(df, w, state_partitions)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return sink


def write_live(df: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None,
               files: int | None = 1, keys: list | None = None, compact_every: int | None = None, **trigger):
    """RW-8: update-mode stream into a table of changes, one folder a
    micro-batch (a few rows, one file; ``files=None``: as many as there are
    partitions, for larger changes).  Read it with ``read_live``.

    With ``compact_every`` (and the windows' ``keys``) the table is compacted after
    every so many micro-batches (``compact_live``).  ``trigger``: by default
    everything available."""
    def change(batch: DataFrame, epoch_id: int) -> None:
        (batch.repartition(files) if files else batch).write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")
        if compact_every and (epoch_id + 1) % compact_every == 0:
            compact_live(batch.sparkSession, path, keys, files=files)

    w = (df.writeStream.outputMode("update").foreachBatch(change)
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    return _start(df, w, state_partitions)


def _snapshots(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path}/_snapshots/log", "path string, upto bigint")


def live_rows(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All values that a live table holds, with their ``epoch``: those of the
    newest snapshot and of the epochs behind it."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    last = _snapshots(spark, path).rows().orderBy(F.desc("commit")).first()
    if last is None:
        rows = r.parquet(path)
        return rows.withColumn("epoch", F.col("epoch").cast("bigint"))
    old = spark.read.parquet(last["path"])
    if not _epochs(spark, path, behind=last["upto"]):
        return old
    rows = spark.read.schema(old.schema).parquet(path).where(F.col("epoch") > last["upto"])
    return old.unionByName(rows.select(*old.columns))


def _epochs(spark: SparkSession, path: str, behind: int = -1) -> list[int]:
    """The epoch folders of a live table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(k for k in (int(n.split("=")[1]) for n in names if n.startswith("epoch=")) if k > behind)


def _latest(rows: DataFrame, keys: list) -> DataFrame:
    cols = [c for c in rows.columns if c != "epoch"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), "epoch").alias("last"), F.max("epoch").alias("epoch"))


def compact_live(spark: SparkSession, path: str, keys: list, keep: int = 2, files: int | None = 1) -> int | None:
    """Merge the epochs up to a safe one into a snapshot; its last epoch, or None
    when there is nothing to merge.

    The newest ``keep`` epochs stay: the last one may be written again when a
    stream restarts.  The snapshot holds each window's latest values with their
    epoch.  It counts from the one entry in a log on; readers take the snapshot and the
    epochs behind it, so an older epoch that is there twice, or appears again,
    changes nothing.  Folders that an earlier snapshot has merged are removed now,
    those that this one has with the next: a reader that listed them just before
    still finds them."""
    log = _snapshots(spark, path)
    last = log.rows().orderBy(F.desc("commit")).first()
    merged = -1 if last is None else last["upto"]
    there = _epochs(spark, path)
    todo = [e for e in there if e > merged][:-keep]
    if not todo:
        return None
    snapshot = f"{path}/_snapshots/upto={todo[-1]}-{uuid.uuid4().hex}"
    rows = _latest(live_rows(spark, path).where(F.col("epoch") <= todo[-1]), keys).select("last.*", "epoch")
    (rows.repartition(files) if files else rows).write.parquet(snapshot)
    log.commit([{"path": snapshot, "upto": todo[-1]}], lambda: None)
    for e in there:
        if e <= merged:
            remove_path(spark, f"{path}/epoch={e}")
    older = log.rows().orderBy(F.desc("commit")).offset(2).collect()   # one row a compaction
    for r in older:
        remove_path(spark, r["path"])
    return todo[-1]


def read_live(spark: SparkSession, path: str, keys: list, schema=None) -> DataFrame:
    """The latest values of each window in a ``write_live`` table."""
    return _latest(live_rows(spark, path, schema), keys).select("last.*")
