"""Spark session settings and the shared work folder.

The engine relies on a few session settings for its semantics:

* ``spark.sql.session.timeZone=UTC``: ``to_date`` and ``CAST(date AS
  TIMESTAMP)`` must follow UTC calendar days.
* ANSI mode (the Spark 4 default) stays on; every division that may see a
  zero goes through ``try_divide``.
* AQE stays on, so small build sides are broadcast only after their
  runtime size is measured, and skewed partitions are split.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidewatch") -> SparkSession:
    """Return the active session (or build one) with the settings above.

    On a cluster the session normally exists already; only the settings the
    engine depends on are applied.  ``master`` and ``shuffle_partitions``
    are for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None under Spark Connect (no context on the client)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect raises a not-supported error
        return None


_LOCAL_FALLBACK: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Shared folder for materialised tables, checkpoints and stream state.

    Read from ``spark.checkpoint.dir`` (set by the cluster).  When it is unset
    on a local master, as in tests, a fresh local folder is made once for the
    application and removed when the process ends; on a cluster that is an
    error, since executors and driver share no local folder."""
    sc = _context(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = _LOCAL_FALLBACK.get(sc.applicationId)
        if base is None:
            base = _LOCAL_FALLBACK[sc.applicationId] = tempfile.mkdtemp(prefix="tidewatch-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the executors' Python workers: Spark
    distributes it, once for each application."""
    sc = _context(spark)
    if sc is None or sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tidewatch-code-")   # the driver serves it while it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "tidewatch"), "zip", os.path.dirname(package), os.path.basename(package)))
    _SHIPPED.add(sc.applicationId)


def default_parallelism(spark: SparkSession) -> int:
    """Total cores of the cluster (shuffle partitions under Spark Connect)."""
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared work folder."""
    base = work_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def set_initial_shuffle_partitions(spark: SparkSession, n: int | None) -> None:
    """Start AQE shuffles at ``n`` partitions (AQE then merges small ones
    down to ``spark.sql.adaptive.advisoryPartitionSizeInBytes``).  Size it
    from the bytes a job shuffles, about one partition per 128 MB: a month
    window of 500 GB → ~4,000."""
    if n:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))


__all__ = ["get_session", "configure", "work_dir", "scratch_path", "ship_package", "default_parallelism", "remove_path",
           "set_initial_shuffle_partitions"]
