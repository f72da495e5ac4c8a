"""Helpers shared by the operators: scratch tables, text buffers, crc folds."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import scratch_path

#: Java / DuckDB pattern of a word: whatever is between blanks and \t \n \v \f \r.
WORD_RE = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch handed to Python; texts may be long.
BATCH_ROWS = 256


_SHIPPED: dict[str, bool] = {}


def prepare(spark: SparkSession) -> None:
    """Make the package importable on the executors (Spark distributes it, once
    for each application) and keep Arrow batches small: documents are long, the
    memory of a Python worker is not."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="tidewatch-code-")   # the driver serves it while it lives
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.addPyFile(shutil.make_archive(os.path.join(folder, "tidewatch"), "zip", os.path.dirname(package),
                                         os.path.basename(package)))
        _SHIPPED[sc.applicationId] = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialise(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the table instead of
    recomputing what made it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._scratch_path = path
    return out


def remove(df: DataFrame) -> None:
    """Delete the scratch table behind a DataFrame made by :func:`materialise`."""
    path = getattr(df, "_scratch_path", None)
    if path:
        with contextlib.suppress(Exception):   # left for the folder's own retention
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that none of the columns has (in either case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(id_col: Column, mod: int) -> Column:
    """``crc32(id as text) mod m``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod


def row_key(*cols: Column) -> Column:
    """A 64-bit key of the given columns, nulls told apart from values."""
    parts = []
    for c in cols:
        parts += [c, c.isNull()]
    return F.xxhash64(*parts)


def least_rows(rows: DataFrame, key: str, n: int) -> list:
    """The ``n`` rows with the least values of ``key``, a 64-bit hash, as a list in the
    order of key and columns; repeated rows count each.

    Only rows below a bound that some ``n`` of them are expected to pass are
    grouped and sorted, and they leave their tasks as distinct rows with a count,
    so what reaches the driver does not grow with the table."""
    total = rows.count()
    if not total or n < 1:
        return []
    share = (1.1 * n + 200) / total
    while True:
        low = rows if share >= 1 else rows.where(F.col(key) < int(-2**63 + share * 2**64))
        counted = low.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("repeats_"))
        found = counted.orderBy(key, *rows.columns).limit(n).collect()   # some ``n`` rows
        out = [r[:-1] for r in found for _ in range(min(r["repeats_"], n))][:n]
        if len(out) == n or share >= 1:
            return out
        share *= 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- text as bytes ------------------------------------------------------------

def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as ``b""``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20240601)
_BYTE_CODE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_WORD_BASE = int(_rng.integers(0, 2**64, dtype=np.uint64)) | 1
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 4096)
        out = np.full(size, _WORD_BASE, dtype=np.uint64)
        out[0] = 1
        _POWERS = np.multiply.accumulate(out)
    return _POWERS


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (constants of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words of each text, and where they stand.

    Returns the hashes of all texts one after the other, the number of words of
    each text, the bytes of all texts, and the words' starts and lengths there.
    """
    none = np.empty(0, np.int64)
    if not texts:
        return np.empty(0, np.uint64), none, np.empty(0, np.uint8), none, none
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    space = _SPACE[buf]
    word = ~space
    start = word.copy()
    start[1:] &= space[:-1]
    starts = np.flatnonzero(start)
    per_text = np.searchsorted(starts, ends)
    per_text = np.diff(per_text, prepend=0)
    if not len(starts):
        return np.empty(0, np.uint64), per_text, buf, none, none
    stop = space.copy()
    stop[1:] &= word[:-1]
    stop[0] = False
    stops = np.flatnonzero(stop)
    at = np.flatnonzero(word)
    lengths = stops - starts
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = np.arange(len(at)) - first
    codes = _BYTE_CODE[_LOWER[buf[at]]] * _powers(int(lengths.max()))[inside]
    return (mix64(np.add.reduceat(codes, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64)), per_text, buf,
            starts, lengths)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes and counts of :func:`hashed_words`."""
    return hashed_words(texts)[:2]
