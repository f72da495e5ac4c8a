"""Raw transaction table on storage: Parquet, directory-partitioned by month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.schema import RAW_MONTH, RAW_TS


def read_raw(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    """Scan the raw table.  Month partitions are discovered from the folder
    names, so a predicate on ``block_timestamp_month`` prunes folders."""
    if table:
        return spark.table(table)
    return spark.read.parquet(path)


def write_raw(raw: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the raw table partitioned by month.

    ``rebalance`` lets AQE split a heavy month across several tasks and merge
    light ones, instead of one task per month; rows are sorted by time inside
    each file so row-group statistics skip on the timestamp filter.
    """
    (raw.hint("rebalance", F.col(RAW_MONTH))
        .sortWithinPartitions(RAW_MONTH, RAW_TS)
        .write.mode(mode).partitionBy(RAW_MONTH).parquet(path))


def register_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Make a month-partitioned folder a table of the session's catalog, with the
    columns found there and its months as catalog partitions; a month predicate then
    prunes in the catalog, before any folder is listed.  Months that arrive later
    are added by ``refresh_raw``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({RAW_MONTH}) LOCATION '{path}'")
    return refresh_raw(spark, table)


def refresh_raw(spark: SparkSession, table: str) -> DataFrame:
    """The catalog table with the months that its folder holds now."""
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)
    return read_raw(spark, table=table)
