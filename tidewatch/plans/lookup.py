"""Transactions by hash in a stored window table (SNK-1, clustered by hash).

The table is sorted by hash inside each file and has Parquet Bloom filters on the
hash (``write_window_table(bloom=True)``).  A lookup hands its list to the scan as
equalities: a row group is opened only if its value range and its Bloom
filter admit one of the hashes, so a lookup reads footers, filters and the few row
groups that hold a hit, whatever the size of the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH = "hachage_transaction"
#: Hashes of one scan; a longer list is looked up by several scans of one plan.
LIST = 500


def _any_of(column: Column, values: list[str]) -> Column:
    """A balanced tree of equalities.  (``isin`` reaches row groups as a mere value
    range when its list is long.)"""
    if len(values) == 1:
        return column == F.lit(values[0])
    half = len(values) // 2
    return _any_of(column, values[:half]) | _any_of(column, values[half:])


def lookup_by_hash(table: DataFrame, hashes: list[str], column: str = HASH) -> DataFrame:
    """The rows of a stored table whose hash is in the list; a repeated, null or
    unknown hash adds nothing."""
    wanted = sorted({h for h in hashes if h is not None})
    out = table.limit(0)
    for i in range(0, len(wanted), LIST):
        part = table.where(_any_of(F.col(column), wanted[i:i + LIST]))
        out = part if i == 0 else out.unionByName(part)
    return out
