"""The raw transaction table derived from the driver tables (FIXTURES.md §2).

One row per order; ``lineitem`` lines become the nested ``inputs`` and
``outputs`` arrays.  Everything is a Spark job over the whole tables: one
aggregation of ``lineitem`` by order key (partial aggregation before the
shuffle) and one outer join that reuses that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture definition.
EPOCH_DAY = "1995-01-01"
COINBASE_EVERY = 50          # o_orderkey % 50 = 0 → coinbase
NULL_VALUE_EVERY = 211       # o_orderkey % 211 = 0 → NULL output value
NULL_ADDR_BLOCK_EVERY = 97   # block_number % 97 = 0 → NULL address lists
SAT_PER_CENT = 250           # output value = cents * 250 satoshi
TS_STEP_SECONDS = 37         # seconds after midnight = o_orderkey * 37 mod 86400

SLOT_TYPE = "array<struct<index:int,addresses:array<string>>>"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions for a scale-factor folder."""
    return tx_from(load_table(spark, sf_dir, "orders"), load_table(spark, sf_dir, "lineitem"))


def _addr(prefix_col) -> F.Column:
    return F.concat(F.lit("A"), prefix_col.cast("string"))


def tx_from(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The order's own address and its NULL rule are computed before the join, not in the
    arrays' functions: those have no generated code and run once a line."""
    lines = (lineitem
             .repartition("l_orderkey")   # lists are not combined before the shuffle: they are as large as their rows
             .groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.collect_list(F.struct(F.col("l_linenumber").alias("no"),
                                          F.col("l_suppkey").alias("sk"),
                                          F.col("l_partkey").alias("pk"))).alias("ls")))
    day = F.to_date("o_orderdate")
    bn = F.datediff(day, F.lit(EPOCH_DAY).cast("date"))
    o = orders.select("o_orderkey", "o_totalprice", "o_orderdate",
                      _addr(F.col("o_custkey")).alias("custaddr"),
                      ((bn % NULL_ADDR_BLOCK_EVERY) == 0).alias("null_block"))
    j = o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left")

    key = F.col("o_orderkey")
    cb = (key % COINBASE_EVERY) == 0
    custaddr, null_block = F.col("custaddr"), F.col("null_block")
    ov = (F.when(key % NULL_VALUE_EVERY == 0, F.lit(None).cast("bigint"))
          .otherwise(F.round(F.col("o_totalprice") * 100).cast("bigint") * SAT_PER_CENT))
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    fee_part = (key % 800) + 200
    ls = F.coalesce(F.col("ls"), F.array().cast("array<struct<no:int,sk:bigint,pk:bigint>>"))
    inputs = F.transform(ls, lambda x: F.struct(
        x["no"].alias("index"),
        F.when(null_block, F.lit(None).cast("array<string>"))
         .otherwise(F.array(_addr(x["sk"]), custaddr)).alias("addresses")))
    outputs = F.transform(ls, lambda x: F.struct(
        x["no"].alias("index"),
        F.when((x["no"] == 6) | null_block, F.lit(None).cast("array<string>"))
         .when(x["no"] == 7, F.array(F.lit(None).cast("string")))
         .otherwise(F.array(_addr(x["pk"]))).alias("addresses")))

    base = j.select(
        F.sha2(key.cast("string"), 256).alias("hash"),
        bn.cast("bigint").alias("block_number"),
        F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
                            + (key * TS_STEP_SECONDS) % 86400).alias("block_timestamp"),
        F.trunc(day, "MM").alias("block_timestamp_month"),
        F.when(cb, F.lit(0).cast("bigint")).otherwise(n).alias("input_count"),
        n.alias("output_count"),
        (1 + key % 2).cast("bigint").alias("version"),
        F.when(cb, F.lit(0).cast("bigint")).otherwise(fee_part).cast("bigint").alias("fee"),
        cb.alias("is_coinbase"),
        F.when(cb, F.lit(None).cast("bigint"))
         .otherwise(F.coalesce(ov, F.lit(0).cast("bigint")) + fee_part).alias("input_value"),
        ov.alias("output_value"),
        F.when(cb, F.array().cast(SLOT_TYPE)).otherwise(inputs).alias("inputs"),
        outputs.alias("outputs"),
    )
    size = (10 + 148 * F.col("input_count") + 34 * F.col("output_count")).cast("bigint")
    return base.select(
        "hash", "block_number", "block_timestamp", "block_timestamp_month",
        size.alias("size"), size.alias("virtual_size"), "version", "input_count",
        "output_count", "fee", "is_coinbase", "input_value", "output_value", "inputs", "outputs")
