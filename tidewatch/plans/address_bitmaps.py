"""Active addresses from a stored dictionary and bitmaps (AG-11, AG-12, SET-1, SET-2).

Every address gets a number once, from 1 without gaps: the new addresses of an
append are dealt out by range, counted per part, and numbered behind those that
are stored, in address order.  Numbers never change; an append writes the rows of
the new ones only.

A day's addresses are bits: one row for each (day, bucket of 32,768 numbers) with
the bitmap of those that are active.  The distinct addresses of any set of days are
the bits of the union (``bitmap_or_agg``), so a window costs its days' bitmaps, not
its transactions, and no address is shuffled again.  Bitmaps are built, and
merged, where a bucket lies: rows are dealt out by bucket first, so a bitmap
of 4 KB is never sent from every task, and a day with most of the rows is
spread over all buckets.

Layout under ``root``: ``log`` (one entry an append: where its rows are, how many
numbers there are then) and ``append-ID/dictionary|days``.  Two appends at once
cannot both commit; the loser's rows are removed and it raises ``FileExistsError``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidewatch.functions.columns import slide_range
from tidewatch.plans.commit_log import CommitLog
from tidewatch.plans.slides import address_days
from tidewatch.session import remove_path, scratch_path

ENTRY = "dictionary string, days string, numbers bigint"
DICTIONARY = "adresse string, number bigint"
DAYS = "jour date, bucket bigint, bits binary"


class AddressBitmaps:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or scratch_path(spark, "address-bitmaps")).rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log", ENTRY)

    def _entries(self) -> list:
        return self.log.rows().orderBy("commit").collect()   # one row an append

    def _read(self, column: str, schema: str) -> DataFrame:
        paths = [r[column] for r in self._entries()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def dictionary(self) -> DataFrame:
        """``adresse, number`` of every address seen."""
        return self._read("dictionary", DICTIONARY)

    def bitmaps(self) -> DataFrame:
        """``jour, bucket, bits``; a day that came in several appends has several rows a bucket."""
        return self._read("days", DAYS)

    def append(self, window: DataFrame) -> int:
        """Add the rows of a window table (of other days, or late rows of known
        ones); the number of addresses known then."""
        number = self.log.next()
        entries = self._entries()
        known = entries[-1]["numbers"] if entries else 0
        build = f"{self.root}/append-{uuid.uuid4().hex}"
        try:
            total = self._write(window, build, known)
            self.log.claim(number, [{"dictionary": f"{build}/dictionary", "days": f"{build}/days", "numbers": total}])
        except BaseException:
            remove_path(self.spark, build)
            raise
        remove_path(self.spark, f"{build}/found")
        remove_path(self.spark, f"{build}/dealt")
        return total

    def _write(self, window: DataFrame, build: str, known: int) -> int:
        read = self.spark.read
        found = address_days(window).join(self.dictionary(), "adresse", "left")
        found.write.parquet(f"{build}/found")
        found = read.schema(found.schema).parquet(f"{build}/found")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = (found.where("number IS NULL").select("adresse").repartitionByRange(parts, "adresse")
                 .withColumn("part", F.spark_partition_id()))
        dealt.write.parquet(f"{build}/dealt")   # fixes which part an address is in
        dealt = read.schema(dealt.schema).parquet(f"{build}/dealt")
        sums = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))   # one row a shuffle partition
        before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
        offsets = sums.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) + known).alias("offset"))
        inside = F.row_number().over(W.partitionBy("part").orderBy("adresse"))
        dealt.join(offsets, "part").select("adresse", (F.col("offset") + inside).cast("bigint").alias("number")) \
            .write.parquet(f"{build}/dictionary")
        new = read.schema(DICTIONARY).parquet(f"{build}/dictionary")
        numbered = found.where("number IS NOT NULL").select("number", "days").unionByName(
            found.where("number IS NULL").drop("number").join(new, "adresse").select("number", "days"))
        by_bucket = numbered.withColumn("bucket", F.bitmap_bucket_number("number")).repartition("bucket")
        days = by_bucket.select(F.explode("days").alias("jour"), "bucket", F.bitmap_bit_position("number").alias("bit"))
        days.groupBy("jour", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")) \
            .sortWithinPartitions("jour", "bucket").write.option("compression", "zstd").parquet(f"{build}/days")
        return known + (sums.agg(F.sum("n")).first()[0] or 0)

    # -- counts ------------------------------------------------------------------

    def _count(self, rows: DataFrame, key: str) -> DataFrame:
        merged = rows.groupBy(key, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return merged.groupBy(key).agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias("n_addr"))

    def daily(self) -> DataFrame:
        """AG-11: ``jour, n_addr``."""
        return self._count(self.bitmaps().repartition("bucket"), "jour")

    def slides(self, start: Column, end: Column, step_days: int, n: Column | int) -> DataFrame:
        """AG-12 of slides 1..n: ``slide, n_addr`` of those that hold an address."""
        slides = F.explode(slide_range(F.col("jour"), start, end, step_days, 1, n)).alias("slide")
        return self._count(self.bitmaps().repartition("bucket").select(slides, "bucket", "bits"), "slide")

    def between(self, start: Column, end: Column) -> DataFrame:
        """AG-12 of one window: one row ``n_addr``."""
        days = self.bitmaps().where(F.col("jour").between(start, end)).repartition("bucket")
        merged = days.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return merged.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("n_addr"))

    def addresses(self, start: Column, end: Column) -> DataFrame:
        """SET-2 of one window: the distinct ``adresse`` behind its bits."""
        days = self.bitmaps().where(F.col("jour").between(start, end)).repartition("bucket")
        merged = days.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        byte = F.posexplode(F.split(F.regexp_replace(F.hex("bits"), "(..)", "$1,"), ","))   # 4,096 a bucket
        bytes_ = merged.select("bucket", byte.alias("at", "hex")).where(~F.col("hex").isin("00", ""))
        value = F.conv("hex", 16, 10).cast("int")
        bits = bytes_.select("bucket", "at", F.explode(F.filter(
            F.array(*map(F.lit, range(8))), lambda b: F.call_function("getbit", value, b) == 1)).alias("b"))
        numbers = bits.select(((F.col("bucket") - 1) * 32768 + F.col("at") * 8 + F.col("b") + 1).alias("number"))
        return self.dictionary().join(numbers, "number", "left_semi").select("adresse")
