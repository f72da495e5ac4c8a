"""A log of commits on a shared store: each entry appears whole, and only once.

An entry is one small file ``<root>/00000000N`` whose lines are the JSON rows of
one commit.  Writing it is the commit: before, readers see nothing of it, after,
all of it.  Of two writers that write the same number, the store lets one through:

* local and mounted folders: the text is written under a hidden name and then
  linked to the entry's name; a link fails when the name exists;
* file systems with an atomic rename (HDFS): a rename that does not overwrite;
* object stores, which have neither: creation without overwriting, the condition
  that the connector hands to the store (an upload becomes visible when it ends).

A writer that loses raises ``FileExistsError``, looks again at what is committed
and either goes on with the next number or gives up.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stores without rename: an entry is created in place.
OBJECT_STORES = ("s3", "s3a", "s3n", "gs", "abfs", "abfss", "wasb", "wasbs", "oss", "cosn")


def create_exclusively(spark: SparkSession, path: str, text: str) -> None:
    """Write a file whole, or raise ``FileExistsError`` when it is there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    scheme = target.toUri().getScheme()

    def write(to) -> None:
        out = fs.create(to, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    try:
        if scheme in OBJECT_STORES:
            write(target)
            return
        part = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
        write(part)
        try:
            if scheme == "file":
                paths = jvm.java.nio.file.Paths
                jvm.java.nio.file.Files.createLink(paths.get(target.toUri()), paths.get(part.toUri()))
            else:
                kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
                none = spark.sparkContext._gateway.new_array(kinds, 1)
                none[0] = kinds.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(part, target, none)
        finally:
            fs.delete(part, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise FileExistsError(path) from None
        raise


class CommitLog:
    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def rows(self) -> DataFrame:
        """The rows of all commits with their ``commit`` number; empty before the first.
        A damaged entry, or any other fault of the store, is raised."""
        try:
            read = self.spark.read.schema(self.schema).option("mode", "FAILFAST").json(self.root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema).withColumn("commit", F.lit(None).cast("int"))
        return read.withColumn("commit", F.col("_metadata.file_name").cast("int"))

    def next(self) -> int:
        """The number behind the last entry."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return 0
        names = [f.getPath().getName() for f in fs.listStatus(folder)]   # one entry a commit
        return 1 + max((int(n) for n in names if n.isdigit()), default=-1)

    def claim(self, number: int, rows: list[dict]) -> None:
        """Commit rows under a number, or raise ``FileExistsError``."""
        text = "".join(json.dumps(r, default=str) + "\n" for r in rows)
        create_exclusively(self.spark, f"{self.root}/{number:09d}", text)

    def commit(self, rows: list[dict], check) -> int:
        """Commit rows under the next number.  ``check()`` looks at what is committed
        and raises when the rows no longer fit; it runs again after each lost claim."""
        while True:
            number = self.next()
            check()
            try:
                self.claim(number, rows)
                return number
            except FileExistsError:   # another commit came in between
                continue
