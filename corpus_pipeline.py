"""A training corpus from ``documents``: filter, deduplicate, clean, mix, pack.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next stage's ``docs``.  All stages but the last return
the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import classifier, mixing, packing, secret_scan, simhash
from tidewatch.llm.common import fresh, materialise, table
from tidewatch.llm.queries import GOOD_SCORE, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    model = classifier.train(docs, table(spark, sf_dir, "labels"))
    score = fresh("score", docs.columns)
    kept = classifier.with_scores(docs, model, score_col=score)
    return kept.where(F.col(score) >= GOOD_SCORE).select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near-duplicates: that of the least id, rows
    without an id last, then the one with the least hash of all its columns.

    Other rows of an id stay when they are of another group.  Of rows that repeat
    each other exactly one stays.
    """
    key, h = fresh("row_of", docs.columns), F.xxhash64(*docs.columns)
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), h.alias("hash")).alias(key), "text")
    found = simhash.near_duplicates(named, id_col=key, width=3, radius=3)
    dropped = found.where(F.col("doc_id") != F.col("component_id")).select(
        F.col("doc_id.id").alias(f"{key}_id"), F.col("doc_id.hash").alias(key)).distinct()
    same = [h == F.col(key), F.col("doc_id").eqNullSafe(F.col(f"{key}_id"))]
    kept = docs.join(materialise(dropped, "dropped"), same, "left_anti")
    repeated = found.groupBy(F.col("doc_id.id").alias(f"{key}_id"), F.col("doc_id.hash").alias(key)).count().where("count > 1").drop("count")
    repeated = materialise(repeated, "repeated")
    if repeated.isEmpty():
        return kept
    once = kept.withColumn(f"{key}_hash", h).join(repeated, [F.col(f"{key}_hash") == F.col(key), same[1]], "left_semi")
    once = once.dropDuplicates([f"{key}_hash", "doc_id"])
    return kept.join(repeated, same, "left_anti").unionByName(once.select(*docs.columns)).select(*docs.columns)


def clean_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in place of every secret; ``n_chars`` follows the text."""
    name = fresh("spans", docs.columns)
    found = secret_scan.with_spans(docs, materialise(secret_scan.scan(docs), "spans"), name=name)
    spans, text = F.col(name), F.col("text")
    out = found.withColumn("text", F.when(spans.isNotNull(), secret_scan.redacted(text, spans)).otherwise(text))
    if "n_chars" in docs.columns:
        n = F.when(spans.isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, all rows sorted by the positions of the copies."""
    mixed = mixing.mix(docs, share=1.5, cap=2.0, weights=(5, 2, 1)).where("copies > 0")
    # rows that repeat each other exactly share a key: one of them stands for all
    key, positions, position = (fresh(n, docs.columns) for n in ("mix_key", "positions", "position"))
    taken = mixed.groupBy(F.col("mix_key").alias(key)).agg(
        F.flatten(F.collect_list("positions")).alias(positions), F.count("*").alias(position))
    rows = docs.withColumn(key, mixing.mix_key(F.col("doc_id"), F.col("text").cast("string"))).join(taken, key)
    one, several = rows.where(F.col(position) == 1), rows.where(F.col(position) > 1).dropDuplicates([key])
    return (one.unionByName(several).withColumn(position, F.explode(positions))
            .orderBy(position, key).select(*docs.columns))


def placed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with each row's place in its table: files by name, rows as they stand in a file.

    Spark reads files in any order; a sorted table's order is that of its files.
    """
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = materialise(docs, "ordered")
    rows = docs.select(*docs.columns, F.col("_metadata.file_path").alias(f"{name}_file"), F.col("_metadata.row_index").alias(f"{name}_row"))
    sizes = rows.groupBy(f"{name}_file").agg((F.max(f"{name}_row") + 1).alias("n")).collect()   # a row a file
    before, first = 0, []
    for file, n in sorted(tuple(r) for r in sizes):
        first.append((file, before))
        before += n
    first = docs.sparkSession.createDataFrame(first, f"{name}_file string, {name}_first long")
    return rows.join(F.broadcast(first), f"{name}_file").select(
        *docs.columns, (F.col(f"{name}_first") + F.col(f"{name}_row")).alias(name))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in the order of the mixed table."""
    place = fresh("place", docs.columns)
    return packing.pack(placed(docs, place), tokenizer_path(), window=2048, end_id=1, order_col=place)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", deduplicate),
    ("secret scans", clean_secrets),
    ("mixing", mix),
    ("packing", pack),
]
#: The classifier, the linked groups and the packing have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, "stage")
    return docs
