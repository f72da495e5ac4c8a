"""The operators' registered queries: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    centroids, classifier, kneser_ney, manifest, mixing, packing, page_text, prefixes, rules, secret_scan, simhash, substrings, urls,
)
from tidewatch.llm.common import crc_mod, table

#: File of the tokenizer that packing uses.
TOKENIZER = "word_bpe_49k.json"
#: A document is predicted good from this score on.
GOOD_SCORE = 0.3


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=3)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), window=2048, end_id=1)


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.fingerprint_edits(table(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = classifier.train(docs, table(spark, sf_dir, "labels"))
    scored = classifier.with_scores(docs, model)
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= GOOD_SCORE).cast("int").alias("predicted"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), share=1.5, cap=2.0, weights=(5, 2, 1))
    return mixed.select("doc_id", "size", "source_size", "target", "taken",
                        F.get("positions", F.lit(0)).alias("position"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.with_spans(docs, secret_scan.scan(docs))
    spans = F.coalesce("secret_spans", F.expr("array()").cast("array<struct<start:int,ord:int,end:int,kind:string>>"))
    base = [r.kind for r in secret_scan.BASE_RULES]
    listed = lambda a: F.concat_ws(",", F.transform(a, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(listed(F.filter(spans, lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        listed(spans).alias("spans"))


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"), min_pages=3)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, size=64, scale=1024, seed=3)
    listed = F.concat_ws(",", F.col("centroid").cast("array<string>"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(listed.cast("binary"), 256).alias("centroid_sha256"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"), tampered=crc_mod(F.col("doc_id"), 3) == 0,
                             audited={"text": manifest.lowered(F.col("text"))})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_quality_rules": op3_quality_rules,
    "op4_repeated_substrings": op4_repeated_substrings,
    "op5_packing": op5_packing,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_url_filters": op7_url_filters,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_mixing": op9_mixing,
    "op10_secret_scan": op10_secret_scan,
    "op11_page_text": op11_page_text,
    "op12_centroids": op12_centroids,
    "op13_manifest": op13_manifest,
}
ORACLE_SQL: dict[str, str] = {"op7_url_filters": urls.oracle_sql(), "op12_centroids": centroids.oracle_sql(),
                              "op13_manifest": manifest.oracle_sql()}
