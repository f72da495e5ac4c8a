import collections
import importlib
import re
import sys

import pytest
from pyspark.sql import functions as F
from helpers import SCHEMA, awkward, empty, labels_of, prose

import corpus_pipeline as P
from tidewatch.llm import queries, simhash
from tidewatch.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def labelled(spark, monkeypatch):
    junk = lambda i: " ".join(w + "***" for w in prose(50, i).split())
    rows = [(i, junk(i) if i % 5 == 0 else prose(50, i) + " end%d" % i, "en", "s%d" % (i % 4), 1) for i in range(200)]
    rows += [(500, rows[1][1], "en", "s0", 1), (501, rows[1][1] + " more", "en", "s0", 1), (502, prose(50, 999) + " token=abcdef123", "en", "s1", 1)]
    labels = labels_of(spark, [(i, int(i % 5 != 0), 0) for i in range(200)])
    monkeypatch.setattr(P, "table", lambda s, d, n: labels if n == "labels" else spark.createDataFrame(rows, SCHEMA))
    return rows


def test_stages_are_those_asked_for():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "simhash near-dedup", "secret scans", "mixing", "packing"]
    assert P.ORACLE_SQL is None


def test_every_stage_takes_effect(spark, labelled):
    docs = spark.createDataFrame(labelled, SCHEMA)
    kept = P.quality(spark, docs, "")
    assert kept.columns == COLUMNS
    ids = {r["doc_id"] for r in kept.collect()}
    assert not any(i % 5 == 0 for i in ids if i < 200) and len(ids) >= 160   # junk goes, clean documents stay
    unique = P.deduplicate(spark, kept, "")
    found = simhash.near_duplicates(kept).collect()
    assert unique.columns == COLUMNS
    assert {r["doc_id"] for r in unique.collect()} == {r["component_id"] for r in found} and 500 not in {r["doc_id"] for r in unique.collect()}
    clean = P.clean_secrets(spark, unique, "")
    by_id = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == COLUMNS and by_id[502]["text"].endswith("[SECRET]") and by_id[502]["n_chars"] == len(by_id[502]["text"])
    assert {i: r["text"] for i, r in by_id.items() if i != 502} == {r["doc_id"]: r["text"] for r in unique.collect() if r["doc_id"] != 502}
    mixed = P.mix(spark, clean, "")
    want = {r["doc_id"]: r["copies"] for r in P.mixing.mix(clean).collect() if r["copies"]}
    assert mixed.columns == COLUMNS and collections.Counter(r["doc_id"] for r in mixed.collect()) == want
    packed = P.pack(spark, mixed, "").collect()
    tokens = collections.Counter()
    for r in packed:
        tokens[r["doc_id"]] += r["length"]
    one = {r["doc_id"]: r["doc_tokens"] for r in packed}
    assert tokens == {i: n * one[i] for i, n in want.items()}


def test_run_is_the_stages_one_after_the_other(spark, labelled):
    docs = P.table(spark, "", "documents")
    for k, (_, stage) in enumerate(P.STAGES):
        docs = stage(spark, docs, "")
        docs = materialise(docs, "test") if k < 4 else docs
    assert rows_of(P.run(spark, "")) == rows_of(docs)


@pytest.mark.parametrize("k", range(5))
def test_awkward_rows_through_each_stage(spark, labelled, k):
    name, stage = P.STAGES[k]
    df = awkward(spark)
    out = stage(spark, df, "")
    if k < 4:
        assert out.columns == df.columns
    n = out.count()
    assert n > 0
    if name == "simhash near-dedup":
        got = [r["doc_id"] for r in out.collect()]
        assert got.count(7) + got.count(6) == 1 and got.count(1) == 1 and 2 not in got and got.count(None) == 1
    if name == "secret scans":
        assert rows_of(out.select(COLUMNS)) == rows_of(df.select(COLUMNS))   # nothing to find
    if name == "mixing":
        assert not {1, 2, 3} & {r["doc_id"] for r in out.collect()}
    if name == "packing":
        assert sum(r["length"] for r in out.collect()) > 1000
    assert stage(spark, empty(spark), "").count() == 0


def test_entry_without_the_package(monkeypatch):
    """The entry file imports and lists its other queries when these folders are gone."""
    import __spark_entry__ as E

    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in E.queries()} and "pipeline" in E.queries()
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if re.match(r"tidewatch\.llm|corpus_pipeline", name) else real(name, *a))
    assert not any(q.startswith("op") or q == "pipeline" for q in E.queries()) and "kpi_daily" in E.queries()
    assert not any(q.startswith("op") for q in E.oracle_sql())
    assert "tidewatch.llm" in sys.modules


def test_queries_have_their_columns(spark):
    want = {
        "op1_simhash": "doc_id fingerprint component_id", "op2_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op3_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op4_repeated_substrings": "doc_id n_bytes n_removed n_spans kept_sha256", "op5_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op6_document_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op7_url_filters": "page_id host path rule verdict", "op8_quality_classifier": "doc_id held_out score predicted",
        "op9_mixing": "doc_id size source_size target taken", "op10_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op11_page_text": "page_id url text n_chars", "op12_centroids": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
        "op13_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
    }
    assert set(queries.QUERIES) == set(want)
    longs = {"n_tokens", "n_known", "train_tokens", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "n_removed", "n_spans",
             "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_chars", "size", "source_size", "taken", "n_assign", "n_access", "n_hex"}
    for name, columns in want.items():
        types = dict(queries.QUERIES[name](spark, "/root/testdata/sf0.001").dtypes)
        assert list(types)[:1] == columns.split()[:1] and set(columns.split()) <= set(types), name
        assert all(types[c] == "bigint" for c in columns.split() if c in longs), (name, types)



def test_positions_rise_through_the_mixed_table_and_its_packing(spark):
    """The curriculum's order is that of the written files, and packing keeps it."""
    docs = spark.createDataFrame([(i, prose(30 + i % 7, i), "en", "s%d" % (i % 3), 1) for i in range(300)], SCHEMA)
    want = sorted((t, r["mix_key"], r["doc_id"]) for r in P.mixing.mix(docs).where("copies > 0").collect() for t in r["positions"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # several files
    try:
        stored = materialise(P.mix(spark, docs, ""), "mixed")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(stored.inputFiles()) > 3
    rows = sorted(P.placed(stored, "place").collect(), key=lambda r: r["place"])
    assert [r["place"] for r in rows] == list(range(len(want)))
    assert [r["doc_id"] for r in rows] == [i for _, _, i in want]
    own = stored.select("*", "_metadata.file_name", "_metadata.row_index").collect()
    assert [r["doc_id"] for r in sorted(own, key=lambda r: (r["file_name"], r["row_index"]))] == [i for _, _, i in want]
    # ids of rows, to follow each copy
    each = spark.createDataFrame([(r["place"], r["text"], r["place"]) for r in rows], "doc_id long, text string, place long")
    shards = {}
    for r in P.packing.pack(each, queries.tokenizer_path(), shard_rows=20, order_col="place", turns=4).collect():
        shards.setdefault(r["sequence_id"] >> 32, set()).add(r["doc_id"])
    turn = [{4 * i // len(rows) for i in shards[s]} for s in sorted(shards)]
    assert len(shards) >= 12 and all(len(t) == 1 for t in turn)
    assert [min(t) for t in turn] == sorted(min(t) for t in turn) and {min(t) for t in turn} == {0, 1, 2, 3}


def test_duplicates_are_dropped_by_row(spark):
    """An id with two texts loses only the copy; a row without an id goes beside a kept copy; of equal rows one stays."""
    a, b, c = (prose(40, k) for k in (21, 22, 23))
    rows = [(3, a, "en", "s", 1), (5, a, "en", "s", 1), (5, b, "en", "s", 1), (None, a, "en", "s", 1), (None, c, "en", "s", 1),
            (None, c, "en", "t", 1), (9, "", "en", "s", 1), (8, None, "en", "s", 1)]
    rows += [(77, "copy " + c, "en", "s", 1)] * 10_000
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8).withColumn("fp", F.lit(1)).withColumn("row_of", F.lit("x"))
    out = P.deduplicate(spark, docs, "")
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    expected = {(3, a), (5, b), (8, None)}
    assert expected <= set(got) and len(got) == len(set(got))
    near = [x for x in got if x not in expected]
    assert (77, "copy " + c) in near and all(x[0] in (77, None) for x in near) and len(near) <= 2
    assert P.deduplicate(spark, docs.limit(0), "").count() == 0


def test_places_of_rows_that_are_no_stored_table(spark):
    """A plan is written first; its places are the order of its partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(2000).repartition(5).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text").orderBy("doc_id")
        rows = P.placed(df, "place").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r["place"], r["doc_id"]) for r in rows) == [(i, i) for i in range(2000)]
