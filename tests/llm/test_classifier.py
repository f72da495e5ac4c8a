import tracemalloc
import zlib

import numpy as np
import pytest
from helpers import SF0001, awkward, awkward_rows, collected, empty, labels_of, prose

from tidewatch.llm import classifier, queries


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def junk(i):
    return " ".join(w + "***" if k % 2 else w + "$$$" for k, w in enumerate(prose(50, i).split()))


def table(spark, n=300):
    rows = [(i, junk(i) if i % 4 == 0 else prose(50, i), "en", "a", 1) for i in range(n)]
    return awkward(spark, clash=False, rows=rows), labels_of(spark, [(i, int(i % 4 != 0), 0) for i in range(n)])


def test_held_out_accuracy(spark):
    docs, labels = table(spark)
    model = classifier.train(docs, labels)
    rows = collected(classifier.with_scores(docs, model))
    held = [r for r in rows if fold(r["doc_id"]) == 0]
    assert len(held) > 30
    right = sum((r["score"] >= queries.GOOD_SCORE) == (r["doc_id"] % 4 != 0) for r in held)
    assert right / len(held) > 0.95
    assert len(model.labels) == sum(fold(i) != 0 for i in range(300))


def test_held_out_accuracy_on_the_given_table(spark):
    sf = SF0001.replace("0.001", "0.01")
    got = {r["doc_id"]: r for r in collected(queries.op8_quality_classifier(spark, sf))}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (fold(i) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for i, r in got.items())
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if fold(r["doc_id"]) == 0]
    assert sum(got[r["doc_id"]]["predicted"] == r["quality"] for r in labels) / len(labels) > 0.9


def test_held_out_labels_have_no_say(spark):
    docs, labels = table(spark, 120)
    flipped = labels_of(spark, [(i, int(i % 4 != 0) if fold(i) else int(i % 4 == 0), 0) for i in range(120)])
    a = collected(classifier.with_scores(docs, classifier.train(docs, labels)))
    b = collected(classifier.with_scores(docs, classifier.train(docs, flipped)))
    assert a == b


def test_votes_equal_brute_force(spark):
    docs, labels = table(spark, 120)
    model = classifier.train(docs, labels, neighbours=5)
    texts = [prose(30, 900 + i).encode() for i in range(10)] + [junk(950).encode()]
    z = model.latent(classifier.features(texts))
    for t, got in zip(z, model.scores(texts)):
        cos = model.vectors @ t
        near = np.argsort(-cos, kind="stable")[:5]
        assert abs(got - (cos[near] * model.labels[near]).sum() / cos[near].sum()) < 1e-5


def test_awkward_rows(spark):
    df = awkward(spark).drop("label")
    labels = labels_of(spark, [(6, 1, 0), (7, 1, 0), (8, None, 0), (9, 0, 1), (9, 0, 1), (12, 0, 0), (14, 7, 0), (None, 1, 0), (999, 0, 0)])
    model = classifier.train(df, labels)
    rows = collected(classifier.with_scores(df, model, score_col="good"))
    assert len(rows) == len(awkward_rows()) and set(rows[0]) == {*df.columns, "good"}
    assert all(0 <= r["good"] <= 1 for r in rows)
    assert {r["good"] for r in rows if not r["text"]} == {model.prior}
    assert len({r["good"] for r in rows if r["doc_id"] == 7}) == 1
    none = classifier.train(df, labels_of(spark, []))
    assert {r["good"] for r in collected(classifier.with_scores(df, none, score_col="good"))} == {0.5}
    assert classifier.with_scores(empty(spark), model, score_col="good").count() == 0
    assert classifier.train(empty(spark), labels).prior == 0.5
    bounded = classifier.train(df, labels, sample=2)
    assert len(bounded.labels) <= 2
    twice = classifier.train(df.unionByName(df), labels)   # repeated rows are one
    assert len(twice.labels) == len(model.labels)


def test_sample_is_bounded_with_repeated_ids(spark):
    """Copies of rows, and one id with thousands of texts: no more rows than asked for are fitted."""
    rows = [(i % 20, prose(20, i % 20), "en", "a", 1) for i in range(4000)] + [(30, f"{prose(10, 1)} {i}", "en", "a", 1) for i in range(3000)]
    docs = awkward(spark, clash=False, rows=rows).repartition(8)
    labels = labels_of(spark, [(i, i % 2, 0) for i in range(20)] + [(30, 1, 0)])
    model = classifier.train(docs, labels, sample=50)
    assert len(model.labels) == 50
    few = classifier.train(docs.where("doc_id < 20"), labels, sample=50)
    assert len(few.labels) == sum(fold(i) != 0 for i in range(20))


def test_sample_is_no_matrix_on_the_driver():
    """Singular vectors and labelled vectors are those of the whole matrix, built a block at a time."""
    rng = np.random.default_rng(3)
    idf = (rng.random(classifier.N_FEATURES) + 1).astype(np.float32)
    rows = []
    for k in range(4096):
        at = np.unique(np.append(rng.integers(0, 300, 60), rng.integers(0, classifier.N_FEATURES, 40)))
        rows.append({"at": at.astype("<u2").tobytes(), "n": rng.integers(1, 9, len(at)).astype("<f4").tobytes()})
    tracemalloc.start()
    x = classifier.SparseRows(rows, idf)
    got = classifier.truncated_svd(x, 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6, peak   # the matrix takes 130 MB
    counts = np.zeros((300, classifier.N_FEATURES), np.float32)
    for k, r in enumerate(rows[:300]):
        counts[k, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<f4")
    whole = classifier.weighted(counts, idf)
    assert (np.concatenate(list(classifier.SparseRows(rows[:300], idf).blocks())) == whole).all()
    mine = classifier.truncated_svd(classifier.SparseRows(rows[:300], idf), 300)
    assert np.linalg.norm(whole @ mine) == pytest.approx(np.linalg.norm(whole), rel=1e-4)
    assert got.T @ got == pytest.approx(np.eye(8), abs=1e-4)
