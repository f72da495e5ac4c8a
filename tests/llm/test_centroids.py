import hashlib
import math
import random

import pytest
from helpers import SF0001, collected
from pyspark.sql import functions as F

from tidewatch.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=8, rounds=10, size=64, scale=1024, seed=3):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    c = [v for _, v in sorted((sha(f"{seed}:{'' if i is None else i}"), v) for i, v in kept)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), n) for n, m in enumerate(c))
    for _ in range(rounds):
        own = [[] for _ in c]
        for _, v in kept:
            own[near(v)[1]].append(v)
        c = [[sum(x) // len(vs) for x in zip(*vs)] if vs else m for m, vs in zip(c, own)]
    found = [(i, *near(v)) for i, v in kept]
    total = {n: sum(d for _, d, m in found if m == n) for n in range(len(c))}
    return sorted(((i, n, d, total[n], sum(total.values()), tuple(c[n])) for i, d, n in found), key=str)


def run(df, **kw):
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"]))
                   for r in collected(centroids.cluster(df, **kw))), key=str)


def test_whole_table_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    expected = brute([(r["vec_id"], r["embedding"]) for r in rows.collect()])
    assert run(rows) == expected
    got = queries.op12_centroids(spark, SF0001)
    assert got.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"),
                          ("inertia", "bigint"), ("centroid_sha256", "string")]
    sha = {i: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for i, *_, c in expected}
    assert {r["vec_id"]: r["centroid_sha256"] for r in got.collect()} == sha


def test_awkward_vectors(spark):
    rng = random.Random(4)
    vector = lambda: [rng.uniform(-2, 2) for _ in range(4)]
    same = vector()
    rows = [(i, [float(f"{x:.3f}") for x in vector()]) for i in range(40)] + [(7, same)] * 5 + [(None, same), (None, None), (50, None)]
    rows += [(51, []), (52, same[:3]), (53, same + [0.0]), (54, [*same[:3], None]), (55, [*same[:3], math.nan]),
             (56, [math.inf, *same[:3]]), (57, [0.0, -0.0, -1e-9, -1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    floats = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    for c in ("v", "x", "number", "near", "cluster", "distance", "inertia", "centroid"):
        df = df.withColumn(c, F.lit("clash"))
    got = run(df, size=4, k=5, rounds=6)
    assert got == brute(floats, size=4, k=5, rounds=6) and len(got) == 47
    assert run(df.repartition(7), size=4, k=5, rounds=6) == got
    assert run(df.limit(0), size=4) == []
    few = [r for r in floats if r[0] in (1, 2, 3)]   # fewer vectors than centroids
    assert run(spark.createDataFrame(few, SCHEMA), size=4) == brute(few, size=4)


def test_ties_and_empty_clusters(spark):
    """Equal distances go to the smaller number; a copied centroid loses all its vectors and stays."""
    rows = [(i, [float(i % 2), 0.0]) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = run(df, size=2, k=4, rounds=3, scale=1)
    assert got == brute(rows, size=2, k=4, rounds=3, scale=1)
    assert len({n for _, n, *_ in got}) == 2


def test_floors_of_negative_means(spark):
    rows = [(1, [-1.0]), (2, [-2.0]), (3, [-2.0]), (4, [100.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(df, size=1, k=2, rounds=2, scale=1) == brute(rows, size=1, k=2, rounds=2, scale=1)


def test_a_component_beyond_exact_distances_is_an_error(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(df).collect()


def test_one_cluster_with_all_rows_sends_one_row_a_task(spark):
    """The sums of a round are partial before they are shuffled, and no Python runs."""
    df = centroids.integer_vectors(spark.read.parquet(f"{SF0001}/embeddings.parquet"), "vec_id", "embedding", 64, 1024)
    sums = df.select(centroids.nearest([(0,) * 64, (5,) * 64])["number"].alias("n"), "v").groupBy("n").agg(F.sum(F.get("v", F.lit(0))))
    plan = sums._jdf.queryExecution().toString()
    assert "partial_sum" in plan and "Python" not in plan and "Arrow" not in plan
