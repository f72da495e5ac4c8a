"""Operator 12: centroid clustering (k-means) of integer vectors, in JVM expressions.

Vectors.  Those with exactly ``size`` components, none null or non-finite, are
kept; a component x becomes ``floor(scale * x)``.  They are stored once, so the
rounds read a table of the shared folder and a lost executor repeats its part of
one round only.

Start.  Centroids are the ``k`` kept vectors with the least SHA-256 of
``<seed>:<id>``, in that order (fewer, when fewer are kept).

A round.  ``zip_with`` and ``aggregate`` give the squared distance to each
centroid, a literal array; ``array_min`` over ``(distance, number)`` structs picks
the nearest, the smaller number at a tie.  The sums of each component and the
count of each cluster are ordinary column sums: partial in every task, so a
cluster with most of the rows costs one row a task.  What reaches the driver is
``k`` rows of sums, from which the exact floors are the next round's literals.

Cases: rows with a null, short, long or non-finite vector are not in the result;
a null id hashes like the text ''; repeated rows are vectors like any other
(equal start hashes are ordered by their components); a cluster that loses its
vectors keeps its centroid; an empty table gives an empty result.  Distances are
exact up to components of 2**27 / sqrt(size / 64) after scaling; a larger one
raises an error instead of a wrong distance.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import materialise

Centroids = list[tuple[int, ...]]


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """``vec_id, v`` of the kept rows, ``v`` an array of bigint."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    most = math.isqrt((2**63 - 1) // (4 * size))   # twice this, squared, ``size`` times, fits in a bigint
    whole = lambda c: F.when(F.abs(c * scale) < most, F.floor(c * scale)).otherwise(
        F.raise_error(F.lit("a component is too large for exact distances")).cast("bigint"))
    kept = rows.select(F.col(id_col).alias("vec_id"), x.alias("x")).where((F.size("x") == size) & finite)
    return kept.select("vec_id", F.transform("x", whole).alias("v"))


def start(vectors: DataFrame, k: int, seed: int) -> Centroids:
    """The first centroids: ``k`` rows reach the driver."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.select(F.sha2(name.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return [tuple(r["v"]) for r in first]


def _array(values) -> str:
    return "array(" + ",".join(f"{v}L" for v in values) + ")"


def nearest(centroids: Centroids, vector: str = "v") -> Column:
    """``struct(distance, number)`` of the nearest centroid."""
    apart = "zip_with({v}, {c}, (a, b) -> (a - b) * (a - b))"
    each = [f"named_struct('distance', aggregate({apart.format(v=vector, c=_array(c))}, 0L, (s, d) -> s + d), 'number', {i})"
            for i, c in enumerate(centroids)]
    return F.expr(f"array_min(array({','.join(each)}))")


def moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """The centroids after one round."""
    size = len(centroids[0])
    sums = (vectors.select(nearest(centroids)["number"].alias("number"), "v").groupBy("number")
            .agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"sum(v[{i}])") for i in range(size)]).collect())
    after = list(centroids)
    for r in sums:   # one row a centroid
        after[r["number"]] = tuple(r[2 + i] // r["n"] for i in range(size))
    return after


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10,
            size: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every kept vector."""
    vectors = materialise(integer_vectors(rows, id_col, vector_col, size, scale), "vectors")
    centroids = start(vectors, k, seed)
    if not centroids:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("bigint").alias(c) for c in (
            "distance", "cluster_inertia", "inertia")], F.col("v").alias("centroid"))
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    near = vectors.select("vec_id", nearest(centroids).alias("near")).select(
        "vec_id", F.col("near.number").alias("cluster"), F.col("near.distance").alias("distance"))
    sums = {r["cluster"]: r["s"] for r in near.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    each = [sums.get(i, 0) for i in range(len(centroids))]
    return near.select("vec_id", "cluster", "distance", F.expr(_array(each))[F.col("cluster")].alias("cluster_inertia"),
                       F.lit(sum(each)).cast("bigint").alias("inertia"),
                       F.expr(f"array({','.join(map(_array, centroids))})")[F.col("cluster")].alias("centroid"))


def oracle_sql(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The same in DuckDB SQL: component rows instead of arrays, one pair of tables a round."""
    near = lambda i: f"""n{i} AS MATERIALIZED (SELECT r, vec_id, d, number FROM (
  SELECT v.r, v.vec_id, c.number, sum((v.x - c.x) * (v.x - c.x)) AS d,
    row_number() OVER (PARTITION BY v.r ORDER BY sum((v.x - c.x) * (v.x - c.x)), c.number) AS best
  FROM e v JOIN c{i} c ON c.i = v.i GROUP BY v.r, v.vec_id, c.number) WHERE best = 1)"""  # noqa: E731
    step = lambda i: f"""c{i + 1} AS MATERIALIZED (SELECT c.number, c.i, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
  SELECT n.number, v.i, CAST((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
  FROM n{i} n JOIN e v ON v.r = n.r GROUP BY n.number, v.i) m ON m.number = c.number AND m.i = c.i)"""  # noqa: E731
    tables = ",\n".join(t for i in range(rounds) for t in (near(i), step(i)))
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {size} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {size}),
e AS MATERIALIZED (SELECT r, vec_id, unnest(range({size})) AS i,
  unnest([CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding]) AS x FROM k),
o AS (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')),
  [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding]) - 1 AS number FROM k),
c0 AS MATERIALIZED (SELECT CAST(o.number AS INTEGER) AS number, e.i, e.x FROM o JOIN e ON e.r = o.r WHERE o.number < {k}),
{tables},
{near(rounds)},
h AS (SELECT number, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY number)
SELECT n.vec_id, n.number AS cluster, CAST(n.d AS BIGINT) AS distance,
  CAST(sum(n.d) OVER (PARTITION BY n.number) AS BIGINT) AS cluster_inertia, CAST(sum(n.d) OVER () AS BIGINT) AS inertia,
  h.centroid_sha256
FROM n{rounds} n JOIN h ON h.number = n.number"""
