import itertools
import random

import pytest
import xxhash
from helpers import SF0001, awkward, awkward_rows, collected, empty

from tidewatch.llm import queries, simhash
from tidewatch.llm.components import connected_components


def brute_fingerprint(text, width=3):
    words = (text or "").encode()
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in words).split()
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < width else [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps, radius=3):
    """Smallest index reachable, by all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def check(rows, got):
    rows = [r for r in rows if r[0] is not None]
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = brute_classes(fps)
    least = {}
    for r, k in zip(rows, root):
        least[k] = min(least.get(k, r[0]), r[0])
    want = sorted((r[0], f"{f:016x}", least[k]) for r, f, k in zip(rows, fps, root))
    assert sorted((g["doc_id"], g["fingerprint"], g["component_id"]) for g in got if g["doc_id"] is not None) == want


def test_spark_hash_is_the_same():
    assert brute_fingerprint("one") == xxhash.xxh64_intdigest(b"one", 42)


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    check(rows, collected(queries.op1_simhash(spark, SF0001)))


def test_awkward_rows(spark):
    found = simhash.near_duplicates(awkward(spark))
    got = collected(found.select("doc_id", simhash.hex16(found["fp"]).alias("fingerprint"), "component_id"))
    assert len(got) == len(awkward_rows())
    # all fingerprints of the rows without an id equal those of others or none, so the rest is as without them
    check([r for r in awkward_rows()], got)
    assert {g["component_id"] for g in got if g["doc_id"] in (1, 2, 3)} == {1}   # no word: fingerprint zero, linked
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_every_pair_within_the_radius_collides(radius):
    masks = simhash.covering_masks(0, radius)
    assert len(masks) == (1 << radius + 1) - 1
    rng = random.Random(radius)
    for _ in range(3000):
        differ = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not differ & m for m in masks)


def test_masks_below_a_bucket_keep_the_guarantee():
    rng = random.Random(1)
    for taken in simhash.covering_masks(0, 3):
        free = [b for b in range(64) if not taken >> b & 1]
        for sub in (simhash.covering_masks(taken, 3),):
            assert all(m & taken == taken for m in sub)
            for _ in range(300):
                differ = sum(1 << b for b in rng.sample(free, 3))
                assert any(not differ & m for m in sub)


def test_large_buckets_lose_no_link(spark):
    """Thousands of fingerprints around one centre, in buckets far over the limit."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 4, 5]))) for _ in range(1500)} | {rng.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    links = simhash.covering_links(df, 3, bucket_limit=16)
    pairs = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 61 for a, b in pairs)
    root = {r["node"] & (2**64 - 1): r["root"] for r in connected_components(links).collect()}
    got = {}
    for f in fps:
        got.setdefault(root.get(f, ("alone", f)), set()).add(f)
    want = {}
    for f, k in zip(fps, brute_classes(fps)):
        want.setdefault(k, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges += [(7, 7), (300, 301), (301, 300), (None, 5)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in list(root)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
