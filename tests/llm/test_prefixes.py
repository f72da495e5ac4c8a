import hashlib

from helpers import SF0001, awkward, awkward_rows, collected, empty

from tidewatch.llm import prefixes, queries


def like(a, b):
    """Character by character."""
    if not max(len(a), len(b)):
        return 1.0
    i = back = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    while back < min(len(a), len(b)) - i and a[-1 - back] == b[-1 - back]:
        back += 1
    n = max(len(a), len(b))
    alike, j, a, b = i + back, i, a[:len(a) - back], b[:len(b) - back]
    for _ in range(prefixes.JUMPS):
        near = min(((x + y, x, y) for x in range(prefixes.SKIP + 1) for y in range(prefixes.SKIP + 1)
                    if len(a) - i - x >= prefixes.LEAST and len(b) - j - y >= prefixes.LEAST
                    and a[i + x:i + x + prefixes.LEAST] == b[j + y:j + y + prefixes.LEAST]), default=None)
        if near is None:
            break
        i, j = i + near[1], j + near[2]
        while i < len(a) and j < len(b) and a[i] == b[j]:
            i, j, alike = i + 1, j + 1, alike + 1
    return alike / n


def expected(texts):
    """For (id, text) in falling order of the id."""
    out = []
    for i, (doc_id, t) in enumerate(texts):
        nxt, half = texts[(i + 1) % len(texts)][1], len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        out.append((doc_id, len(t), hashlib.sha256(edited.encode()).hexdigest(), prefixes.Prefix.of(t).fingerprint(),
                    prefixes.Prefix.of(edited).fingerprint(), round(like(t, edited), 9), round(like(t, nxt), 9)))
    return out


def rows_of(df):
    return [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
             round(r["near_edited"], 9), round(r["near_next"], 9)) for r in collected(df)]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    want = sorted(expected(sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)))
    assert sorted(rows_of(queries.op6_document_fingerprints(spark, SF0001))) == want
    assert sorted(rows_of(prefixes.fingerprint_edits(docs.repartition(7), range_rows=9))) == want


def test_awkward_rows(spark):
    rows = [r for r in awkward_rows() if r[0] is not None]
    texts = sorted({(r[0], r[1] or "") for r in rows}, reverse=True)
    df = awkward(spark, rows=[r for k, r in enumerate(rows) if r not in rows[:k]])
    for size in (3, 100):
        assert sorted(rows_of(prefixes.fingerprint_edits(df, range_rows=size))) == sorted(expected(texts))
    every = rows_of(prefixes.fingerprint_edits(awkward(spark), range_rows=4))
    assert len(every) == len(awkward_rows())
    equal = {}
    for r, (_, n, _, f, *_) in zip(sorted(awkward_rows(), key=str), sorted(every, key=str)):
        assert (n == 0) == (f.endswith("00000000"))
    for _, n, _, f, *_ in every:
        equal.setdefault(f, set()).add(n)
    assert all(len(v) == 1 for v in equal.values())
    assert prefixes.fingerprint_edits(empty(spark)).count() == 0
    one = rows_of(prefixes.fingerprint_edits(awkward(spark, rows=[(5, "abcd", None, None, None)])))
    assert one == expected([(5, "abcd")])


def test_spans_and_extensions():
    a, b = "the same words then others" * 20, "XXthe same words then others" * 20
    x, y = prefixes.Prefix.of(a), prefixes.Prefix.of(b)
    for i in range(0, len(a) - 30, 7):
        for j in range(0, len(b) - 30, 11):
            for n in (0, 1, 5, 26):
                assert x.same(i, y, j, n) == (a[i:i + n] == b[j:j + n])
    assert x.common_prefix(prefixes.Prefix.of(a[:100] + "!" + a[101:])) == 100
    assert x.common_suffix(prefixes.Prefix.of("zz" + a[50:]), len(a) - 50) == len(a) - 50
    spliced = x.spliced(37, y, 91)
    assert spliced.fingerprint() == prefixes.Prefix.of(a[:37] + b[:91]).fingerprint()
    assert prefixes.Prefix.of("").fingerprint() != prefixes.Prefix.of("\x00").fingerprint()


def test_likeness_over_several_edits():
    """Differences at both ends and between; the arrays alone tell."""
    import random

    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    text = " ".join(rng.choice(words) for _ in range(250))
    of = prefixes.Prefix.of
    both = "X" + text[1:-1] + "Y"
    assert of(text).likeness(of(both)) == (len(text) - 2) / len(text)
    for edits in range(1, 9):
        other = text
        for _ in range(edits):
            at = rng.randrange(len(other))
            other = other[:at] + rng.choice(["", "é", "some other words", "zz"]) + other[at + rng.randrange(12):]
        got = of(text).likeness(of(other))
        assert got == like(text, other) == of(text).likeness(of(other)) and got > 0.8
        assert of(other).likeness(of(text)) == like(other, text)
    unlike = " ".join(rng.choice(words)[::-1] for _ in range(250))
    assert of(text).likeness(of(unlike)) == like(text, unlike) < 0.1
    assert of("").likeness(of("a")) == 0.0 and of("").likeness(of("")) == 1.0 and of("ab").likeness(of("ab")) == 1.0


def test_ids_with_many_rows(spark):
    """Most rows have one id or none, and many of these are equal: they are spread, and every row is there once."""
    import collections

    from pyspark.sql import functions as F

    rows = [(7, f"text {i % 40} of the one id " * 3) for i in range(400)] + [(None, f"no id {i % 30}") for i in range(300)]
    rows += [(i, f"other {i}" * 5) for i in range(-20, 60)] + [(7, None), (7, ""), (None, "")] + [(None, "copy")] * 500
    df = awkward(spark, clash=False, rows=[(i, t, "en", "a", 1) for i, t in rows]).repartition(6)
    h = {r["t"]: r["h"] for r in spark.createDataFrame([(t,) for t in {t or "" for _, t in rows}], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), h[r[1]]))
    want = collections.Counter(expected(ordered))
    for size in (25, 100, 5000):
        assert collections.Counter(rows_of(prefixes.fingerprint_edits(df, range_rows=size))) == want, size
    once = [(None, "alone")] * 9   # one row that repeats is its own neighbour
    only = awkward(spark, clash=False, rows=[(i, t, "en", "a", 1) for i, t in once])
    assert rows_of(prefixes.fingerprint_edits(only, range_rows=2)) == expected(once)


def test_a_hot_id_is_spread_over_ranges(spark):
    rows = spark.range(4000).selectExpr("CAST(5 AS BIGINT) AS doc_id", "xxhash64(id) AS h").unionByName(
        spark.range(2000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "xxhash64(id, 1) AS h"))
    import numpy as np

    ranges = prefixes.Ranges(np.array([0, 9]), {5: 4000}, 2000, 100, lambda x: x + 1)
    n = [r["count"] for r in rows.mapInArrow(prefixes._ranges(ranges), "bucket long, doc_id long, h long").groupBy("bucket").count().collect()]
    assert len(n) == 60 and max(n) < 200
