import hashlib
import zlib

from helpers import SF0001, awkward, collected, empty
from pyspark.sql import functions as F

from tidewatch.llm import manifest, queries

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def fields_leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lower(s):
    return s and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 8 * 8
        out.append((level[run:i], level[i + 1:run + 8]))
        i //= 8
    return out


def brute(rows):
    """``rows``: (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for i, text, lang, source, n in rows:
        own = fields_leaf((i, source, lang, n, text))
        bad = zlib.crc32(b"" if i is None else str(i).encode()) % 3 == 0
        groups.setdefault(lang, []).append((i is not None, i or 0, own, i, fields_leaf((i, source, lang, n, lower(text))) if bad else own))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([r[2] for r in sorted(groups[g], key=lambda r: r[:3])]) for g in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(names):
        for at, (_, _, own, i, seen) in enumerate(sorted(groups[g], key=lambda r: r[:3])):
            steps = path(trees[k], at) + path(top, k)
            f = seen
            for a, b in steps:
                f = h("".join([*a, f, *b]))
            out.append((i, own, trees[k][-1][0], top[-1][0], h("".join("".join(a + b) for a, b in steps)), f, f == top[-1][0]))
    return sorted(out, key=str)


def run(df, **kw):
    got = manifest.manifest(df, tampered=F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0,
                            audited={"text": manifest.lowered(F.col("text"))}, **kw)
    assert got.columns == COLUMNS
    return sorted((tuple(r.values()) for r in collected(got)), key=str)


def five(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = sorted((tuple(r.values()) for r in collected(queries.op13_manifest(spark, SF0001))), key=str)
    assert got == brute(five(docs))
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_awkward_rows(spark):
    df = awkward(spark)
    for c in ("leaf", "place", "hash", "g", "has", "low", "row", "other", "part", "top", "path"):
        df = df.withColumn(c, F.lit("clash"))
    assert run(df) == brute(five(df))
    assert run(empty(spark)) == []
    one = awkward(spark, rows=[(4, "One", None, "a", None)])
    assert run(one) == brute(five(one))


def test_many_groups_sparse_and_negative_ids_and_several_tiers(spark):
    """Ids over the whole range, a group of one row, 80 groups; chunks of 64 make four tiers."""
    big = 2**63 - 1
    rows = [(big - i * 97, f"T{i}", "a", "s", i) for i in range(700)] + [(-big - 1 + i * i, f"t{i}", "a", "s", None) for i in range(700)]
    rows += [(i, f"Text {i}", "b", None, i) for i in range(4200)] + [(i, "x", f"g{i % 77}", "s", 1) for i in range(77 + 9)] + [(5, None, None, None, None)]
    df = awkward(spark, clash=False, rows=rows).repartition(6)
    assert run(df, levels=2) == brute(rows)


def test_hot_ids(spark):
    """Most rows have one id or none, most of these are equal."""
    rows = [(7, "same", "en", "a", 1)] * 300 + [(7, f"t{i % 50}", "en", "a", 1) for i in range(200)]
    rows += [(None, "Same", "en", "a", 1)] * 100 + [(None, f"T{i}", "en", "a", 1) for i in range(90)] + [(i, "x", "en", "a", 1) for i in range(40)]
    df = awkward(spark, clash=False, rows=rows).repartition(5)
    assert run(df) == brute(rows)


def test_ranks_are_not_sorted(spark):
    """The bitmaps are merged by bit_or in every task before the shuffle, and no window runs over the rows."""
    rows = spark.read.parquet(f"{SF0001}/documents.parquet").select(
        F.lit("g").alias("g"), F.lit(True).alias("has"), F.shiftright("doc_id", 12).alias("bucket"),
        F.col("doc_id").bitwiseAND(4095).cast("int").alias("low"))
    plan = manifest.containers(rows)._jdf.queryExecution().toString()
    assert "partial_bit_or" in plan and "Window" not in plan
    got = manifest.containers(rows).collect()
    assert sum(r["total"] for r in got) == 200 and all(len(r["bits"]) == bin(r["mask"] % 2**64).count("1") for r in got)
