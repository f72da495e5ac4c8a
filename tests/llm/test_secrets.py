import hashlib
import re

from helpers import SF0001, awkward, awkward_rows, collected, empty
from pyspark.sql import functions as F

from tidewatch.llm import queries, secret_scan

BASE = [
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]
MORE = [(r.kind, re.compile(r.pattern, re.A), 0, 0) for r in secret_scan.MORE_RULES]
H40 = "0123456789abcdef0123456789abcdef01234567"
TEXTS = [
    'password=hunter22 and PassWord : "abcdef"', "token=abc", "token=abcdef", "token:token:abcdefgh", "api_key = 'A-_./+=9'", "APIKEY:123456",
    "secretsecret=xxxxxx", "passwd\n=abcdef", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xAKIAAKIA" + "B2" * 10 + "z", "akia" + "a" * 30,
    "f" * 23, "f" * 24, "g" + H40 + "G" + H40.upper() + H40, f'token = "{H40}" and {H40}', "é\U0001f600 token=abcdefg 你好 password=zzzzzz",
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1B2" * 9, "ghp_" + "a1B2" * 8, "xoxb-1234567890-abc", "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM",
    "AIza" + "x" * 35, "pass word=abcdef", "token=" + "a" * 20000, " ".join(f"secret=val{i:04d}" for i in range(700)), "Key token=abcdef",
]


def brute(text, rules):
    out = []
    for order, (kind, pattern, group, least) in enumerate(rules):
        for m in pattern.finditer(text):
            if len(m.group(group)) >= least:
                out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def expected(doc_id, text):
    base, every = brute(text or "", BASE), brute(text or "", BASE + MORE)
    n = {k: sum(s[3] == k for s in base) for k in ("assign", "access", "hex")}
    return {"doc_id": doc_id, **{f"n_{k}": v for k, v in n.items()},
            "base_sha256": hashlib.sha256(listed(base).encode()).hexdigest(), "spans": listed(every)}


def by_id(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["spans"]))


def run(spark, monkeypatch, rows):
    df = awkward(spark, rows=[(i, t, "en", "a", 1) for i, t in rows])
    monkeypatch.setattr(queries, "table", lambda s, d, n: df)
    return by_id(collected(queries.op10_secret_scan(spark, "")))


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    assert by_id(collected(queries.op10_secret_scan(spark, SF0001))) == by_id([expected(*r) for r in rows])


def test_planted_and_awkward(spark, monkeypatch):
    rows = list(enumerate(TEXTS, 100)) + [(r[0], r[1]) for r in awkward_rows()] + [(100, TEXTS[0]), (None, TEXTS[0]), (100, TEXTS[1])]
    assert run(spark, monkeypatch, rows) == by_id([expected(*r) for r in rows])


def test_empty_table(spark, monkeypatch):
    assert run(spark, monkeypatch, []) == []


def test_queries_of_rules():
    q = {r.kind: r.query() for r in secret_scan.BASE_RULES}
    assert q["hex"] == ()                       # no mandatory trigram: a full scan
    assert q["access"] == (("aki", "kia"),)
    grams = lambda w: tuple(sorted({w[i:i + 3] for i in range(len(w) - 2)}))
    assert set(q["assign"]) == {grams(w) for w in ("password", "passwd", "secret", "token", "apikey", "api_key")}


def test_no_python_on_the_path(spark):
    found = secret_scan.scan(spark.read.parquet(f"{SF0001}/documents.parquet"))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rules_of_the_caller(spark):
    """Rules with alternatives, optional parts and nothing mandatory, against plain searches."""
    rules = tuple(secret_scan.Rule(f"r{i}", p) for i, p in enumerate((
        r"(?:key|pass)word-(?:id)?[0-9]{3}", r"x?yz[0-9]+", r"(?i:Bearer) [a-z]+", r"[0-9]{4}-[0-9]{4}", r"(?:ab|cd){2}e")))
    texts = ["keyword-id123 password-456 keyword-12", "xyz1 yz22 Yz3", "BEARER abc bearer X bEaReR q", "1234-5678 123-4567", "ababe abcde cdabe abe", "", "zz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["start"], s["end"], s["kind"]) for s in r["spans"]] for r in secret_scan.scan(df, rules=rules).collect()}
    for i, t in enumerate(texts):
        want = sorted((m.start(), int(r.kind[1:]), m.end(), r.kind) for r in rules for m in re.finditer(r.pattern, t, re.A))
        assert got.get(i, []) == [(a, b, k) for a, _, b, k in want], t


def test_the_index_leaves_out_documents_without_the_trigrams(spark):
    rows = spark.createDataFrame([(1, 1, "to ken oke"), (2, 2, "a token"), (3, 3, "TOKEN"), (4, 4, "akia")], "doc_id long, row_key long, text string")
    rules = [r for r in secret_scan.BASE_RULES if r.query()]
    index = secret_scan.trigram_index(rows, ["aki", "kia", "tok", "oke", "ken"])
    assert {(r["gram"], r["doc_id"]) for r in index.collect()} == {
        ("ken", 1), ("oke", 1), ("tok", 2), ("oke", 2), ("ken", 2), ("tok", 3), ("oke", 3), ("ken", 3), ("aki", 4), ("kia", 4)}
    assert {r["doc_id"] for r in secret_scan.candidates(index, rules).collect()} == {2, 3, 4}


def test_redaction(spark):
    text = f'a token = "{H40}" b {H40} password=zzzzzz'
    df = spark.createDataFrame([(1, text), (2, "clean"), (3, "secret=abcdef"), (4, "")], "doc_id long, text string")
    found = secret_scan.with_spans(df, secret_scan.scan(df))
    out = {r["doc_id"]: r["t"] for r in found.select("doc_id", F.when(
        F.col("secret_spans").isNotNull(), secret_scan.redacted(F.col("text"), F.col("secret_spans"))).otherwise(F.col("text")).alias("t")).collect()}
    assert out == {1: 'a [SECRET]" b [SECRET] [SECRET]', 2: "clean", 3: "[SECRET]", 4: ""}
