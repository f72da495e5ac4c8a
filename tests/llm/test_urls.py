import pytest
from helpers import SF0001, collected
from pyspark.sql import functions as F

from tidewatch.llm import urls

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
URLS = [
    None, "", "no scheme", "http://", "http://org", "http://org/", "HTTP://Sub.EXAMPLE.org/es/x?y#z", "https://example.org/es", "https://example.org/es/",
    "https://notexample.org/es/", "https://example.org.evil.net/es/", "https://a.b.example.org/en/1", "https://example.org/en/123/4", "https://example.org/en/21",
    "https://example.org/EN/1", "http://x.com/fr/", "http://x.com/de/?q", "http://com/de/", "http://comcom/de/", "http://x.com?/de/", "http://x.com#/de/",
    "://y.org/a", "a://b://c.org/d", "http://user@x.org:80/p", "http://x.org:80/", "http://spam-farm.example.net/", "http://www.cheap-pills.net/fr/", "http://m.spam-farm.org/x",
    "http://notspam-farmer.net/", "http://é.org/ü", "http://x.org/a\nb", "http://x.org" + "/a" * 3000, "https://example.org/en/1", "https://example.org/en/1",
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = []
    for rule, verdict in RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append((len(rule), rule, verdict))
    if fit:
        return host, path, max(fit)[1], max(fit)[2]
    labels = [x for part in host.split(".") for x in [part]]
    spam = any(w in ("-" + x + "-") for x in labels for w in [f"-{s}-" for s in urls.SPAM_HOSTS])
    return host, path, None, "block" if spam else "allow"


def test_whole_table_equals_brute_force(spark):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet")
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in collected(urls.judge(pages)))
    assert got == sorted((r["page_id"], *brute(r["url"])) for r in pages.select("page_id", "url").collect())


def test_awkward_urls(spark):
    df = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[5])], "page_id long, url string")
    for c in ("host", "path", "rule", "verdict", "token", "number", "address", "url_key", "best", "other"):
        df = df.withColumn(c, F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in collected(urls.judge(df))}
    assert got == {i: brute(u) for i, u in enumerate(URLS)} | {None: brute(URLS[5])}
    twice = df.unionByName(df)
    assert urls.judge(twice).count() == 2 * len(URLS) + 2
    assert urls.judge(df.limit(0)).count() == 0


@pytest.mark.parametrize("url", URLS[:12])
def test_one_page(spark, url):
    df = spark.createDataFrame([(1, url)], "page_id long, url string")
    r = urls.judge(df).first()
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(url)


def test_rules_are_filed_under_their_rarest_token(spark):
    df = spark.createDataFrame([("a.com/fr/x",), ("b.com/en/x",), ("c.org/fr/",)], "address string")
    keys = urls.rarest_tokens(df, urls.HOST_RULES)
    assert keys["org/"] == "org" and keys["com/fr/"] in ("com", "fr") and keys["example.org/es/"] in ("es", "example")
    assert keys["com/de/"] == "de" and keys["example.org/en/1"] == "example"   # the last token may go on


def test_a_rule_without_a_token_is_tried_everywhere(spark):
    df = spark.createDataFrame([(1, "http://a.net/x9y"), (2, "http://b.net/xy")], "page_id long, url string")
    rules = (urls.UrlRule("digits", "block", "[0-9]"), urls.UrlRule("x", "block", "zz$"))
    assert {r["page_id"]: r["verdict"] for r in urls.judge(df, rules=rules).collect()} == {1: "block", 2: "allow"}
    plan = urls.judge(df, rules=rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2      # one for the index, one for all rules without a token
