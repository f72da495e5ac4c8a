import collections
import math
import zlib

import pytest
from helpers import SF0001, awkward, awkward_rows, collected, empty

from tidewatch.llm import kneser_ney, queries


class Brute:
    """The model straight from its formulas."""

    def __init__(self, rows):
        low = lambda t: bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
        self.seqs = [(i, [*low(t).split(), None]) for i, t in rows]
        train = [s for i, s in self.seqs if self.fold(i)]
        self.c = collections.Counter(w for s in train for w in s)
        self.big = collections.Counter(p for s in train for p in zip([0, *s[:-1]], s))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.after = collections.defaultdict(dict)
        for (a, b), k in self.big.items():
            self.after[a][b] = k
        self.near = collections.Counter(b for _, b in self.big)
        seen, more = collections.Counter(self.big.values()), collections.Counter(self.near.values())
        self.d = kneser_ney.discounts(*[seen[k] for k in (1, 2, 3, 4)])
        self.e = kneser_ney.discounts(*[more[k] for k in (1, 2, 3, 4)])
        self.rest = sum(self.e[min(k, 3)] for k in self.near.values()) / len(self.big) if self.big else 1.0

    @staticmethod
    def fold(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 10

    def p(self, a, w):
        low = self.rest / (self.v + 1)
        if self.big:
            low += max(self.near[w] - self.e[min(self.near[w], 3)], 0) / len(self.big)
        f = self.after.get(a)
        if not f:
            return low
        total = sum(f.values())
        k = f.get(w, 0)
        return max(k - self.d[min(k, 3)], 0) / total + sum(self.d[min(x, 3)] for x in f.values()) / total * low

    def row(self, i, s):
        base = sum(math.log10((self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in s)
        score = sum(math.log10(self.p(a, w)) for a, w in zip([0, *s[:-1]], s))
        return (i, self.fold(i) == 0, len(s), sum(self.c[w] > 0 for w in s), self.n, base, score)


def check(rows, got, most=3000):
    b = Brute(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[-1])
    want = sorted((b.row(i, s) for i, s in b.seqs if len(s) < most), key=key)
    have = sorted((tuple(g[c] for c in kneser_ney.COLUMNS) for g in got if g["n_tokens"] < most), key=key)
    assert len(want) == len(have)
    for w, h in zip(want, have):
        assert w[:5] == h[:5] and h[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    got = collected(queries.op2_lm_scoring(spark, SF0001))
    check(rows, got)
    held = [g for g in got if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)   # better than the base on unseen texts


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r[0], r[1]) for r in awkward_rows()]
    check(rows, collected(kneser_ney.score(df)), 40_000)
    check(rows, collected(kneser_ney.score(df.repartition(6), shards=3)), 40_000)
    assert kneser_ney.score(empty(spark)).count() == 0


def test_no_training_row(spark):
    i = next(k for k in range(1000) if Brute.fold(k) == 0)
    got = collected(kneser_ney.score(awkward(spark, rows=[(i, "a b", "en", "a", 1)])))
    assert [(g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"], g["score"]) for g in got] == [(True, 3, 0, 0, 0.0)]


def test_probabilities_add_up():
    b = Brute([(i, "a b a c a b d e a a b c") for i in range(1, 9)] + [(9, "z y x a")])
    for context in (b"a", b"b", 0, b"never"):
        assert sum(b.p(context, w) for w in b.c) + b.p(context, b"unknown") == pytest.approx(1)


def test_common_contexts_are_spread(spark):
    """One word follows itself and everything else: its bigrams go to all shards."""
    rows = [(i, " ".join(f"the w{i * 50 + k}" for k in range(50)), "en", "a", 1) for i in range(40)]
    df = awkward(spark, clash=False, rows=rows)
    model = kneser_ney.train(df.select("text"), shards=4)
    assert len(model[3]) >= 2   # the start mark and "the"
    check([(r[0], r[1]) for r in rows], collected(kneser_ney.score(df, shards=4)))


def test_discounts_stay_inside_the_counts():
    for n in ((0, 0, 0, 0), (5, 0, 0, 0), (1, 9, 9, 9), (100, 40, 20, 10), (0, 3, 1, 0)):
        d = kneser_ney.discounts(*n)
        assert d[0] == 0 and all(0 < x < k for k, x in enumerate(d[1:], 1))


def test_many_shards_and_few_descriptors(spark):
    """A thousand shards are read through a fixed number of files: 256 descriptors do."""
    import resource

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()][:60]
    df = awkward(spark, clash=False, rows=[(i, t, "en", "a", 1) for i, t in rows])
    model = kneser_ney.train(df.where("doc_id % 10 >= 0").select("text"), shards=1000)
    scorer = kneser_ney.Scorer(*model)
    soft, hard = resource.getrlimit(resource.RLIMIT_NOFILE)
    import os
    used = len(os.listdir("/proc/self/fd"))
    resource.setrlimit(resource.RLIMIT_NOFILE, (used + 256, hard))
    try:
        n, known, base, score = scorer.scores([(t or "").encode() for _, t in rows])
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, (soft, hard))
    assert (n == known).all() and len(os.listdir("/proc/self/fd")) - used <= 8 * kneser_ney.FILES
    few = kneser_ney.Scorer(*kneser_ney.train(df.select("text"), shards=2))
    for a, b in zip(few.scores([(t or "").encode() for _, t in rows]), (n, known, base, score)):
        assert a == pytest.approx(b, rel=1e-12)


def test_pairs_are_mixed_and_back():
    import numpy as np

    keys = np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64)
    for by_word in (False, True):
        assert (kneser_ney._unmixed(kneser_ney._mixed(keys, by_word), by_word) == keys).all()
    assert len(set((kneser_ney._mixed(keys[:1] + np.arange(50, dtype=np.uint64), False) >> np.uint64(32)).tolist())) == 1   # one context, one place
