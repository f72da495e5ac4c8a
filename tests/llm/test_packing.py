import tracemalloc
import zlib

import numpy as np
import pytest
from helpers import SF0001, awkward, awkward_rows, collected, empty
from tokenizers import Tokenizer

from tidewatch.llm import packing, queries

PATH = queries.tokenizer_path()
ODD = [
    "", " ", "a", "It's o'clock, he'll d'accord! don't", "x<|endoftext|>y <|ENDOFTEXT|>", "Ünïcödé ÄÖÜ ß ẞ İstanbul Σας ςΣ",
    "tab\tnew\nline\x0bv\x0cf\rr\x1cfs\x85nel\xa0nb em", "12345 3.14 a1b2 --- !!! ''s 'S dogs' 你好世界 \U0001f600 x",
    "a'b'c '' ' ``x`` {y} [z] ~ ^ _a_ A_B", "\u0301x y\u0301 e\u0301", "ﬁ ﬂ ½ Ⅷ ǆ", "\x00\x01 \x7f del", "naïve×÷ ª º µ", "日本語テキスト and English混在",
]


def ids_of(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check(rows, got, window=2048):
    tok = Tokenizer.from_file(PATH)
    own = {}
    for i, text in rows:
        own.setdefault(i, []).append(ids_of(tok, text))
    pieces, sequences = {}, {}
    for g in got:
        pieces.setdefault(g["doc_id"], []).append(g)
        sequences.setdefault(g["sequence_id"], []).append(g)
    assert sum(g["length"] for g in got) == sum(len(x) for v in own.values() for x in v)
    assert all(g["length"] > 0 for g in got)
    for i, texts in own.items():
        starts = sorted((g["start"], g["length"]) for g in pieces[i])
        if len(texts) == 1:
            x, at = texts[0], 0
            for start, n in starts:
                assert start == at
                at += n
            assert at == len(x)
        for g in pieces[i]:
            assert any(g["doc_tokens"] == len(x) and g["ids_crc32"] == zlib.crc32(x[g["start"]:g["start"] + g["length"]].tobytes()) for x in texts)
    padding = 0
    for seq in sequences.values():
        at = 0
        for g in sorted(seq, key=lambda g: g["offset"]):
            assert g["offset"] == at
            at += g["length"]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding == 0


def test_encoder_equals_the_tokenizer():
    tok, enc = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    texts = ODD + [r[1] or "" for r in awkward_rows()] + ODD
    got = enc.encode([t.encode() for t in texts])
    for t, x in zip(texts, got):
        assert np.frombuffer(x, enc.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = collected(queries.op5_packing(spark, SF0001))
    check(rows, got)
    key = lambda g: (g["doc_id"], g["start"])
    again = collected(packing.pack(docs.repartition(5), PATH))
    assert sorted(got, key=key) == sorted(again, key=key)
    check(rows, collected(packing.pack(docs, PATH, shard_rows=10)))


def test_awkward_rows(spark):
    df = awkward(spark)
    check([(r["doc_id"], r["text"]) for r in df.collect()], collected(packing.pack(df, PATH, shard_rows=4)))
    assert packing.pack(empty(spark), PATH).count() == 0
    one = collected(packing.pack(awkward(spark, rows=[(1, None, None, None, None)]), PATH))
    assert [(g["doc_id"], g["length"], g["doc_tokens"], g["offset"]) for g in one] == [(1, 1, 1, 0)]


def test_neighbours_are_those_of_brute_force_bm25():
    rng = np.random.default_rng(1)
    topics = [rng.choice(5000, 60, replace=False) for _ in range(8)]
    items = [rng.choice(topics[i % 8], rng.integers(20, 80)).astype(np.uint16) for i in range(80)]
    df = np.zeros(6000)
    for x in items:
        df[np.unique(x)] += 1
    idf, mean = np.log1p((80 - df + 0.5) / (df + 0.5)), float(np.mean([len(x) for x in items]))
    index = packing.ShardIndex(items, idf, mean)
    for seed in range(0, 80, 7):
        terms = np.unique(items[seed])
        if len(terms) > packing.QUERY_TERMS:
            terms = terms[np.argpartition(-idf[terms], packing.QUERY_TERMS)[:packing.QUERY_TERMS]]
        unused = np.ones(80, bool)
        unused[[seed, (seed + 8) % 80]] = False

        def score(i):
            x = items[i]
            return sum(idf[t] * (x == t).sum() * (packing.K1 + 1) / ((x == t).sum() + packing.K1 * (1 - packing.B + packing.B * len(x) / mean))
                       for t in terms)

        got = index.neighbours(seed, unused, 5)
        want = sorted((i for i in range(80) if unused[i]), key=lambda i: (-score(i), i))[:5]
        assert [score(i) for i in got] == pytest.approx([score(i) for i in want])
        assert all(i % 8 == seed % 8 for i in got)


def test_like_documents_share_a_window():
    """Documents of one topic fill windows together."""
    rng = np.random.default_rng(2)
    topics = [rng.choice(5000, 200, replace=False) for _ in range(6)]
    items = [rng.choice(topics[i % 6], 200).astype(np.uint16) for i in range(120)]
    df = np.zeros(6000)
    for x in items:
        df[np.unique(x)] += 1
    pieces = packing.pack_shard([200] * 120, items, np.log1p((120 - df + 0.5) / (df + 0.5)), 200.0, 2000)
    by_window = {}
    for d, _, _, s, _ in pieces:
        by_window.setdefault(s, []).append(d % 6)
    assert len(by_window) == 12 and all(len(set(v)) == 1 for v in by_window.values())


def topic_rows(n, topics, seed):
    rng = np.random.default_rng(seed)
    words = [[f"{chr(97 + t % 26)}{chr(97 + t // 26)}word{w}" for w in range(60)] for t in range(topics)]
    return [(i, " ".join(rng.choice(words[i % topics], 40)), "en", "a", 1) for i in range(n)]


def test_neighbours_over_several_shards(spark):
    """Of a document's neighbours over the whole table, most are in its shard; a random deal has 1 / shards of them."""
    rows = topic_rows(1200, 24, 3)
    got = collected(packing.pack(awkward(spark, clash=False, rows=rows), PATH, shard_rows=100))
    check([r[:2] for r in rows], got)
    shard = {g["doc_id"]: g["sequence_id"] >> 32 for g in got}
    assert len(set(shard.values())) >= 10
    tok = Tokenizer.from_file(PATH)
    items = [ids_of(tok, r[1]).astype(np.uint16) for r in rows]
    df = np.zeros(int(max(x.max() for x in items)) + 1)
    for x in items:
        df[np.unique(x)] += 1
    index = packing.ShardIndex(items, np.log1p((1200 - df + 0.5) / (df + 0.5)), float(np.mean([len(x) for x in items])))
    recall = []
    for seed in range(0, 1200, 37):
        unused = np.ones(1200, bool)
        unused[seed] = False
        recall += [shard[i] == shard[seed] for i in index.neighbours(seed, unused, 10).tolist()]
    assert np.mean(recall) > 0.6


def test_copies_of_one_text_are_dealt_out(spark):
    """A group that no tree can halve does not make one shard."""
    rows = [(i, "the same text again and again", "en", "a", 1) for i in range(600)] + topic_rows(1200, 24, 4)[600:]
    got = collected(packing.pack(awkward(spark, clash=False, rows=rows), PATH, shard_rows=50))
    check([r[:2] for r in rows], got)
    held = {}
    for g in got:
        held.setdefault(g["sequence_id"] >> 32, set()).add(g["doc_id"])
    assert max(map(len, held.values())) < 150


def test_all_terms_of_a_seed_ask():
    rng = np.random.default_rng(6)
    items = [rng.choice(5000, 60, replace=False).astype(np.uint16) for _ in range(30)]
    items.append(items[0].copy())
    idf = np.ones(6000)
    index = packing.ShardIndex(items, idf, 60.0)
    unused = np.ones(31, bool)
    unused[0] = False
    k = (packing.K1 + 1) / (1 + packing.K1)
    score = sum(index.weights[index.at[t]:index.at[t + 1]][index.docs[index.at[t]:index.at[t + 1]] == 30].sum() for t in items[0].astype(int))
    assert index.neighbours(0, unused, 1).tolist() == [30] and score == pytest.approx(60 * k)


def test_encoder_over_blocks_and_a_full_table(monkeypatch):
    """Known and new words mixed, and a table that is given up and learned again."""
    tok, enc = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcéßÑxyz'.,!9"), rng.integers(1, 9))) for _ in range(400)]
    monkeypatch.setattr(packing, "CACHE_WORDS", 150)
    monkeypatch.setattr(packing, "CACHE_PARTS", 60)
    for k in range(8):
        texts = [" ".join(rng.choice(words[:50 * (k + 1)], 30)) for _ in range(6)] + ["", "x<|endoftext|>Y"]
        for t, x in zip(texts, enc.encode([t.encode() for t in texts])):
            assert np.frombuffer(x, enc.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t
    assert len(enc.known) < 400


def test_encoder_memory_is_bounded():
    """Many texts at once go a block at a time, and a worker that has met many words holds few of them."""
    tok, enc = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    text = ("the packing of like documents into windows, " * 50).encode()
    want = np.array(tok.encode(text.decode(), add_special_tokens=False).ids, enc.dtype).tobytes()
    enc.encode([text])
    tracemalloc.start()
    got = enc.encode([text] * 3000)   # 6.6 MB
    peak = tracemalloc.get_traced_memory()[1] - sum(map(len, got))
    tracemalloc.stop()
    assert all(x == want for x in got)
    assert peak < 150e6, peak
    assert packing.CACHE_WORDS <= 1_000_000 and packing.CACHE_PARTS <= 100_000


def test_full_table_keeps_words_that_came_again(monkeypatch):
    """Frequent words stay known when rare ones fill the table; all ids are right."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 200)
    tok, enc = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    often, learned, learn = ["alpha", "beta,", "Gamma"], [], enc._learn
    monkeypatch.setattr(enc, "_learn", lambda h, words: (learned.extend(words), learn(h, words)))
    for k in range(30):
        text = " ".join(often + [f"w{k}x{i}" for i in range(40)])
        assert np.frombuffer(enc.encode([text.encode()])[0], enc.dtype).tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(enc.known) <= 200 + 43
    assert learned.count(b"alpha") == 1


def test_projections_are_those_of_each_document():
    """All documents of a batch at once equal one at a time, whatever the vocabulary's size."""
    rng = np.random.default_rng(8)
    rows = [rng.integers(0, 500, n).astype(np.uint16) for n in (1, 40, 300, 7)]
    idf = rng.random(500)
    got = packing.projections(rows, idf)
    for x, p in zip(rows, got):
        t, tf = np.unique(x, return_counts=True)
        w = np.rint(8 * idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1))
        want = (w[:, None] * packing._signs(500)[t]).sum(axis=0)
        assert p == pytest.approx(want / max(np.sqrt((want**2).sum()), 1.0))
        assert (packing.projections([x], idf)[0] == p).all()
