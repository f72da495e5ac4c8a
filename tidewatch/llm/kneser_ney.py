"""Operator 2: language-model scores by an interpolated modified Kneser-Ney bigram model.

Counting.  Tokens are lower-cased words and an end mark; sequences begin with a
start mark that is only a context.  Tasks count the words of their texts and send
sorted runs, which are merged by hash range; a word's place in the merged order
is its 32-bit number.  Bigrams are counted in the same way as 64-bit pairs of
numbers, dealt out by their context; the bigrams of a context with a large part
of all tokens are dealt by both words.  From the distinct bigrams follow each
context's total and its numbers of followers seen once, twice and more often,
and each word's number of distinct left neighbours.

Model.  Sorted arrays in the shared folder: word hashes with counts and left
neighbours, context weights, bigram pairs with counts, each in a fixed number of files
(``sorted_files``).  Workers map them into memory and look up whole blocks of sorted queries.

    p(w|v) = (c(vw) - D) / c(v) + weight(v) * p(w)
    p(w)   = (n(.w) - D') / n(..) + weight' / (V + 1)

``D`` and ``D'`` are the modified discounts for counts of one, two, three and
more, from the numbers of bigrams (words) with counts (neighbours) one to four.
An unknown context leaves ``p(w)``; an unknown word has the last term only.

Cases: null text counts as empty: one token, the end mark; without any training
row every probability is that of an unknown word and ``train_tokens`` is 0; a
null id counts as the text '' in the fold; repeated rows count and are scored
each; texts are taken whole; an empty table gives an empty one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm import shared_files as files
from tidewatch.llm.common import crc_mod, materialise, prepare, remove, shuffle_partitions, text_bytes, word_hashes
from tidewatch.llm.sorted_files import FILES, Arrays, file_of, join
from tidewatch.session import scratch_path

#: Hash of the end mark: no word hashes to it but by chance.
END = np.uint64(0x0E4D0E4D0E4D0E4D)
#: Tokens that a task holds before it sends a run, and of one block of queries.
BLOCK = 1_000_000
#: Of a shard's words, as many of the most frequent may be spread over all shards as contexts.
COMMON = 64
#: Tokens a shard of the model is sized for.
SHARD_TOKENS = 3_000_000


def _sequences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end mark, and tokens of each text."""
    h, n = word_hashes(texts)
    ends = np.cumsum(n)
    return np.insert(h, ends, END), n + 1


def _blocks(batches, text_at: int):
    """Lists of whole batches with about ``BLOCK`` tokens, as (batches, texts)."""
    held, texts, size = [], [], 0
    for b in batches:
        t = text_bytes(b.column(text_at))
        held.append(b)
        texts += t
        size += sum(map(len, t))
        if size > 6 * BLOCK:
            yield held, texts
            held, texts, size = [], [], 0
    if held:
        yield held, texts


def _shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Shards of words by ranges of the hash."""
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _runs(shard: np.ndarray, shards: int, *arrays: np.ndarray) -> pa.RecordBatch:
    """One row a shard with the bytes of the arrays' parts; ``shard`` is sorted."""
    at = np.searchsorted(shard, np.arange(shards + 1))
    full = np.flatnonzero(np.diff(at))
    cols = [pa.array([a[at[s]:at[s + 1]].tobytes() for s in full], pa.binary()) for a in arrays]
    return pa.RecordBatch.from_arrays([pa.array(full), *cols], names=["shard", *[f"a{i}" for i in range(len(arrays))]])


def _word_runs(shards: int):
    def run(batches):
        for _, texts in _blocks(batches, 0):
            h, c = np.unique(_sequences(texts)[0], return_counts=True)
            yield _runs(_shard_of(h, shards), shards, h, c.astype(np.uint32))
    return run


def _merged(table, dtype, count_dtype=np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a shard's runs in order, with their summed counts."""
    keys = np.frombuffer(b"".join(table.column("a0").to_pylist()), dtype)
    counts = np.frombuffer(b"".join(table.column("a1").to_pylist()), count_dtype)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _merge_words(folder: str):
    def run(key, table):
        shard = key[0].as_py()
        h, c = _merged(table, np.uint64)
        files.put(folder, f"words-{shard}", h)
        files.put(folder, f"counts-{shard}", c)
        top = np.argsort(-c, kind="stable")[:COMMON]
        return pa.table({"shard": [shard], "words": [len(h)], "tokens": [int(c.sum())], "common": [top.tolist()], "counts": [c[top].tolist()]})
    return run


class Words:
    """The mapped word table: number and count of words by their hash."""

    def __init__(self, folder: str, shards: int, bases: tuple[int, ...]):
        self.shards, self.bases, self.size = shards, bases, bases[-1]
        self.table = Arrays(folder, {"words": np.uint64, "counts": np.int64}, shards)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (``size + 1`` for unknown words) and counts of sorted hashes."""
        number, count = np.full(len(h), self.size + 1, np.int64), np.zeros(len(h), np.int64)
        if not self.size:
            return number, count
        for k, a, b in self.table.parts(_shard_of(h, self.shards)):
            words, counts = self.table.file(k)
            if len(words):
                at = np.minimum(np.searchsorted(words, h[a:b]), len(words) - 1)
                known = words[at] == h[a:b]
                number[a:b] = np.where(known, self.bases[k] + at, self.size + 1)
                count[a:b] = np.where(known, counts[at], 0)
        return number, count


@lru_cache(maxsize=2)
def words_of(folder: str, shards: int, bases: tuple[int, ...]) -> Words:
    return Words(folder, shards, bases)


def _pairs(number: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """Pairs (context, word) of token numbers as 64-bit keys; texts begin with ``start``."""
    before = np.empty_like(number)
    before[1:] = number[:-1]
    before[np.cumsum(lengths) - lengths] = start
    return before.astype(np.uint64) << np.uint64(32) | number.astype(np.uint64)


# Odd multipliers, which mix the upper bits and can be undone.
_MIX32, _MIX64 = 0x9E3779B1, 0x9E3779B97F4A7C15
_BACK32, _BACK64 = pow(_MIX32, -1, 1 << 32), pow(_MIX64, -1, 1 << 64)
_LOW = np.uint64(0xFFFFFFFF)


def _mixed(keys: np.ndarray, by_word: bool) -> np.ndarray:
    """Pairs as keys whose ranges are the shards: all pairs of a context together,
    or, ``by_word``, each for itself."""
    if by_word:
        return keys * np.uint64(_MIX64)
    return ((keys >> np.uint64(32)) * np.uint64(_MIX32) & _LOW) << np.uint64(32) | keys & _LOW


def _unmixed(mixed: np.ndarray, by_word: bool) -> np.ndarray:
    if by_word:
        return mixed * np.uint64(_BACK64)
    return ((mixed >> np.uint64(32)) * np.uint64(_BACK32) & _LOW) << np.uint64(32) | mixed & _LOW


def _of_large(keys: np.ndarray, large: np.ndarray) -> np.ndarray:
    """Whether the pairs' contexts are in ``large`` (sorted)."""
    if not len(large):
        return np.zeros(len(keys), bool)
    context = keys >> np.uint64(32)
    return large[np.minimum(np.searchsorted(large, context), len(large) - 1)] == context


def _pair_runs(args, large: np.ndarray):
    def run(batches):
        words = words_of(*args)
        for _, texts in _blocks(batches, 0):
            h, n = _sequences(texts)
            distinct, at = np.unique(h, return_inverse=True)
            keys, c = np.unique(_pairs(words.find(distinct)[0][at], n, words.size), return_counts=True)
            of_large = _of_large(keys, large)
            for by_word in (False, True):
                own = np.flatnonzero(of_large == by_word)
                mixed = _mixed(keys[own], by_word)
                order = np.argsort(mixed, kind="stable")
                runs = _runs(_shard_of(mixed[order], words.shards), words.shards, mixed[order], c[own][order].astype(np.uint32))
                yield runs.append_column("by_word", pa.array(np.full(runs.num_rows, by_word)))
    return run


def _merge_pairs(folder: str, shards: int, offsets: np.ndarray):
    """Write a shard of bigrams; send what its contexts and words get from it."""
    ranges = offsets[1:-1]

    def run(key, table):
        shard = key[0].as_py()
        by_word = np.array(table.column("by_word").to_pylist(), bool)
        parts = []
        for kind, name in ((False, "pairs"), (True, "large")):
            if (by_word == kind).any():
                keys, c = _merged(table.filter(pa.array(by_word == kind)), np.uint64)
                files.put(folder, f"{name}-{shard}", keys)
                files.put(folder, f"{name}_counts-{shard}", c.astype(np.uint32))
                parts.append((_unmixed(keys, kind), c))
        keys, c = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(keys, kind="stable")   # by context, then word
        keys, c = keys[order], c[order]
        context = keys >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        left = context[first].astype(np.uint32)
        sums = [np.add.reduceat(x, first) for x in (c, c == 1, c == 2, c > 2)]
        right, neighbours = np.unique((keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), return_counts=True)
        rows = []
        own = np.searchsorted(ranges, left, side="right"), np.searchsorted(ranges, right, side="right")
        there = np.unique(np.concatenate(own))
        cuts = [np.searchsorted(x, there, side=side).tolist() for x in own for side in ("left", "right")]
        for s, a, b, d, e in zip(there.tolist(), *cuts):
            rows.append((s, left[a:b].tobytes(), np.stack([x[a:b] for x in sums]).astype(np.int64).tobytes(),
                         right[d:e].tobytes(), neighbours[d:e].astype(np.uint32).tobytes()))
        seen = [int((c == k).sum()) for k in (1, 2, 3, 4)]
        cols = list(zip(*rows))
        n = len(rows)
        return pa.table({"shard": list(cols[0]), "left": list(cols[1]), "sums": list(cols[2]), "right": list(cols[3]),
                         "neighbours": list(cols[4]), "seen": [seen] + [[0] * 4] * (n - 1), "pairs": [len(keys)] + [0] * (n - 1)},
                        schema=pa.schema([("shard", pa.int64()), ("left", pa.binary()), ("sums", pa.binary()), ("right", pa.binary()),
                                          ("neighbours", pa.binary()), ("seen", pa.list_(pa.int64())), ("pairs", pa.int64())]))
    return run


def _merge_words_again(folder: str, shards: int, offsets: np.ndarray):
    """Write the totals of a range's contexts and the left neighbours of its words."""
    def run(key, table):
        s = key[0].as_py()
        low = int(offsets[s])
        size = int(offsets[s + 1]) - low + (s == shards - 1)   # the start mark stands behind the last word
        sums, neighbours = np.zeros((4, size), np.int64), np.zeros(size, np.int64)
        for left, x, right, n in zip(*[table.column(c).to_pylist() for c in ("left", "sums", "right", "neighbours")]):
            at = np.frombuffer(left, np.uint32).astype(np.int64) - low
            sums[:, at] += np.frombuffer(x, np.int64).reshape(4, -1)
            neighbours[np.frombuffer(right, np.uint32).astype(np.int64) - low] += np.frombuffer(n, np.uint32)
        files.put(folder, f"contexts-{s}", sums.T)   # four numbers a word
        files.put(folder, f"neighbours-{s}", neighbours)
        return pa.table({"shard": [s], "seen": [[int((neighbours == k).sum()) for k in (1, 2, 3, 4)]]},
                        schema=pa.schema([("shard", pa.int64()), ("seen", pa.list_(pa.int64()))]))
    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """The modified discounts for counts 0, 1, 2, 3 and more, kept inside (0, count)."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *[min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]])


class Scorer:
    """The mapped model of one job."""

    def __init__(self, folder, shards, bases, large, seen_pairs, seen_words, pairs, tokens):
        self.words = words_of(folder, shards, bases)
        self.large = np.array(large, np.uint64)
        self.pair_discount, self.word_discount = discounts(*seen_pairs), discounts(*seen_words)
        self.pairs_total, self.tokens = pairs, tokens
        self.pairs = [Arrays(folder, {name: np.uint64, f"{name}_counts": np.uint32}, shards) for name in ("pairs", "large")]
        # contexts and neighbours in the order of the numbers
        self.numbers = Arrays(folder, {"neighbours": np.int64, "contexts": np.int64}, shards, {"contexts": 4})
        size = self.words.size
        words_with = seen_words[0], seen_words[1], max(0, size - seen_words[0] - seen_words[1])
        self.rest = float(np.dot(self.word_discount[1:], words_with) / pairs) if pairs else 1.0

    def _of_numbers(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context sums (4 rows) and left neighbours of sorted known numbers."""
        sums, near = np.zeros((4, len(number)), np.int64), np.zeros(len(number), np.int64)
        # the start mark's number is behind the last word's, in the last shard's file
        of = np.minimum(np.searchsorted(self.words.bases[:-1], number, side="right") - 1, file_of(self.words.shards - 1, self.words.shards))
        cuts = np.searchsorted(of, np.arange(FILES + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = int(cuts[k]), int(cuts[k + 1])
            neighbours, contexts = self.numbers.file(k)
            at = number[a:b] - self.words.bases[k]
            sums[:, a:b], near[a:b] = contexts[at].T, neighbours[at]
        return sums, near

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of distinct sorted pairs."""
        out = np.zeros(len(keys), np.int64)
        of_large = _of_large(keys, self.large)
        for by_word, table in zip((False, True), self.pairs):
            own = np.flatnonzero(of_large == by_word)
            mixed = _mixed(keys[own], by_word)
            order = np.argsort(mixed, kind="stable")
            own, mixed = own[order], mixed[order]
            for k, a, b in table.parts(_shard_of(mixed, self.words.shards)):
                pairs, counts = table.file(k)
                if len(pairs):
                    at = np.minimum(np.searchsorted(pairs, mixed[a:b]), len(pairs) - 1)
                    out[own[a:b]] = np.where(pairs[at] == mixed[a:b], counts[at], 0)
        return out

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, base score and model score of each text."""
        h, n = _sequences(texts)
        if not len(n):
            return n, n, np.zeros(0), np.zeros(0)
        distinct, at = np.unique(h, return_inverse=True)
        number, count = self.words.find(distinct)
        size = self.words.size
        base = np.log10((count + 0.1) / (self.tokens + 0.1 * (size + 1)))
        order = np.argsort(number, kind="stable")
        known = order[number[order] < size]
        low = np.full(len(distinct), self.rest / (size + 1))
        if size and self.pairs_total:
            near = self._of_numbers(number[known])[1]
            low[known] += np.maximum(near - self.word_discount[np.minimum(near, 3)], 0) / self.pairs_total
        p = low[at]
        if size:
            pair, where = np.unique(_pairs(number[at], n, size), return_inverse=True)
            context = (pair >> np.uint64(32)).astype(np.int64)
            c = self._pair_counts(pair)
            sums = np.zeros((4, len(pair)), np.int64)
            some = np.flatnonzero(context <= size)   # the start mark's number is ``size``
            each, back = np.unique(context[some], return_inverse=True)
            sums[:, some] = self._of_numbers(each)[0][:, back]
            total = np.maximum(sums[0], 1)
            d = self.pair_discount
            weight = np.where(sums[0] > 0, (d[1] * sums[1] + d[2] * sums[2] + d[3] * sums[3]) / total, 1.0)
            high = np.maximum(c - d[np.minimum(c, 3)], 0) / total
            p = high[where] + weight[where] * p
        first = np.cumsum(n) - n
        return (n, np.add.reduceat((count[at] > 0).astype(np.int64), first),
                np.add.reduceat(base[at], first), np.add.reduceat(np.log10(p), first))


@lru_cache(maxsize=1)
def scorer_of(*args) -> Scorer:
    return Scorer(*args)


def _score_batches(args):
    def run(batches):
        model = scorer_of(*args)
        for held, texts in _blocks(batches, 2):
            n, known, base, score = model.scores(texts)
            at = 0
            for b in held:
                part = slice(at, at + b.num_rows)
                at += b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n[part], pa.int64()), pa.array(known[part], pa.int64()),
                     pa.array(np.full(b.num_rows, model.tokens), pa.int64()), pa.array(base[part]), pa.array(score[part])], names=COLUMNS)
    return run


COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def train(texts: DataFrame, shards: int | None = None) -> tuple:
    """Count the texts (one string column); what :func:`scorer_of` takes."""
    spark = texts.sparkSession
    folder = scratch_path(spark, "language-model")
    if shards is None:
        size = texts.agg(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0
        shards = max(shuffle_partitions(spark), -(-size // (6 * SHARD_TOKENS)))
    made = (texts.mapInArrow(_word_runs(shards), "shard long, a0 binary, a1 binary").groupBy("shard")
            .applyInArrow(_merge_words(folder), "shard long, words long, tokens long, common array<long>, counts array<long>").collect())   # a row a shard
    words = np.zeros(shards, np.int64)
    for r in made:
        words[r["shard"]] = r["words"]
    offsets = np.concatenate([[0], np.cumsum(words)])
    tokens, size = sum(r["tokens"] for r in made), int(offsets[-1])
    if size >= 2**32 - 2:
        raise ValueError("the vocabulary has more words than 32-bit numbers")
    if not size:
        return folder, shards, (0,) * (FILES + 1), (), (0,) * 4, (0,) * 4, 0, 0
    bases = tuple([0, *np.cumsum([n // 8 for n in join(spark, folder, "words", shards)]).tolist()])
    join(spark, folder, "counts", shards)
    # contexts with a large part of a shard's tokens, spread over all shards; and the start mark
    large = sorted([size, *[int(offsets[r["shard"]]) + i for r in made for i, c in zip(r["common"], r["counts"])
                            if c > tokens // (4 * shards)]])
    sent = (texts.mapInArrow(_pair_runs((folder, shards, bases), np.array(large, np.uint64)), "shard long, a0 binary, a1 binary, by_word boolean")
            .groupBy("shard").applyInArrow(_merge_pairs(folder, shards, offsets),
                                           "shard long, left binary, sums binary, right binary, neighbours binary, seen array<long>, pairs long"))
    sent = materialise(sent, "neighbours")
    facts = sent.agg(F.sum("pairs"), *[F.sum(F.col("seen")[k]) for k in range(4)]).first()
    again = sent.groupBy("shard").applyInArrow(_merge_words_again(folder, shards, offsets), "shard long, seen array<long>")
    near = again.agg(*[F.sum(F.col("seen")[k]) for k in range(4)]).first()
    remove(sent)
    for name in ("pairs", "pairs_counts", "large", "large_counts", "contexts", "neighbours"):
        join(spark, folder, name, shards)
    return folder, shards, bases, tuple(large), tuple(facts[1:]), tuple(near), facts[0], tokens


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, shards: int | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of
    every row; rows whose ``crc32(id as text) mod folds`` is 0 are held out."""
    prepare(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    d = d.select("doc_id", (crc_mod(F.col("doc_id"), folds) == 0).alias("held_out"), "text")
    model = train(d.where(~F.col("held_out")).select("text"), shards)
    schema = T.StructType([d.schema["doc_id"], T.StructField("held_out", T.BooleanType())]
                          + [T.StructField(c, T.LongType()) for c in COLUMNS[2:5]] + [T.StructField(c, T.DoubleType()) for c in COLUMNS[5:]])
    return d.mapInArrow(_score_batches(model), schema)
