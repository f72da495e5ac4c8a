"""Operator 5: packing by lexical retrieval.

Texts become token ids.  Like documents are dealt together into shards of about
``shard_rows`` rows, so that a shard's index finds a seed's neighbours however
many shards there are: a document's BM25 weights are projected onto ``AXES``
random signs, a tree grown on a sample of the projections halves them along
their widest direction, and a leaf is a shard.  A leaf that cannot be halved
(copies of one text) or holds very long documents is dealt out by a hash into as
many shards as its rows and tokens need.  Neighbours that the tree parts do not
meet; a table of one shard is searched as a whole.

A shard has its own BM25 inverted index over token ids, with document
frequencies and mean length taken over all documents.  Whole
windows of a long document are sequences of their own.  What is left of each
document is an item of its shard: the first unused item seeds a window, the
index returns the unused items most like it, and these fill the window
greedily; all distinct tokens of the seed ask.  When no item that fits whole is left among those returned, the best
one is cut to fill the rest and its remainder goes back as an item.  The last
window of a shard is cut into sequences whose lengths are powers of two, which
need no padding.

Documents that come in an order of training are first cut into turns, ranges of
that order: a turn has shards and a tree of its own, a shard's seeds are taken in
the order, and sequence ids rise from turn to turn.  Neighbours are those of the
same turn.

Cases: null text counts as empty; every document ends with ``end_id``, so an
empty one is one token; repeated rows are documents of their own; null ids are
kept; an empty table gives an empty one.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import hashed_words, materialise, mix64, prepare, row_key, text_bytes

K1, B = 1.2, 0.75
#: Distinct tokens of a seed that ask the index: all, whatever the vocabulary.
QUERY_TERMS = 1 << 32
#: A token of more than one item in so many has a row of weights for all of the shard.
COMMON = 8
#: Dimensions of a document's projection; projections a shard and at most that the tree is grown on.
AXES, SAMPLE_A_SHARD, SAMPLE = 64, 16, 1 << 17
#: Words, and runs of letters or marks, whose ids a Python worker remembers (it keeps them between
#: tasks and stages, a worker a core); bytes of text that it takes at once, unless one text has more.
CACHE_WORDS, CACHE_PARTS, BLOCK = 1_000_000, 100_000, 1 << 20


def _byte_letters() -> dict[str, str]:
    """How byte-level vocabularies write the lower-case letters up to U+00FF: a
    printable byte stands for itself, the others for the characters from 256 on.
    (No sign is such a letter itself, so they can be put in one after the other.)"""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {b: chr(b) for b in shown}
    sign |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in sign)}
    return {chr(c): "".join(sign[b] for b in chr(c).encode()) for c in range(0xDF, 0x100) if c != 0xF7}


class Encoder:
    """Token ids of whole texts, word by word through a table of known words.

    The tokenizer splits at white space before it merges, so a text's ids are
    those of its words one after the other.  The words of many texts are hashed at
    once (64 bits); the table has, by hash, where a word's ids lie in one array, from which
    the texts' ids are gathered.  A full table keeps the words that came again since
    they were learned, or since it was full before.  A word of letters with marks behind
    it falls into the two (the tokenizer splits there too); unknown runs of
    letters are encoded many at a time and told apart by the tokens that end a
    word.  Everything else goes to the tokenizer as it is.
    """

    #: Letters that normalisation and lower-casing change each for itself, then marks; or anything else.
    WORD = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)(?: |$)|([^ ]+)(?: |$)")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the same model without what runs of letters do not need; only if it gives the same ids
        self.letters, self.table = Tokenizer(self.tokenizer.model), _byte_letters()
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        probe = [chr(c) * 2 + w for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7) for w in ("", "and", "tion")]
        if self._letter_ids(probe) != self.tokenizer.encode(" ".join(probe), add_special_tokens=False).ids:
            self.letters, self.table = self.tokenizer, {}
        spec = json.load(open(path))
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        end = spec["model"].get("end_of_word_suffix")
        self.word_end = np.zeros(self.size, bool)
        if end:
            self.word_end[[i for t, i in vocab.items() if t.endswith(end)]] = True
        self.special = [t["content"].encode().lower() for t in spec["added_tokens"]]
        self.special_start = os.path.commonprefix(self.special)
        self.by_word = bool(end)
        self.known = np.empty(0, np.uint64)   # hashes in order, and where their ids are
        self.first, self.length = np.empty(0, np.int64), np.empty(0, np.int32)
        self.again = np.empty(0, bool)
        self.pool = np.empty(0, self.dtype)
        self.parts: dict[str, bytes] = {"": b""}

    def _forget(self) -> None:
        """Keep the words that came again, none of them if they fill half the table."""
        keep = np.flatnonzero(self.again)
        keep = keep[:0] if 2 * len(keep) > CACHE_WORDS else keep
        n = self.length[keep]
        before = np.cumsum(n, dtype=np.int64) - n
        self.pool = self.pool[np.repeat(self.first[keep] - before, n) + np.arange(int(n.sum()))]
        self.known, self.first, self.length = self.known[keep], before, n
        self.again = np.zeros(len(keep), bool)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _letter_ids(self, runs: list[str]) -> list[int]:
        text = " ".join(runs)
        if self.table:
            text = text.lower()
            for letter, signs in self.table.items():
                text = text.replace(letter, signs)
        return self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn_letters(self, runs: list[str]) -> None:
        n = self.dtype.itemsize
        for i in range(0, len(runs), 500):
            part = runs[i:i + 500]
            ids = np.array(self._letter_ids(part), self.dtype)
            stops = (np.flatnonzero(self.word_end[ids]) + 1) * n
            if len(stops) != len(part):   # not with this vocabulary; then one at a time
                self.parts.update((w, self._ids(w)) for w in part)
                continue
            raw, at = ids.tobytes(), 0
            for w, stop in zip(part, stops.tolist()):
                self.parts[w] = raw[at:stop]
                at = stop

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Add words to the table, by their hashes in order."""
        found = self.WORD.findall(b" ".join(words).decode())
        if len(self.parts) > CACHE_PARTS:
            self.parts = {"": b""}
        parts = self.parts
        self._learn_letters(list({f[0] for f in found}.difference(parts)))
        for m in {f[1] for f in found}.difference(parts):
            parts[m] = self._ids(m)
        new = [self._ids(other) if other else parts[letters] + parts[marks] for letters, marks, other in found]
        length = np.fromiter(map(len, new), np.int64, len(new)) // self.dtype.itemsize
        at = np.searchsorted(self.known, hashes)
        self.first = np.insert(self.first, at, len(self.pool) + np.cumsum(length) - length)
        self.length, self.known = np.insert(self.length, at, length), np.insert(self.known, at, hashes)
        self.again = np.insert(self.again, at, False)
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(new), self.dtype)])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian bytes of ``dtype``."""
        collecting = gc.isenabled()
        gc.disable()   # many small objects and no cycles
        try:
            out, first, size = [], 0, 0
            for i, t in enumerate(texts):
                if size and size + len(t) > BLOCK:
                    out += self._encode(texts[first:i])
                    first, size = i, 0
                size += len(t)
            return out + self._encode(texts[first:])
        finally:
            if collecting:
                gc.enable()

    def _whole(self, text: bytes) -> bool:
        """Whether a text cannot go word by word."""
        if not self.by_word:
            return True
        low = text.lower()
        return self.special_start in low and any(s in low for s in self.special)

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:
            self._forget()
        whole = {i for i, t in enumerate(texts) if self._whole(t)}
        h, per_text, buf, starts, lengths = hashed_words([b"" if i in whole else t for i, t in enumerate(texts)])
        distinct, of = np.unique(h, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        there = at < len(self.known)
        there[there] = self.known[at[there]] == distinct[there]
        self.again[at[there]] = True
        new = np.flatnonzero(~there)
        if len(new):
            where = np.empty(len(distinct), np.int64)
            where[of] = np.arange(len(of))   # some place of each word
            spans = zip(starts[where[new]].tolist(), lengths[where[new]].tolist())
            raw = buf.tobytes()
            self._learn(distinct[new], [raw[a:a + n].lower() for a, n in spans])
            at = np.searchsorted(self.known, distinct)
        n = self.length[at][of]
        shift = self.first[at][of] - (np.cumsum(n) - n)
        ids = self.pool[np.repeat(shift, n) + np.arange(int(n.sum()))].tobytes()
        stops = np.concatenate([[0], np.cumsum(n)])[np.cumsum(per_text)] * self.dtype.itemsize
        out, before = [], 0
        for i, stop in enumerate(stops.tolist()):
            out.append(self._ids(texts[i].decode()) if i in whole else ids[before:stop])
            before = stop
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _blocks(batches, column: int):
    """Lists of whole batches with some ``BLOCK`` bytes of text, and their texts."""
    held, texts, size = [], [], 0
    for b in batches:
        own = text_bytes(b.column(column))
        held.append(b)
        texts += own
        size += sum(map(len, own))
        if size >= BLOCK:
            yield held, texts
            held, texts, size = [], [], 0
    if held:
        yield held, texts


def _token_batches(path: str, end_id: int):
    """Token ids of each row; last a row with ``n = -1`` that holds in how many rows
    of this task each id occurs."""
    def run(batches):
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        names, kinds = ["doc_id", "shard_key", "place", "ids", "n"], None
        df, place = np.zeros(enc.size, np.int64), np.zeros(enc.size, np.int64)
        for held, texts in _blocks(batches, 3):
            encoded, at = enc.encode(texts), 0
            for b in held:
                rows = [x + end for x in encoded[at:at + b.num_rows]]
                at += b.num_rows
                for x in rows:
                    ids = np.frombuffer(x, enc.dtype)
                    every = np.arange(len(ids))
                    place[ids] = every
                    df[ids[place[ids] == every]] += 1   # each id where it stands last
                kinds = b.schema.types[:3]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:3], pa.array(rows, pa.binary()),
                     pa.array([len(x) // enc.dtype.itemsize for x in rows], pa.int64())], names)
        if kinds:
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(1, k) for k in kinds], pa.array([df.tobytes()], pa.binary()), pa.array([-1], pa.int64())], names)
    return run


def _frequencies(batches):
    for b in batches:
        for x in b.column(0).to_pylist():
            df = np.frombuffer(x, np.int64)
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])


@lru_cache(maxsize=2)
def _signs(size: int) -> np.ndarray:
    return np.random.default_rng(5).integers(0, 2, (size, AXES)).astype(np.float32) * 2 - 1


def projections(rows: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """The documents' token weights on the random axes, each of length 1.  The weights
    are whole numbers, so that the sums are exact in any order."""
    kind = np.uint32 if len(idf) * len(rows) < 1 << 32 else np.uint64
    key = np.concatenate(rows).astype(kind) + np.repeat(np.arange(len(rows), dtype=kind) * kind(len(idf)), list(map(len, rows)))
    key.sort()   # (document, token): a token's run is its count
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    tf = np.diff(first, append=len(key))
    row, t = np.divmod(key[first], kind(len(idf)))
    w = np.rint(8 * idf[t] * tf * (K1 + 1) / (tf + K1)).astype(np.float32)
    at, signs = np.searchsorted(row, np.arange(len(rows) + 1)).tolist(), _signs(len(idf))
    x = np.array([w[i:j] @ signs[t[i:j]] for i, j in zip(at[:-1], at[1:])]).astype(np.float64)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1.0)


class Tree:
    """Leaves of like documents, grown on a sample of projections."""

    def __init__(self):
        self.axis, self.cut, self.child, self.parts = [], [], [], []

    def grow(self, points: np.ndarray, rows: np.ndarray, tokens: np.ndarray, shard_rows: float, shard_tokens: float) -> int:
        """Add a tree for points that stand for so many rows and tokens each; its root."""
        leaves = int(-(-rows.sum() // shard_rows))
        if leaves > 1:
            mid = points - points.mean(axis=0)
            axis = np.linalg.eigh(mid.T @ mid)[1][:, -1]
            at = (points * axis).sum(axis=1)
            order = np.argsort(at, kind="stable")
            below = np.cumsum(rows[order])
            cut = at[order[min(np.searchsorted(below, below[-1] * (leaves // 2) / leaves, side="right"), len(at) - 1)]]
            if cut - at.min() < 1e-9:
                cut = at[at - at.min() > 1e-9].min(initial=np.inf)
            up = at >= cut
            if up.any():
                node = len(self.cut)
                self.axis.append(axis), self.cut.append(cut), self.child.append(None)
                self.child[node] = [self.grow(points[k], rows[k], tokens[k], shard_rows, shard_tokens) for k in (~up, up)]
                return node
        self.parts.append(max(1, round(rows.sum() / shard_rows), int(-(-tokens.sum() // shard_tokens))))
        return -len(self.parts)

    def close(self, roots: list[int]) -> Tree:
        self.roots = np.array(roots)
        self.axis, self.cut = np.array(self.axis).reshape(-1, AXES), np.array(self.cut)
        self.child, self.parts = np.array(self.child, np.int64).reshape(-1, 2), np.array(self.parts, np.int64)
        self.base = np.cumsum(self.parts) - self.parts
        return self

    def shards(self, points: np.ndarray, turns: np.ndarray, keys: np.ndarray) -> np.ndarray:
        node = self.roots[turns]
        while len(go := np.flatnonzero(node >= 0)):
            at = node[go]
            node[go] = self.child[at, ((points[go] * self.axis[at]).sum(axis=1) >= self.cut[at]).astype(np.int64)]
        leaf = -node - 1
        return self.base[leaf] + (mix64(keys.view(np.uint64)) % self.parts[leaf].astype(np.uint64)).astype(np.int64)


def _projections(dtype: str, idf: np.ndarray):
    def run(batches):
        for b in batches:
            rows = [np.frombuffer(i, dtype) for i in b.column(3).to_pylist()]
            x = [p.tobytes() for p in projections(rows, idf)] if rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(x, pa.binary())], ["turn", "shard_key", "n", "point"])
    return run


def _deal_batches(dtype: str, idf: np.ndarray, tree):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            points = projections([np.frombuffer(i, dtype) for i in b.column(3).to_pylist()], idf)
            turns, keys = (b.column(k).to_numpy(zero_copy_only=False) for k in (4, 1))
            shard = tree.value.shards(points, turns.astype(np.int64), keys)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(shard)], ["doc_id", "shard_key", "place", "ids", "shard"])
    return run


class ShardIndex:
    """BM25 over the items of one shard."""

    def __init__(self, items: list[np.ndarray], idf: np.ndarray, mean: float):
        self.items, self.idf, self.n = items, idf, len(items)
        sizes = np.fromiter(map(len, items), np.int64, self.n)
        # (term, item) as one number: sorted, its runs are the postings
        kind = np.uint32 if len(idf) * self.n < 1 << 32 else np.uint64
        key = np.concatenate(items).astype(kind) * kind(self.n) + np.repeat(np.arange(self.n, dtype=kind), sizes)
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        tf = np.diff(first, append=len(key))
        term, self.docs = np.divmod(key[first], kind(self.n))
        self.docs = self.docs.astype(np.int64)
        self.weights = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[self.docs] / mean))
        self.at = np.searchsorted(term, np.arange(len(idf) + 1))
        # tokens of many items also have their weights in a row, an item a column
        common = np.flatnonzero(np.diff(self.at) * COMMON > self.n)
        self.row = np.full(len(idf), -1)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), self.n))
        held = self.row[term] >= 0
        self.rows[self.row[term[held]], self.docs[held]] = self.weights[held]

    def neighbours(self, seed: int, unused: np.ndarray, most: int) -> np.ndarray:
        """Unused items by falling score, at most ``most``; unlike ones come last."""
        t = np.unique(self.items[seed])
        row = self.row[t]
        t = t[row < 0]
        spans = list(zip(self.at[t].tolist(), self.at[t.astype(np.int64) + 1].tolist()))
        score = np.zeros(self.n)
        if spans:
            score += np.bincount(np.concatenate([self.docs[a:b] for a, b in spans]),
                                 np.concatenate([self.weights[a:b] for a, b in spans]), self.n)
        for k in row[row >= 0].tolist():
            score += self.rows[k]
        score = np.where(unused, score, -1.0)
        top = np.argpartition(-score, most)[:most] if most < self.n else np.arange(self.n)
        top = top[unused[top]]
        return top[np.lexsort((top, -score[top]))]


def pack_shard(lengths: list[int], ids: list[np.ndarray], idf: np.ndarray, mean: float, window: int, returned: int = 64):
    """Pieces ``(document, start, length, sequence, offset)`` of one shard."""
    pieces, sequence = [], 0
    items = []   # (document, start): what is left behind whole windows
    for d, n in enumerate(lengths):
        at = 0
        while n - at >= window:
            pieces.append((d, at, window, sequence, 0))
            sequence += 1
            at += window
        if at < n:
            items.append([d, at])
    if not items:
        return pieces
    left = np.array([lengths[d] - at for d, at in items])
    index = ShardIndex([ids[d][at:] for d, at in items], idf, mean)
    unused = np.ones(len(items), bool)
    last, nxt = [], 0
    while nxt < len(items):
        if not unused[nxt]:
            nxt += 1
            continue
        room, placed = window, []
        cut, chosen = None, [nxt]
        unused[nxt] = False
        room -= left[nxt]
        while room > 0 and unused.any():
            found = index.neighbours(chosen[0], unused, returned)
            if not len(found):
                break
            for i in found:
                if left[i] <= room:
                    chosen.append(i)
                    unused[i] = False
                    room -= left[i]
                    if not room:
                        break
            else:
                rest = [i for i in found if unused[i]]
                if rest:
                    cut = rest[0]
                    break
        offset = 0
        for i in chosen:
            placed.append((items[i][0], items[i][1], int(left[i]), sequence, offset))
            offset += int(left[i])
        if cut is not None and room > 0:
            placed.append((items[cut][0], items[cut][1], int(room), sequence, offset))
            items[cut][1] += int(room)
            left[cut] -= room
            room = 0
            nxt = min(nxt, int(cut))
        if room:
            last = placed
            break
        pieces += placed
        sequence += 1
    # the last window: sequences whose lengths are powers of two
    total = sum(p[2] for p in last)
    sizes = [1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1]
    used = 0
    for d, at, n, _, _ in last:
        while n:
            take = min(n, sizes[0] - used)
            pieces.append((d, at, take, sequence, used))
            at, n, used = at + take, n - take, used + take
            if used == sizes[0]:
                sizes, used, sequence = sizes[1:], 0, sequence + 1
    return pieces


def _pack_batches(dtype: str, idf: np.ndarray, mean: float, window: int):
    def run(key, table):
        table = table.sort_by([("place", "ascending"), ("doc_id", "ascending"), ("shard_key", "ascending")])
        raw = table.column("ids").to_pylist()
        ids = [np.frombuffer(x, dtype) for x in raw]
        p = np.array(pack_shard([len(x) for x in ids], ids, idf, mean, window), np.int64).reshape(-1, 5)
        crc = [zlib.crc32(ids[d][a:a + n].astype("<u4").tobytes()) for d, a, n, _, _ in p.tolist()]
        base = (key[0].as_py() << 32)
        return pa.Table.from_arrays(
            [table.column("doc_id").take(pa.array(p[:, 0])), pa.array(p[:, 1]), pa.array(p[:, 2]), pa.array(crc, pa.int64()),
             pa.array(np.array([len(x) for x in ids], np.int64)[p[:, 0]]), pa.array(p[:, 3] + base), pa.array(p[:, 4])],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def _tree(tokens: DataFrame, dtype: str, idf: np.ndarray, rows: int, total: int, turns: int, shard_rows: int) -> Tree:
    """A tree for each turn.  Its sample is chosen by a hash of the rows, so a table gives one tree."""
    shards = -(-rows // shard_rows)
    tree = Tree()
    if shards <= turns:
        return tree.close([tree.grow(np.zeros((1, AXES)), np.ones(1), np.ones(1), 2, 2) for _ in range(turns)])
    share = min(1.0, min(max(SAMPLE_A_SHARD * shards, 4096), SAMPLE) / rows)
    picked = (tokens.where(F.pmod(F.xxhash64("shard_key", F.lit(7)), F.lit(1 << 20)) < round(share * (1 << 20)))
              .select("turn", "shard_key", "n", "ids").mapInArrow(_projections(dtype, idf), "turn long, shard_key long, n long, point binary")
              .groupBy("turn", "shard_key").agg(F.first("point").alias("point"), F.count("*").alias("rows"), F.sum("n").alias("tokens"))
              .orderBy("turn", "shard_key").collect())   # at most about SAMPLE rows
    of = np.array([r["turn"] for r in picked], np.int64)
    points = np.frombuffer(b"".join(r["point"] for r in picked), np.float64).reshape(-1, AXES)
    n, long = (np.array([r[c] for r in picked], np.float64) / share for c in ("rows", "tokens"))
    return tree.close([tree.grow(points[of == k], n[of == k], long[of == k], shard_rows, 3 * shard_rows * total / rows) for k in range(turns)])


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048,
         end_id: int = 1, shard_rows: int = 1500, order_col: str | None = None, turns: int = 16) -> DataFrame:
    """One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    With ``order_col`` (places from 0 on) sequences follow that order, see above.
    """
    spark = docs.sparkSession
    prepare(spark)
    enc = encoder(tokenizer_path)
    dtype, size = enc.dtype.str, enc.size
    text = F.col(text_col).cast("string")
    d = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(id_col), text).alias("shard_key"),
                    (F.lit(0) if order_col is None else F.coalesce(F.col(order_col), F.lit(0))).cast("long").alias("place"), text.alias("text"))
    id_type = d.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("shard_key", T.LongType()), T.StructField("place", T.LongType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("n", T.LongType())])
    tokens = materialise(d.mapInArrow(_token_batches(tokenizer_path, end_id), schema), "tokens", "snappy")
    counted, tokens = tokens.where("n < 0"), tokens.where("n > 0")
    rows, total, last = tokens.agg(F.count("*"), F.sum("n"), F.max("place")).first()
    df = np.zeros(size)
    for term, n in (counted.select("ids").mapInArrow(_frequencies, "term long, df long")
                    .groupBy("term").agg(F.sum("df")).collect()):   # at most the vocabulary
        df[term] = n
    rows, total = rows or 0, total or 1
    idf = np.log1p((rows - df + 0.5) / (df + 0.5))
    turns = 1 if order_col is None else max(1, min(turns, -(-rows // shard_rows)))
    tokens = tokens.withColumn("turn", F.floor(F.col("place") * F.lit(turns) / F.lit((last or 0) + 1)).cast("long"))
    tree = spark.sparkContext.broadcast(_tree(tokens, dtype, idf, rows, total, turns, shard_rows))
    out = T.StructType([T.StructField("doc_id", id_type)] + [T.StructField(c, T.LongType()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
    dealt = T.StructType([*schema.fields[:4], T.StructField("shard", T.LongType())])
    return (tokens.select("doc_id", "shard_key", "place", "ids", "turn").mapInArrow(_deal_batches(dtype, idf, tree), dealt)
            .groupBy("shard").applyInArrow(_pack_batches(dtype, idf, total / max(rows, 1), window), out))
