"""Operator 4: repeated substrings, found by external induced sorting, leave all documents but the first.

A byte goes when a string of ``length`` bytes covers it that also starts in a
document with a smaller id.

A string's anchor is the least hash of its ``GRAM``-byte pieces, so equal strings
have equal anchors wherever they stand.  Neighbouring strings with one anchor make
a stretch; a text is cut into stretches of about 60 bytes.  Three passes over the
texts:

1. Sorted anchors go to shards by range, which keep those of several documents.
2. Stretches with a kept anchor go to the anchor's shard.  Of equal stretches of
   one task only those of the smallest id travel: the others are repeats already.
   A shard sorts the suffixes of its distinct stretches (``suffix_sort``); strings
   are runs of suffixes that agree in ``length`` bytes, the smallest id of a run
   decides for all of them.
3. What goes, filed by document in the shared folder, is looked up, and the texts
   are cut.

All strings of an anchor meet in one shard, so nothing is missed.  An anchor of more
than ``HOT`` stretches is no group of its own: its stretches (those at the edges of
a common passage run into each document's own text and differ) are dealt out as
single strings by a hash of the string, of equal ones of a task only those of the
smallest id.  Equal strings still meet, and a string in a third of all documents
reaches its shard once from each part of a task.

Cases: null text counts as empty; texts shorter than ``length`` stay; ids are
integers, a null id counts as larger than all others; rows of one id do not make
each other's text go; an empty table gives an empty one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm import shared_files as files
from tidewatch.llm.common import mix64, prepare, row_key, shuffle_partitions, text_bytes
from tidewatch.llm.sorted_files import Arrays, join
from tidewatch.llm.suffix_sort import between, suffix_array
from tidewatch.session import scratch_path

GRAM = 24
#: Strings of one stretch at most: as many as a mask has bits.
STRETCH = 32
#: Bytes of text that a task holds at a time, and that a shard is sized for.
FLUSH, SHARD_BYTES = 4 << 20, 4 << 20
#: Stretches of an anchor above which they are dealt out by their strings, and how many a task cuts up at a time.
HOT, CUT_UP = 4096, 4096
_LAST = np.iinfo(np.int64).max
_CODE = np.random.default_rng(4242).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Polynomial hash of the ``GRAM`` bytes from each position, by doubling."""
    h, have, out, done = _CODE[buf], 1, None, 0
    while have <= GRAM:
        if GRAM & have:   # the binary digits of GRAM
            tail = h[done:]
            out = h if out is None else out[:len(tail)] + np.uint64(pow(_BASE, done, 1 << 64)) * tail[:len(out)]
            done += have
        if have * 2 <= GRAM:
            h = h[:-have] + np.uint64(pow(_BASE, have, 1 << 64)) * h[have:]
        have *= 2
    return out


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    rest = width - have
    return np.minimum(h[:len(h) - rest], h[rest:]) if rest else h


class Stretches:
    """The stretches of some texts: document, first string's place, strings, anchor."""

    def __init__(self, texts: list[bytes], length: int):
        self.buf = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        self.first = ends - sizes
        none = np.empty(0, np.int64)
        self.doc, self.at, self.n, self.anchor = none, none, none, np.empty(0, np.uint64)
        strings = np.maximum(sizes - length + 1, 0)
        if not strings.sum():
            return
        low = _least(_gram_hashes(self.buf), length - GRAM + 1)   # one for each string of the joined texts
        inside = np.zeros(len(self.buf) + 1, np.int64)
        has = strings > 0
        np.add.at(inside, self.first[has], 1)
        np.add.at(inside, (self.first + strings)[has], -1)
        inside = np.cumsum(inside)[:len(low)] > 0
        new = np.concatenate([[True], low[1:] != low[:-1]])
        new[self.first[has]] = True
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        new[edge] = True
        start = np.flatnonzero(new)
        run = np.diff(start, append=len(low))
        start, run = start[inside[start]], run[inside[start]]
        pieces = -(-run // STRETCH)
        part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.at = np.repeat(start, pieces) + part * STRETCH
        self.n = np.minimum(np.repeat(run, pieces) - part * STRETCH, STRETCH)
        self.anchor = mix64(low[self.at])   # least hashes are small; the shards need them spread
        self.doc = np.searchsorted(ends, self.at, side="right")


def _flushes(batches, text_at: int):
    held, texts, size = [], [], 0
    for b in batches:
        t = text_bytes(b.column(text_at))
        held.append(b)
        texts += t
        size += sum(map(len, t))
        if size >= FLUSH:
            yield held, texts
            held, texts, size = [], [], 0
    if held:
        yield held, texts


def _column(held, k: int, fill: int) -> np.ndarray:
    return np.concatenate([b.column(k).fill_null(fill).to_numpy(zero_copy_only=False) for b in held]).astype(np.int64)


def _shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _anchor_runs(length: int, shards: int):
    """Each flush's distinct anchors in order, the lowest bit set if several documents have it."""
    def run(batches):
        for held, texts in _flushes(batches, 2):
            s = Stretches(texts, length)
            if not len(s.at):
                continue
            owner = _column(held, 0, _LAST)[s.doc]
            order = np.argsort(s.anchor, kind="stable")
            a, owner = s.anchor[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
            many = np.minimum(np.diff(first, append=len(a)), 65535).astype(np.uint16)
            a = a[first]
            runs = list(_runs_of(_shard_of(a, shards)))
            a = (a & ~np.uint64(1)) | several
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _, _ in runs], pa.int64()), pa.array([a[i:j].tobytes() for _, i, j in runs], pa.binary()),
                 pa.array([many[i:j].tobytes() for _, i, j in runs], pa.binary())], names=["shard", "anchors", "counts"])
    return run


def _keep_anchors(folder: str, hot: int):
    """Anchors of several flushes or documents; equal ids in two flushes only cost a look.  Of these, the hot ones."""
    def run(key, table):
        a, counts = _joined(table, "anchors", np.uint64), _joined(table, "counts", np.uint16)
        order = np.argsort(a)
        a, counts = a[order], counts[order]
        h = a >> np.uint64(1)
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        many = (np.diff(first, append=len(h)) > 1) | ((a[first] & np.uint64(1)) > 0)
        many |= (np.maximum.reduceat(a, first) & np.uint64(1)) > 0
        kept = h[first[many]]
        files.put(folder, f"anchors-{key[0].as_py()}", kept)
        often = h[first[many & (np.add.reduceat(counts, first, dtype=np.int64) > hot)]]
        if len(often):
            files.put(folder, f"hot-{key[0].as_py()}", often)
        return pa.table({"shard": [key[0].as_py()], "n": [len(kept)], "hot": [len(often)]})
    return run


@lru_cache(maxsize=4)
def _anchors(folder: str, shards: int, name: str = "anchors") -> Arrays:
    return Arrays(folder, {name: np.uint64}, shards)


def _listed(anchors: np.ndarray, shard: np.ndarray, lists: Arrays) -> np.ndarray:
    """Which of the sorted anchors (and their shards) are listed."""
    found = np.zeros(len(anchors), bool)
    for k, a, b in lists.parts(shard):
        own = lists.file(k)[0]
        if len(own):
            h = anchors[a:b] >> np.uint64(1)
            found[a:b] = own[np.minimum(np.searchsorted(own, h), len(own) - 1)] == h
    return found


def _runs_of(shard: np.ndarray):
    """``(shard, first, behind the last)`` of the runs of a sorted array."""
    if len(shard):
        first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        yield from zip(shard[first].tolist(), first.tolist(), [*first[1:].tolist(), len(shard)])


def _single_strings(s: Stretches, pick: np.ndarray, owner: np.ndarray, row: np.ndarray, length: int, shards: int):
    """The strings of some stretches for the shard of the string (kind 2); those of larger ids, by document (kind 1)."""
    grams = _gram_hashes(s.buf)
    windows = np.lib.stride_tricks.sliding_window_view(s.buf, length)
    for i in range(0, len(pick), CUT_UP):
        p = pick[i:i + CUT_UP]
        n = s.n[p]
        at = np.repeat(s.at[p] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        doc = np.repeat(s.doc[p], n)
        own, key, place = owner[doc], row[doc], at - s.first[doc]
        data = np.ascontiguousarray(windows[at]).view(f"S{length}").ravel()
        later = own > _least_of_equal(data, own)
        if later.any():
            yield from _filed(key[later], place[later], np.ones(later.sum(), np.uint32), shards)
        go = np.flatnonzero(~later)
        h = np.zeros(len(go), np.uint64)
        for k in {*range(0, length - GRAM, GRAM), length - GRAM}:
            h = mix64(h ^ grams[at[go] + k])
        to = _shard_of(h, shards)
        order = np.argsort(to, kind="stable")
        go = go[order]
        rows = [(2, k, own[go[a:b]].tobytes(), key[go[a:b]].tobytes(), place[go[a:b]].astype(np.uint32).tobytes(), b"", data[go[a:b]].tobytes())
                for k, a, b in _runs_of(to[order])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SENT_TYPES)], names=_SENT_NAMES)


def _least_of_equal(data: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """For each string, the smallest owner of its equals."""
    distinct, back = np.unique(data, return_inverse=True)
    least = np.full(len(distinct), _LAST)
    np.minimum.at(least, back, owners)
    return least[back]


_SENT = "kind int, shard long, owners binary, keys binary, places binary, strings binary, bytes binary"
_SENT_NAMES = ["kind", "shard", "owners", "keys", "places", "strings", "bytes"]


def _stretch_runs(folder: str, length: int, shards: int):
    """Stretches for their shard (kind 0); what a task found by itself, by document (kind 1);
    strings of hot anchors for theirs (kind 2)."""
    def run(batches):
        kept, often = _anchors(folder, shards), _anchors(folder, shards, "hot")
        for held, texts in _flushes(batches, 2):
            s = Stretches(texts, length)
            if not len(s.at):
                continue
            owner, row = _column(held, 0, _LAST), _column(held, 1, 0).view(np.uint64)
            anchors, back = np.unique(s.anchor, return_inverse=True)
            shard = _shard_of(anchors, shards)
            known, single = _listed(anchors, shard, kept), _listed(anchors, shard, often)[back]
            pick = np.flatnonzero(known[back])
            if not len(pick):
                continue
            to = shard[back[pick]]
            order = np.argsort(to, kind="stable")
            pick, to = pick[order], to[order]
            raw = s.buf.tobytes()
            at, n, doc = s.at[pick], s.n[pick], s.doc[pick]
            data = [raw[a:b] for a, b in zip(at.tolist(), (at + n + (length - 1)).tolist())]
            least: dict[bytes, int] = {}
            own = owner[doc]
            for x, o in zip(data, own.tolist()):
                if least.get(x, _LAST) >= o:
                    least[x] = o
            later = own > np.fromiter(map(least.__getitem__, data), np.int64, len(data))
            place = at - s.first[doc]
            here = np.flatnonzero(later)
            if len(here):
                yield from _filed(row[doc[here]], place[here], np.array(_ALL, np.uint32)[n[here]], shards)
            alone = single[pick] & ~later
            if alone.any():
                yield from _single_strings(s, pick[alone], owner, row, length, shards)
            go = np.flatnonzero(~later & ~alone)
            rows = [(0, k, own[go[a:b]].tobytes(), row[doc[go[a:b]]].tobytes(), place[go[a:b]].astype(np.uint32).tobytes(),
                     n[go[a:b]].astype(np.uint8).tobytes(), b"".join([data[i] for i in go[a:b].tolist()]))
                    for k, a, b in _runs_of(to[go])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SENT_TYPES)], names=_SENT_NAMES)
    return run


_SENT_TYPES = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
_ALL = [(1 << k) - 1 for k in range(STRETCH + 1)]


def _filed(key: np.ndarray, place: np.ndarray, mask: np.ndarray, shards: int):
    """Rows of kind 1: places and masks of documents, by ranges of their keys."""
    order = np.argsort(key, kind="stable")
    key, place, mask = key[order], place[order].astype(np.uint32), mask[order].astype(np.uint32)
    rows = [(1, k, b"", key[a:b].tobytes(), place[a:b].tobytes(), b"", mask[a:b].tobytes())
            for k, a, b in _runs_of(_shard_of(key, shards))]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SENT_TYPES)], names=_SENT_NAMES)


def _joined(table, column: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype)


def repeated(strings: list[bytes], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """For each distinct stretch, the smallest owner of each of its strings."""
    text = np.frombuffer(b"\x00".join(strings) + b"\x00", np.uint8)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    first = np.cumsum(sizes + 1) - (sizes + 1)
    x = np.append(text.astype(np.uint16) + 2, 0).astype(np.uint16)
    ends = first + sizes
    x[ends] = 1   # between stretches
    order, common = suffix_array(x, length)
    of = np.repeat(np.arange(len(strings)), sizes + 1)
    starts = np.zeros(len(x), bool)
    starts[:-1] = np.arange(len(text)) <= np.repeat(first + sizes - length, sizes + 1)
    whole = np.flatnonzero(starts[order])   # ranks of the strings; other suffixes stand between them
    order = order[whole].astype(np.int64)
    run = np.concatenate([[0], np.flatnonzero(between(common, whole) < length) + 1])
    least = np.minimum.reduceat(owners[of[order]], run)
    found = np.zeros(len(x), np.int64)
    found[order] = np.repeat(least, np.diff(run, append=len(order)))
    return [found[a:a + n - length + 1] for a, n in zip(first.tolist(), sizes.tolist())]


def _smallest_owners(distinct: list[bytes], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """For each distinct stretch of a shard, the smallest owner of each of its strings."""
    buf = np.frombuffer(b"".join(distinct), np.uint8)
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
    begin = np.cumsum(sizes) - sizes
    # the anchor again: the least hash of the grams of the first string
    grams = _gram_hashes(buf)
    anchor = grams[begin]
    for k in range(1, length - GRAM + 1):
        anchor = np.minimum(anchor, grams[begin + k])
    _, back, n = np.unique(anchor, return_inverse=True, return_counts=True)
    several = np.flatnonzero(n[back] > 1)
    out = [np.full(s - length + 1, o) for s, o in zip(sizes.tolist(), owners.tolist())]
    if len(several):
        for i, found in zip(several.tolist(), repeated([distinct[i] for i in several.tolist()], owners[several], length)):
            out[i] = found
    return out


def _sort_shard(length: int, shards: int):
    def run(key, table):
        kind = table.column("kind").to_pylist()
        if kind[0] == 1:   # kinds do not share a group
            return table
        if kind[0] == 2:
            owners, data = _joined(table, "owners", np.int64), _joined(table, "bytes", f"S{length}")
            hit = np.flatnonzero(owners > _least_of_equal(data, owners))
            found = _filed(_joined(table, "keys", np.uint64)[hit], _joined(table, "places", np.uint32)[hit], np.ones(len(hit), np.uint32), shards)
            return pa.Table.from_batches(list(found) if len(hit) else [], schema=pa.schema(list(zip(_SENT_NAMES, _SENT_TYPES))))
        owners, rows = _joined(table, "owners", np.int64), _joined(table, "keys", np.uint64)
        places, n = _joined(table, "places", np.uint32), _joined(table, "strings", np.uint8).astype(np.int64)
        raw = b"".join(table.column("bytes").to_pylist())
        stop = np.cumsum(n + length - 1)
        data = [raw[a:b] for a, b in zip((stop - n - length + 1).tolist(), stop.tolist())]
        least: dict[bytes, int] = {}
        for x, o in zip(data, owners.tolist()):
            if least.get(x, _LAST) >= o:
                least[x] = o
        distinct = list(least)
        number = {x: i for i, x in enumerate(distinct)}
        smallest = _smallest_owners(distinct, np.fromiter(least.values(), np.int64, len(least)), length)
        flat, size = np.concatenate(smallest), np.fromiter(map(len, smallest), np.int64, len(smallest))
        begin = np.cumsum(size) - size
        which = np.fromiter(map(number.__getitem__, data), np.int64, len(data))
        mask = np.zeros(len(data), np.uint32)
        for k in range(STRETCH):
            some = np.flatnonzero(n > k)
            mask[some] |= (flat[begin[which[some]] + k] < owners[some]).astype(np.uint32) << np.uint32(k)
        hit = np.flatnonzero(mask)
        batches = list(_filed(rows[hit], places[hit], mask[hit], shards)) if len(hit) else []
        return pa.Table.from_batches(batches, schema=pa.schema(list(zip(_SENT_NAMES, _SENT_TYPES))))
    return run


def _file_documents(folder: str):
    def run(key, table):
        s = key[0].as_py()
        keys, places, masks = _joined(table, "keys", np.uint64), _joined(table, "places", np.uint32), _joined(table, "bytes", np.uint32)
        order = np.lexsort((places, keys))
        for name, a in (("keys", keys), ("places", places), ("masks", masks)):
            files.put(folder, f"{name}-{s}", a[order])
        return pa.table({"shard": [s], "n": [len(keys)]})
    return run


@lru_cache(maxsize=4)
def _found(folder: str, shards: int) -> Arrays:
    return Arrays(folder, {"keys": np.uint64, "places": np.uint32, "masks": np.uint32}, shards)


def covered(size: int, places: np.ndarray, masks: np.ndarray, length: int) -> np.ndarray:
    """Which bytes the marked strings cover."""
    step = np.zeros(size + 1, np.int64)
    for k in range(STRETCH):
        at = places[(masks >> np.uint32(k)) & np.uint32(1) > 0].astype(np.int64) + k
        np.add.at(step, at, 1)
        np.add.at(step, at + length, -1)
    return np.cumsum(step)[:size] > 0


def _marks(keys: np.ndarray, shards: int, found: Arrays) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Places and masks of each document's marked strings, None without any."""
    order = np.argsort(keys, kind="stable")
    out: list = [None] * len(keys)
    for k, a, b in found.parts(_shard_of(keys[order], shards)):
        own, places, masks = found.file(k)
        lo, hi = (np.searchsorted(own, keys[order[a:b]], side=x) for x in ("left", "right"))
        for i in np.flatnonzero(hi > lo).tolist():
            out[order[a + i]] = places[lo[i]:hi[i]], masks[lo[i]:hi[i]]
    return out


def _cut_batches(folder: str, length: int, shards: int):
    def run(batches):
        found = _found(folder, shards)
        for b in batches:
            texts = text_bytes(b.column(2))
            keys = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            gone, runs, kept = [], [], []
            for t, marks in zip(texts, _marks(keys, shards, found)):
                if marks is None:
                    gone.append(0), runs.append(0), kept.append(t)
                    continue
                cover = covered(len(t), *marks, length)
                gone.append(int(cover.sum()))
                runs.append(int(cover[0]) + int((cover[1:] & ~cover[:-1]).sum()))
                kept.append(np.frombuffer(t, np.uint8)[~cover].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
                   shards: int | None = None, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left) of every row."""
    if not GRAM + 8 <= length <= 255:
        raise ValueError(f"length must be from {GRAM + 8} to 255")
    spark = docs.sparkSession
    prepare(spark)
    text = F.col(text_col).cast("string")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(id_col), text).alias("row_key"), text.alias("text"))
    if shards is None:
        size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(shuffle_partitions(spark), -(-size // SHARD_BYTES))
    folder = scratch_path(spark, "repeats")
    (d.mapInArrow(_anchor_runs(length, shards), "shard long, anchors binary, counts binary").groupBy("shard")
     .applyInArrow(_keep_anchors(folder, hot), "shard long, n long, hot long").agg(F.sum("n")).first())
    for name in ("anchors", "hot"):
        join(spark, folder, name, shards)
    sent = d.mapInArrow(_stretch_runs(folder, length, shards), _SENT)
    marked = sent.groupBy("kind", "shard").applyInArrow(_sort_shard(length, shards), _SENT)
    marked.groupBy("shard").applyInArrow(_file_documents(folder), "shard long, n long").agg(F.sum("n")).first()
    for name in ("keys", "places", "masks"):
        join(spark, folder, name, shards)
    out = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                        T.StructField("kept", T.BinaryType())])
    return d.mapInArrow(_cut_batches(folder, length, shards), out)
