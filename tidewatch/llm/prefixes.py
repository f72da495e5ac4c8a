"""Operator 6: document fingerprints by prefix polynomial hashes.

For code points ``c`` the prefix array ``H[i]`` is the sum of ``(c[j] + 1) * B^j``
for ``j < i``, modulo a prime; two primes are used.  The last entries and the
length are a text's fingerprint.  Any two spans are compared in constant time
from the arrays, and the longest common extension of two places is found by
binary search over span equalities.  A text made from pieces of others gets its
array from theirs without a look at its characters.

Two fingerprints' likeness: the code points of the longest common extension from
the starts, of that from the ends, and of those between that follow a difference of at
most ``SKIP`` code points on either side, up to ``JUMPS`` of them, over the longer
length.  Behind a difference the arrays give the hashes of all spans of ``LEAST``
code points that begin in reach; the two nearest equal ones are where the texts go on.

Neighbours: rows are dealt by ranges of the id, in falling order, and sorted inside
them; each range also gets the first row of the one behind it.  Rows of one id, or
without one, that are more than a range holds are dealt by ranges of a hash of
their texts, and of equal ones a task sends one with a count: a copy's next row is
a copy, but for the last.

Cases: null text counts as empty; two empty texts are alike (1.0), an empty and
another are not (0.0); rows of one id stand in the order of that hash; null ids
come last; a single row is its own neighbour; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import materialise, prepare, shuffle_partitions, text_bytes

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1403630843)
#: Code points that a difference has at most, and that must agree behind it; differences that are passed.
SKIP, LEAST, JUMPS = 32, 16, 16
_POWERS = [np.ones(1, np.uint64) for _ in PRIMES]


def _powers(which: int, n: int) -> np.ndarray:
    """``B^0 .. B^(n-1)`` modulo the prime, by doubling."""
    p = np.uint64(PRIMES[which])
    while len(_POWERS[which]) < n:
        have = _POWERS[which]
        step = np.uint64(pow(BASES[which], len(have), PRIMES[which]))
        _POWERS[which] = np.concatenate([have, have * step % p])
    return _POWERS[which]


class Prefix:
    """The prefix arrays of one text."""

    def __init__(self, arrays: list[np.ndarray]):
        self.arrays, self.n = arrays, len(arrays[0]) - 1

    @classmethod
    def of(cls, text: str) -> Prefix:
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        out = []
        for k, p in enumerate(PRIMES):
            h = np.zeros(len(c) + 1, np.uint64)
            np.cumsum(c * _powers(k, len(c) + 1)[:len(c)] % np.uint64(p), out=h[1:])
            out.append(h % np.uint64(p))
        return cls(out)

    def spliced(self, keep: int, other: Prefix, take: int) -> Prefix:
        """The arrays of the first ``keep`` code points and the first ``take`` of ``other``."""
        out = []
        for k, p in enumerate(PRIMES):
            tail = (self.arrays[k][keep] + _powers(k, keep + 1)[keep] * other.arrays[k][1:take + 1]) % np.uint64(p)
            out.append(np.concatenate([self.arrays[k][:keep + 1], tail]))
        return Prefix(out)

    def fingerprint(self) -> str:
        return "".join(f"{int(h[-1]):08x}" for h in self.arrays) + f"{self.n:08x}"

    def same(self, a: int, other: Prefix, b: int, n: int) -> bool:
        """Whether the spans of length ``n`` from ``a`` and, in ``other``, from ``b`` are equal."""
        for k, p in enumerate(PRIMES):
            x = (int(self.arrays[k][a + n]) - int(self.arrays[k][a])) % p
            y = (int(other.arrays[k][b + n]) - int(other.arrays[k][b])) % p
            if x * int(_powers(k, b + 1)[b]) % p != y * int(_powers(k, a + 1)[a]) % p:
                return False
        return True

    def extension(self, a: int, other: Prefix, b: int, most: int) -> int:
        """The longest common extension of two places, up to ``most``."""
        low, high = 0, most
        while low < high:
            mid = (low + high + 1) // 2
            if self.same(a, other, b, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def common_prefix(self, other: Prefix) -> int:
        return self.extension(0, other, 0, min(self.n, other.n))

    def common_suffix(self, other: Prefix, most: int) -> int:
        low, high = 0, most
        while low < high:
            mid = (low + high + 1) // 2
            if self.same(self.n - mid, other, other.n - mid, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def _spans(self, at: int, n: int, top: int) -> np.ndarray:
        """The hashes of the spans of ``LEAST`` from ``n`` places on, as if all began at ``top``."""
        out = []
        for k, p in enumerate(PRIMES):
            h, q = self.arrays[k], np.uint64(p)
            powers = _powers(k, top + 1)[top - at - n + 1:top - at + 1][::-1]   # B^(top - place)
            out.append((h[at + LEAST:at + LEAST + n] + q - h[at:at + n]) % q * powers % q)
        return out[0] << np.uint64(32) | out[1]

    def likeness(self, other: Prefix) -> float:
        if not max(self.n, other.n):
            return 1.0
        i = j = self.common_prefix(other)
        back = self.common_suffix(other, min(self.n, other.n) - i)
        ends, alike = (self.n - back, other.n - back), i + back
        for _ in range(JUMPS):
            n = [min(SKIP + 1, end - at - LEAST + 1) for at, end in zip((i, j), ends)]
            if min(n) < 1:
                break
            top = max(i + n[0], j + n[1])
            x, y = self._spans(i, n[0], top), other._spans(j, n[1], top)
            a, b = np.nonzero(x[:, None] == y[None, :])
            if not len(a):
                break
            near = np.lexsort((a, a + b))[0]
            i, j = i + int(a[near]), j + int(b[near])
            run = self.extension(i, other, j, min(ends[0] - i, ends[1] - j))
            i, j, alike = i + run, j + run, alike + run
        return alike / max(self.n, other.n)


class Ranges:
    """Numbered ranges of (id, hash of the text), in the order of the rows."""

    def __init__(self, bounds: np.ndarray, hot: dict, nulls: int, rows: int, step):
        # an id with many rows has a range of its own, in as many parts as its rows need
        self.bounds = np.array(sorted({*bounds.tolist(), *hot, *map(step, hot)}))
        parts = np.ones(len(self.bounds) + 2, np.int64)
        if hot:
            ids = np.array(sorted(hot))
            parts[self._base(ids, np.zeros(len(ids), bool))] = [-(-hot[i] // rows) for i in ids.tolist()]
        parts[-1] = max(1, -(-nulls // rows))
        self.many = parts > 1
        self.parts, self.first = parts.astype(np.uint64), np.cumsum(parts) - parts

    def _base(self, ids: np.ndarray, null: np.ndarray) -> np.ndarray:
        """0 for the largest ids; null ids behind all others."""
        return np.where(null, len(self.bounds) + 1, len(self.bounds) - np.searchsorted(self.bounds, ids, side="right"))

    def of(self, column, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's range, and whether its id has many rows."""
        null = column.is_null().to_numpy(zero_copy_only=False)
        ids = column.fill_null(0).to_numpy(zero_copy_only=False)
        base = self._base(ids, null)
        high = (h.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)   # in the order of the signed hashes
        return self.first[base] + (high * self.parts[base] >> np.uint64(32)).astype(np.int64), self.many[base]


def _ranges(ranges: Ranges):
    def run(batches):
        for b in batches:
            h = b.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(ranges.of(b.column(0), h)[0]), b.column(0), b.column(1)], names=["bucket", "doc_id", "h"])
    return run


DEALT = ["bucket", "doc_id", "h", "raw", "n", "kind"]
#: A row of the range; the row behind the range; further copies of a row, ``raw`` being a digest of its text.
ROW, EDGE, COPIES = range(3)


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _deal(ranges: Ranges, first: dict[int, tuple], before: dict[int, int]):
    """Rows to their ranges, compressed; a range's first row also to the one before it.
    Of equal rows of an id with many, the first one goes, and at last how many more there were."""
    def run(batches):
        pack, more, kind = zstandard.ZstdCompressor(level=1), {}, None
        for b in batches:
            kind = b.column(0).type
            h = b.column(1).to_numpy(zero_copy_only=False)
            at, many = ranges.of(b.column(0), h)
            ids, rows = b.column(0).to_pylist(), []
            for i, (k, x, y, hot, t) in enumerate(zip(at.tolist(), ids, h.tolist(), many.tolist(), text_bytes(b.column(2)))):
                if hot:
                    own = (k, x, y, _digest(t))
                    if own in more:
                        more[own] += 1
                        continue
                    more[own] = 0
                raw = pack.compress(t)
                rows.append((k, x, y, raw, 1, ROW))
                if first[k] == (x, y):
                    rows.append((before[k], x, y, raw, 1, EDGE))
            if rows:
                yield _rows(rows, kind)
        rest = [(k, x, y, digest, n, COPIES) for (k, x, y, digest), n in more.items() if n]
        for i in range(0, len(rest), 4096):
            yield _rows(rest[i:i + 4096], kind)
    return run


def _rows(rows: list[tuple], kind) -> pa.RecordBatch:
    kinds = [pa.int64(), kind, pa.int64(), pa.binary(), pa.int64(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=DEALT)


def _distinct(table) -> tuple[list, tuple | None]:
    """A range's rows in order as ``[id, text, count]``, and the row behind them."""
    unpack = zstandard.ZstdDecompressor()
    found, more, edges = {}, [], []
    for x, y, raw, n, kind in zip(*[table.column(c).to_pylist() for c in DEALT[1:]]):
        if kind == COPIES:
            more.append((x, y, raw, n))
            continue
        t = unpack.decompress(raw)
        if kind == EDGE:
            edges.append((x is None, -(x or 0), y, t, x))
            continue
        key = (x is None, -(x or 0), y, t)
        found[key] = [x, t, found[key][2] + n if key in found else n]
    if more:
        by_digest = {(r[0], key[2], _digest(r[1])): r for key, r in found.items()}
        for x, y, digest, n in more:
            by_digest[x, y, digest][2] += n
    return [found[k] for k in sorted(found)], min(edges, default=None, key=lambda e: e[:4])


def _compared(most: int):
    """Compare a range's rows; a row of the result stands for up to ``most`` copies."""
    def run(key, table):
        rows, edge = _distinct(table)
        text = lambda t: t.decode("utf-8", "surrogatepass")
        out = []
        nxt = text(rows[0][1]) if rows else ""
        nxt_prefix = Prefix.of(nxt)

        def judge(doc_id, here, prefix, behind, behind_prefix, repeats):
            keep, take = prefix.n - prefix.n // 2, min(prefix.n // 2, behind_prefix.n)
            edited = prefix.spliced(keep, behind_prefix, take)
            out.append((doc_id, prefix.n, hashlib.sha256((here[:keep] + behind[:take]).encode("utf-8", "surrogatepass")).hexdigest(),
                        prefix.fingerprint(), edited.fingerprint(), prefix.likeness(edited), prefix.likeness(behind_prefix), repeats))

        for i, (doc_id, _, n) in enumerate(rows):
            here, prefix = nxt, nxt_prefix
            nxt = text(rows[i + 1][1] if i + 1 < len(rows) else edge[3])
            nxt_prefix = Prefix.of(nxt)
            judge(doc_id, here, prefix, nxt, nxt_prefix, 1)
            for done in range(0, n - 1, most):   # copies stand before a copy
                if not done:
                    judge(doc_id, here, prefix, here, prefix, min(most, n - 1))
                else:
                    out.append((*out[-1][:-1], min(most, n - 1 - done)))
        cols = list(zip(*out)) if out else [[]] * 8
        kinds = [table.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=[*COLUMNS, "repeats"])
    return run


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
#: Copies that one row of the result stands for until they are written out.
REPEATS = 4096


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_rows: int = 4000) -> DataFrame:
    """Every row's fingerprint, that of its edited text, and how alike they are.

    The edited text: the last ``floor(n / 2)`` code points replaced by the first
    as many (or all) of the next row's in falling order of the (numeric) id;
    behind the last row comes the first.
    """
    prepare(docs.sparkSession)
    text = F.col(text_col).cast("string")
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), text.alias("text"))
    id_type = d.schema["doc_id"].dataType
    fractional = isinstance(id_type, T.FractionalType)
    many = d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).groupBy(
        F.when(F.col("n") > range_rows, F.struct("doc_id", "n")).alias("hot")).agg(F.sum("n").alias("n")).collect()   # a row a hot id
    n = sum(r["n"] for r in many)
    hot = {r["hot"]["doc_id"]: r["hot"]["n"] for r in many if r["hot"] is not None}
    nulls = hot.pop(None, 0)
    parts = -(-n // range_rows) if n else 1
    cuts = d.select(F.col("doc_id").cast("double").alias("x")).approxQuantile(
        "x", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    bounds = np.array(sorted({int(x) if not fractional else x for x in cuts}))
    step = (lambda x: float(np.nextafter(x, np.inf))) if fractional else (lambda x: x + 1)
    ranges = Ranges(bounds, hot, nulls, range_rows, step)
    bucketed = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("doc_id", id_type), T.StructField("h", T.LongType())])
    ends = (d.select("doc_id", "h").mapInArrow(_ranges(ranges), bucketed).groupBy("bucket")
            .agg(F.max(F.struct("doc_id", F.bitwise_not("h").alias("h"))).alias("first")).orderBy("bucket").collect())   # one row a range
    first = {r["bucket"]: (r["first"]["doc_id"], ~r["first"]["h"]) for r in ends}
    order = [r["bucket"] for r in ends]
    before = {b: order[i - 1] for i, b in enumerate(order)}
    dealt = T.StructType([*bucketed.fields, T.StructField("raw", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("kind", T.IntegerType())])
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_chars", T.LongType())] + [
        T.StructField(c, T.StringType()) for c in COLUMNS[2:5]] + [T.StructField(c, T.DoubleType()) for c in COLUMNS[5:]]
        + [T.StructField("repeats", T.LongType())])
    spread = bool(hot or nulls)
    found = d.mapInArrow(_deal(ranges, first, before), dealt).groupBy("bucket").applyInArrow(_compared(REPEATS if spread else 1), out)
    if not spread:
        return found.select(*COLUMNS)   # no row stands for copies
    found = materialise(found, "compared")
    copies = found.where("repeats > 1").repartition(shuffle_partitions(docs.sparkSession)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "repeats")))
    return found.where("repeats = 1").select(*COLUMNS).unionByName(copies.select(*COLUMNS))
