"""Operator 1: SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint holds, bit by bit, the majority of its shingles'
XXH64 hashes.  Fingerprints within ``radius`` bits are linked.  To find the
links, bit position ``i`` gets a vector ``m(i)`` of ``radius + 1`` bits, and
each nonzero vector ``v`` of that length a table whose mask keeps the positions
with ``<m(i), v> = 1`` (mod 2).  At most ``radius`` differing positions span at
most ``radius`` dimensions, so some ``v`` is orthogonal to all of them: its mask
keeps none of them and the pair collides there.  No pair within the radius is
missed, and there are only ``2^(radius+1) - 1`` tables.

Equal fingerprints are one node throughout.  A bucket of at most
``bucket_limit`` distinct fingerprints is compared inside one task.  A larger
one is dealt out again by a covering code over the positions its mask leaves
free, which keeps the guarantee; 64 free positions become about 30, 14, 6, so
this ends after a few rounds whatever the data.

A fingerprint that very many rows have is one key of the join that gives rows their
class: a sort-merge join whose large partitions Spark splits at run time (AQE), the
classes being one row each.

Cases: null text counts as empty; no word gives fingerprint zero, linked like
any other; a null id gets no say in a component's id (null if there is no
other); repeated rows stay, each with the same result; an empty table gives an
empty one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import materialise, shuffle_partitions, prepare, text_bytes
from tidewatch.llm.components import connected_components

SEED = 42
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANES = np.arange(8) * 256
_CHUNK = 1 << 17


def fingerprint(text: bytes, width: int) -> int:
    """The 64-bit SimHash of one text, as an unsigned integer."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = len(words) - width + 1
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    ends = ends[width - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(2048, np.int64)
    for i in range(0, n, _CHUNK):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[i:i + _CHUNK], ends[i:i + _CHUNK])]
        lanes = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8) + _LANES
        counts += np.bincount(lanes.ravel(), minlength=2048)
    ones = np.einsum("lv,vb->lb", counts.reshape(8, 256), _BITS).ravel()
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def _fingerprint_batches(width: int):
    def run(batches):
        for b in batches:
            fps = [fingerprint(t, width) for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64), pa.int64())], ["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's bits as a signed long) of every row."""
    prepare(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])
    return d.mapInArrow(_fingerprint_batches(width), schema)


@lru_cache(maxsize=100_000)
def covering_masks(taken: int, radius: int) -> tuple[int, ...]:
    """Masks of the tables below a bucket whose positions in ``taken`` are equal."""
    free = [i for i in range(64) if not taken >> i & 1]
    n = (1 << radius + 1) - 1
    masks = []
    for v in range(1, n + 1):
        masks.append(taken | sum(1 << p for i, p in enumerate(free) if ((1 + i % n) & v).bit_count() & 1))
    return tuple(dict.fromkeys(masks))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal_out(radius: int):
    """Rows (mask, fp) of too large buckets to rows of their sub-tables."""
    def run(batches):
        for b in batches:
            mask = b.column(0).to_numpy().view(np.uint64)
            fp = b.column(1).to_numpy().view(np.uint64)
            for m in np.unique(mask):
                own = fp[mask == m]
                for sub in covering_masks(int(m), radius):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), _signed(sub), np.int64)),
                         pa.array((own & np.uint64(sub)).view(np.int64)), pa.array(own.view(np.int64))],
                        ["mask", "key", "fp"])
    return run


def _spanning_links(fp: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by group: a star of links for each component inside a group."""
    left, right = [], []
    for lag in range(1, len(fp)):
        same = group[lag:] == group[:-lag]
        if not same.any():
            break
        near = np.flatnonzero(same & (np.bitwise_count(fp[lag:] ^ fp[:-lag]) <= radius))
        left.append(near)
        right.append(near + lag)
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    a, b = np.concatenate(left), np.concatenate(right)
    root = np.arange(len(fp))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return fp[moved], fp[root[moved]]


def _bucket_links(radius: int):
    """Links inside the buckets of a partition sorted by (mask, key)."""
    def links(mask, key, fp):
        group = np.cumsum(np.concatenate([[0], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]))
        a, b = _spanning_links(fp, group, radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def run(batches):
        rest = [np.empty(0, np.int64)] * 2 + [np.empty(0, np.uint64)]
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            cols[2] = cols[2].view(np.uint64)
            cols = [np.concatenate([r, c]) for r, c in zip(rest, cols)]
            if not len(cols[0]):
                continue
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            cut = len(last) - int(last.sum())
            if cut:
                yield links(*[c[:cut] for c in cols])
            rest = [c[cut:] for c in cols]
        if len(rest[0]):
            yield links(*rest)
    return run


def covering_links(fps: DataFrame, radius: int = 3, bucket_limit: int = 64) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints whose components are those
    of all pairs within ``radius`` bits.  ``fps``: one column, distinct longs."""
    spark, col = fps.sparkSession, fps.columns[0]
    if bucket_limit < 1 << radius + 1:
        raise ValueError("bucket_limit is too small for this radius")
    rows = fps.select(F.col(col).alias("fp")).where("fp is not null").select(F.explode(F.array(*[
        F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"),
                 F.col("fp").alias("fp")) for m in covering_masks(0, radius)])).alias("r")).select("r.*")
    found = None
    while True:
        rows = rows.distinct() if found is not None else rows
        sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        shared = materialise(rows.join(sizes, ["mask", "key"]), "buckets")
        n = shuffle_partitions(spark)
        links = (shared.where(F.col("n") <= bucket_limit).select("mask", "key", "fp")
                 .repartition(n, "mask", "key").sortWithinPartitions("mask", "key", "fp")
                 .mapInArrow(_bucket_links(radius), "a long, b long"))
        found = links if found is None else found.unionByName(links)
        large = shared.where(F.col("n") > bucket_limit)
        if large.isEmpty():
            return found.distinct()
        rows = large.select("mask", "fp").mapInArrow(_deal_out(radius), "mask long, key long, fp long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    radius: int = 3, bucket_limit: int = 64) -> DataFrame:
    """``doc_id, fp, component_id`` of every row; see the module's text."""
    fps = materialise(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(covering_links(nodes.select("fp"), radius, bucket_limit))
    classes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(classes.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
