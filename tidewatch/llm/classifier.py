"""Operator 8: quality by nearest-neighbour voting in a latent-semantic space.

Features are counts of neighbouring byte pairs, bytes folded into classes
(letters, digits, each ASCII mark, white space, bytes of other scripts), and the
number of words equal to the one before.  Inverse
document frequencies come from all documents.  A bounded sample of the labelled
training rows (``sample``: the least hashes of their ids, and of these ids' texts) gives a truncated
singular value decomposition; its rows in the latent space, scaled to length
one, and their labels are broadcast (``sample * rank`` floats).  Every document
is projected, and in blocks its cosine with every labelled vector is computed;
the ``neighbours`` most alike vote with their similarity as weight.

Cases: null text counts as empty; a text without a pair (and any text if there
are no labelled rows) gets the share of label 1 among the sample, 0.5 if there
is none; labels that are null or not 0/1 are ignored; an id labelled several
times counts as often; rows that repeat an id and a text are one row of the
sample, and several texts of one id count each, as far as the sample has room;
repeated rows are scored alike; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import crc_mod, least_rows, prepare, text_bytes, word_hashes


def _classes() -> tuple[np.ndarray, int]:
    code = np.zeros(256, np.int64)
    code[128:] = 1                                  # bytes of other scripts
    code[48:58] = 2                                 # digits
    n = 3
    for c in [*range(33, 48), *range(58, 127), 32, 10]:
        code[c] = n
        n += 1
    return code, n


_CODE, N_CLASSES = _classes()
N_PAIRS = N_CLASSES * N_CLASSES
#: Behind the pairs: words equal to the one before, weighed as much as several pairs.
N_FEATURES = N_PAIRS + 1
REPEAT_WEIGHT = 5.0


def features(texts: list[bytes]) -> np.ndarray:
    """Counts of byte pairs and of repeated words, one row a text."""
    out = np.zeros((len(texts), N_FEATURES), np.float32)
    words, n = word_hashes(texts)
    same = np.zeros(len(words) + 1, np.int64)
    same[1:-1] = words[1:] == words[:-1]
    first = np.cumsum(n) - n
    same[first[n > 0]] = 0
    total = np.concatenate([[0], np.cumsum(same)])
    out[:, N_PAIRS] = total[first + n] - total[first]
    for i, t in enumerate(texts):
        if len(t) > 1:
            c = _CODE[np.frombuffer(t, np.uint8)]
            out[i, :N_PAIRS] = np.bincount(c[:-1] * N_CLASSES + c[1:], minlength=N_PAIRS)
    return out


def _blocks(texts: list[bytes], rows: int = 64):
    return (texts[i:i + rows] for i in range(0, len(texts), rows))


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    x[:, N_PAIRS] *= REPEAT_WEIGHT
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _frequencies(batches):
    df = np.zeros(N_FEATURES, np.int64)
    rows = 0
    for b in batches:
        for block in _blocks(text_bytes(b.column(0))):
            df += (features(block) > 0).sum(axis=0)
            rows += len(block)
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1)), pa.array(np.append(df[at], rows))], ["feature", "n"])


def _sparse(batches):
    for b in batches:
        at, n = [], []
        for block in _blocks(text_bytes(b.column(0))):
            for x in features(block):
                k = np.flatnonzero(x)
                at.append(k.astype("<u2").tobytes())
                n.append(x[k].astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.binary()), pa.array(n, pa.binary()), b.column(1)],
                                         ["at", "n", "label"])


class SparseRows:
    """Weighted feature rows, of which only a block at a time is a matrix."""

    def __init__(self, rows, idf: np.ndarray, block: int = 64):
        self.block, self.at, self.values = block, [], []
        for i in range(0, len(rows), block):
            part = rows[i:i + block]
            counts = np.zeros((len(part), N_FEATURES), np.float32)
            at = [np.frombuffer(r["at"], "<u2") for r in part]
            for k, r in enumerate(part):
                counts[k, at[k]] = np.frombuffer(r["n"], "<f4")
            x = weighted(counts, idf)
            self.at += at
            self.values += [x[k, c] for k, c in enumerate(at)]

    def blocks(self):
        for i in range(0, len(self.at), self.block):
            x = np.zeros((len(self.at[i:i + self.block]), N_FEATURES), np.float32)
            for k in range(len(x)):
                x[k, self.at[i + k]] = self.values[i + k]
            yield x


def truncated_svd(rows: SparseRows, rank: int, seed: int = 7) -> np.ndarray:
    """The first ``rank`` right singular vectors as columns (randomised, three power steps)."""
    shape = len(rows.at), N_FEATURES
    rank = min(rank, *shape)
    basis = np.random.default_rng(seed).standard_normal((N_FEATURES, min(rank + 16, min(shape)))).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(sum(x.T @ (x @ basis) for x in rows.blocks()))
    _, _, vt = np.linalg.svd(np.concatenate([x @ basis for x in rows.blocks()]), full_matrices=False)
    return (basis @ vt[:rank].T).astype(np.float32)


class Model:
    """What the executors get: projection, labelled vectors, labels."""

    def __init__(self, idf, projection, vectors, labels, neighbours: int):
        self.idf, self.projection, self.vectors = idf, projection, vectors
        self.labels, self.neighbours = labels, min(neighbours, len(labels))
        self.prior = float(labels.mean()) if len(labels) else 0.5

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return self.project(weighted(counts, self.idf).astype(np.float32))

    def project(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.projection
        norm = np.linalg.norm(z, axis=1, keepdims=True)
        return z / np.where(norm > 0, norm, 1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        for i in range(0, len(texts), 64):
            z = self.latent(features(texts[i:i + 64]))
            cos = z @ self.vectors.T
            near = np.argpartition(-cos, self.neighbours - 1, axis=1)[:, :self.neighbours]
            w = np.maximum(np.take_along_axis(cos, near, axis=1), 0)
            total = w.sum(axis=1)
            vote = (w * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
            out[i:i + 64] = np.where(total > 0, vote, self.prior)
        return np.clip(out, 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          folds: int = 5, sample: int = 4096, rank: int = 48, neighbours: int = 5) -> Model:
    """Fit on rows whose ``crc32(id as text) mod folds`` is not 0."""
    prepare(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    stats = {r[0]: r[1] for r in d.select("text").mapInArrow(_frequencies, "feature long, n long")
             .groupBy("feature").agg(F.sum("n")).collect()}   # at most one row a feature
    n = stats.pop(-1, 0)
    df = np.zeros(N_FEATURES)
    df[list(stats)] = list(stats.values())
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & (crc_mod(F.col("doc_id"), folds) != 0))
    there = marked.join(d.select("doc_id").distinct(), "doc_id").select(F.xxhash64("doc_id").alias("key"), "doc_id", "label")
    chosen = least_rows(there, "key", sample)
    if not chosen:
        return Model(idf, np.zeros((N_FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32), neighbours)
    ids = docs.sparkSession.createDataFrame([tuple(r[1:]) for r in chosen], there.select("doc_id", "label").schema)
    # an id may have any number of rows: each text once, and no more of them than the sample holds
    texts = d.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id").select(   # at most ``sample`` ids
        F.xxhash64("doc_id", "text").alias("key"), "doc_id")
    keys = docs.sparkSession.createDataFrame(sorted({r[0] for r in least_rows(texts.distinct(), "key", sample)}), "bigint")
    own = d.withColumn("key", F.xxhash64("doc_id", "text")).join(F.broadcast(keys.withColumnRenamed("value", "key")), "key")
    rows = (own.dropDuplicates(["key"]).join(F.broadcast(ids), "doc_id").select("text", "label")
            .mapInArrow(_sparse, "at binary, n binary, label int").orderBy("at", "n", "label").limit(sample).collect())
    y = np.array([r["label"] for r in rows], np.float32)
    if not len(rows):
        return Model(idf, np.zeros((N_FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), y, neighbours)
    x = SparseRows(rows, idf)   # as a matrix: 130 MB of the driver
    model = Model(idf, truncated_svd(x, rank), None, y, neighbours)
    model.vectors = np.concatenate([model.project(b) for b in x.blocks()])
    return model


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score in [0, 1]; higher: label 1 is likelier."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            s = shared.value.scores(text_bytes(b.column(at)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, score_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))
