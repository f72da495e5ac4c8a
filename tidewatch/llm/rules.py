"""Operator 3: quality rules, then an isolation forest over rule statistics.

The base rules count words, symbols, repeated lines and repeated five-word
windows.  Ratios of such counts are a document's statistics.  Each tree of the
forest splits its own ``tree_rows`` rows (a bounded sample, part of the method:
the rows with the least hashes) at random until they are alone; a document's
mean path length gives its anomaly score in (0, 1).  The threshold comes from
the scores of all labelled rows that pass the base rules, good and bad: of those above which at
most ``good_loss`` of the good rows lie, the one that parts the two best (the
share of the bad rows above it less that of the good ones), the highest at a tie.
Without bad rows it is the least of them.  A document is kept when it passes the
base rules and its score is not above the threshold.

Cases: null text has no words and fails the base rules, like an empty one; no
labelled good row: no threshold, the base rules decide alone; labels that are null
or not 0/1 are ignored, an id labelled both ways counts for both; repeated rows are
judged alike; a text of any length is taken whole; an empty table gives an empty
one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import least_rows, materialise, prepare, row_key, text_bytes

WINDOW = 5
# The symbols and white space of the contract.
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = ("symbols_a_word", "repeated_words", "capitals", "marks", "same_as_before")
_BINS = 2000


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_IS_SYMBOL, _IS_SPACE = _table(SYMBOLS), _table(SPACES)
_IS_CAPITAL, _IS_LETTER = _table(bytes(range(65, 91))), _table(bytes([*range(65, 91), *range(97, 123)]))
_IS_MARK = _table(bytes(c for c in range(33, 127) if not chr(c).isalnum()))


def threshold(scored: list[tuple[int, int, int]], good_loss: float) -> float:
    """The threshold from ``(bin, good rows, bad rows)``; a bin's rows score at most
    ``bin / _BINS``."""
    good, bad = sum(r[1] for r in scored), sum(r[2] for r in scored)
    if not good:
        return 1.0
    best, out, above_good, above_bad, last = None, 1.0, 0, 0, _BINS + 1
    for k, g, b in sorted(scored, reverse=True):   # what lies above bin k goes: the bins from ``last`` on
        if above_good > good_loss * good:
            break
        gain = above_bad / bad - above_good / good if bad else -k
        if best is None or gain > best:
            best, out = gain, (last - 1 if bad else k) / _BINS
        above_good, above_bad, last = above_good + g, above_bad + b, k
    return out


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first one included."""
    windows = list(zip(*[words[i:] for i in range(width)]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    total, covered = 0, 0   # covered: up to which word
    for i, w in enumerate(windows):
        if seen[w] > 1:
            total += i + width - max(i, covered)
            covered = i + width
    return total


def repeated_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def counts(text: bytes) -> tuple[list[int], list[float]]:
    """The base counts and the statistics of one text."""
    words = text.split()
    n = len(words)
    if not n:
        return [0, 0, int(sum(text.count(c) for c in SYMBOLS)), 0, 0], [0.0] * len(STATISTICS)
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text) - int(kinds[0x80:0xC0].sum())   # continuation bytes are not code points
    word_chars = chars - int(kinds[_IS_SPACE].sum())
    symbols, letters = int(kinds[_IS_SYMBOL].sum()), max(1, int(kinds[_IS_LETTER].sum()))
    dup, repeats = repeated_lines(text), repeated_words(words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [n, word_chars, symbols, dup, repeats], [
        symbols / n, repeats / n, kinds[_IS_CAPITAL].sum() / letters, kinds[_IS_MARK].sum() / word_chars, same / n]


def _count_batches(batches):
    for b in batches:
        rows = [counts(t) for t in text_bytes(b.column(2))]
        c = np.array([r[0] for r in rows], np.int64).reshape(-1, len(COUNTS))
        s = np.array([r[1] for r in rows], np.float64).reshape(-1, len(STATISTICS))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(x) for x in c.T], *[pa.array(x) for x in s.T]],
                                         names=["doc_id", "order_key", *COUNTS, *STATISTICS])


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, order_key``, the base counts and the statistics of every row."""
    prepare(docs.sparkSession)
    text = F.col(text_col).cast("string")
    d = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(id_col), text).alias("order_key"), text.alias("text"))
    schema = T.StructType([T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("order_key", T.LongType())]
                          + [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(c, T.DoubleType()) for c in STATISTICS])
    return d.mapInArrow(_count_batches, schema)


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, np.float64)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


class Forest:
    """Trees as arrays: feature (-1 in a leaf), split, left child, depth with the leaf's own mean path."""

    def __init__(self, rows: np.ndarray, trees: int, seed: int = 11):
        self.trees = []
        self.size = 0
        rng = np.random.default_rng(seed)
        for k in range(trees):
            own = rows[k::trees]
            if len(own):
                self.size = max(self.size, len(own))
                self.trees.append(self._grow(own, rng))

    @staticmethod
    def _grow(rows: np.ndarray, rng) -> tuple:
        limit = int(np.ceil(np.log2(max(len(rows), 2))))
        feature, split, child, depth = [], [], [], []
        feature.append(-1), split.append(0.0), child.append(0), depth.append(0.0)
        todo = [(0, rows, 0)]
        while todo:
            at, x, d = todo.pop()
            spread = np.flatnonzero(x.max(axis=0) > x.min(axis=0)) if len(x) > 1 and d < limit else []
            if not len(spread):
                depth[at] = d + float(mean_path(len(x)))
                continue
            f = int(rng.choice(spread))
            cut = rng.uniform(x[:, f].min(), x[:, f].max())
            below = x[:, f] < cut
            feature[at], split[at], child[at] = f, cut, len(feature)
            for part in (x[below], x[~below]):
                todo.append((len(feature), part, d + 1))
                feature.append(-1), split.append(0.0), child.append(0), depth.append(0.0)
        return np.array(feature), np.array(split), np.array(child), np.array(depth)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores ``2^(-path / mean path)``; 0.5 without a tree."""
        if not self.trees or self.size < 2 or not len(x):
            return np.full(len(x), 0.5)
        total, every = np.zeros(len(x)), np.arange(len(x))
        for feature, split, child, depth in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                at = np.where(inner, child[at] + (x[every, np.maximum(f, 0)] >= split[at]), at)
            total += depth[at]
        return 2.0 ** (-total / len(self.trees) / float(mean_path(self.size)))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          trees: int = 100, tree_rows: int = 256, good_loss: float = 0.003) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed, anomaly, threshold, kept`` of every row."""
    spark = docs.sparkSession
    stats = materialise(statistics(docs, id_col, text_col), "statistics")
    rows = np.array([r[1:] for r in least_rows(   # bounded by the two parameters
        stats.where(~base_failed()).select("order_key", *STATISTICS), "order_key", trees * tree_rows)], np.float64).reshape(-1, len(STATISTICS))
    shared = spark.sparkContext.broadcast(Forest(rows, trees))
    names = stats.columns

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(names.index(s)).to_numpy() for s in STATISTICS]) if b.num_rows else np.zeros((0, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.scores(x))], names=[*names, "anomaly"])

    scored = materialise(stats.mapInArrow(run, T.StructType([*stats.schema.fields, T.StructField("anomaly", T.DoubleType())])), "anomalies")
    label = F.col(label_col).cast("int")
    marked = labels.select(F.col(id_col).alias("doc_id"), label.alias("label")).where(F.col("label").isin(0, 1)).distinct()
    bins = (scored.where(~base_failed()).join(marked, "doc_id").groupBy(F.ceil(F.col("anomaly") * _BINS).alias("bin"))
            .agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad")).collect())   # at most _BINS rows
    limit = threshold([tuple(r) for r in bins], good_loss)
    failed = base_failed()
    return scored.select("doc_id", *COUNTS, failed.alias("base_failed"), "anomaly", F.lit(limit).alias("threshold"),
                         (~failed & (F.col("anomaly") <= limit)).alias("kept"))
