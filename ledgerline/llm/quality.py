"""Quality classifier: gradient-boosted trees over statistics of whole documents.

Statistics (class shares of characters, repetition, lengths) are taken in one pass over the
bytes and words of a text. Trees grow level by level on histograms: statistics are binned by
quantiles of the sample, gradients and hessians are summed per node, statistic and bin, and
the best gain splits. The trees become flat arrays, and a batch of documents walks them in
step: one gather per level and tree.

The sample is bounded (``SAMPLE_ROWS`` labelled rows by hash), so growing happens on the
driver on a table of some MB; statistics and scores of all documents are map-only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.batches import raw, text_slices
from ledgerline.llm.language import fold
from ledgerline.llm.shipping import ship_package

#: Bound of the training sample.
SAMPLE_ROWS = 20_000
N_BINS, N_TREES, DEPTH, RATE, L2, MIN_HESSIAN = 32, 60, 4, 0.15, 1.0, 2.0
THRESHOLD = 0.3
STATISTICS = [
    "n_bytes", "n_words", "n_lines", "mean_word", "long_words", "short_words", "upper", "lower", "digit", "space", "wide",
    "symbol", "sentence_mark", "bar", "bang", "hash_like", "distinct_words", "top_word", "same_as_before", "words_per_line",
    "distinct_lines", "top_line", "packed", "longest_word", "symbol_ended_words", "title_words", "angle", "brace",
]
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LOWER = np.array([97 <= b <= 122 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_SPACE = np.array([b in b" \t\n\r\x0b\x0c" for b in range(256)])
_WIDE = np.arange(256) >= 128
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _WIDE)
CLASSES = np.stack([
    _UPPER, _LOWER, _DIGIT, _SPACE, _WIDE, _SYMBOL, np.isin(np.arange(256), list(b".,;:?")), np.arange(256) == ord("|"),
    np.arange(256) == ord("!"), np.isin(np.arange(256), list(b"#$%&*@~^=_")), np.isin(np.arange(256), list(b"<>")), np.isin(np.arange(256), list(b"{}[]()")),
]).astype(np.float64)
SYMBOL_END = re.compile(rb"[^0-9A-Za-z\x80-\xff\s.,;:]\s")
TITLE = re.compile(rb"(?<![A-Za-z\x80-\xff])[A-Z][a-z]")
#: Bytes that are deflated for the compressibility statistic: every block of a text is.
BLOCK = 1 << 15


def statistics_of(text: bytes) -> list[float]:
    """One row of STATISTICS; all zero for an empty text."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    shares = CLASSES @ np.bincount(np.frombuffer(text, np.uint8), minlength=256) / n
    upper, lower, digit, space, wide, symbol, mark, bar, bang, hash_like, angle, brace = shares.tolist()
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counted, same = Counter(words), Counter(lines)
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    packed = sum(len(zlib.compress(text[at : at + BLOCK], 1)) for at in range(0, n, BLOCK)) / n
    return [
        n, len(words), len(lines), float(lengths.mean()), float((lengths > 12).mean()), float((lengths < 4).mean()),
        upper, lower, digit, space, wide, symbol, mark, bar, bang, hash_like,
        len(counted) / n_words, max(counted.values(), default=0) / n_words, repeated / n_words, n_words / n_lines,
        len(same) / n_lines, max(same.values(), default=0) / n_lines, packed, float(lengths.max()),
        len(SYMBOL_END.findall(text)) / n_words, len(TITLE.findall(text)) / n_words, angle, brace,
    ]


@dataclass(frozen=True)
class Trees:
    """All trees as flat arrays. Inner nodes: statistic, upper edge of the left side, and the
    children at 2i+1 and 2i+2 of a tree's block; a node that did not split sends all left."""

    statistic: np.ndarray
    edge: np.ndarray
    leaf: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, row = np.full(len(x), self.base), np.arange(len(x))
        for statistic, edge, leaf in zip(self.statistic, self.edge, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[row, statistic[node]] > edge[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for labels 0 and 1 (logistic loss). Ties go to the first statistic and
    bin. Without rows, or with one label only, there is no split and the score is constant."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, N_BINS) / N_BINS)) if n else np.zeros(0) for j in range(m)]
    bins = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)], axis=1) if n else np.zeros((0, m), np.int64)
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    statistic, edge = np.zeros((N_TREES, inner), np.int64), np.full((N_TREES, inner), np.inf)
    leaf = np.zeros((N_TREES, leaves))
    margin = np.full(n, base)
    if n and 0 < y.sum() < n:
        for t in range(N_TREES):
            p = 1 / (1 + np.exp(-margin))
            gradient, hessian = p - y, p * (1 - p)
            node = np.zeros(n, np.int64)
            for level in range(DEPTH):
                first, width = 2**level - 1, 2**level
                cell = ((node - first)[:, None] * m + np.arange(m)) * N_BINS + bins
                sums = [
                    np.bincount(cell.ravel(), np.repeat(v, m), width * m * N_BINS).reshape(width, m, N_BINS)
                    for v in (gradient, hessian)
                ]
                left = [s.cumsum(axis=2)[:, :, :-1] for s in sums]
                whole = [s.sum(axis=2)[:, :, None] for s in sums]
                right = [w - a for w, a in zip(whole, left)]
                gain = left[0] ** 2 / (left[1] + L2) + right[0] ** 2 / (right[1] + L2) - whole[0] ** 2 / (whole[1] + L2)
                gain[(left[1] < MIN_HESSIAN) | (right[1] < MIN_HESSIAN)] = 0
                best = gain.reshape(width, -1).argmax(axis=1)
                for w in range(width):
                    j, b = divmod(int(best[w]), N_BINS - 1)
                    if gain[w, j, b] > 1e-6 and b < len(edges[j]):
                        statistic[t, first + w], edge[t, first + w] = j, edges[j][b]
                node = 2 * node + 1 + (x[np.arange(n), statistic[t, node]] > edge[t, node])
            at = node - inner
            g, h = np.bincount(at, gradient, leaves), np.bincount(at, hessian, leaves)
            leaf[t] = -RATE * g / (h + L2)
            margin += leaf[t][at]
    return Trees(statistic, edge, leaf, base)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in text_slices(batches):
        yield pa.array([statistics_of(t) for t in raw(texts)], pa.list_(pa.float64()))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Trees:
    """Learn from labelled rows whose id is not held out (NULL ids and labels are not used).

    Of several labels of one document the least counts; a document that is listed several
    times is as many rows. The labelled ids with the least hashes are drawn first, so only
    the drawn documents reach Python and only their statistics reach the driver."""
    ship_package(docs.sparkSession)
    able = labels.where((fold(F.col("doc_id")) != 0) & F.col(label).isNotNull())
    drawn = able.groupBy("doc_id").agg(F.min(F.when(F.col(label) > 0, 1).otherwise(0)).alias("y"))
    drawn = drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)  # bounded, so it may be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("doc_id", "y", statistics(F.col("text")).alias("x"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(SAMPLE_ROWS).collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), len(STATISTICS))
    return grow(x, np.array([r["y"] for r in rows], np.float64))


def scorer(trees: Trees, docs: DataFrame):
    """Column function: text to a score from 0 to 1."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_slices(batches):
            rows = [statistics_of(t) for t in raw(texts)]
            x = np.array(rows, np.float64).reshape(len(rows), len(STATISTICS))
            yield pa.array(shared.value.score(x))

    return scored


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 is likelier) and ``predicted`` (1 from
    THRESHOLD on, else 0), which replace columns so named. NULL texts count as empty; every
    row has a score. Whole texts of any length are read."""
    scored = docs.withColumn("score", scorer(trees, docs)(F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, trees: Trees) -> DataFrame:
    """Rows of ``docs`` that the classifier predicts as 1, with their own columns. NULL and empty
    texts are judged as empty, repeated rows alike, long texts whole; no documents give none."""
    rows = docs.select(F.struct("*").alias("_row"), F.col("text"))
    return score(rows, trees).where("predicted = 1").select("_row.*")
