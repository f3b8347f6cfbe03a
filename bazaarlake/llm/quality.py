"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives a few measures. Cyclic boosting visits the measures in turn and fits a shallow tree of one
measure to the remaining error; the sum of a measure's trees is a lookup table over its bins. Then the pairs
of measures that explain most of what is left get tables of their own in the same way. Scoring a text is a
bin search per measure and a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm import text as tx
from bazaarlake.llm.labels import SAMPLE_ROWS, labelled, remainder

TEST_BUCKETS, TEST_REMAINDER = 4, 2
THRESHOLD = 0.7
MEASURES = (
    "log_words", "word_bytes", "distinct", "repeats", "symbols", "digits", "upper", "stops",
    "lines", "line_words", "non_ascii", "odd_ends", "lone", "common", "longest", "sentence",
)
BINS, PAIR_BINS = 48, 8
ROUNDS, PAIR_ROUNDS, PAIRS, RATE, LEAVES = 250, 80, 6, 0.1, 4

_CLASS = {
    "digit": np.isin(np.arange(256), range(48, 58)),
    "upper": np.isin(np.arange(256), range(65, 91)),
    "stop": np.isin(np.arange(256), [ord(c) for c in ".!?"]),
    "line": np.isin(np.arange(256), [10]),
    "high": np.arange(256) >= 128,
    "symbol": np.isin(np.arange(256), [ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]),
}


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of measures per text of a slice; a text without words has zeros."""
    rows = len(offsets) - 1
    words = tx.Words(data, offsets)
    n = words.counts.astype(float)
    some = np.maximum(n, 1.0)
    size = np.maximum(np.diff(offsets).astype(float), 1.0)

    def bytes_of(name: str) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(_CLASS[name][data])])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    length = words.end - words.start
    at, value = tx.distinct(words.row, words.hash)
    unique = np.bincount(at, minlength=rows).astype(float)
    same = np.zeros(len(words.hash), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
    by_row = lambda x: np.bincount(words.row, x, rows)
    last = data[words.end - 1] if len(words.end) else np.zeros(0, np.uint8)
    order = np.lexsort((words.hash, words.row))
    change = np.ones(len(order), bool)
    change[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (words.row[order][1:] != words.row[order][:-1])
    starts = np.flatnonzero(change)
    runs = np.diff(np.append(starts, len(order)))
    common = np.zeros(rows)
    np.maximum.at(common, at, runs.astype(float))
    longest = np.zeros(rows)
    np.maximum.at(longest, words.row, length.astype(float))
    stops, lines = bytes_of("stop"), bytes_of("line")
    out = [
        np.log1p(n), by_row(length) / some, unique / some, by_row(same) / some, bytes_of("symbol") / size,
        bytes_of("digit") / size, bytes_of("upper") / size, stops / some, lines / some, n / (lines + 1),
        bytes_of("high") / size, by_row(_CLASS["symbol"][last]) / some, by_row(length == 1) / some, common / some,
        np.log1p(longest), n / (stops + 1),
    ]
    return np.column_stack(out)


@dataclass
class Additive:
    """Bias, bin edges and a table per measure, and tables per pair over coarser bins."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], "right"), np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float = 1.0) -> np.ndarray:
    """Leaf values over ordered bins of a tree of at most ``leaves`` leaves, grown by the best split each time."""
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = (1e-9, 0, 0)
        for i, (a, b) in enumerate(parts):
            if b - a > 1:
                cut = np.arange(a + 1, b)
                won = gain(a, cut) + gain(cut, b) - gain(a, b)
                k = int(won.argmax())
                best = max(best, (float(won[k]), i, int(cut[k])))
        if not best[2]:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that splits both measures of a pair once."""
    pad = lambda x: np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    g, h = pad(grad), pad(hess)
    n, m = grad.shape
    best, where = -1.0, (n, m)
    for i in range(1, n):
        for k in range(1, m):
            corners = [(g[i, k], h[i, k]), (g[i, m] - g[i, k], h[i, m] - h[i, k]), (g[n, k] - g[i, k], h[n, k] - h[i, k]), (g[n, m] - g[i, m] - g[n, k] + g[i, k], h[n, m] - h[i, m] - h[n, k] + h[i, k])]
            won = sum(a * a / (b + ridge) for a, b in corners)
            if won > best:
                best, where = won, (i, k)
    out = np.zeros((n, m))
    i, k = where
    for rows in (slice(0, i), slice(i, n)):
        for cols in (slice(0, k), slice(k, m)):
            if out[rows, cols].size:
                out[rows, cols] = grad[rows, cols].sum() / (hess[rows, cols].sum() + ridge)
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Fit the tables; with one kind of label only the bias is left."""
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    k = x.shape[1]
    edges, pair_edges = [_edges(x[:, j], BINS) for j in range(k)], [_edges(x[:, j], PAIR_BINS) for j in range(k)]
    model = Additive(float(np.log(rate / (1 - rate))), edges, [np.zeros(len(e) + 1) for e in edges], pair_edges, [], [])
    if len(set(y.tolist())) < 2:
        return model
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    logit = np.full(len(y), model.bias)
    p = 1 / (1 + np.exp(-logit))
    for _ in range(ROUNDS):
        for j in range(k):
            b, size = bins[j], len(model.tables[j])
            step = RATE * _tree(np.bincount(b, y - p, size), np.bincount(b, p * (1 - p), size), LEAVES)
            model.tables[j] += step
            logit += step[b]
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(pair_edges)]

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        shape = (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)
        return np.bincount(coarse[a] * shape[1] + coarse[b], v, shape[0] * shape[1]).reshape(shape)

    gains = sorted(((_pair_tree(grid(a, b, y - p), grid(a, b, p * (1 - p)))[0], a, b) for a in range(k) for b in range(a)), reverse=True)
    model.pairs = [(a, b) for _, a, b in gains[:PAIRS]]
    model.pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for t, (a, b) in enumerate(model.pairs):
            step = RATE * _pair_tree(grid(a, b, y - p), grid(a, b, p * (1 - p)))[1]
            model.pair_tables[t] += step
            logit += step[coarse[a], coarse[b]]
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return model


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in tx.slices(batch.column("text")):
            x = measures(data, offsets)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in x.T] + [batch.column("y").slice(low, high - low)], [*MEASURES, "y"])


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Additive:
    """The model of at most ``rows`` labelled texts; only their measures and labels reach the driver."""
    sample = labelled(docs, labels, "quality", remainder(F.col("doc_id"), TEST_BUCKETS) != TEST_REMAINDER, rows)
    seen = sample.mapInArrow(_measured, ", ".join(f"{m} double" for m in MEASURES) + ", y int").orderBy(*MEASURES, "y").toPandas()
    return fit(seen[list(MEASURES)].to_numpy(float), seen["y"].to_numpy(float))


def quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document.

    Labels of held-out ids (and null ids) are never learned from. Texts of any length are measured whole;
    empty and null texts have zero measures; equal texts get equal scores; without labels every score is one
    half, with one kind of label all scores are near it; an empty table gives no rows. Only doc_id and text
    are read, so other columns may have any name.
    """
    model = learn(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column("text")):
                value = model.score(measures(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), pa.array(value)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), TEST_BUCKETS) == TEST_REMAINDER, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
