"""Quality rules: gradient-boosted trees over document statistics.

Trees are grown on the histograms of a bounded sample of labelled rows, with monotonic
constraints on chosen statistics (more symbols or repetition never raises a score), and
flattened into arrays of nodes, by which whole batches are scored at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodseries.llm.text_stats import COUNTS, RATIOS, text_stats

# Labelled rows that the trees are fitted on, at most: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, RATE, BINS, SMOOTHING, LEAST_ROWS = 60, 3, 0.15, 64, 5.0, 10
# Direction of each constrained statistic: -1, a higher value never raises the score.
MONOTONE = {"symbols": -1, "upper": -1, "dup_lines": -1, "repeat_words": -1, "top_word": -1}
MIN_WORDS, MOST_REPEATS = 50, 50


@dataclass
class Trees:
    """All trees in one set of arrays; a leaf is its own child."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of a good document for each row of statistics."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-total))


def _leaf(g: float, h: float, low: float, high: float) -> float:
    return float(np.clip(-g / (h + SMOOTHING), low, high))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: np.ndarray) -> Trees:
    """Boosted trees of logistic loss on histogram bins. A split on a constrained statistic
    needs ordered leaf values, and its halves stay on their sides of the middle between them."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    total = np.full(len(y), base)

    def node() -> int:
        k = len(value)
        for held, new in ((feature, 0), (threshold, np.inf), (left, k), (right, k), (value, 0.0)):
            held.append(new)
        return k

    def grow(rows: np.ndarray, depth: int, low: float, high: float) -> int:
        k = node()
        g, h = grad[rows], hess[rows]
        value[k] = RATE * _leaf(g.sum(), h.sum(), low, high)
        best = (1e-6, None)
        if depth and len(rows) >= 2 * LEAST_ROWS:
            whole = g.sum() ** 2 / (h.sum() + SMOOTHING)
            for f in range(x.shape[1]):
                bins = binned[rows, f]
                n_bins = len(edges[f]) + 1
                gl, hl, nl = (np.cumsum(np.bincount(bins, w, n_bins))[:-1] for w in (g, h, None))
                gr, hr, nr = g.sum() - gl, h.sum() - hl, len(rows) - nl
                gain = gl**2 / (hl + SMOOTHING) + gr**2 / (hr + SMOOTHING) - whole
                ok = (nl >= LEAST_ROWS) & (nr >= LEAST_ROWS)
                if monotone[f]:
                    a, b = np.clip(-gl / (hl + SMOOTHING), low, high), np.clip(-gr / (hr + SMOOTHING), low, high)
                    ok &= (b - a) * monotone[f] >= 0
                gain = np.where(ok, gain, 0.0)
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), (f, int(gain.argmax())))
        if best[1] is not None:
            f, cut = best[1]
            goes = binned[rows, f] <= cut
            bounds = [(low, high), (low, high)]
            if monotone[f]:
                a, b = (_leaf(grad[r].sum(), hess[r].sum(), low, high) for r in (rows[goes], rows[~goes]))
                middle = (a + b) / 2
                bounds = [(low, middle), (middle, high)] if monotone[f] > 0 else [(middle, high), (low, middle)]
            feature[k], threshold[k] = f, float(edges[f][cut])
            left[k] = grow(rows[goes], depth - 1, *bounds[0])
            right[k] = grow(rows[~goes], depth - 1, *bounds[1])
        return k

    for _ in range(TREES if len(y) else 0):
        p = 1.0 / (1.0 + np.exp(-total))
        grad, hess = p - y, p * (1 - p)
        root = grow(np.arange(len(y)), DEPTH, -np.inf, np.inf)
        roots.append(root)
        at = np.full(len(y), root)
        f, t, le, ri, v = (np.array(a) for a in (feature, threshold, left, right, value))
        for _ in range(DEPTH):
            at = np.where(x[np.arange(len(y)), f[at]] <= t[at], le[at], ri[at])
        total += v[at]
    return Trees(
        base, np.array(roots, dtype=np.int64), np.array(feature, dtype=np.int64), np.array(threshold, dtype=float),
        np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), np.array(value, dtype=float),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, the COUNTS, ratios) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                both = [text_stats(t) for t in part.column(1).to_pylist()]
                counts = np.array([c for c, _ in both], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c) for c in counts.T), pa.array([r for _, r in both], pa.list_(pa.float64()))],
                    names=["doc_id", *COUNTS, "ratios"],
                )

    columns = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {columns}, ratios array<double>")


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents, those with the smallest hash of their id."""
    chosen = (
        labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.coalesce(F.max("toxic"), F.lit(0)).alias("toxic"))
        .dropna(subset=["doc_id", "quality"])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # Bounded by ``rows`` rows of three numbers.
    return docs.join(F.broadcast(chosen), "doc_id")


def rule_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  sample_rows: int = SAMPLE_ROWS, least: float = 0.5) -> DataFrame:
    """Per row: doc_id, the COUNTS, base_failed, score and kept.

    Null and empty texts have no words and fail the base rules. Without labels every document
    scores 0.5. Repeated rows and null ids are scored alike; of labels that
    repeat an id the worse counts. Empty table: empty result; other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = labelled_sample(base, labels, sample_rows)
    fitted = statistics(sample).join(sample.select("doc_id", "quality").distinct(), "doc_id").orderBy("doc_id").select("ratios", "quality").collect()
    x = np.array([r[0] for r in fitted], dtype=float).reshape(len(fitted), len(RATIOS))
    trees = fit_trees(x, np.array([float(r[1] > 0) for r in fitted]), np.array([MONOTONE.get(r, 0) for r in RATIOS]))

    @F.pandas_udf("double")
    def score(ratios):
        import pandas as pd

        rows = np.array(ratios.to_list(), dtype=float).reshape(len(ratios), len(RATIOS))
        return pd.Series(trees.scores(rows))

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATS * F.col("n_words"))
    scored = statistics(base).withColumn("score", score("ratios")).drop("ratios").withColumn("base_failed", failed)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))
