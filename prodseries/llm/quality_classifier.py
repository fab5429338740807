"""Quality classifier: hierarchical empirical Bayes.

A logistic model of statistics and words gives each document's evidence. Evidence, summed by
host and path with grouped aggregation, gives each site a beta posterior: hosts shrink to the
global rate, paths to their host, with strengths taken from the spread between sites, so a
sparse site says little. A document's posterior adds its site's log odds to its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseries.llm.common import maybe_broadcast, row_key, written
from prodseries.llm.hashing import mixed, spans_hash
from prodseries.llm.quality_rules import labelled_sample
from prodseries.llm.text_stats import _LETTER, RATIOS, text_stats

# Labelled rows that the document model is fitted on, at most.
SAMPLE_ROWS = 8_000
WORD_BITS, WORDS = 18, 512
# Beginnings of words, in bytes, that are features like whole words.
PREFIXES = (4, 5)
STEPS, RIDGE = 400, 1e-4
# Pseudo-documents that a site's prior counts for at least: what a site with as many documents says
# of itself is worth half. The spread between sites can only raise it.
LEAST_STRENGTH = 20.0
# Rates of sites are held this far from 0 and 1, where log odds have no number.
LEAST_RATE = 1e-9


def word_buckets(text: str | None) -> np.ndarray:
    """Distinct hash buckets of a text's words (runs of letters, A-Z lower-cased) and of their
    beginnings."""
    buf = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower() + b" ", dtype=np.uint8)
    edge = np.diff(np.concatenate(([False], _LETTER[buf])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    found = [spans_hash(buf, starts, ends)]
    for n in PREFIXES:
        longer = ends - starts > n
        found.append(mixed(spans_hash(buf, starts[longer], starts[longer] + n) + np.uint64(n)))
    return np.unique(np.concatenate(found) >> np.uint64(64 - WORD_BITS)).astype(np.int64)


@dataclass
class DocumentModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    words: np.ndarray  # weight of each bucket

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Log odds of a good document; a text without words has none of its own."""
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            counts, ratios = text_stats(text)
            if counts[0]:
                z = np.clip((np.array(ratios) - self.mean) / self.scale, -8, 8)
                out[i] = self.bias + z @ self.weights + self.words[word_buckets(text)].sum()
        return out


def fit_document_model(ratios: np.ndarray, buckets: list[np.ndarray], good: np.ndarray) -> DocumentModel:
    """Logistic regression by gradient steps, on statistics and the WORDS buckets that tell
    the classes apart best (by chi-square, of those in 5 rows or more)."""
    n = len(good)
    empty = DocumentModel(np.zeros(len(RATIOS)), np.ones(len(RATIOS)), np.zeros(len(RATIOS)), 0.0, np.zeros(1 << WORD_BITS))
    if not n or good.min() == good.max():
        return empty
    held = np.zeros((2, 1 << WORD_BITS))
    for b, y in zip(buckets, good.astype(int), strict=True):
        held[y, b] += 1
    rows, seen = np.array([(1 - good).sum(), good.sum()]), held.sum(axis=0)
    expected = seen * rows[0] / n
    chi = np.where(seen >= 5, (held[0] - expected) ** 2 / np.maximum(expected * (1 - seen / n) * rows[1] / n, 1e-9), 0.0)
    # Below this a bucket is chance (about one in 10,000).
    chosen = np.argsort(-chi, kind="stable")[:WORDS]
    chosen = chosen[chi[chosen] > 15.0]
    at = np.full(1 << WORD_BITS, -1)
    at[chosen] = np.arange(len(chosen))
    mean, scale = ratios.mean(axis=0), ratios.std(axis=0) + 1e-6
    x = np.zeros((n, len(RATIOS) + len(chosen)))
    x[:, : len(RATIOS)] = np.clip((ratios - mean) / scale, -8, 8)
    for i, b in enumerate(buckets):
        hit = at[b]
        x[i, len(RATIOS) + hit[hit >= 0]] = 1.0
    # Adam on the mean loss with a small ridge; no weighting, so odds follow the labels' rate.
    w, bias = np.zeros(x.shape[1]), float(np.log(rows[1] / rows[0]))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30)))
        g = np.append(x.T @ (p - good) / n + RIDGE * w, (p - good).mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    words = np.zeros(1 << WORD_BITS)
    words[chosen] = w[len(RATIOS) :]
    return DocumentModel(mean, scale, w[: len(RATIOS)], float(bias), words)


def document_model(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DocumentModel:
    """Fit on a bounded sample; a document is good if its quality is 1 and it is not toxic."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([text_stats(t)[1] for t in texts], pa.list_(pa.float64())),
                    pa.array([word_buckets(t) for t in texts], pa.list_(pa.int64())), batch.column(2),
                ],
                names=["doc_id", "ratios", "buckets", "good"],
            )

    good = ((F.col("quality") > 0) & (F.col("toxic") == 0)).cast("double").alias("good")
    sample = labelled_sample(docs, labels, rows).select("doc_id", "text", good)
    made = sample.mapInArrow(features, "doc_id long, ratios array<double>, buckets array<long>, good double")
    got = made.orderBy("doc_id").toArrow()
    ratios = np.array(got["ratios"].to_pylist(), dtype=float).reshape(got.num_rows, len(RATIOS))
    buckets = [np.array(b, dtype=np.int64) for b in got["buckets"].to_pylist()]
    return fit_document_model(ratios, buckets, np.asarray(got["good"], dtype=float))


def with_evidence(rows: DataFrame, model: DocumentModel) -> DataFrame:
    """Add ``evidence`` to rows of (doc_id, host, path, text, and ``key`` if they have it); the
    text goes."""
    names = [c for c in ("doc_id", "host", "path", "key") if c in rows.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                e = model.evidence(part.column(len(names)).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(names))), pa.array(e)], names=[*names, "evidence"])

    return rows.select(*names, "text").mapInArrow(run, rows.select(*names, F.lit(0.0).alias("evidence")).schema)


def strength(spread: float, mean: float) -> float:
    """Pseudo-documents of a beta prior with this mean and variance between sites; infinite
    without variance, where all sites are the prior."""
    return max(LEAST_STRENGTH, mean * (1 - mean) / spread - 1) if spread > 0 else float("inf")


def shrunk(good: Column, n: Column, prior: Column, k: float) -> Column:
    """The posterior rate of a site under a prior of ``k`` pseudo-documents."""
    rate = prior if np.isinf(k) else (good + k * prior) / (n + k)
    return F.least(F.greatest(rate, F.lit(LEAST_RATE)), F.lit(1 - LEAST_RATE))


def between_sites(sites: DataFrame, mean: Column) -> float:
    """Variance of site means around ``mean``, less what chance within sites explains."""
    rate = F.col("good") / F.col("n")
    row = sites.agg(
        F.sum(F.col("n") * (rate - mean) ** 2).alias("ss"), F.sum(rate * (1 - rate)).alias("chance"), F.sum("n").alias("n")
    ).first()
    return max(0.0, ((row["ss"] or 0.0) - (row["chance"] or 0.0)) / max(row["n"] or 0, 1))


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, prior: the path's posterior rate of good documents), and the global rate."""
    p = 1 / (1 + F.exp(-F.col("evidence")))
    paths = written(scored.groupBy("host", "path").agg(F.sum(p).alias("good"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    whole = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    rate = min(max((whole["good"] or 0.0) / max(whole["n"] or 0, 1), 1e-6), 1 - 1e-6)
    k = strength(between_sites(hosts, F.lit(rate)), rate)
    posts = written(hosts.select("host", shrunk(F.col("good"), F.col("n"), F.lit(rate), k).alias("host_rate")), "hosts")
    below = paths.join(posts, paths["host"].eqNullSafe(posts["host"])).select(paths["host"], "path", "good", "n", "host_rate")
    k2 = strength(between_sites(below, F.col("host_rate")), rate)
    prior = shrunk(F.col("good"), F.col("n"), F.col("host_rate"), k2)
    return written(below.select("host", "path", prior.alias("prior")), "sites"), rate


def posteriors(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
               least: float = 0.5) -> DataFrame:
    """Per row: doc_id, host, path, evidence (log odds), prior (of its site), score, kept.

    ``host`` and ``path`` are columns of ``docs``; nulls form sites of their own. Null and empty
    texts have no evidence and follow their site. Without labels of both classes no document
    has evidence, and all are kept. Repeated rows and null ids are scored alike; other columns
    are not read. Empty table: empty result.
    """
    return _scored(_rows(docs, host, path, id_col, text_col), labels, least)


def _rows(docs: DataFrame, host: Column, path: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"),
        F.col(text_col).alias("text"),
    )


def _scored(rows: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    model = document_model(rows, labels)
    scored = written(with_evidence(rows, model), "evidence")
    sites, rate = site_posteriors(scored)
    near = maybe_broadcast(sites, 200)
    same = scored["host"].eqNullSafe(near["host"]) & scored["path"].eqNullSafe(near["path"])
    pull = F.log(F.col("prior") / (1 - F.col("prior"))) - float(np.log(rate / (1 - rate)))
    odds = F.col("evidence") + pull
    joined = scored.join(near, same, "left").select(scored["*"], "prior")
    return joined.withColumn("score", 1 / (1 + F.exp(-odds))).withColumn("kept", F.col("score") >= least)


def kept_documents(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose posterior is not below a half, with all their columns. The verdict is
    on the row (its id, text and site), so rows without an id are kept or go one by one."""
    rows = _rows(docs, host, path, id_col, text_col)
    key = row_key(F.col("doc_id"), F.col("text"), F.col("host"), F.col("path"))
    found = _scored(rows.withColumn("key", key), labels)
    gone = found.filter(~F.col("kept")).select(F.col("key").alias("gone_key")).distinct()
    gone = maybe_broadcast(written(gone, "rejected"), 32)
    mine = row_key(docs[id_col].cast("long"), docs[text_col], host.cast("string"), path.cast("string"))
    return docs.join(gone, mine == gone["gone_key"], "left_anti")
