"""From raw documents to packed training sequences, one written table per stage.

Every stage works on all that its predecessor kept. All but the last return the columns of the
documents table; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseries.llm import decontamination, line_chunks, near_duplicates, packing, quality_classifier
from prodseries.llm.common import dropped, free_name, scope, written
from prodseries.llm.queries import TOKENIZER, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior of being good is below a half go."""
    path = F.concat_ws("/", "source", "lang")
    return quality_classifier.kept_documents(docs, table(spark, sf_dir, "labels"), F.col("source"), path)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Multi-line chunks that an earlier document has are cut out; n_chars follows the text.
    Documents go that lose lines and have no word left; those that had none come as they are."""
    removed = free_name(docs, "n_removed")
    cleaned = line_chunks.without_repeats(docs, lines_col=free_name(docs, "n_lines"), removed_col=removed)
    left = cleaned.filter((F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", changed).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return near_duplicates.one_of_each(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item (or a whole shorter one) go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 tokens along the curve, as pieces of documents with their ids."""
    return packing.packed(docs, TOKENIZER, width=2048)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Tables that stages wrote for themselves, until a later stage has read their result.
_SPENT: dict[str, list[str]] = {}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer rows at a time between the JVM and its Python workers, which both hold them: ten
    thousand whole texts are tens of megabytes on either side of every task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, 1000)
    try:
        yield
    finally:
        spark.conf.set(name, old)


def tidied(stage: Stage) -> Stage:
    """The stage, which first drops what earlier ones wrote for themselves: its documents have been
    written by then. Where they have not, and still come from such tables, all of them stay."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spent = _SPENT.setdefault(spark.sparkContext.applicationId, [])
        sources = docs.inputFiles() if spent else []
        if spent and sources and not any(path in file for path in spent for file in sources):
            dropped(spark, spent)
            spent.clear()
        with scope() as own, small_batches(spark):
            out = stage(spark, docs, sf_dir)
        spent.extend(own)
        return out

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    (name, tidied(stage))
    for name, stage in (
        ("quality_classifier", quality),
        ("line_dedup", line_dedup),
        ("minhash_near_dedup", near_dedup),
        ("decontamination", decontaminate),
        ("packing", pack),
    )
]

# The trained model, the hashed chunks and the tokenizer are beyond SQL; tests/llm holds each
# stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scope() as own:
            docs = written(stage(spark, docs, sf_dir), name)
        # The documents before are read; the last result stays.
        dropped(spark, held)
        held = own
    dropped(spark, _SPENT.pop(spark.sparkContext.applicationId, []))
    return docs
