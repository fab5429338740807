"""Language identification by a string kernel.

The blended-spectrum presence kernel counts the byte n-grams (of one to three bytes) that two
texts share, over the geometric mean of how many each has. Nyström landmarks, a bounded sample
of training texts, stand for all others: a text is its kernel values with them, whitened, and
one-versus-rest kernel ridge regression over these features scores the languages. Whole batches
are scored by matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

ORDERS = 3
# Training texts per language, at most, and how many of all are landmarks.
ROWS_PER_LANGUAGE, LANDMARKS = 500, 192
RIDGE = 1e-2
UNDETERMINED = "und"
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    if _LETTERS[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)].any():
        return True
    return any(c.isalpha() for c in text)


def grams(text: str | None) -> np.ndarray:
    """Distinct n-grams of a whole text as numbers (their bytes below their length), ascending:
    A-Z lower-cased, all that is not a letter one space."""
    buf = np.frombuffer(b" " + (text or "").encode("utf-8", "surrogatepass").lower() + b" ", dtype=np.uint8)
    letter = _LETTERS[buf] | (buf >= 128)
    clean = np.where(letter, buf, 32).astype(np.int32)
    clean = clean[np.concatenate(([True], letter[1:] | letter[:-1]))]
    code, found = np.zeros(len(clean), dtype=np.int32), []
    for k in range(min(ORDERS, len(clean))):
        code = (code[: len(clean) - k] << 8) | clean[k:]
        found.append(code + np.int32(k << 24))
    return np.unique(np.concatenate(found))


def presence(rows: list[np.ndarray], vocabulary: np.ndarray) -> np.ndarray:
    """Rows of presence over the vocabulary, each over the root of how many grams its text has:
    products with landmarks, whose grams all are in the vocabulary, are the normalised kernel."""
    x = np.zeros((len(rows), len(vocabulary)), dtype=np.float32)
    for i, r in enumerate(rows):
        at = np.minimum(np.searchsorted(vocabulary, r), len(vocabulary) - 1)
        x[i, at[vocabulary[at] == r]] = 1.0 / np.sqrt(max(len(r), 1))
    return x


@dataclass
class LanguageModel:
    languages: list[str]
    vocabulary: np.ndarray  # the landmarks' grams
    landmarks: np.ndarray  # grams x landmarks
    weights: np.ndarray  # landmarks x languages, whitening included
    bias: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        rows = [grams(t) for t in texts]
        known = [has_letter(t) for t in texts]
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        values = presence(rows, self.vocabulary) @ self.landmarks @ self.weights + self.bias
        e = np.exp(6.0 * (values - values.max(axis=1, keepdims=True)))
        share = e / e.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        return (
            [self.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known, strict=True)],
            [float(share[i, b]) if k else 0.0 for i, (b, k) in enumerate(zip(best.tolist(), known, strict=True))],
        )


def fit_languages(rows: list[np.ndarray], langs: list[str]) -> LanguageModel:
    languages = sorted(set(langs))
    if not languages:
        return LanguageModel([], np.zeros(0, np.int32), np.zeros((0, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    # Landmarks are taken from the languages in turn.
    turn: dict[str, int] = {}
    place = []
    for i, lang in enumerate(langs):
        place.append((turn.setdefault(lang, 0), i))
        turn[lang] += 1
    chosen = [rows[i] for _, i in sorted(place)[:LANDMARKS]]
    vocabulary = np.unique(np.concatenate(chosen))
    marks = presence(chosen, vocabulary)
    inner = (marks @ marks.T).astype(float)
    values, vectors = np.linalg.eigh(inner)
    solid = values > 1e-6 * values.max()
    whiten = vectors[:, solid] / np.sqrt(values[solid])
    z = np.concatenate([(presence(rows[i : i + 128], vocabulary) @ marks.T).astype(float) @ whiten for i in range(0, len(rows), 128)])
    y = np.where(np.array(langs)[:, None] == np.array(languages), 1.0, -1.0)
    # Each language's rows weigh the same together.
    weight = np.array([1.0 / turn[lang] for lang in langs])[:, None] / len(languages)
    mz, my = (weight * z).sum(axis=0), (weight * y).sum(axis=0)
    zc, yc = z - mz, y - my
    w = np.linalg.solve((weight * zc).T @ zc + RIDGE * np.eye(zc.shape[1]) / 10, (weight * zc).T @ yc)
    return LanguageModel(languages, vocabulary, marks.T.copy(), (whiten @ w).astype(np.float32), my - mz @ w)


def training_rows(docs: DataFrame, per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """(doc_id, text, lang): at most ``per_language`` different texts of each language, those with
    the smallest hash, of the documents that are not held out. Copies count once.

    A language's smallest are taken within each of 64 hash ranges first, so no task holds more
    than a share of a frequent language.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    texts = known.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.min("doc_id").alias("doc_id"))
    narrow = texts.withColumn("slice", F.pmod(F.col("h"), F.lit(64)))
    first = narrow.withColumn("r", F.row_number().over(Window.partitionBy("lang", "slice").orderBy("h"))).filter(F.col("r") <= per_language)
    best = first.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("r") <= per_language)
    # At most per_language rows of three numbers for each language.
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    return rows.join(F.broadcast(best.select("doc_id", "lang", "h")), ["doc_id", "h"]).dropDuplicates(["doc_id", "h", "lang"]).drop("h")


def held_out(doc_id):
    """One id in five, by the checksum of its text; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score.

    Null texts and texts without a letter are ``und`` with score 0; so is everything where there
    is nothing to learn from. Repeated rows and null ids are predicted alike. Empty table: empty
    result; other columns are not read.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([grams(t) for t in batch.column(0).to_pylist()], pa.list_(pa.int64())), batch.column(1)], names=["grams", "lang"]
            )

    got = training_rows(base).orderBy(F.xxhash64("text"), "doc_id").select("text", "lang").mapInArrow(reduce, "grams array<long>, lang string").toArrow()
    model = fit_languages([np.array(g, dtype=np.int64) for g in got["grams"].to_pylist()], got["lang"].to_pylist())

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                pred, score = model.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    scored = base.select("doc_id", "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
