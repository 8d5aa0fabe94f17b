"""Language identification from character n-grams.

A text's letters, in lower case and with single spaces between words, give its n-grams of one to three
characters, hashed to ``BUCKETS`` features. A feature weighs log(1 + count) times its inverse document
frequency, and a text's weights have length 1. Document frequencies count all documents that may be learned
from. The classifier is a multinomial logistic regression trained by follow-the-regularised-leader with
elastic-net penalties, which leaves most weights exactly zero, on a bounded sample: ``PER_LANGUAGE`` documents
of each language are expected. A fifth of the sample is kept apart to choose the temperature that divides the
scores before they become probabilities.

A NULL text or one without a letter (of Unicode's categories of letters) gets ``und`` with score 0. Texts of any length
are read whole. More than ``MOST_LANGUAGES`` different languages are an error. Of the input's columns lang_pred and score
are replaced, all others stay. Ties between languages go to the one that sorts
first. Rows with NULL language are predicted, not learned from; NULL doc_ids too. Repeated rows count as
they come. With nothing to learn from, every text gets ``und``. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import table, written

UNKNOWN = "und"
BUCKETS = 1 << 16
#: Expected size of the sample of each language that the classifier is fitted on.
PER_LANGUAGE = 1500
#: Most different languages; the classifier has as many weights for each feature, and its sample as many parts.
MOST_LANGUAGES = 256
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1

_OTHERS = re.compile(r"[\W\d_]+")
_MULTIPLIERS = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SHIFT = np.uint64(48)


def buckets_of(text: str) -> np.ndarray:
    """The feature of every n-gram of a text; empty without a letter."""
    letters = _OTHERS.sub(" ", text.lower()).strip()
    # Numerals such as a half or a Roman eight pass the expression but are no letters.
    if not any(map(str.isalpha, letters)):
        return np.zeros(0, dtype=np.int64)
    c = np.frombuffer(f" {letters} ".encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
    two = c[:-1] << np.uint64(21) | c[1:]
    three = two[:-1] << np.uint64(21) | c[2:]
    # Unsigned products wrap round; the upper bits of a product are well mixed.
    return np.concatenate([(g * m) >> _SHIFT for g, m in zip((c, two, three), _MULTIPLIERS, strict=True)]).astype(np.int64)


def weighted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and their weights."""
    counts = np.bincount(buckets_of(text), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    weights = np.log1p(counts[found]) * idf[found]
    return found, weights / max(float(np.sqrt(weights @ weights)), 1e-12)


def softmax(scores: np.ndarray) -> np.ndarray:
    exp = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return exp / exp.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str) -> tuple[str, float]:
        found, weights = weighted(text, self.idf)
        if not len(found) or not self.languages:
            return UNKNOWN, 0.0
        chances = softmax(weights @ self.weights[found] / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes of follow-the-regularised-leader, one example at a time."""
    z = np.zeros((BUCKETS, classes))
    n = np.zeros((BUCKETS, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(epochs):
        for found, values, label in examples:
            zs, ns = z[found], n[found]
            w = weights(zs, ns)
            error = softmax(values @ w)
            error[label] -= 1
            gradient = np.multiply.outer(values, error)
            grown = ns + gradient * gradient
            z[found] = zs + gradient - (np.sqrt(grown) - np.sqrt(ns)) / ALPHA * w
            n[found] = grown
    return weights(z, n)


def best_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss; 1 without examples."""
    if not len(labels):
        return 1.0
    tried = np.geomspace(0.05, 5, 93)
    losses = [-np.log(np.maximum(softmax(scores / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in tried]
    return float(tried[int(np.argmin(losses))])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, and the number of texts. A task sends one row per feature."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(BUCKETS + 1, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                seen = np.unique(buckets_of(text.as_py()))
                total[seen] += 1
                texts += 1
        total[BUCKETS] = texts
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(BUCKETS + 1, dtype=np.int64)
    for row in rows.collect():
        total[row.bucket] = row.n
    return total[:BUCKETS], int(total[BUCKETS])


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from ``labelled`` (doc_id, text, lang), none of them NULL."""
    frequencies, texts = document_frequencies(labelled)
    idf = np.log((1 + texts) / (1 + frequencies)) + 1
    counted = labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different values of lang: not a column of languages")
    sizes = {r.lang: r.n for r in counted}
    languages = sorted(sizes)
    if not languages:
        return Model([], idf, np.zeros((BUCKETS, 0), np.float32), 1.0)
    spark = labelled.sparkSession
    # A row's hash decides whether it is in the sample: as many of each language as are wanted, on average.
    rates = spark.createDataFrame(
        [(name, n, min(1.0, per_language / sizes[name])) for n, name in enumerate(languages)],
        "lang string, label int, rate double",
    )
    place = F.xxhash64(F.lit("language sample"), "doc_id", "text")
    share = F.pmod(place, F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.join(F.broadcast(rates), "lang").where(share < F.col("rate"))
    sample = sample.select("label", "text", place.alias("place"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for label, text, place in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found, values = weighted(text, idf)
                rows.append((place, label, found, values))
        rows.sort(key=lambda r: (r[0], r[1]))
        held = [r for i, r in enumerate(rows) if i % 5 == 4]
        fitted = [(f, v, label) for i, (_, label, f, v) in enumerate(rows) if i % 5 != 4]
        weights = ftrl(fitted, len(languages))
        scores = np.array([v @ weights[f] for _, _, f, v in held]).reshape(-1, len(languages))
        temperature = best_temperature(scores, np.array([r[1] for r in held], dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype("<f4").tobytes()]), pa.array([temperature])], names=["weights", "temperature"]
        )

    # The sample is bounded, so one task fits the model.
    row = written(sample.repartition(1).mapInArrow(fit, "weights binary, temperature double"), "language-model").first()
    weights = np.frombuffer(row.weights, dtype="<f4").reshape(BUCKETS, len(languages))
    return Model(languages, idf, weights, row.temperature)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score. The model's size is fixed by its features and languages."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def language(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        found = [sent.value.predict(t) if t is not None else (UNKNOWN, 0.0) for t in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    own = f"__language_{'_'.join(rest)}"  # no column's name
    done = docs.select(*rest, language("text").alias(own))
    return done.select(*rest, F.col(own).lang_pred.alias("lang_pred"), F.col(own).score.alias("score"))


def remainder(doc_id: Column, divisor: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def trained_on(docs: DataFrame) -> Model:
    """The model learned from rows with a language that are not held out."""
    labelled = docs.where((remainder(F.col("doc_id"), 4) != 2) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    return train(labelled.select("doc_id", "text", "lang"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; a quarter of them is held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    done = predict(docs.select("doc_id", "text"), trained_on(docs))
    return done.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
