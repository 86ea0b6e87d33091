"""Language of texts: multinomial logistic regression on TF-IDF of character n-grams.

N-grams of one to three characters are hashed into `BUCKETS`. Document frequencies are counted over every row that may
be learnt from; weights are fitted to a bounded sample of them by follow-the-regularised-leader with an elastic net,
and probabilities are calibrated by a temperature on a part of the sample that the fit does not see.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.learning import chosen, held_out, softmax, temperature
from rosterloom.llm.text_arrays import give_back

BUCKETS = 1 << 13
_LETTER = re.compile(r"[^\W\d_]")
_STEP = 1 << 18
#: Texts whose features are in memory at a time.
_ROWS = 256


def ngram_counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams (1 to 3 lower-case characters) occur in the whole text."""
    out = np.zeros(BUCKETS, np.int64)
    lowered = text.lower()
    for begin in range(0, len(lowered), _STEP):  # parts overlap by two characters, so no n-gram is lost or doubled
        own = min(_STEP, len(lowered) - begin)
        c = np.frombuffer(
            lowered[begin : begin + own + 2].encode("utf-32-le", "surrogatepass"), np.uint32
        ) * np.uint32(0x9E3779B1)
        shift = np.uint32(32 - BUCKETS.bit_length() + 1)
        h = c
        for n in range(1, 4):
            if n > 1:
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + c[n - 1 :]
            out += np.bincount((h[:own] * np.uint32(0xC2B2AE35)) >> shift, minlength=BUCKETS)
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    divisor: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not isinstance(text, str) or not _LETTER.search(text):
            return "und", 0.0
        at, value = features(text, self.idf)
        p = softmax((value @ self.weights[at] + self.weights[-1]) / self.divisor)
        best = int(np.argmax(p))  # ties: the first in alphabetical order
        return self.languages[best], float(p[best])


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = ngram_counts(text)
    at = np.flatnonzero(counts)
    value = (1 + np.log(counts[at])) * idf[at]
    return at, value / max(np.sqrt((value * value).sum()), 1e-12)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, dict[str, int]]:
    """Over all rows with text and lang: in how many each bucket occurs, and the rows of each lang. Sums are made in Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(BUCKETS, np.int64), Counter()
        for batch in batches:
            for text in batch.column("text"):  # one text at a time as a string
                seen += ngram_counts(text.as_py()) > 0
            rows.update(batch.column("lang").to_pylist())
        give_back()
        at = np.flatnonzero(seen)
        yield pa.record_batch(
            {
                "bucket": pa.array([*at.tolist(), *[None] * len(rows)], pa.int64()),
                "lang": pa.array([*[None] * len(at), *rows], pa.string()),
                "n": pa.array([*seen[at].tolist(), *rows.values()], pa.int64()),
            }
        )

    counted = (
        docs.select("text", "lang").mapInArrow(count, "bucket long, lang string, n long")
        .groupBy("bucket", "lang").agg(F.sum("n").alias("n"))
    )
    out, rows = np.zeros(BUCKETS, np.int64), {}
    for bucket, lang, n in counted.collect():  # BUCKETS rows at most, and one for each lang
        if bucket is None:
            rows[lang] = n
        else:
            out[bucket] = n
    return out, rows


def sample_features(learnable: DataFrame, idf: np.ndarray, rows: dict[str, int], per_language: int) -> DataFrame:
    """lang and features (places as 32-bit integers, values as 32-bit floats) of about `per_language` rows of each lang.

    They are made where the texts are. Only features, of at most 8 bytes a bucket, go on from there.
    """

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(begin, _ROWS)
                made = [features(t.as_py(), idf) for t in batch.column("text")]
                yield pa.record_batch(
                    {
                        "lang": batch.column("lang"),
                        "at": pa.array([a.astype("<i4").tobytes() for a, _ in made], pa.binary()),
                        "value": pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary()),
                    }
                )
        give_back()

    sample = chosen(learnable, "lang", per_language, rows, "doc_id", "text").select("text", "lang")
    return sample.mapInArrow(featured, "lang string, at binary, value binary").limit(2 * per_language * len(rows))


def _ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]], truth: np.ndarray, classes: int,
    alpha: float, beta: float, l1: float, l2: float, epochs: int,
) -> np.ndarray:
    """Weights (a row for each bucket, the last one for the bias) by proximal follow-the-regularised-leader."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        kept = np.maximum(np.abs(z[at]) - l1, 0)
        return -np.sign(z[at]) * kept / ((beta + np.sqrt(n[at])) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, value = np.append(rows[k][0], BUCKETS), np.append(rows[k][1], 1.0)
            w = weights(at)
            error = softmax(value @ w)
            error[truth[k]] -= 1
            gradient = value[:, None] * error
            squared = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / alpha * w
            n[at] += squared
    return weights(slice(None))


def fit(
    docs: DataFrame, per_language: int = 800, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3,
    epochs: int = 4,
) -> LanguageModel:
    """A model from the rows of `docs` (doc_id, text, lang) that are not held out and have text and lang.

    Weights come from a sample of about `per_language` rows of each language; document frequencies from all rows.
    """
    learnable = docs.where(~held_out("doc_id") & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    seen, rows = document_frequencies(learnable)
    idf = np.log((1 + sum(rows.values())) / (1 + seen)) + 1
    if not rows:
        return LanguageModel([], idf, np.zeros((BUCKETS + 1, 0)), 1.0)
    got = sample_features(learnable, idf, rows, per_language).collect()
    got = sorted(got, key=lambda r: (bytes(r["at"]), bytes(r["value"])))  # the same order in every run
    languages = sorted({r["lang"] for r in got})
    data = [(np.frombuffer(r["at"], "<i4"), np.frombuffer(r["value"], "<f4").astype(float)) for r in got]
    truth = np.array([languages.index(r["lang"]) for r in got])
    aside = np.arange(len(data)) % 5 == 0
    used = [d for d, a in zip(data, aside, strict=True) if not a] or data
    weights = _ftrl(used, truth[~aside] if (~aside).any() else truth, len(languages), alpha, beta, l1, l2, epochs)
    unseen = [d for d, a in zip(data, aside, strict=True) if a]
    logits = np.array([v @ weights[a] + weights[-1] for a, v in unseen]).reshape(len(unseen), len(languages))
    return LanguageModel(languages, idf, weights, temperature(logits, truth[aside]))


def _predicted(texts: pa.Array, model: LanguageModel) -> list[pa.Array]:
    """lang_pred and score of each text."""
    found = [model.predict(t.as_py()) for t in texts]
    return [pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())]


def predictions(text: Column, model: LanguageModel) -> Column:
    """A struct of lang_pred and score."""

    def of(texts: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_predicted(texts, model), ["lang_pred", "score"])

    return F.arrow_udf(of, "lang_pred string, score double")(text.cast("string"))


def identified(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `docs` (doc_id, text, lang).

    Null texts and texts without a letter are `und` with score 0, and so is all if there was nothing to learn from.
    Repeated rows are judged row by row; a row without id is held out. Other columns are not read.
    """
    model = fit(docs) if model is None else model

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column("doc_id"), batch.column("held_out"), *_predicted(batch.column("text"), model)]
            yield pa.record_batch(columns, ["doc_id", "held_out", "lang_pred", "score"])
        give_back()

    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out("doc_id").alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    # not a column of rows that wait: those would be held, texts and all, until their batch is back
    return read.mapInArrow(judged, "doc_id long, held_out boolean, lang_pred string, score double")
