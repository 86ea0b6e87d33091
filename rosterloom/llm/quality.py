"""Quality of texts: word vectors by random indexing, pooled per document, and a two-layer network.

Every word and every word shape (kinds of characters, length) is hashed into one of `BUCKETS`. A bucket has a fixed
sparse index vector; its word vector is the sum of the index vectors that stood near it in the sample. Pooled vectors and
a few ratios feed a small numpy network whose logit is divided by a temperature fitted on rows it was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.learning import bounded_sample, held_out, temperature
from rosterloom.llm.storage import stored
from rosterloom.llm.text_arrays import Words, byte_set, grouped, mixed

BUCKETS = 1 << 14
#: Words whose vectors are in memory at a time (at most twice as many).
_PIECE = 1 << 14
DIMENSIONS = 32
_NONZERO = 4
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)
_RATIOS = 6
_NOT_SPACE = ~byte_set((9, 13), (32, 32))
_KINDS = np.zeros(256, np.uint8)  # bits: lower case, upper case, digit, quiet mark, loud mark, not ASCII
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58], _KINDS[128:] = 1, 2, 4, 32
for _mark in range(33, 127):
    if not chr(_mark).isalnum():
        _KINDS[_mark] = 8 if chr(_mark) in ",.;:'-()" else 16


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero parts of every bucket's index vector."""
    h = mixed(np.arange(1, BUCKETS * _NONZERO + 1, dtype=np.uint64)).reshape(BUCKETS, _NONZERO)
    return (h % np.uint64(DIMENSIONS)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


class _Buckets:
    """Buckets of words and of shapes for a group of texts."""

    def __init__(self, group: list[bytes]) -> None:
        words = Words(group, _NOT_SPACE)
        self.first = words.first
        self.length = words.ends - words.starts
        self.word = (words.hashes() >> _SHIFT).astype(np.int64)
        if len(words):
            kinds = np.bitwise_or.reduceat(_KINDS[words.data], words.starts)
            # the byte of white space after a word has no kind, so it adds nothing
            initial = _KINDS[words.data[words.starts]]
            size = np.minimum(np.log2(self.length).astype(np.uint64), np.uint64(7))
            shape = (kinds.astype(np.uint64) << np.uint64(16)) | (initial.astype(np.uint64) << np.uint64(8)) | size
            self.shape = (mixed(shape + np.uint64(1 << 40)) >> _SHIFT).astype(np.int64)
        else:
            self.shape = self.word


def _contexts(texts: Iterable[str | None], window: int = 2) -> np.ndarray:
    """Sums of the index vectors of the neighbours of each word, and of the words with each shape."""
    places, signs = _index_vectors()
    out = np.zeros(BUCKETS * DIMENSIONS)

    def add(target: np.ndarray, source: np.ndarray) -> None:
        for begin in range(0, len(target), 4 * _PIECE):  # bounded memory, however long the text
            to, of = target[begin : begin + 4 * _PIECE], source[begin : begin + 4 * _PIECE]
            cells = (to[:, None] * DIMENSIONS + places[of]).reshape(-1)
            out[:] += np.bincount(cells, signs[of].reshape(-1), minlength=len(out))

    for group in grouped(texts):
        b = _Buckets(group)
        doc = np.repeat(np.arange(len(group)), np.diff(b.first))
        for k in range(1, window + 1):
            near = doc[k:] == doc[:-k]
            for target, source in ((b.word[k:], b.word[:-k]), (b.word[:-k], b.word[k:])):
                add(target[near], source[near])
        add(b.shape, b.shape)
        near = doc[1:] == doc[:-1]
        add(b.shape[1:][near], b.shape[:-1][near])
    return out.reshape(BUCKETS, DIMENSIONS)


def _pooled(vectors: np.ndarray, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the vectors of each text's words; whole texts, a bounded number of words at a time.

    Texts are cut at multiples of `_PIECE` words from their own start, so a sum does not depend on the texts beside it.
    """
    out = np.zeros((len(first) - 1, vectors.shape[1]), np.float32)
    pieces = -(-np.diff(first) // _PIECE)
    owner = np.repeat(np.arange(len(pieces)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = first[:-1][owner] + nth * _PIECE
    ends = np.minimum(starts + _PIECE, first[1:][owner])
    bounds = np.flatnonzero(np.diff(starts // _PIECE, prepend=-1)).tolist() + [len(starts)]
    for low, high in zip(bounds, bounds[1:], strict=False):
        a, z = starts[low], ends[high - 1]
        np.add.at(out, owner[low:high], np.add.reduceat(vectors[buckets[a:z]], starts[low:high] - a))
    return out


def document_vectors(texts: Iterable[str | None], vectors: np.ndarray) -> Iterator[np.ndarray]:
    """For lists of texts in order: a row for each, of pooled word vectors, pooled shape vectors and ratios."""
    for group in grouped(texts):
        b = _Buckets(group)
        n = np.diff(b.first)
        out = np.zeros((len(group), 2 * DIMENSIONS + _RATIOS), np.float32)
        some = n > 0
        if some.any():
            begin = b.first[:-1][some]
            size = n[some].astype(np.float32)
            doc = np.repeat(np.arange(len(group)), n)
            for at, buckets in ((0, b.word), (DIMENSIONS, b.shape)):
                out[some, at : at + DIMENSIONS] = _pooled(vectors, buckets, b.first)[some] / size[:, None]
            distinct = np.unique(doc * BUCKETS + b.word)
            again = np.zeros(len(doc), np.float32)
            again[1:] = (b.word[1:] == b.word[:-1]) & (doc[1:] == doc[:-1])
            lengths = b.length.astype(np.float32)
            out[some, -6] = np.log1p(size) / 8
            out[some, -5] = np.bincount(distinct // BUCKETS, minlength=len(group))[some] / size
            out[some, -4] = np.add.reduceat(again, begin) / size
            out[some, -3] = np.log1p(np.add.reduceat(lengths, begin) / size)
            out[some, -2] = np.sqrt((out[some, :DIMENSIONS] ** 2).sum(axis=1))
            out[some, -1] = np.sqrt((out[some, DIMENSIONS : 2 * DIMENSIONS] ** 2).sum(axis=1))
        yield out


@dataclass
class QualityModel:
    vectors: np.ndarray
    layers: list[np.ndarray] = field(default_factory=list)
    divisor: float = 1.0

    def score(self, texts: Iterable[str | None]) -> np.ndarray:
        """Probabilities of label 1; 0.5 throughout if there was nothing to learn from."""
        parts = [self._probability(x) for x in document_vectors(texts, self.vectors)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _probability(self, x: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(x), 0.5)
        z = np.clip(_logit(x.astype(float), self.layers) / self.divisor, -500, 500)
        return 1 / (1 + np.exp(-z))


def _logit(x: np.ndarray, layers: list[np.ndarray]) -> np.ndarray:
    mean, spread, w1, b1, w2, b2 = layers
    return np.tanh((x - mean) / spread @ w1 + b1) @ w2 + b2


def _train(x: np.ndarray, y: np.ndarray, hidden: int, epochs: int) -> list[np.ndarray]:
    """Weights of the network by Adam on the log loss."""
    random = np.random.default_rng(11)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    inputs = (x - mean) / spread
    p = [random.normal(0, 0.1, (x.shape[1], hidden)), np.zeros(hidden), random.normal(0, 0.1, hidden), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p]
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(y))
        for begin in range(0, len(y), 128):
            rows = order[begin : begin + 128]
            a, step = inputs[rows], step + 1
            h = np.tanh(a @ p[0] + p[1])
            error = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -500, 500))) - y[rows]) / len(rows)
            back = error[:, None] * p[2] * (1 - h * h)
            gradients = [a.T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ error + 1e-4 * p[2], error.sum(keepdims=True)]
            for k, g in enumerate(gradients):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] -= 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return [mean, spread, *p]


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 3000, hidden: int = 24, epochs: int = 30) -> QualityModel:
    """A model from labelled rows of `docs` (doc_id, text) that are not held out.

    `labels` has doc_id and quality (0 or 1). About `per_label` rows of each label are used: word vectors and network
    belong to the fit. A doc_id with several labels has the largest. Null labels and null ids are not used.
    """
    labelled = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out("doc_id"))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("quality").cast("int")).alias("quality"))
    )
    chosen = bounded_sample(labelled, "quality", per_label, "doc_id")  # bounded: fit for a broadcast
    sample = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .repartition(8, F.xxhash64("doc_id", "text")),
        "quality-sample",
    )
    columns = [f"v{k}" for k in range(DIMENSIONS)]

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BUCKETS, DIMENSIONS))
        for batch in batches:
            total += _contexts(batch["text"])
        seen = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame(total[seen], columns=columns).assign(bucket=seen)

    schema = ", ".join(f"{c} double" for c in columns) + ", bucket long"
    summed = sample.select("text").mapInPandas(contexts, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns])
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    got = summed.toPandas()  # BUCKETS rows at most
    if len(got):
        raw = got[columns].to_numpy()
        vectors[got["bucket"].to_numpy()] = raw / np.maximum(np.sqrt((raw * raw).sum(axis=1, keepdims=True)), 1e-9)

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = np.concatenate(list(document_vectors(batch["text"], vectors)) or [np.zeros((0, 1), np.float32)])
            yield pd.DataFrame({"quality": batch["quality"], "x": [r.astype("<f4").tobytes() for r in rows]})

    rows = sorted((bytes(x), q) for x, q in sample.mapInPandas(featured, "quality int, x binary").select("x", "quality").collect())
    if not rows:
        return QualityModel(vectors)
    x = np.array([np.frombuffer(r, "<f4") for r, _ in rows], float)
    y = np.array([q for _, q in rows], float)
    aside = np.arange(len(y)) % 5 == 0
    if aside.all():
        aside[:] = False
    layers = _train(x[~aside], y[~aside], hidden, epochs)
    z = _logit(x[aside], layers)
    divisor = temperature(np.stack((np.zeros_like(z), z), axis=1), y[aside].astype(int))
    return QualityModel(vectors, layers, divisor)


def scores(text: Column, model: QualityModel) -> Column:
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts), dtype=float)

    return F.pandas_udf(of, "double")(text.cast("string"))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, model: QualityModel | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs` (doc_id, text); null text is the empty text.

    Without any label to learn from, every score is 0.5. Repeated rows are scored row by row; other columns are not read.
    """
    model = fit(docs, labels) if model is None else model
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out("doc_id").alias("held_out"),
        scores(F.col("text"), model).alias("score"),
    )
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
