"""What the classifiers share: held-out rows, bounded samples, temperature."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
_RANGE = 1 << 31


def held_out(doc_id: Column | str) -> Column:
    """Whether crc32 of the id as text leaves no remainder modulo 5; rows without an id are never learnt from."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def chosen(df: DataFrame, by: str, per_value: int, counts: dict[object, int], *key: str) -> DataFrame:
    """About `per_value` rows for each value of `by`, chosen by a hash of `key`. `counts`: how often each value occurs."""
    if not counts:
        return df.limit(0)
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(_RANGE * min(1.0, per_value / n)))])
    return df.where(F.pmod(F.xxhash64(*key), F.lit(_RANGE)) <= shares[F.col(by)])


def bounded_sample(df: DataFrame, by: str, per_value: int, *key: str) -> DataFrame:
    """About `per_value` rows (twice that in all at most) for each value of `by`, chosen by a hash of `key`.

    `by` must have few values: their counts go through the driver. The bound takes the rows through one task, so they
    must be short; whole texts are `chosen`, made small where they are, and bounded then.
    """
    counts = {r[by]: r["count"] for r in df.where(F.col(by).isNotNull()).groupBy(by).count().collect()}
    return chosen(df, by, per_value, counts, *key).limit(2 * per_value * len(counts))


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of `logits` that makes the probabilities of `truth` likeliest, on rows the model was not fitted to."""
    if not len(truth):
        return 1.0
    tried = np.geomspace(0.05, 20, 121)
    loss = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])
