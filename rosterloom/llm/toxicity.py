"""Toxicity of texts by their nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and beginnings of words (so that inflected forms meet), of which those stay whose documents in the sample
are clearly more often toxic. A text is its vector over these terms. Examples lie in blocks; for every term the index has
its postings by block and the largest weight in each block, so that a block whose bound cannot reach the k nearest found so
far is never opened. Votes of the nearest, weighted by similarity, are calibrated on examples that did not vote for
themselves. Texts without any such term have the share of toxic ones among examples without any.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.learning import bounded_sample, held_out
from rosterloom.llm.storage import stored
from rosterloom.llm.text_arrays import Words, byte_set, give_back, grouped, mixed

_WORD_BYTES = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Bytes of the beginnings of words that are terms.
PREFIXES = (4, 5, 6, 7)
_POSTINGS_BLOCK = 64


def text_terms(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For groups of whole texts in order: term hashes, the place in the group of each one's text, and how many texts."""
    lowered = (t.lower() if isinstance(t, str) else t for t in texts)
    for group in grouped(lowered, 1 << 19):
        words = Words(group, _WORD_BYTES)
        owner = np.repeat(np.arange(len(group)), np.diff(words.first))
        kinds, owners = [words.hashes()], [owner]
        length = words.ends - words.starts
        for k in PREFIXES:
            longer = np.flatnonzero(length > k)
            kinds.append(mixed(words.prefix_hashes(longer, k) + np.uint64(k)))
            owners.append(owner[longer])
        yield np.concatenate(kinds), np.concatenate(owners), len(group)


def _counted(terms: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, term) pairs, in that order, and how often each occurs."""
    order = np.lexsort((terms, owners))
    terms, owners = terms[order], owners[order]
    new = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (owners[1:] != owners[:-1]))) if len(terms) else order
    return owners[new], terms[new], np.diff(np.append(new, len(terms)))


class Vocabulary:
    """Terms by place; `weights` are their inverse document frequencies."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray | None = None) -> None:
        self.terms = np.sort(terms)
        self.weights = np.ones(len(terms)) if weights is None else weights

    def places(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text: places of the vocabulary's terms in it, ascending, and their counts."""
        for terms, owners, n in text_terms(texts):
            if len(self.terms):
                at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
                known = self.terms[at] == terms
            else:
                at, known = np.zeros(len(terms), np.int64), np.zeros(len(terms), bool)
            owner, place, count = _counted(at[known], owners[known])
            edges = np.searchsorted(owner, np.arange(n + 1))
            for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                yield place[a:z], count[a:z]

    def vector(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The unit vector of a text at its places; nothing if it has no term."""
        values = (1 + np.log(counts)) * self.weights[places]
        return values / np.sqrt((values * values).sum()) if len(values) else values


class BlockMaxIndex:
    """Unit vectors of examples by term, in blocks, with the largest weight of each term in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int) -> None:
        """`vectors` has places and weights of every example. The order of examples decides ties and which ones share a block."""
        self.n = len(vectors)
        size = [len(p) for p, _ in vectors]
        place = np.concatenate([p for p, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        example = np.repeat(np.arange(self.n), size)
        order = np.lexsort((example, place))
        self.example, self.weight = example[order].astype(np.int32), weight[order]
        place, block = place[order], example[order] // _POSTINGS_BLOCK
        new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (block[1:] != block[:-1]))) if len(place) else order
        #: Runs of postings of one term in one block: where they begin, their block and their largest weight.
        self.run_start = np.append(new, len(place))
        self.run_block = block[new].astype(np.int32)
        self.run_most = np.maximum.reduceat(self.weight, new) if len(new) else self.weight
        #: Where the runs of each term begin.
        self.term_start = np.searchsorted(place[new], np.arange(terms + 1))
        self.blocks = -(-self.n // _POSTINGS_BLOCK)

    def nearest(self, places: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Examples with the k largest positive inner products, and those, largest first, ties to the earlier example.

        `without` is an example that takes no part.
        """
        low, high = self.term_start[places], self.term_start[places + 1]
        runs = _ranges(low, high)
        factor = np.repeat(weights, high - low)
        bound = np.bincount(self.run_block[runs], factor * self.run_most[runs], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        begin, step = 0, 4
        while begin < len(order):
            # Rounding may put a sum a little above its bound.
            if len(scores) >= k and bound[order[begin]] * (1 + 1e-9) < scores[k - 1]:
                break
            opened = np.zeros(self.blocks, bool)
            opened[order[begin : begin + step]] = True
            mine = np.flatnonzero(opened[self.run_block[runs]])
            first, last = self.run_start[runs[mine]], self.run_start[runs[mine] + 1]
            posts = _ranges(first, last)
            ids, of = np.unique(self.example[posts], return_inverse=True)
            sums = np.bincount(of, np.repeat(factor[mine], last - first) * self.weight[posts], len(ids))
            keep = (ids != without) & (sums > 0)
            found, scores = np.concatenate((found, ids[keep])), np.concatenate((scores, sums[keep]))
            best = np.lexsort((found, -scores))[:k]
            found, scores = found[best], scores[best]
            begin, step = begin + step, 2 * step
        return found, scores


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """low[i], low[i] + 1, ... high[i] - 1 for all i, one after the other."""
    size = high - low
    ends = np.cumsum(size)
    return np.repeat(low - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class ToxicityModel:
    vocabulary: Vocabulary
    index: BlockMaxIndex
    toxic: np.ndarray
    share: np.ndarray
    ids: np.ndarray
    prior: float = 0.0
    without_terms: float = 0.0
    slope: float = 1.0
    offset: float = 0.0
    k: int = 32

    def vote(self, places: np.ndarray, counts: np.ndarray, without: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """The smoothed share of toxic votes, the nearest examples and their similarities."""
        near, similarity = self.index.nearest(places, self.vocabulary.vector(places, counts), self.k, without)
        weight = self.share[near] * similarity * similarity
        return (weight @ self.toxic[near] + 0.25 * self.prior) / (weight.sum() + 0.25), near, similarity

    def calibrated(self, vote: float) -> float:
        z = self.slope * np.log(max(vote, 1e-6) / max(1 - vote, 1e-6)) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    def score(self, places: np.ndarray, counts: np.ndarray, evidence: int = 3) -> tuple[float, list[dict]]:
        """The probability that a text is toxic, and its nearest examples."""
        if not len(places) or not self.index.n:
            return self.without_terms, []
        vote, near, similarity = self.vote(places, counts)
        told = zip(near[:evidence].tolist(), similarity[:evidence].tolist(), strict=True)
        return self.calibrated(vote), [
            {"doc_id": int(self.ids[e]), "similarity": s, "toxic": int(self.toxic[e])} for e, s in told
        ]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the likeliest logistic curve, held near slope 1 and offset 0 by a weak penalty."""
    w = np.array([1.0, 0.0])
    inputs = np.stack((x, np.ones_like(x)), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(inputs @ w, -500, 500)))
        gradient = inputs.T @ (weight * (p - y)) + (w - [1.0, 0.0])
        curvature = (inputs * (weight * p * (1 - p))[:, None]).T @ inputs + np.eye(2)
        w = w - np.linalg.solve(curvature, gradient)
    return float(w[0]), float(w[1])


def _telling_terms(sample: DataFrame, least: int, times: float, most_terms: int) -> np.ndarray:
    """Terms whose odds among toxic documents are, with little doubt, `times` those among others."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, begin = batch["toxic"].to_numpy(), 0
            for terms, owners, n in text_terms(batch["text"]):
                owner, term, _ = _counted(terms, owners)
                names, which = np.unique(term, return_inverse=True)
                ones = np.bincount(which, toxic[begin + owner], len(names)).astype(np.int64)
                every = np.bincount(which, minlength=len(names))
                yield pd.DataFrame({"term": names.view(np.int64), "toxic": ones, "other": every - ones})
                begin += n

    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    a, b = F.col("toxic") + 0.5, F.col("other") + 0.5
    odds = F.log(a / (n1 + 1 - a)) - F.log(b / (n0 + 1 - b))
    doubt = F.sqrt(1 / a + 1 / b + 1 / (n1 + 1 - a) + 1 / (n0 + 1 - b))
    found = (
        sample.select("text", "toxic").mapInPandas(counts, "term long, toxic long, other long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where(F.col("toxic") >= least)
        .select("term", (odds - 2 * doubt).alias("sure"))
        .where(F.col("sure") > float(np.log(times)))
        .orderBy(F.desc("sure"), "term").limit(most_terms)
    )
    return np.array([r["term"] for r in found.collect()], np.int64).view(np.uint64)


def with_places(docs: DataFrame, vocabulary: Vocabulary, *columns: str) -> DataFrame:
    """`columns` of `docs` with places and counts of the vocabulary's terms in the whole text."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(list(vocabulary.places(texts)), columns=["places", "counts"])

    found = F.pandas_udf(of, "places array<int>, counts array<int>")(F.col("text").cast("string"))
    return docs.select(*columns, found.alias("found")).select(*columns, "found.*")


def _example(row) -> tuple[np.ndarray, np.ndarray]:
    return np.array(row["places"], np.int64), np.array(row["counts"], np.int64)


def fitted(
    docs: DataFrame, labels: DataFrame, per_label: int = 4000, least: int = 4, times: float = 3.0,
    most_terms: int = 20_000, calibrated_on: int = 2000,
) -> tuple[ToxicityModel, DataFrame]:
    """A model from labelled rows of `docs` that are not held out, and all rows of `docs` with their terms.

    `labels` has doc_id and toxic (0 or 1). About `per_label` documents of each label are examples (twice that at most in
    all), which bounds the index; a doc_id with several labels is toxic if one of them says so, one with several texts has
    the one with the least hash. Null labels and null ids are not used. Terms are counted in examples with `least` toxic
    documents at least; their document frequencies cover all rows of `docs`, whatever their labels.
    """
    labelled = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    labelled = stored(labelled, "toxic-labels")
    chosen = bounded_sample(labelled, "toxic", per_label, "doc_id")  # bounded: fit for a broadcast
    text = F.col("text").cast("string")
    sample = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")).repartition(8, "doc_id"),
        "toxic-sample",
    )
    vocabulary = Vocabulary(_telling_terms(sample, least, times, most_terms))
    placed = stored(
        with_places(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), vocabulary, "doc_id"), "toxic-terms"
    )
    rows = placed.count()
    seen = placed.select(F.explode("places").alias("place")).groupBy("place").count().collect()  # most_terms rows at most
    frequency = np.zeros(len(vocabulary.terms))
    for r in seen:
        frequency[r["place"]] = r["count"]
    vocabulary.weights = np.log((rows + 1) / (frequency + 1)) + 1
    total = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    examples = sorted(
        with_places(sample, vocabulary, "doc_id", "toxic").collect(), key=lambda r: (mixed(np.array([r["doc_id"]], np.int64).view(np.uint64))[0])
    )
    taken = {t: sum(r["toxic"] == t for r in examples) for t in (0, 1)}
    stands_for = {t: total.get(t, 0) / max(1, taken[t]) for t in (0, 1)}  # labelled documents for each example
    silent = [stands_for[r["toxic"]] * (r["toxic"], 1 - r["toxic"])[k] for k in (0, 1) for r in examples if not r["places"]]
    silent = np.array(silent).reshape(2, -1).sum(axis=1)
    speaking = [r for r in examples if r["places"]]
    # Examples with the same weightiest term share blocks, which makes the bounds of blocks tight.
    vectors = [(p, vocabulary.vector(p, c)) for p, c in map(_example, speaking)]
    order = sorted(range(len(speaking)), key=lambda e: int(vectors[e][0][vectors[e][1].argmax()]))
    speaking, vectors = [speaking[e] for e in order], [vectors[e] for e in order]
    toxic = np.array([r["toxic"] for r in speaking], float)
    share = np.array([stands_for[r["toxic"]] for r in speaking])
    model = ToxicityModel(
        vocabulary, BlockMaxIndex(vectors, len(vocabulary.terms)), toxic, share / share.mean() if len(share) else share,
        np.array([r["doc_id"] for r in speaking], np.int64),
        prior=total.get(1, 0) / max(1, sum(total.values())),
        without_terms=float(silent[0] + 0.5 * (total.get(1, 0) > 0)) / max(1.0, float(silent.sum()) + 1),
    )
    tried = np.unique(np.linspace(0, len(speaking) - 1, min(calibrated_on, len(speaking))).astype(int)).tolist()
    if tried:
        votes = np.clip([model.vote(*_example(speaking[e]), without=e)[0] for e in tried], 1e-6, 1 - 1e-6)
        model.slope, model.offset = _logistic(np.log(votes / (1 - votes)), toxic[tried], model.share[tried])
    return model, placed


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every row of `docs` (doc_id, text).

    evidence has the nearest examples: doc_id, similarity, toxic. Null and empty texts, and others without a telling term,
    have the score of examples without one and no evidence. Without labels every score is 0. Repeated rows are scored row by
    row; other columns are not read; an empty table gives no rows.
    """
    model, placed = fitted(docs, labels)

    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for places, counts in batches:
            rows = [model.score(p.astype(np.int64), c) for p, c in zip(places, counts, strict=True)]
            yield pd.DataFrame(rows, columns=["score", "evidence"])
            give_back()

    found = F.pandas_udf(of, "score double, evidence array<struct<doc_id: long, similarity: double, toxic: int>>")
    out = placed.select("doc_id", held_out("doc_id").alias("held_out"), found("places", "counts").alias("found"))
    return out.select(
        "doc_id", "held_out", "found.score", (F.col("found.score") >= threshold).cast("int").alias("predicted"), "found.evidence"
    )
