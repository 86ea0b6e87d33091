"""Nearest vectors by inner product: robust-pruned directed graphs over shards, searched by beams.

Vectors are dealt in shards of bounded size. Each shard's task links every vector to diverse neighbours: greedy searches
of the graph so far propose candidates, and a candidate is kept only if no kept one is nearer to it, by a relaxed
measure, than the vector itself is. Every query searches every shard with a beam, in blocks of queries; the shards'
best candidates are scored exactly and merged. Inner products become distances by one more dimension that lifts all
vectors to the same length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterloom.llm.storage import stored


@dataclass
class Graph:
    """Points lifted to one length, and each point's neighbours (-1: none)."""

    points: np.ndarray
    neighbours: np.ndarray
    entry: np.ndarray

    def search(self, queries: np.ndarray, beam: int, known: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each query the `beam` nearest points met, nearest first, and their squared distances (inf: none).

        All queries move together: each step expands the nearest point of each beam that was not expanded yet. Points
        from `known` on are not in the graph yet.
        """
        m, width = len(queries), self.neighbours.shape[1]
        n = len(self.points) if known is None else known
        entry = self.entry[self.entry < n]
        rows = np.arange(m)[:, None]
        seen = np.zeros((m, n + 1), bool)
        seen[:, n] = True  # the place of "no neighbour"
        ids = np.broadcast_to(entry, (m, len(entry))).copy()
        seen[rows, ids] = True
        far = self._far(queries, ids)
        pad = max(0, beam - ids.shape[1])
        ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=n)
        far = np.pad(far, ((0, 0), (0, pad)), constant_values=np.inf)
        ids, far, done = self._best(ids, far, np.isinf(far), beam)
        while True:
            live = np.flatnonzero(~done.all(axis=1))
            if not len(live):
                return np.where(np.isinf(far), -1, ids), far
            at = np.argmin(done[live], axis=1)  # the first that is not expanded is the nearest
            done[live, at] = True
            fresh = self.neighbours[ids[live, at]].astype(np.int64)
            fresh = np.where((fresh < 0) | (fresh >= n), n, fresh)
            new = ~seen[live[:, None], fresh]
            seen[live[:, None], fresh] = True
            d = np.full((len(live), width), np.inf)
            who, which = np.nonzero(new)
            p = fresh[who, which]
            d[who, which] = ((self.points[p] - queries[live[who]]) ** 2).sum(axis=1)
            ids[live], far[live], done[live] = self._best(
                np.concatenate((ids[live], fresh), axis=1), np.concatenate((far[live], d), axis=1),
                np.concatenate((done[live], np.isinf(d)), axis=1), beam,
            )

    def _far(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return ((self.points[ids] - queries[:, None]) ** 2).sum(axis=2)

    @staticmethod
    def _best(ids: np.ndarray, far: np.ndarray, done: np.ndarray, beam: int) -> tuple:
        order = np.argsort(far, axis=1, kind="stable")[:, :beam]
        return tuple(np.take_along_axis(x, order, axis=1) for x in (ids, far, done))


def _pruned(points: np.ndarray, own: np.ndarray, ids: np.ndarray, far: np.ndarray, degree: int, relaxed: float) -> np.ndarray:
    """Neighbours of the points `own`, out of candidates `ids` with squared distances, nearest first, inf for none."""
    kept = np.full((len(own), degree), -1, np.int32)
    alive = ~np.isinf(far) & (ids != own[:, None])
    count = np.zeros(len(own), np.int64)
    rows = np.arange(len(own))
    safe = np.maximum(ids, 0)
    for _ in range(degree):
        live = rows[alive.any(axis=1)]
        if not len(live):
            break
        at = np.argmax(alive[live], axis=1)
        chosen = safe[live, at]
        kept[live, count[live]] = chosen
        count[live] += 1
        alive[live, at] = False
        between = ((points[safe[live]] - points[chosen][:, None]) ** 2).sum(axis=2)
        alive[live] &= relaxed * relaxed * between > far[live]
    return kept


def build(points: np.ndarray, degree: int = 32, beam: int = 64, relaxed: float = 1.2, step: int = 512) -> Graph:
    """The graph over distinct points; they join in batches that double, each searched for in the graph before it."""
    n = len(points)
    graph = Graph(points, np.full((n, degree), -1, np.int32), np.zeros(1, np.int64))
    known = min(n, 2 * degree)
    if known:
        first = np.arange(known)
        far = ((points[:known, None] - points[None, :known]) ** 2).sum(axis=2)
        order = np.argsort(far, axis=1, kind="stable")
        graph.neighbours[:known] = _pruned(points, first, order, np.take_along_axis(far, order, axis=1), degree, relaxed)
    while known < n:
        new = np.arange(known, min(n, known + min(step, known)))
        ids, far = graph.search(points[new], beam, known)
        graph.neighbours[new] = _pruned(points, new, ids, far, degree, relaxed)
        known = int(new[-1]) + 1
        _link_back(graph, new, degree, relaxed)
    graph.entry = np.unique(np.append(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)), np.arange(min(n, 8)))) if n else np.zeros(0, np.int64)
    return graph


def _link_back(graph: Graph, new: np.ndarray, degree: int, relaxed: float) -> None:
    """Edges from the neighbours of `new` to them; lists that overflow are pruned again."""
    source = np.repeat(new, degree)
    target = graph.neighbours[new].reshape(-1).astype(np.int64)
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    owners, begin, count = np.unique(target, return_index=True, return_counts=True)
    for size in np.unique(count):  # owners with equally many new edges go together
        rows = count == size
        own = owners[rows]
        added = source[begin[rows][:, None] + np.arange(size)]
        ids = np.concatenate((graph.neighbours[own].astype(np.int64), added), axis=1)
        far = ((graph.points[np.maximum(ids, 0)] - graph.points[own][:, None]) ** 2).sum(axis=2)
        far[ids < 0] = np.inf
        order = np.argsort(far, axis=1, kind="stable")
        ids, far = np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)
        full = (~np.isinf(far)).sum(axis=1) > degree
        graph.neighbours[own[~full]] = np.where(np.isinf(far), -1, ids)[~full][:, :degree]
        if full.any():
            graph.neighbours[own[full]] = _pruned(graph.points, own[full], ids[full], far[full], degree, relaxed)


#: A shard as it is stored: sizes, and the bytes of its arrays.
SHARD_SCHEMA = (
    "size int, shard int, distinct binary, member_ids binary, at binary, points binary, neighbours binary, entry binary, "
    "shuffled binary, longest double"
)


@dataclass
class Shard:
    """A graph over the distinct vectors of some rows, and the rows' ids by point."""

    distinct: np.ndarray
    #: The ids of point p, ascending, are member_ids[at[p] : at[p + 1]].
    member_ids: np.ndarray
    at: np.ndarray
    graph: Graph
    #: The point of distinct vectors that each point of the graph is.
    shuffled: np.ndarray
    longest: float

    @staticmethod
    def of(ids: np.ndarray, vectors: np.ndarray, beam: int) -> Shard:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        # Equal vectors are one point of the graph; its ids ascend.
        distinct, point_of = np.unique(vectors, axis=0, return_inverse=True)
        point_of = point_of.reshape(-1)
        members = np.argsort(point_of, kind="stable")
        at = np.concatenate(([0], np.cumsum(np.bincount(point_of, minlength=len(distinct)))))
        squared = (distinct * distinct).sum(axis=1)
        lift = np.sqrt(np.maximum(squared.max() - squared, 0))
        # Points join in an order that has nothing to do with their values.
        shuffled = np.random.default_rng(5).permutation(len(distinct))
        points = np.concatenate((distinct, lift[:, None]), axis=1)[shuffled]
        graph = build(points.astype(np.float32), beam=max(64, beam // 2))
        return Shard(distinct, ids[members], at, graph, shuffled, float(np.sqrt(squared.max())))

    def row(self, size: int, shard: int) -> dict:
        arrays = {
            "distinct": self.distinct, "member_ids": self.member_ids, "at": self.at, "points": self.graph.points,
            "neighbours": self.graph.neighbours, "entry": self.graph.entry, "shuffled": self.shuffled,
        }
        return {"size": size, "shard": shard, "longest": self.longest} | {k: v.tobytes() for k, v in arrays.items()}

    @staticmethod
    def read(row) -> Shard:
        long_ = lambda raw: np.frombuffer(raw, np.int64)
        distinct = np.frombuffer(row.distinct, np.float64).reshape(-1, row.size)
        points = np.frombuffer(row.points, np.float32).reshape(len(distinct), -1)
        neighbours = np.frombuffer(row.neighbours, np.int32).reshape(len(distinct), -1)
        graph = Graph(points, neighbours, long_(row.entry))
        return Shard(distinct, long_(row.member_ids), long_(row.at), graph, long_(row.shuffled), row.longest)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, vec_id, score) of up to `k` best found for each query, without the query's own id."""
        distinct, member_ids, at = self.distinct, self.member_ids, self.at
        lifted = np.concatenate((queries, np.zeros((len(queries), 1))), axis=1).astype(np.float32)
        # Only the direction of a query matters; at the points' length the beam sees the same order.
        lifted *= self.longest / np.maximum(np.sqrt((lifted**2).sum(axis=1, keepdims=True)), 1e-30)
        out = []
        for begin in range(0, len(queries), 256):
            found, _ = self.graph.search(lifted[begin : begin + 256], beam)
            for row, near in enumerate(found):
                q = begin + row
                near = self.shuffled[near[near >= 0]]
                score = distinct[near] @ queries[q]
                own = query_ids[q]
                least = member_ids[at[near]]  # the smallest id of each point but the query's own
                other = np.ones(len(near), bool)
                for j in np.flatnonzero(least == own):
                    here = member_ids[at[near[j]] : at[near[j] + 1]]
                    after = np.searchsorted(here, own, "right")
                    other[j] = after < len(here)
                    least[j] = here[after] if other[j] else own
                near, score, least = near[other], score[other], least[other]
                best = np.lexsort((least, -score))[:k]
                which = [_first_others(member_ids, at[p], at[p + 1], own, k) for p in near[best]]
                value = np.repeat(score[best], [len(w) for w in which])
                which = np.concatenate(which) if which else np.zeros(0, np.int64)
                top = np.lexsort((member_ids[which], -value))[:k]
                out.append((np.full(len(top), q), member_ids[which[top]], value[top]))
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (none, none, np.zeros(0))


def _first_others(ids: np.ndarray, begin: int, end: int, own: int, k: int) -> np.ndarray:
    """Places of the first `k` ids but `own` in ids[begin:end], which ascend."""
    lo, hi = begin + np.searchsorted(ids[begin:end], own), begin + np.searchsorted(ids[begin:end], own, "right")
    before = np.arange(begin, min(lo, begin + k))
    return np.append(before, np.arange(hi, min(end, hi + k - len(before))))


def _usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, shard: int = 4096, block: int = 1 << 16, beam: int = 128
) -> DataFrame:
    """query_id, rank, vec_id and score of the `k` nearest found for each query, by inner product.

    Queries are the distinct (vec_id, vector) of `queries`, ranked each by itself: repeated rows are answered once, and an
    id with several vectors has ranks for each.

    Both tables have vec_id and embedding. A query's own id is no candidate. Vectors that are null, zero or hold null or
    non-finite components take no part, nor do rows without vec_id; a query without usable vector has no rows. Scores are
    double-precision inner products of the original vectors; ties go to the smaller vec_id. Rows repeated under one id
    are candidates each. Vectors of differing lengths only meet their own kind. Other columns are not read. Every vector
    is in the graph of its shard (`shard` rows on average), which is built once and stored, and every query searches every
    shard in blocks of `block`.
    """

    def clean(df: DataFrame) -> DataFrame:
        cast = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        return cast.where(F.col("vec_id").isNotNull() & _usable(F.col("v"))).withColumn("size", F.size("v"))

    base, asked = stored(clean(vectors), "vectors"), stored(clean(queries).distinct(), "queries")
    shards = max(1, -(-base.count() // shard))
    blocks = max(1, -(-asked.count() // block))
    dealt = base.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    meeting = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")).withColumns(
        {"query": F.xxhash64("v"), "shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))}
    )

    def graph(key: tuple, points: pd.DataFrame) -> pd.DataFrame:
        shard_ = Shard.of(points["vec_id"].to_numpy(np.int64), np.stack(points["v"].to_numpy()), beam)
        return pd.DataFrame([shard_.row(*key)])

    # Built once, however many blocks of queries search it.
    graphs = stored(dealt.groupBy("size", "shard").applyInPandas(graph, SHARD_SCHEMA), "shard-graphs")

    def search(shard_: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(shard_) or not len(wanted):
            return pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "query": "int64", "vec_id": "int64"}
            )
        (row,) = shard_.itertuples(index=False)
        q, p, s = Shard.read(row).nearest(wanted["vec_id"].to_numpy(np.int64), np.stack(wanted["v"].to_numpy()), k, beam)
        asked_ = wanted.iloc[q]
        return pd.DataFrame({"query_id": asked_["vec_id"].to_numpy(), "query": asked_["query"].to_numpy(), "vec_id": p, "score": s})

    keys = ["size", "shard", "block"]
    every_block = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (
        every_block.groupBy(*keys).cogroup(meeting.groupBy(*keys)).applyInPandas(
            search, "query_id long, query long, vec_id long, score double"
        )
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
