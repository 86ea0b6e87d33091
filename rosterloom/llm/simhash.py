"""SimHash fingerprints of documents, and groups of documents whose fingerprints nearly agree.

Fingerprints within `radius` bits agree in all bits of at least `PARTS - radius` of `PARTS` bit ranges, so only
fingerprints that share such a set of ranges are compared. Within such a bucket BK-trees answer the question: a child
hangs at its Hamming distance from the parent, and a search follows only the edges within the radius. Large buckets are
dealt in shards; every two shards meet in a task of their own, so a task's memory is bounded whatever the bucket. Tasks
return a spanning forest, never all pairs; groups are then contracted by star operations in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.storage import stored, unused
from rosterloom.llm.text_arrays import give_back

PARTS = 5
_EDGES = "a long, b long"


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()  # lower() and split() of bytes know ASCII only
    if not words:
        return 0
    raw = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(raw, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    starts, ends = starts[:n], ends[shingle - 1 :]
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for begin in range(0, n, 1 << 14):  # whole texts, in bounded memory
        some = slice(begin, begin + (1 << 14))
        hashes = np.array([digest(raw[a:z], 42) for a, z in zip(starts[some].tolist(), ends[some].tolist(), strict=True)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little")
        set_bits += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(sum(1 << k for k in np.flatnonzero(2 * set_bits > n).tolist()))


def fingerprints(text: Column) -> Column:
    """Fingerprints as signed longs with the same bits."""

    def of(texts: pd.Series) -> pd.Series:
        found = pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64), dtype="int64")
        give_back()
        return found

    return F.pandas_udf(of, "long")(text)


class BKForest:
    """BK-trees of many groups of fingerprints, built and searched together level by level."""

    def __init__(self, values: np.ndarray, group: np.ndarray) -> None:
        """`group` ascends; the first fingerprint of each group is its root."""
        self.values = values
        n = len(values)
        self.roots = np.flatnonzero(np.diff(group, prepend=group[0] - 1)) if n else np.zeros(0, np.int64)
        #: child[node, d] is the child at distance d of the node, or -1.
        self.child = np.full((n, 65), -1, np.int32)
        here = np.arange(n)
        below = np.zeros(n, bool)
        below[self.roots] = True
        parent = self.roots[np.cumsum(below) - 1]
        here, parent = here[~below], parent[~below]
        while len(here):
            distance = np.bitwise_count(values[here] ^ values[parent]).astype(np.int64)
            key = parent * 65 + distance
            _, first, which = np.unique(key, return_index=True, return_inverse=True)
            self.child[parent[first], distance[first]] = here[first]
            parent = here[first][which]
            here, parent = here[parent != here], parent[parent != here]

    def near(self, query: np.ndarray, root: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in `query`, node) within the radius; each query searches the tree with its root."""
        who, node, found = np.arange(len(query)), root, []
        while len(node):
            distance = np.bitwise_count(query[who] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            found.append((who[hit], node[hit]))
            nexts = []
            for offset in range(-radius, radius + 1):
                edge = distance + offset
                child = np.where((edge >= 0) & (edge <= 64), self.child[node, np.clip(edge, 0, 64)], -1)
                nexts.append((who[child >= 0], child[child >= 0].astype(np.int64)))
            who, node = (np.concatenate(x) for x in zip(*nexts, strict=True))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (who, node)


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the smallest place of its set) after joining the sets of a[i] and b[i]."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label = label[label]


def forest_edges(values: np.ndarray, group: np.ndarray, role: np.ndarray, radius: int, step: int = 1024) -> tuple:
    """Edges (a, b) of a spanning forest of the links in each group, which ascends.

    role: 0 is both in the tree and searched for, 1 only in the tree, 2 only searched for.
    """
    tree = np.flatnonzero(role != 2)
    forest = BKForest(values[tree], group[tree])
    trees, names = forest.roots, group[tree][forest.roots]
    asked = np.flatnonzero(role != 1)
    place = np.searchsorted(names, group[asked])
    known = (place < len(names)) & (names[np.minimum(place, len(names) - 1)] == group[asked]) if len(names) else place < 0
    asked, place = asked[known], place[known]
    label = np.arange(len(values))
    for begin in range(0, len(asked), step):
        part = asked[begin : begin + step]
        who, node = forest.near(values[part], trees[place[begin : begin + step]], radius)
        label = _merge(label, part[who], tree[node])
    joined = np.flatnonzero(label != np.arange(len(label)))
    return values[joined], values[label[joined]]


def _masks(radius: int) -> list[int]:
    """Bit masks, as signed longs, of every choice of ranges that two near fingerprints can agree in."""
    edges = [64 * k // PARTS for k in range(PARTS + 1)]
    ranges = [((1 << (z - a)) - 1) << a for a, z in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(ranges, PARTS - radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def linked(values: DataFrame, radius: int = 2, shard: int = 8192) -> DataFrame:
    """Edges (a, b) that connect what links of at most `radius` bits connect; `values` has distinct longs `fp`."""
    keyed = stored(
        values.select(
            "fp",
            F.explode(
                F.array(*[
                    F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                    for k, m in enumerate(_masks(radius))
                ])
            ).alias("bucket"),
        ).select("fp", "bucket.*"),
        "simhash-keys",
    )
    sizes = keyed.groupBy("mask", "key").count().where("count > 1")
    shards = F.ceil(F.col("count") / F.lit(shard)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int")
    met = (
        keyed.join(sizes.select("mask", "key", shards.alias("shards")), ["mask", "key"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .select(
            "fp", "mask", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("role"),
        )
    )

    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by group; the last group of a batch may go on in the next."""
        names, rest = ["mask", "key", "i", "j"], None

        def of(rows: pd.DataFrame) -> pd.DataFrame:
            new = (rows[names] != rows[names].shift()).any(axis=1).to_numpy()
            a, b = forest_edges(
                rows["fp"].to_numpy().view(np.uint64), np.cumsum(new), rows["role"].to_numpy(), radius
            )
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            open_ = (rows[names] == rows[names].iloc[-1]).all(axis=1).to_numpy()
            rest = rows[open_]
            if not open_.all():
                yield of(rows[~open_])
        if rest is not None and len(rest):
            yield of(rest)

    groups = ["mask", "key", "i", "j"]
    found = met.repartition(*groups).sortWithinPartitions(*groups, "role", "fp").mapInPandas(edges, _EDGES)
    return found.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def contracted(edges: DataFrame) -> DataFrame:
    """(a, b) for every vertex a but the smallest of its component, which is b; from edges (a, b) with a > b.

    Large and small stars in turn: neighbours move to the smallest vertex known nearby until nothing moves. Rounds grow
    with the logarithm of the component; each ends in a written table, and only a count and a checksum reach the driver.
    """

    def star(pairs: DataFrame) -> DataFrame:
        """Each pair (u, v) with v moved under the smallest of u and its neighbours."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = stored(edges, "stars")
    seen = mark(now)
    while seen[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b"), F.col("a")))
        large = star(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = star(large.distinct().select(F.col("a").alias("u"), F.col("b").alias("v")))
        moved = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.select("u", "m"))
        now = stored(moved.where("a <> b").distinct(), "stars")
        before, seen = seen, mark(now)
        if before == seen:
            break
    return now


def rooted(classes: DataFrame, radius: int = 2) -> DataFrame:
    """`classes`, which has distinct longs `fp`, with `root`: the fingerprint that stands for its group."""
    classes = stored(classes, "fingerprint-classes")
    roots = contracted(linked(classes.select("fp"), radius)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    return classes.join(roots, "fp", "left").select(*classes.columns, F.coalesce("root", "fp").alias("root"))


def without_near_duplicates(docs: DataFrame, radius: int = 2) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id, ties by a hash of the text, nulls last.

    Groups are of rows, not of ids: a doc_id that repeats with another text stays with it if that text is the first of
    its group. Columns of `docs` stay. Only ids and hashes are shuffled to find the rows; texts are joined once.
    """
    key = ["i", "x", "y"]
    id_, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    codes = [id_.alias("i"), F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y")]
    marked = stored(docs.select(*codes, fingerprints(text).alias("fp")), "fingerprints")
    named = stored(rooted(marked.select("fp").distinct(), radius), "fingerprint-groups")
    # Equal texts have one fingerprint, so a key is in one group.
    members = stored(marked.groupBy(*key, "fp").agg(F.count("*").alias("n")).join(named, "fp").select(*key, "n", "root"), "group-rows")
    first = F.min(F.struct(F.col("i").isNull().alias("none"), *key)).alias("first")
    firsts = stored(members.groupBy("root").agg(first), "group-firsts")
    is_first = F.col("i").eqNullSafe(F.col("first.i")) & (F.col("x") == F.col("first.x")) & (F.col("y") == F.col("first.y"))
    judged = members.join(firsts, "root").withColumn("stays", is_first).where("not stays or n > 1")
    mark = unused(docs, "mark")
    marks = stored(judged.select(F.struct(*key).alias("key"), F.col("stays").alias(mark)), "marks")
    joined = docs.join(marks, F.struct(*codes) == marks["key"], "left")
    once = joined.where(F.col(mark)).dropDuplicates(["key"])  # rows that agree in doc_id and text
    return joined.where(F.col(mark).isNull()).select(*[docs[c] for c in docs.columns]).union(once.select(*[docs[c] for c in docs.columns]))


def near_duplicates(docs: DataFrame, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of `docs` (doc_id, text).

    Null and empty texts and texts of white space have fingerprint zero and link like any other. component_id is the
    smallest doc_id in the group, null only if no row of the group has one. Rows repeated under one doc_id are kept.
    Other columns of `docs` are not read. An empty table gives no rows.
    """
    marked = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprints(F.col("text").cast("string")).alias("fp")),
        "fingerprints",
    )
    named = rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), radius)
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    members = stored(named.join(groups, "root").select("fp", "component_id"), "fingerprint-groups")
    return marked.join(members, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
