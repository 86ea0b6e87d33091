"""Vectors compressed to codes: each part of a vector becomes the index of the nearest entry of a codebook.

All arithmetic is on integers and exact. Distances come from matrix products in float64, which are exact only below 2**53:
integers are broken into limbs so small that no product of two limb matrices reaches that, and the products are put
together again in 64-bit integers. The nearest entry is the first one with the least distance.

Codebooks are fitted to all vectors. A task returns sums and counts of its own vectors for each entry, Spark adds them up,
and only the codebooks themselves (entries times components) pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.storage import stored
from rosterloom.llm.text_arrays import give_back

#: Vectors whose distances are in memory at a time.
_ROWS = 4096


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 arrays l[0], l[1], ... with values == sum of l[k] << (bits * k); all but the last are not negative."""
    out = []
    high = int(np.abs(values).max(initial=0))
    while high >> bits:
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
        high = int(np.abs(values).max(initial=0))
    return [*out, values.astype(np.float64)]


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of the int64 rows of x with those of c, which must fit in 63 bits."""
    bits = (53 - max(1, x.shape[1]).bit_length()) // 2
    out = np.zeros((len(x), len(c)), np.int64)
    of_c = [limb.T for limb in limbs(c, bits)]
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(of_c):
            out += (a @ b).astype(np.int64) << (bits * (i + j))
    return out


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row of x the first entry of least squared distance, and that distance."""
    distance = products(x, book)
    distance *= -2
    distance += (book * book).sum(axis=1)
    index = distance.argmin(axis=1)
    return index, distance[np.arange(len(x)), index] + (x * x).sum(axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for begin in range(0, batch.num_rows, _ROWS):
            part = batch.slice(begin, _ROWS)
            yield part, part.column("whole").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)


def _integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


class Codebooks:
    """`books[p]` has the entries of part p as rows."""

    def __init__(self, books: np.ndarray) -> None:
        self.books = books
        self.parts, _, self.width = books.shape

    def assigned(self, whole: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for p in range(self.parts):
            x = np.ascontiguousarray(whole[:, p * self.width : (p + 1) * self.width])
            yield (p, x, *nearest_entries(x, self.books[p]))

    def sha256(self, dimensions: int) -> str:
        """Over all components by part, entry and place, as decimal integers parted by commas."""
        flat = [v for p, book in enumerate(self.books) for row in book.tolist() for v in row[: dimensions - p * self.width]]
        return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()

    def moved(self, table: DataFrame) -> Codebooks:
        """Every entry replaced by the floor of the mean of what it is nearest to; entries without any stay."""
        parts, entries, width = self.books.shape

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros(self.books.shape, np.int64), np.zeros((parts, entries), np.int64)
            for _, whole in _blocks(batches, parts * width):
                for p, x, index, _ in self.assigned(whole):
                    np.add.at(total[p], index, x)
                    count[p] += np.bincount(index, minlength=entries)
            part, entry = np.nonzero(count)
            columns = [part.astype(np.int32), entry.astype(np.int32), count[part, entry]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns] + [pa.array(total[part, entry, k]) for k in range(width)],
                names=["part", "entry", "n", *names],
            )
            give_back()

        names = [f"s{k}" for k in range(width)]
        schema = "part int, entry int, n long, " + ", ".join(f"{c} long" for c in names)
        added = table.select("whole").mapInArrow(sums, schema).groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)])
        books = self.books.copy()
        for row in added.collect():  # a row for each entry at most
            books[row["part"], row["entry"]] = [row[c] // row["n"] for c in names]
        return Codebooks(books)

    def coded(self, table: DataFrame, *columns: str) -> DataFrame:
        """`columns` of the table with code and error."""
        kept = table.select(*columns, "whole")
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]), "code string", "error long"])

        def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, whole in _blocks(batches, self.parts * self.width):
                found = list(self.assigned(whole))
                index = np.stack([f[2] for f in found], axis=1).astype(np.uint8)
                error = np.sum([f[3] for f in found], axis=0)
                text = index.tobytes().hex()
                step = 2 * self.parts
                code = [text[k : k + step] for k in range(0, len(text), step)]
                arrays = [batch.column(c) for c in columns] + [pa.array(code, pa.string()), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "code", "error"])
            give_back()

        return kept.mapInArrow(codes, schema)


def vector_codes(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable row of `vectors` (vec_id, embedding, label).

    Null vectors, empty ones and those with null or non-finite components take no part, nor do vectors that are not as long
    as that of the smallest vec_id. Components x become floor(scale * x). Codebooks (`entries`, 256 at most, for each of
    `parts`) start as the vectors with the smallest vec_ids, all of them if there are fewer, ties by their components and
    null ids last, and move `rounds` times. A length that `parts` does not divide is filled up with zeros at the end.
    Repeated rows count as often as they stand there. Null labels are one label. Other columns are not read; a table
    without usable rows gives none. Components whose distances could leave 64 bits are refused with a ValueError.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits for each part: 256 entries at most")
    usable = vectors.where(_usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), _integers(F.col("embedding"), scale).alias("whole")
    )
    order = [F.col("vec_id").asc_nulls_last(), F.size("whole"), F.col("whole")]
    first = usable.orderBy(*order).limit(1).collect()
    dimensions = len(first[0]["whole"]) if first else parts
    width = -(-dimensions // parts)
    filled = F.concat("whole", F.array_repeat(F.lit(0).cast("long"), parts * width - dimensions))
    table = stored(usable.where(F.size("whole") == dimensions).withColumn("whole", filled), "vector-integers")
    largest = table.select(F.max(F.greatest(F.array_max("whole"), -F.array_min("whole")))).first()[0] or 0
    if 4 * parts * width * largest * largest >= 1 << 63:
        raise ValueError(f"components of up to {largest} have distances that do not fit in 64 bits")
    seeds = [r["whole"] for r in table.orderBy(*order).limit(entries).collect()]
    start = np.array(seeds, np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)
    books = Codebooks(np.ascontiguousarray(start))
    if seeds:
        for _ in range(rounds):
            books = books.moved(table)
    coded = stored(books.coded(table, "vec_id", "label"), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, coded["label"].eqNullSafe(by_label["of_label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256(dimensions)).alias("codebooks_sha256")
    )
