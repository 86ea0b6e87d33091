"""Passages of benchmark items in documents: Wu-Manber search for many word windows at once.

The alphabet is the words. Windows of one length share a shift table: for every block of two words, how far the search
may move without missing a window. Blocks that end a window shift by nothing; their hash selects the windows to try, a
hash of the whole window narrows those down, and a comparison of the words themselves confirms. Documents are cut into
lanes that move together, so the search is a few numpy operations a step.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.storage import stored, unused
from rosterloom.llm.text_arrays import Words, byte_set, grouped, mixed

#: Words, once A-Z are lower-cased: digits, a-z and whatever is not ASCII.
WORD_BYTES = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_PAIR = np.uint64(0x9FB21C651E98DF25)
_TABLE_BITS = 18
_LANE = 256


def _windows(words: list[bytes], length: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1))]


class _SameLength:
    """Search tables of the windows of one number of words."""

    def __init__(self, windows: dict[bytes, list[str]], length: int) -> None:
        self.length = length
        self.items = windows
        texts = list(windows)
        words = Words(texts, WORD_BYTES)
        each = words.hashes().reshape(len(texts), length)
        self.block = min(2, length)
        self.shift = np.full(1 << _TABLE_BITS, length - self.block + 1, np.int32)
        blocks = self._blocks(each.T)  # a row for each place in the window
        for k, row in enumerate(blocks):
            np.minimum.at(self.shift, self._slot(row), length - self.block - k)
        self.last = np.unique(blocks[-1])
        self.whole = np.unique(self._whole([each[:, k] for k in range(length)]))

    def _blocks(self, columns: np.ndarray) -> np.ndarray:
        return columns if self.block == 1 else mixed(columns[:-1] * _PAIR + columns[1:])

    @staticmethod
    def _slot(block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    @staticmethod
    def _whole(columns: list[np.ndarray]) -> np.ndarray:
        return mixed(reduce(lambda h, c: h * _PAIR + c, columns))

    def ends(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Places of last words of likely windows; `first` parts the words into documents."""
        m = self.length
        low, high = first[:-1] + m - 1, first[1:]
        low, high = low[low < high], high[low < high]
        if not len(low):
            return low
        lanes = -(-(high - low) // _LANE)
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(low, lanes) + nth * _LANE
        stop = np.minimum(at + _LANE, np.repeat(high, lanes))
        block = hashes if self.block == 1 else np.concatenate((hashes[:1], mixed(hashes[:-1] * _PAIR + hashes[1:])))
        shifts = self.shift[self._slot(block)]
        found = []
        while len(at):
            step = shifts[at]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        ends = np.concatenate(found)
        ends = ends[_within(self.last, block[ends])]
        return ends[_within(self.whole, self._whole([hashes[ends - m + 1 + k] for k in range(m)]))]


def _within(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[place] == values


class WindowSearch:
    """Search for the windows of benchmark items, given as (item id as string, text)."""

    def __init__(self, items: Iterable[tuple[str, str | None]], length: int = 13) -> None:
        by_length: dict[int, dict[bytes, list[str]]] = defaultdict(lambda: defaultdict(list))
        for item, text in items:
            words = Words([(text or "").encode().lower()], WORD_BYTES)
            each = [words.raw[a:z] for a, z in zip(words.starts, words.ends, strict=True)]
            for window in set(_windows(each, length)):
                by_length[len(window)][b" ".join(window)].append(item)
        self.tables = [_SameLength(dict(windows), n) for n, windows in sorted(by_length.items())]

    def search(self, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray, set[str]]]:
        """For each text: its number of words, which words are hit, and the items with occurring windows."""
        for group in grouped(texts):
            words = Words([raw.lower() for raw in group], WORD_BYTES)
            hashes = words.hashes()
            hit = np.zeros(len(words) + 1, np.int32)
            items: dict[int, set[str]] = defaultdict(set)
            for table in self.tables if len(words) else ():
                ends = table.ends(hashes, words.first)
                for end, doc in zip(
                    ends.tolist(), (np.searchsorted(words.first, ends, "right") - 1).tolist(), strict=True
                ):
                    begin = end - table.length + 1
                    if owners := table.items.get(words.text(begin, end + 1)):
                        hit[begin] += 1
                        hit[end + 1] -= 1
                        items[doc].update(owners)
            hit = np.cumsum(hit)[:-1] > 0
            for k in range(len(group)):
                begin, end = words.first[k], words.first[k + 1]
                yield int(end - begin), hit[begin:end], items.get(k, set())


def _parts(benchmark: DataFrame, max_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """Items in lists of about `max_bytes` of text: what one pass sends to the executors is bounded."""
    part: list[tuple[str, str | None]] = []
    size = 0
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")
    )
    for row in rows.toLocalIterator():
        part.append((row["item"], row["text"]))
        size += len(row["text"] or "")
        if size >= max_bytes:
            yield part
            part, size = [], 0
    if part:
        yield part


_RESULT = "n_words long, hits array<int>, items array<string>"


def _searcher(items: list[tuple[str, str | None]], length: int):
    @F.pandas_udf(_RESULT)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        windows = WindowSearch(items, length)
        for texts in batches:
            rows = [(n, _runs(hit), sorted(found)) for n, hit, found in windows.search(texts)]
            yield pd.DataFrame(rows, columns=["n_words", "hits", "items"])

    return search


def _runs(hit: np.ndarray) -> list[int]:
    """Begin and end of each run of hit words, one after the other."""
    return np.flatnonzero(np.diff(hit.view(np.int8), prepend=0, append=0)).tolist() if hit.any() else []


def _covered(hits: Column) -> Column:
    """How many words the runs cover, which may overlap."""
    pairs = F.filter(F.transform(hits, lambda x, k: F.when(k % 2 == 0, F.struct(x.alias("begin"), hits[k + 1].alias("end")))), F.isnotnull)
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(
        F.array_sort(pairs),
        start,
        lambda s, run: F.struct(
            (s["n"] + F.greatest(F.lit(0), run["end"] - F.greatest(run["begin"], s["reach"]))).alias("n"),
            F.greatest(s["reach"], run["end"]).alias("reach"),
        ),
        lambda s: s["n"].cast("long"),
    )


def with_contamination(
    docs: DataFrame, benchmark: DataFrame, length: int = 13, share: int = 20, part_bytes: int = 8 << 20
) -> DataFrame:
    """`docs` with a struct column `contamination`: n_words, n_hit, n_items, items_sha256, contaminated.

    A document is contaminated if at least one of `share` of its words lies in windows of items. Null and empty texts
    have no words and no hits; items without words have no windows; equal items count once each by their ids, a null id
    as the empty string. Repeated rows are judged row by row. Columns of `docs` stay, whatever their names; the new
    column gets underscores if its name is taken. Benchmarks of any size are searched in passes of `part_bytes` of text.
    """
    text, result, all_hits, all_items = (unused(docs, c) for c in ("text_", "found_", "hits_", "items_"))
    out = docs.withColumn(text, F.col("text").cast("string"))
    empty = F.array().cast("array<int>"), F.array().cast("array<string>")
    passes = 0
    n_words = unused(docs, "n_words_")
    for part in _parts(benchmark, part_bytes):
        if passes:
            out = stored(out, "contamination")
        found = out.withColumn(result, _searcher(part, length)(text))
        before = (F.col(all_hits), F.col(all_items)) if passes else empty
        out = found.select(
            *docs.columns, text, F.col(f"{result}.n_words").alias(n_words),
            F.concat(before[0], f"{result}.hits").alias(all_hits),
            F.concat(before[1], f"{result}.items").alias(all_items),
        )
        passes += 1
    if not passes:  # an empty benchmark: words are counted all the same
        found = out.withColumn(result, _searcher([], length)(text))
        out = found.select(
            *docs.columns, F.col(f"{result}.n_words").alias(n_words), empty[0].alias(all_hits), empty[1].alias(all_items)
        )
    names = F.array_sort(F.array_distinct(all_items))
    n_hit, summed = F.col(f"{result}.n_hit"), F.struct(
        _covered(F.col(all_hits)).alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
    )
    return out.withColumn(result, summed).select(
        *docs.columns,
        F.struct(
            F.col(n_words).alias("n_words"), f"{result}.n_hit", f"{result}.n_items", f"{result}.items_sha256",
            ((n_hit > 0) & (share * n_hit >= F.col(n_words))).alias("contaminated"),
        ).alias(unused(docs, "contamination")),
    )
