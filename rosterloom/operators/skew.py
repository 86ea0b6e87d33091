"""Joins that stay balanced when one key holds a large share of the rows.

One scan of the left table's key columns (a sketch, one row of result) tells how many different
keys there are and which are hot. Few keys: the right table is reduced to them and broadcast, so
neither table is shuffled. Many keys: a shuffle join, except that rows of hot keys, which a shuffle
would send to one task, are joined with a broadcast of their few right rows instead.

The sketch decides only *how* a row is joined, never *whether*: the result is the same whatever
it finds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.scratch import local_table

#: A key is hot when it has at least this many rows: more than one task should take in a join.
HOT_MIN_ROWS = 1_000_000
#: At most this many hot keys are split off, which bounds the broadcast side to as many rows.
HOT_MAX_KEYS = 1_000
#: A table with up to this many rows may be broadcast after its size was checked.
SMALL_ROWS = 50_000


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _code(keys: Sequence[str]) -> Column:
    """Hash of the key; rows with a null in it match nothing and share the code 0."""
    return F.when(any_null(keys), F.lit(0).cast("bigint")).otherwise(F.xxhash64(*keys))


@dataclass(frozen=True)
class KeyStatistics:
    """Approximate number of different keys, and the codes of hot ones, heaviest first."""

    distinct: int
    hot: tuple[int, ...]


def key_statistics(
    df: DataFrame, keys: Sequence[str], min_rows: int = HOT_MIN_ROWS, max_keys: int = HOT_MAX_KEYS
) -> KeyStatistics:
    found = (
        df.select(_code(keys).alias("code"))
        .agg(
            F.expr(f"approx_top_k(code, {max_keys}, {10 * max_keys})").alias("top"),
            F.approx_count_distinct("code").alias("distinct"),
        )
        .first()
    )
    hot = tuple(t["item"] for t in (found["top"] or []) if t["count"] >= min_rows)
    return KeyStatistics(found["distinct"], hot)


def _same_value(df: DataFrame, key: str, wanted: T.DataType) -> Column:
    """The key in the wanted type, or null where the conversion would change it."""
    own = df.schema[key].dataType
    if own == wanted:
        return F.col(key)
    converted = F.col(key).try_cast(wanted)
    return F.when(converted.try_cast(own) == F.col(key), converted)


def left_join_first(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    one_per_key: Callable[[DataFrame], DataFrame],
    min_rows: int = HOT_MIN_ROWS,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """LEFT JOIN on same-named ``keys`` with what ``one_per_key`` leaves of ``right``.

    ``one_per_key`` must choose among the rows of each key by themselves, so that it may be
    applied to some of the keys only. Rows are never multiplied and null keys match nothing, nor do
    keys of ``right`` that the type of ``left``'s key cannot hold unchanged.
    """
    keys = list(keys)
    types = {f.name: f.dataType for f in left.schema.fields}
    right = right.withColumns({k: _same_value(right, k, types[k]) for k in keys})
    statistics = key_statistics(left, keys, min_rows)
    if statistics.distinct <= small_rows:
        wanted = left.select(*keys).dropna().distinct()
        few = one_per_key(right.join(F.broadcast(wanted), keys, "left_semi"))
        return left.join(F.broadcast(few), keys, "left")  # as many rows as wanted keys
    right = one_per_key(right)
    if not statistics.hot:
        return left.join(right, keys, "left")
    is_hot = _code(keys).isin(*statistics.hot)
    few = F.broadcast(right.filter(is_hot & ~any_null(keys)))  # one row per hot key
    return (
        left.filter(~is_hot)
        .join(right, keys, "left")
        .unionByName(left.filter(is_hot).join(few, keys, "left"))
    )


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of the rows when the scan has fewer partitions than cores.

    Parsing text is bound by the processor, and a small file is read by one task. A table with
    enough partitions, as any large one, is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def copy_if_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """A driver-held copy of a small aggregate, or None when it has more than ``max_rows`` rows."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return local_table(df.sparkSession, rows, df.schema)
