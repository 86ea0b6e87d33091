"""Totals beside the rows they sum up, and attributes turned into columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.operators.skew import HOT_MIN_ROWS, SMALL_ROWS, copy_if_small, left_join_first

_KEY = "_total_key"
#: More categories than this are taken for a mistake.
MAX_CATEGORIES = 200


def with_totals(
    df: DataFrame,
    keys: Sequence[str],
    totals: Mapping[str, Column],
    hot_min_rows: int = HOT_MIN_ROWS,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """``df`` with aggregates over the rows of each key beside every row; nulls are a key like any other.

    Rows are summed up per task first, and the totals are joined back: a few of them by a broadcast
    of their checked size, many by a shuffle join in which the rows of a frequent key do not meet in
    one task, as they would in a window. Without keys the totals are those of the whole table.
    """
    clashing = sorted(set(totals) & set(df.columns))
    if clashing:
        raise ValueError(f"columns of that name exist: {clashing}")
    aggregates = [c.alias(name) for name, c in totals.items()]
    if not keys:
        return df.crossJoin(F.broadcast(df.agg(*aggregates)))  # one row
    # One text for all key columns, null or not, which differs wherever they do.
    key = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]))
    keyed = df.withColumn(_KEY, key)
    summed = keyed.groupBy(_KEY).agg(*aggregates)
    few = copy_if_small(summed, small_rows)
    if few is not None:
        joined = keyed.join(F.broadcast(few), _KEY, "left")
    else:
        joined = left_join_first(keyed, summed, [_KEY], lambda rows: rows, hot_min_rows, small_rows)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *totals)


def categories(df: DataFrame, attribute: str, most: int = MAX_CATEGORIES) -> list[str]:
    """The different values of ``attribute`` as text, in order; an error if there are more than ``most``."""
    text = F.col(f"`{attribute}`").cast("string").alias("value")
    found = [r["value"] for r in df.select(text).dropna().distinct().orderBy("value").limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"'{attribute}' has more than {most} different values: {', '.join(found[:5])}, ...")
    return found


def pivot_attribute(
    df: DataFrame,
    keys: Sequence[str],
    attribute: str,
    value: str,
    how: Callable[[Column], Column] = F.sum,
    values: Sequence[str] | None = None,
    prefix: str = "",
    most: int = MAX_CATEGORIES,
) -> DataFrame:
    """One row per key with a column for each value of ``attribute``: ``how`` aggregates ``value`` over its rows.

    Rows of other categories are null to the aggregate. Without ``values`` the categories are looked
    up, which is an error if there are more than ``most``. Rows without the attribute make no column,
    but their keys stay. One conditional aggregation, combined per task before its only shuffle.
    """
    values = categories(df, attribute, most) if values is None else list(values)
    names = [f"{prefix}{v}" for v in values]
    if len({n.lower() for n in (*names, *keys)}) < len(names) + len(keys):
        raise ValueError("categories and key columns must have different names")
    text = F.col(f"`{attribute}`").cast("string")
    columns = [
        how(F.when(text == v, F.col(f"`{value}`"))).alias(n)
        for v, n in zip(values, names, strict=True)
    ]
    grouped = df.groupBy(*keys)
    return grouped.agg(*columns) if columns else grouped.agg(F.lit(None).alias("_none")).drop("_none")
