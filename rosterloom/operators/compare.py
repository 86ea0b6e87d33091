"""Compare two versions of a table by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _by_key(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]):
    """One row per key: rows on each side, and per column its value on each side.

    A union and one grouped aggregation instead of a full join: keys repeated on both sides
    would make a join emit every pair of their rows, here they only raise a count.
    """
    sides = [
        df.select(*keys, *columns, F.lit(is_new).alias("_new"))
        for df, is_new in ((old, False), (new, True))
    ]
    both = sides[0].unionByName(sides[1])
    value = [
        F.min(F.when(F.col("_new") == is_new, F.col(c))).alias(f"{prefix}{c}")
        for c in columns
        for prefix, is_new in (("_old_", False), ("_new_", True))
    ]
    return both.groupBy(*keys).agg(
        F.count_if(~F.col("_new")).alias("_n_old"), F.count_if(F.col("_new")).alias("_n_new"), *value
    )


def compare_tables(
    old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Number of keys per kind of difference: (difference, column, keys).

    ``only_old`` / ``only_new``: key on one side. ``repeated``: key twice or more on a side, so
    its rows cannot be paired. ``value``: a column differs, counting null as a value.
    """
    columns = list(columns or [c for c in old.columns if c in new.columns and c not in keys])
    grouped = _by_key(old, new, keys, columns)
    paired = (F.col("_n_old") == 1) & (F.col("_n_new") == 1)
    counts = {
        ("only_old", None): (F.col("_n_new") == 0) & (F.col("_n_old") > 0),
        ("only_new", None): (F.col("_n_old") == 0) & (F.col("_n_new") > 0),
        ("repeated", None): (F.col("_n_old") > 1) | (F.col("_n_new") > 1),
    }
    for c in columns:
        counts["value", c] = paired & ~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}"))
    one_row = grouped.agg(
        *[F.count_if(condition).alias(f"n{i}") for i, condition in enumerate(counts.values())]
    )
    entries = [
        F.struct(
            F.lit(kind).alias("difference"),
            F.lit(column).cast("string").alias("column"),
            F.col(f"n{i}").alias("keys"),
        )
        for i, (kind, column) in enumerate(counts)
    ]
    return one_row.select(F.inline(F.array(*entries)))


def changed_values(
    old: DataFrame, new: DataFrame, keys: Sequence[str], column: str, n: int | None = None
) -> DataFrame:
    """All keys whose ``column`` differs, or the first ``n`` of them in key order."""
    grouped = _by_key(old, new, keys, [column])
    differs = ~F.col(f"_old_{column}").eqNullSafe(F.col(f"_new_{column}"))
    found = grouped.filter((F.col("_n_old") == 1) & (F.col("_n_new") == 1) & differs).select(
        *keys, F.col(f"_old_{column}").alias("old"), F.col(f"_new_{column}").alias("new")
    )
    return found if n is None else found.orderBy(*keys).limit(n)


def rows_on_one_side(old: DataFrame, new: DataFrame, keys: Sequence[str], n: int | None = None) -> DataFrame:
    """All keys found on one side only, or the first ``n`` of them in key order."""
    grouped = _by_key(old, new, keys, [])
    one_side = (F.col("_n_old") == 0) | (F.col("_n_new") == 0)
    side = F.when(F.col("_n_new") == 0, "old").otherwise("new")
    found = grouped.filter(one_side).select(*keys, side.alias("side"))
    return found if n is None else found.orderBy(*keys).limit(n)


def all_changes(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    n: int | None = None,
) -> DataFrame:
    """(column, keys, old, new) for every differing cell of keys that stand once on either side, as text.

    With ``n``, the first ``n`` of each column in key order, numbered by ``nth``. Both tables are read
    once for all columns, and tasks keep ``n`` rows of each column before anything is sorted.
    """
    columns = list(columns or [c for c in old.columns if c in new.columns and c not in keys])
    text = lambda prefix, c: F.col(f"{prefix}{c}").cast("string")
    cells = [
        F.when(
            ~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}")),
            F.struct(F.lit(c).alias("column"), text("_old_", c).alias("old"), text("_new_", c).alias("new")),
        )
        for c in columns
    ]
    paired = _by_key(old, new, keys, columns).filter("_n_old = 1 and _n_new = 1")
    changed = F.filter(F.array(*cells), lambda cell: cell.isNotNull())
    found = paired.select(*keys, F.explode(changed).alias("_cell")).select(
        "_cell.column", *keys, "_cell.old", "_cell.new"
    )
    if n is None:
        return found
    order = Window.partitionBy("column").orderBy(*keys)
    return found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= n)
