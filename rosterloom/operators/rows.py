"""Choosing rows: newest file, latest row per key, status filter, duplicates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.operators.skew import SMALL_ROWS, copy_if_small, left_join_first

FILE = "_source_file"
SHEET = "_source_sheet"
FILE_ORDER = "_file_order"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Iterable[str] = (),
    tie_breakers: Iterable[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest by ``order_by``, nulls last. Null keys form one group.

    Order columns the table lacks are ignored. Remaining ties go to the newest file and then to
    the other columns by name, so a re-run picks the same row. Spark keeps one candidate per key
    in each task before the shuffle, so a frequent key costs no more than a rare one.
    """
    ranking = [c for c in order_by if c in df.columns]
    if tie_breakers is None:
        orderable = [
            f.name
            for f in df.schema.fields
            if not isinstance(f.dataType, (T.MapType, T.VariantType))
        ]
        tie_breakers = [FILE_ORDER, *sorted(orderable)]
    ranking += [c for c in tie_breakers if c in df.columns and c not in {*ranking, *keys}]
    ordering = [F.col(c).desc_nulls_last() for c in ranking] or [F.lit(0)]
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def newest_file_per_period(
    df: DataFrame, period: str = "period", order: str = FILE_ORDER, small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Keep, for each period, only the rows of its newest file.

    Rows without a period belong to no month, so none of them replaces another; all are kept (and
    reported by the required-column rule). The newest file per period is a table of one row per
    month, so the rows are filtered in place against a broadcast of it and are not shuffled.
    """
    # Each file of a period once first, by hashing: the greatest text of a group is found by sorting,
    # which is then left few rows. Rows without a period count none; a filter on it would restate its parsing.
    files = df.groupBy(period, order).agg(F.count(period).alias("_rows")).filter("_rows > 0")
    newest = files.groupBy(period).agg(F.max(order).alias("_newest"))
    small = copy_if_small(newest, small_rows)
    joined = (
        df.join(F.broadcast(small), period, "left")
        if small is not None
        else left_join_first(df, newest, [period], lambda table: table, small_rows=small_rows)
    )
    kept = joined.filter(F.col(period).isNull() | (F.col(order) == F.col("_newest")))
    return kept.select(*df.columns)


def periods_in_several_files(
    df: DataFrame, period: str = "period", file: str = FILE, order: str = FILE_ORDER
) -> DataFrame:
    """Periods found in more than one file, their file names, and the newest of them.

    Reduced to one row per (period, file) first; the names gathered per period are then bounded
    by the number of source files.
    """
    per_file = df.groupBy(period, file).agg(F.max(order).alias("_order"))
    return (
        per_file.groupBy(period)
        .agg(
            F.array_sort(F.collect_list(file)).alias("files"),
            F.max_by(file, "_order").alias("used_file"),
        )
        .filter(F.size("files") > 1)
    )


def exclude_status(df: DataFrame, column: str, excluded: Sequence[str]) -> DataFrame:
    """Drop rows with one of the statuses; a row without a status stays."""
    if not excluded or column not in df.columns:
        return df
    return df.filter(~F.coalesce(F.col(column).isin(*excluded), F.lit(False)))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. Nulls compare equal.

    Counted per task before the shuffle, so one key with most of the rows is no problem.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def duplicate_sample(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows, in key order, among all rows of duplicated keys.

    They belong to the first ``n`` duplicated keys at most, so those are looked up, not all.
    """
    first_groups = duplicate_groups(df, keys).orderBy(*keys).limit(n).drop("rows")
    match = None
    d, g = df.alias("d"), F.broadcast(first_groups.alias("g"))
    for k in keys:
        equal = F.col(f"d.{k}").eqNullSafe(F.col(f"g.{k}"))
        match = equal if match is None else match & equal
    return d.join(g, match, "left_semi").orderBy(*keys).limit(n)
