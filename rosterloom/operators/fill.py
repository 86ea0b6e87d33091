"""Values carried forward over gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.scratch import scratch_path, written

_PART = "_range"


def _last(c: str, order: Sequence[Column]) -> Column:
    """The value of ``c`` in the last row that has one; an aggregate."""
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order)))


def fill_down(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str], groups: Sequence[str] = ()
) -> DataFrame:
    """Each null of ``columns`` becomes the last value before it in the order, of the same group.

    Nulls come first in the order, and rows that it does not tell apart go by their other columns,
    so a re-run fills alike. Works in parallel on an order over the whole table: rows are dealt in
    ranges of the order, the last value of each range is carried on over the ranges (one row for
    each), and the ranges are filled on their own. Group columns may not be filled themselves.
    """
    if set(columns) & {*order_by, *groups}:
        raise ValueError("columns that order or group the rows cannot be filled")
    plain = [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.MapType, T.VariantType)) and f.name not in {*groups, *order_by}
    ]
    ranking = [*groups, *order_by, *sorted(plain)]
    ascending = [F.col(f"`{c}`").asc_nulls_first() for c in ranking]
    # Written, because dealing again might draw other borders.
    dealt = written(
        df.repartitionByRange(*ascending).withColumn(_PART, F.spark_partition_id()),
        scratch_path(df.sparkSession, "ranges"),
    )
    group = F.struct(*[F.col(f"`{c}`") for c in groups]) if groups else F.lit(0)
    # Null-safe order of structs: fields compare one by one, nulls first, as in the ranges.
    keys = [F.col(f"`{c}`") for c in ranking]
    with_group = dealt.withColumn("_group", group)
    last_group = F.max_by("_group", F.struct(*keys))
    ends = with_group.groupBy(_PART).agg(last_group.alias("_group"))
    last = (
        with_group.join(F.broadcast(ends.withColumnRenamed("_group", "_last")), _PART)  # one row a range
        .filter(F.col("_group").eqNullSafe(F.col("_last")))
        .groupBy(_PART, "_group")
        .agg(*[_last(c, keys).alias(f"_last_{c}") for c in columns])
    )
    # Over a table of one row for each range: what goes on into the next one.
    along = Window.partitionBy("_group").orderBy(_PART).rowsBetween(Window.unboundedPreceding, 0)
    carried = last.select(
        _PART,
        F.col("_group").alias("_from"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(along).alias(f"_last_{c}") for c in columns],
    )
    next_range = F.lead(_PART).over(Window.orderBy(_PART))
    carried = carried.withColumn(_PART, next_range).dropna(subset=[_PART])
    here = Window.partitionBy(_PART, *[f"`{c}`" for c in groups]).orderBy(*ascending)
    here = here.rowsBetween(Window.unboundedPreceding, 0)
    filled = with_group.withColumns(
        {f"_own_{c}": F.last(F.col(f"`{c}`"), ignorenulls=True).over(here) for c in columns}
    ).join(F.broadcast(carried), _PART, "left")  # one row a range
    same = F.col("_group").eqNullSafe(F.col("_from"))

    def value(c: str) -> Column:
        before = F.when(same, F.col(f"_last_{c}"))
        return F.coalesce(F.col(f"_own_{c}"), before).alias(c) if c in columns else F.col(f"`{c}`")

    return filled.select(*[value(c) for c in df.columns])
