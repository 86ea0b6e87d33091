"""Labels for values from a table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.functions import value_code
from rosterloom.operators.skew import HOT_MIN_ROWS, SMALL_ROWS, left_join_first

_CODE = "_value_code"


def _coded(mapping: DataFrame, value: str, label: str) -> DataFrame:
    """(code, label), without values that have no code and without empty labels."""
    code = F.nullif(value_code(F.col(value)), F.lit(""))
    text = F.nullif(F.upper(F.trim(F.col(label).cast("string"))), F.lit(""))
    return mapping.select(code.alias(_CODE), text.alias("label")).dropna()


def label_from_table(
    df: DataFrame,
    column: str,
    mapping: DataFrame,
    label: str,
    value_in: str = "value",
    label_in: str = "label",
    hot_min_rows: int = HOT_MIN_ROWS,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """``df`` with ``label``: what ``mapping`` (value, label) says about the code of ``column``.

    Values meet by their code: accents, case and punctuation do not count. Anything unmapped
    becomes null. A code with several labels has the least of them (see ``label_conflicts``). Few
    different values make the mapping small, which is then broadcast; many make a shuffle join in
    which frequent values do not meet in one task.
    """
    kept = [c for c in df.columns if c != label]
    code = F.nullif(value_code(F.col(column)), F.lit(""))
    found = left_join_first(
        df.select(*kept, code.alias(_CODE)),
        _coded(mapping, value_in, label_in),
        [_CODE],
        lambda rows: rows.groupBy(_CODE).agg(F.min("label").alias("_label")),
        hot_min_rows,
        small_rows,
    )
    return found.select(*kept, F.col("_label").alias(label))


def label_conflicts(mapping: DataFrame, value_in: str = "value", label_in: str = "label") -> DataFrame:
    """(code, labels, least): codes that the mapping gives several labels, how many, and the one that is used."""
    return (
        _coded(mapping, value_in, label_in)
        .groupBy(F.col(_CODE).alias("code"))
        .agg(F.count_distinct("label").alias("labels"), F.min("label").alias("least"))
        .filter("labels > 1")
    )
