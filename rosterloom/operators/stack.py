"""Stacking the tables of all flows into one labelled table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.contract import ContractError, TableContract
from rosterloom.operators.shape import conform

ROW_LABEL = "_row_label"


def labelled(
    df: DataFrame, contract: TableContract, label_column: str, label: str, name: str = ""
) -> DataFrame:
    """The table in contract order behind its label. Rows that bring a label of their own keep it.

    Columns of another type than the contract's are refused: casting them here would hide a fault
    of the flow. Missing columns become null, further columns are left out.
    """
    unlike = [d for d in contract.differences(df.schema) if d.expected and d.found]
    if unlike:
        raise ContractError(f"{name or label}: {'; '.join(map(str, unlike))}")
    own = ROW_LABEL if ROW_LABEL in df.columns else None
    rows = conform(df, contract, keep_internal=bool(own))
    return rows.select((F.col(own) if own else F.lit(label)).alias(label_column), *contract.names)


def stack_labelled(
    tables: Mapping[str, DataFrame],
    contract: TableContract,
    label_column: str,
    labels: Mapping[str, str],
) -> DataFrame:
    """UNION ALL of the tables, each ``labelled``."""
    return reduce(DataFrame.union, [df for _, df in labelled_parts(tables, contract, label_column, labels)])


def labelled_parts(
    tables: Mapping[str, DataFrame],
    contract: TableContract,
    label_column: str,
    labels: Mapping[str, str],
) -> list[tuple[str | None, DataFrame]]:
    """Each table ``labelled``, behind its label, or None if its rows bring labels of their own."""
    return [
        (None if ROW_LABEL in df.columns else labels[n], labelled(df, contract, label_column, labels[n], n))
        for n, df in tables.items()
    ]


def rows_per_label(stacked: DataFrame, label_column: str) -> DataFrame:
    return stacked.groupBy(label_column).agg(F.count(F.lit(1)).alias("rows"))
