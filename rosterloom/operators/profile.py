"""Profile a source: what each header maps to, how full it is, and what it holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.contract import TableContract
from rosterloom.functions import header_code
from rosterloom.operators.shape import is_internal
from rosterloom.scratch import local_table

EXAMPLES = 3
#: Groups of tasks whose examples are merged first.
MERGED_AT_ONCE = 64


def _least_of_batches(n: int):
    """Function for ``mapInArrow``: of all rows of a task, the ``n`` smallest different texts of each column."""

    def least(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        kept = {}
        for batch in batches:
            for name, column in zip(batch.schema.names, batch.columns, strict=True):
                seen = pc.unique(column.drop_null())
                if name in kept:
                    seen = pc.unique(pa.concat_arrays([kept[name], seen]))
                kept[name] = seen.take(pc.select_k_unstable(seen, n, [("", "ascending")])) if len(seen) > n else seen
        if kept:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v.to_pylist()], pa.list_(pa.string())) for v in kept.values()], names=list(kept)
            )

    return least


def _smallest_values(df: DataFrame, headers: list[str], n: int) -> list[list[str]]:
    """The ``n`` smallest distinct values of every column, as text.

    One scan: each task keeps ``n`` values per column, and those sets are merged. Unpivoting and
    de-duplicating all cells would shuffle the whole table.
    """
    names = [f"v{i}" for i in range(len(headers))]
    if not names:
        return []
    cells = df.select(*[F.col(f"`{h}`").cast("string").alias(v) for h, v in zip(headers, names, strict=True)])
    found = cells.mapInArrow(_least_of_batches(n), ", ".join(f"{v} array<string>" for v in names))
    # Sets of a task are merged one by one into a set that stays as small.
    start = F.array().cast("array<string>")
    merged = found.groupBy((F.spark_partition_id() % MERGED_AT_ONCE).alias("part")).agg(
        *[_merged(v, start, n) for v in names]
    )
    row = merged.agg(*[_merged(v, start, n) for v in names]).first()
    return [row[v] for v in names]


def _merged(name: str, start, n: int):
    """An aggregate: the ``n`` smallest different values of all arrays."""
    smaller = lambda have, more: F.slice(F.array_sort(F.array_union(have, more)), 1, n)
    return F.aggregate(F.collect_list(name), start, smaller).alias(name)


def profile_columns(
    df: DataFrame, contract: TableContract, n_examples: int = EXAMPLES
) -> DataFrame:
    """One row per header: contract column, kind, status, fill ratio, distinct values, examples.

    Runs over the whole table. Contract columns no header provides are listed as ``missing``.
    """
    headers = [c for c in df.columns if not is_internal(c)]
    targets = contract.header_targets()
    kinds = {c.name: c.kind for c in contract.columns}

    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(f"`{h}`").alias(f"f{i}") for i, h in enumerate(headers)],
        *[F.approx_count_distinct(f"`{h}`").alias(f"d{i}") for i, h in enumerate(headers)],
    ).first()
    examples = _smallest_values(df, headers, n_examples)

    rows, used = [], set()
    for i, header in enumerate(headers):
        target = targets.get(header_code(header))
        status = "unmatched" if target is None else "repeated" if target in used else "matched"
        used.add(target)
        rows.append(
            (
                header,
                target,
                kinds.get(target),
                status,
                stats[f"f{i}"] / max(stats["n"], 1),
                stats[f"d{i}"],
                examples[i],
            )
        )
    rows += [
        (None, c.name, c.kind, "missing", 0.0, 0, []) for c in contract.columns if c.name not in used
    ]
    return local_table(
        df.sparkSession,
        rows,
        "header string, column string, kind string, status string, fill_ratio double, "
        "approx_distinct bigint, examples array<string>",
    )
