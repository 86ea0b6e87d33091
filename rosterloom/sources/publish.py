"""Writing results: Parquet and CSV, and the all-or-nothing publication of a run."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.contract import TableContract
from rosterloom.operators.shape import publish_projection

_PUBLICATION = "run_id string, published_at timestamp, formats array<string>"


@dataclass(frozen=True)
class PublishOptions:
    """Formats and locale of the published files."""

    formats: tuple[str, ...] = ("parquet", "csv")
    sep: str = ";"
    decimal_comma: bool = True
    date_format: str = "yyyy-MM-dd"

    def __post_init__(self) -> None:
        unknown = sorted(set(self.formats) - {"parquet", "csv"})
        if unknown:
            raise ValueError(f"unknown output format(s): {unknown}")
        if self.decimal_comma and self.sep == ",":
            raise ValueError("with decimal_comma the separator cannot be ','; use ';'")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet with zstd. Tasks write where their rows are; no shuffle before the write."""
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(
        path
    )


def plain_number(value: Column) -> Column:
    """A double as text without an exponent, if its size is between 1e-18 and 1e38; every digit stays."""
    text = value.cast("string")
    part = lambda k: F.regexp_extract(text, r"^(-?)(\d)\.(\d+)E(-?\d+)$", k)
    digits = F.concat(part(2), F.rtrim(part(3), F.lit("0")))
    power = part(4).try_cast("int")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    padded = F.rpad(digits, F.greatest(F.length(digits), power + 1), "0")
    whole = F.substring(padded, F.lit(1), power + 1)
    rest = F.substring(padded, power + 2, F.length(padded))
    large = F.when(power >= 20, whole).otherwise(F.concat(whole, F.lit("."), F.when(rest == "", "0").otherwise(rest)))
    plain = F.concat(part(1), F.when(power < 0, small).otherwise(large))
    within = (F.abs(value) >= 1e-18) & (F.abs(value) < 1e38)
    return F.when(text.contains("E") & within, plain).otherwise(text)


def write_csv(df: DataFrame, path: str, options: PublishOptions = PublishOptions()) -> None:
    """Delimited text with a header, the locale's decimal mark, and nothing for null."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    df = df.withColumns({c: plain_number(F.col(f"`{c}`")) for c in doubles})
    if options.decimal_comma:
        df = df.withColumns(
            {c: F.translate(F.col(f"`{c}`"), ".", ",") for c in doubles}
        )
    df.write.mode("overwrite").csv(
        path,
        sep=options.sep,
        header=True,
        dateFormat=options.date_format,
        nullValue="",
        emptyValue="",
        escape='"',
    )


#: Labelled rows, and their label if it is the same for all of them.
Part = tuple[str | None, DataFrame]


def _write_by_label(path: str, label_column: str, parts: Sequence[Part]) -> None:
    """One folder per label. Rows of a table with one label need not be sorted by it; such tables are written side by side."""
    mixed = [df for label, df in parts if label is None or not re.fullmatch(r"\w+", label, re.ASCII)]
    single = [(label, df) for label, df in parts if label and re.fullmatch(r"\w+", label, re.ASCII)]
    # First, because it replaces what a broken attempt of the same run may have left.
    first = reduce(DataFrame.union, mixed) if mixed else single[0][1].limit(0)
    write_parquet(first, path, [label_column])

    def append(part: Part) -> None:
        rows = part[1].drop(label_column).write.mode("append").option("compression", "zstd")
        rows.parquet(f"{path}/{label_column}={part[0]}")

    with ThreadPoolExecutor(max_workers=max(1, len(single))) as pool:
        list(pool.map(append, single))


def publish(
    stacked: DataFrame,
    contract: TableContract,
    label_column: str,
    output_path: str,
    run_id: str,
    options: PublishOptions = PublishOptions(),
    flows: Mapping[str, Sequence[str]] | None = None,
    parts: Sequence[Part] | None = None,
) -> list[str]:
    """Write the stacked table under its run, then make that run the current one.

    Parquet is partitioned by label, so each flow can be read by itself; ``flows`` (name ->
    labels) asks for one CSV folder per flow as well. ``parts`` are the tables that ``stacked`` is the
    union of; where they are given, they are written side by side. Readers follow the
    ``publications`` log, whose one-row append is the last thing written and is committed as a
    whole: they see the previous run or this one, never half of it.
    """
    table = publish_projection(stacked, contract)
    written = []
    for kind in options.formats:
        target = f"{output_path}/{kind}/run_id={run_id}"
        if kind == "parquet":
            shown = [(label, publish_projection(df, contract)) for label, df in parts or [(None, stacked)]]
            _write_by_label(target, label_column, shown)
        else:
            write_csv(table, target, options)
        written.append(target)
    if flows and "csv" in options.formats:
        for flow, labels in flows.items():
            target = f"{output_path}/csv_per_flow/run_id={run_id}/{flow}"
            write_csv(table.filter(F.col(label_column).isin(*labels)), target, options)
            written.append(target)
    stacked.sparkSession.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("published_at"),
        F.array(*[F.lit(f) for f in options.formats]).alias("formats"),
    ).coalesce(1).write.mode("append").parquet(f"{output_path}/publications")
    return written


def current_run(spark: SparkSession, output_path: str) -> str | None:
    """Run id of the newest publication, or None when nothing was published yet."""
    try:
        log = spark.read.schema(_PUBLICATION).parquet(f"{output_path}/publications")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.agg(F.max_by("run_id", F.struct("published_at", "run_id"))).first()[0]


def read_published(
    spark: SparkSession,
    output_path: str,
    contract: TableContract,
    label_column: str,
    label: str | Sequence[str] | None = None,
) -> DataFrame:
    """The current publication in contract order, or the rows of some labels only.

    Asking for one label drops the label column; only that label's files are read.
    """
    run_id = current_run(spark, output_path)
    if run_id is None:
        raise FileNotFoundError(f"nothing published under {output_path}")
    published = contract.struct_type(published=True)
    schema = T.StructType([T.StructField(label_column, T.StringType()), *published.fields])
    table = (
        spark.read.schema(schema)
        .parquet(f"{output_path}/parquet/run_id={run_id}")
        .select(*[f"`{n}`" for n in schema.names])
    )
    if label is None:
        return table
    if isinstance(label, str):
        return table.filter(F.col(label_column) == label).drop(label_column)
    return table.filter(F.col(label_column).isin(*label))

