"""Stage files as they arrive, without listing what was loaded before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.contract import TableContract
from rosterloom.operators.shape import (
    apply_types,
    clean_all_text,
    conform,
    drop_blank_rows,
    header_matches,
)
from rosterloom.operators.rows import FILE, FILE_ORDER, SHEET
from rosterloom.sources.folder import (
    FEW_FILES,
    MODIFIED,
    PATH,
    SIZE,
    Source,
    SourceError,
    held,
    metadata_columns,
    plain_path,
    scan_headers,
    stack_tables,
    with_file_order,
)

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def stage_arrivals(
    spark: SparkSession,
    source: Source,
    headers: Sequence[str],
    contract: TableContract,
    target_path: str,
    checkpoint_path: str,
) -> None:
    """Append the typed rows of text files that arrived since the last call, then stop.

    For drop folders of delimited text whose files share one header line and are never rewritten:
    the stream's checkpoint remembers the files, so each one is loaded exactly once. A file with
    other headers, or the same in another order, stops the stream with an error; such files, and
    files that change under the same name, need ``read_staged``. Every path is streamed; paths
    must not overlap.
    """
    if source.format != "csv":
        raise SourceError(f"arriving files must be delimited text, not {source.format!r}")
    if len({h.lower() for h in headers}) < len(headers):
        raise SourceError("headers of arriving files must differ from each other")
    schema = T.StructType([T.StructField(h, T.StringType()) for h in headers])
    wanted = header_matches(list(headers), contract)

    def arriving(path: str) -> DataFrame:
        rows = (
            spark.readStream.schema(schema)
            # Each file's own header line must be the declared one.
            .options(header=True, enforceSchema=False)
            .options(sep=source.sep, encoding=source.encoding, escape='"')
            .options(**source.options)
            .csv(path)
        )
        cells = [rows[f"`{headers[i]}`"].alias(name) for i, name in wanted]
        return rows.select(*cells, *metadata_columns())

    named = with_file_order(reduce(DataFrame.union, map(arriving, source.paths)))
    typed = apply_types(clean_all_text(drop_blank_rows(named)), contract, cleaned=True)
    (
        conform(typed, contract)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def stage_arriving_layouts(
    spark: SparkSession,
    source: Source,
    contract: TableContract,
    target_path: str,
    checkpoint_path: str,
    keep: Mapping[str, str] | None = None,
) -> None:
    """Append the typed rows of files of any layout that arrived since the last call, then stop.

    The stream is of files, not of rows: every batch of new files has its header lines scanned and
    its cells matched to the contract like any folder, so files may differ in columns and their
    order, and may be workbooks. The stream's checkpoint remembers the files. A batch is written as a
    whole under its number (column ``_batch``), so one that is repeated after a failure replaces
    itself. Files must not change under the same name; those that do need ``read_staged``.
    """

    def load(batch: DataFrame, number: int) -> None:
        files = batch.select(
            plain_path(F.col("path")).alias("path"),
            F.unix_micros("modificationTime").alias("modified"),
            F.col("length").alias("size"),
        ).filter(~F.element_at(F.split("path", "/"), -1).startswith("~$"))
        files = held(files, "arrived")
        if files.isEmpty():
            return
        own = batch.sparkSession
        rows = stack_tables(own, scan_headers(own, files, source), source, contract, keep)
        typed = apply_types(clean_all_text(drop_blank_rows(rows)), contract, cleaned=True)
        conform(typed, contract).write.mode("overwrite").parquet(f"{target_path}/_batch={number}")

    def arriving(path: str) -> DataFrame:
        # Names and times only: the content column is never selected, so no file is opened here.
        found = spark.readStream.format("binaryFile").schema(_FILES)
        found = found.option("maxFilesPerTrigger", FEW_FILES)
        return found.load(path).select("path", "modificationTime", "length")

    (
        reduce(DataFrame.union, map(arriving, source.paths))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_arrived(spark: SparkSession, contract: TableContract, target_path: str) -> DataFrame:
    """What ``stage_arriving_layouts`` has written: the contract's columns and the provenance of every row."""
    names = sorted([PATH, SHEET, MODIFIED, SIZE, FILE, FILE_ORDER])
    kinds = {MODIFIED: T.LongType(), SIZE: T.LongType()}
    internal = [T.StructField(n, kinds.get(n, T.StringType())) for n in names]
    schema = T.StructType([*contract.struct_type().fields, *internal])
    return spark.read.schema(schema).parquet(target_path).drop("_batch")
