"""Keep a staged Parquet copy of a source, and read only the files that changed."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.contract import TableContract
from rosterloom.operators.rows import FILE, FILE_ORDER, SHEET
from rosterloom.operators.skew import SMALL_ROWS
from rosterloom.scratch import local_table, scratch_path, written
from rosterloom.sources.folder import (
    MODIFIED,
    NAMED_FILES,
    PATH,
    SIZE,
    Source,
    SourceError,
    few_rows,
    list_files,
    scan_headers,
    stack_tables,
    wanted_columns,
)

#: Part of every fingerprint: a reader that understands files otherwise takes a new number and stages them anew.
READER_VERSION = "1"
FINGERPRINT = "file_fingerprint"
_MANIFEST = f"{FINGERPRINT} string, path string, columns array<string>"


def _fingerprint(
    path: Column, modified: Column, size: Column, source: Source, contract: TableContract, keep
) -> Column:
    """Identity of one version of a file, together with everything that shapes its staged copy.

    It is taken of every staged row, so the settings, which are the same for all, enter as their own digest.
    """
    headers = sorted(contract.header_targets().items())
    settings = repr(
        (
            READER_VERSION,
            source.format,
            source.sheet,
            source.header_row,
            source.sep,
            source.encoding,
            sorted(source.options.items()),
            headers,
            sorted((keep or {}).items()),
        )
    )
    digest = hashlib.sha256(settings.encode()).hexdigest()
    return F.sha2(F.concat_ws("|", path, size, modified, F.lit(digest)), 256)


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_table(spark, [], _MANIFEST)


def read_staged(
    spark: SparkSession,
    source: Source,
    contract: TableContract,
    staging_path: str,
    keep: Mapping[str, str] | None = None,
    restage: bool = False,
) -> DataFrame:
    """Like ``read_folder``, served from a staged table; only new and changed files are read.

    The table has one partition per file version. Loading replaces exactly the partitions it
    loads, and a version counts as loaded only when the manifest says so, which is written last:
    a job that dies half-way is simply loaded again. ``restage`` reads every file anew.
    """
    identity = _fingerprint(
        F.col("path"), F.col("modified"), F.col("size"), source, contract, keep
    )
    current = list_files(spark, source).withColumn(FINGERPRINT, identity)
    manifest = _manifest(spark, staging_path)
    listed = few_rows(current)
    if listed is not None:  # what a few files are known by is compared here, without a job for it
        versions = sorted(r[FINGERPRINT] for r in listed)
        of_these = manifest.filter(F.col(FINGERPRINT).isin(*versions))
        loaded = {r[FINGERPRINT]: r["columns"] for r in of_these.collect()}
        seen = {c for columns in loaded.values() for c in columns}
        new = [r for r in listed if restage or r[FINGERPRINT] not in loaded]
        if new:
            pending = local_table(spark, new, current.schema)
            seen |= _load(spark, source, contract, staging_path, keep, pending)
        return _rows(spark, contract, staging_path, keep, seen).filter(
            F.col(FINGERPRINT).isin(*versions)
        ).drop(FINGERPRINT)
    # A load that died after its last write but one may have left a version in the manifest twice.
    once = manifest.dropDuplicates([FINGERPRINT]).select(FINGERPRINT, "columns")
    known = written(current.join(once, FINGERPRINT, "left"), scratch_path(spark, "versions"))
    state = known.agg(
        F.count("*").alias("files"),
        F.count_if(F.col("columns").isNull()).alias("new"),
        F.collect_set("columns").alias("columns"),  # one entry for each layout
    ).first()
    seen = {c for columns in state["columns"] for c in columns}
    if restage or state["new"]:
        pending = known if restage else known.filter("columns is null")
        seen |= _load(spark, source, contract, staging_path, keep, pending.select(*current.columns))
    versions = known.select(FINGERPRINT)
    versions = F.broadcast(versions) if state["files"] <= SMALL_ROWS else versions
    rows = _rows(spark, contract, staging_path, keep, seen)
    return rows.join(versions, FINGERPRINT, "left_semi").drop(FINGERPRINT)


def _load(spark, source, contract, staging_path, keep, pending: DataFrame) -> set[str]:
    """Stage the pending files; returns the columns they provide."""
    scanned = scan_headers(spark, pending.drop(FINGERPRINT), source)
    rows = stack_tables(spark, scanned, source, contract, keep)
    identity = _fingerprint(F.col(PATH), F.col(MODIFIED), F.col(SIZE), source, contract, keep)
    (
        rows.withColumn(FINGERPRINT, identity)
        .drop(MODIFIED, SIZE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(FINGERPRINT)
        .parquet(f"{staging_path}/rows")
    )
    # Rows carry the version that was read. One that is no longer listed may have been replaced
    # before it was read: it must not count as loaded.
    kept = list_files(spark, source).select(_fingerprint(
        F.col("path"), F.col("modified"), F.col("size"), source, contract, keep
    ).alias(FINGERPRINT))
    gone = pending.join(kept, FINGERPRINT, "left_anti").orderBy("path").limit(NAMED_FILES).collect()
    if gone:
        raise SourceError("changed while they were read, load again: " + ", ".join(r["path"] for r in gone))
    provided = {
        layout.code: sorted({name for _, name in wanted_columns(layout.headers, contract, keep)})
        for layout in scanned.layouts
    }
    by_layout = local_table(spark, provided.items(), "layout bigint, provided array<string>")
    of_path = (
        scanned.tables.join(F.broadcast(by_layout), "layout")
        .groupBy("path")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("provided")))).alias("columns"))
    )
    nothing = F.array().cast("array<string>")
    (
        pending.join(of_path, "path", "left")
        .select(FINGERPRINT, "path", F.coalesce("columns", nothing).alias("columns"))
        .write.mode("append").parquet(f"{staging_path}/manifest")
    )
    return {name for names in provided.values() for name in names}


def _rows(spark, contract, staging_path, keep, seen) -> DataFrame:
    """All staged rows, to be filtered by version: other partitions are pruned, and staged rows never move."""
    names = [
        *[n for n in contract.names if n in seen],
        *[k for k in (keep or {}) if k in seen],
        PATH,
        SHEET,
        FILE,
        FILE_ORDER,
        FINGERPRINT,
    ]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).parquet(f"{staging_path}/rows")
