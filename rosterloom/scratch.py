"""Intermediate tables on the storage the cluster shares, and small ones that are part of the plan."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence
from threading import Thread

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_SETTING = "spark.checkpoint.dir"
#: For counts that were taken during a write.
WAIT_SECONDS = 60


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the session's checkpoint directory.

    Only a session on one machine without that setting, as in tests, gets a temporary folder, which
    becomes the setting. On a cluster its absence is an error: executors would write to their own disks.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="rosterloom-")
        spark.conf.set(_SETTING, root)
    return f"{root}/rosterloom/{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read back.

    Cuts the lineage, so a lost executor costs a re-read and not a re-computation, and lets later
    steps read only the columns they need.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_and_counted(
    df: DataFrame, path: str, counts: Sequence[Column], columns: Sequence[Column] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """``written``, and aggregates over the rows of ``df`` as they pass, by name.

    They are taken in the tasks that write, so nothing is read twice, and a task that is repeated
    after a lost executor counts once. Of ``df`` only ``columns`` are written, if given. The counts
    come by an event that a busy driver may drop; they are then taken by a pass of their own.
    """
    seen = Observation()
    passing = df.observe(seen, *counts)
    table = written(passing if columns is None else passing.select(*columns), path)
    found: dict[str, int] = {}
    waiting = Thread(target=lambda: found.update(seen.get), daemon=True)
    waiting.start()
    waiting.join(WAIT_SECONDS)
    return table, found or df.agg(*counts).first().asDict()


def local_table(
    spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType
) -> DataFrame:
    """A few rows as a table that is part of the plan: reading it takes no job and no Python worker."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    listed = [dict(zip(kind.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(listed, schema=to_arrow_schema(kind)), kind)
