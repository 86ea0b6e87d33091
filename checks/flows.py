"""The six flows, the stacked table and the rules across flows, on the derived raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables
from rosterloom.functions import value_code
from rosterloom.operators.joins import FOUND, same_month_counterpart
from rosterloom.operators.shape import conform, standardise
from rosterloom.operators.stack import ROW_LABEL, rows_per_label, stack_labelled
from rosterloom.plans import FLOWS, PEOPLE_CONTRACT, rules
from rosterloom.plans.config import FlowConfig, people_flow
from rosterloom.plans.people import LABELS
from rosterloom.scratch import scratch_path, written

RAW = {
    "snapshot": tables.snapshot_raw,
    "hires": tables.hires_raw,
    "leavers": tables.leavers_raw,
    "movements": tables.movements_raw,
    "contractors": tables.contractors_raw,
    "budget": tables.budget_raw,
}


def settings(name: str) -> FlowConfig:
    usual = people_flow(name, None)
    if name == "snapshot":
        return people_flow(name, None, parameters={**usual.parameters, "drop_duplicates": True})
    return usual


def build(
    spark: SparkSession, sf_dir: str, name: str, snapshot: DataFrame | None = None
) -> DataFrame:
    """One flow from its raw table; event flows build the snapshot first if none is given.

    As in a run, text is parsed once, into a written table, whatever the builder reads it for. Not so the
    snapshot's: of its many columns only the period is read twice, and writing them costs more than that.
    """
    raw = RAW[name](spark, sf_dir)
    if name == "contractors":
        raw = raw.withColumnRenamed("TIPO", "_class")
    if FLOWS[name].depends_on and snapshot is None:
        snapshot = snapshot_table(spark, sf_dir)
    typed = standardise(raw, PEOPLE_CONTRACT)
    if name != "snapshot":
        typed = written(typed, scratch_path(spark, f"{name}-typed"))
    found = {} if snapshot is None else {"snapshot": snapshot}
    return FLOWS[name].build(typed, settings(name), tables.REFERENCE, found)


def snapshot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot, written once because several flows read it."""
    return written(build(spark, sf_dir, "snapshot"), scratch_path(spark, "snapshot"))


def build_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    snapshot = snapshot_table(spark, sf_dir)
    return {n: snapshot if n == "snapshot" else build(spark, sf_dir, n, snapshot) for n in FLOWS}


def flow_query(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = conform(build(spark, sf_dir, name), PEOPLE_CONTRACT)
        marks = [c for c in (FOUND, ROW_LABEL) if c in built.columns]
        return built.select(*PEOPLE_CONTRACT.names, *marks)

    return query


def stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stack_labelled(build_all(spark, sf_dir), PEOPLE_CONTRACT, "BASE", LABELS)


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_per_label(stack(spark, sf_dir), "BASE")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of leavers by the previous month's snapshot, without same-month hires."""
    snapshot = snapshot_table(spark, sf_dir)
    # As in a run: the rule reads the tables the flows wrote.
    leavers, hires = [
        written(build(spark, sf_dir, name, snapshot), scratch_path(spark, name))
        for name in ("leavers", "hires")
    ]
    flagged = same_month_counterpart(leavers, hires, "hire_date", rules.NO_COUNTERPART)
    return rules.coverage_counts(flagged, excluded=rules.NO_COUNTERPART).withColumn(
        "ratio", F.round("ratio", 9)
    )


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = snapshot_table(spark, sf_dir)
    table = rules.reconciliation(
        snapshot,
        build(spark, sf_dir, "hires", snapshot),
        build(spark, sf_dir, "leavers", snapshot),
        ("F",),
    )
    return table.withColumn("deviation", F.round("deviation", 9))


def class_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.contractors_raw(spark, sf_dir).select(
        F.col("NOME").alias("full_name"), value_code(F.col("TIPO")).alias("code")
    )
