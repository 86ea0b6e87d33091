"""Data-quality rules. Their outcomes are rows; ERROR blocks publishing.

Most rules count offending rows, and all counts over one table are taken in a single aggregation
(``check_counts``), in a run while the table is written. Samples are separate, limited reads made
only for rules that failed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from enum import IntEnum

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.contract import TableContract
from rosterloom.operators.joins import FOUND
from rosterloom.operators.rows import duplicate_groups, duplicate_sample, exclude_status
from rosterloom.operators.shape import is_internal, typed
from rosterloom.scratch import local_table

CONSOLIDATED = "consolidated"
NO_COUNTERPART = "_no_snapshot_expected"
# Plausible dates start here and end this many days after the reference date.
EARLIEST_DATE = dt.date(1950, 1, 1)
DAYS_AHEAD = 400
VALUE_EXAMPLES = 10
_TYPED = "_typed_"


class Severity(IntEnum):
    OK = 0
    INFO = 1
    WARN = 2
    ERROR = 3


@dataclass
class RuleResult:
    """Outcome of one rule, with a lazy sample of offending rows where there are any."""

    rule: str
    scope: str
    severity: Severity
    message: str
    occurrences: int = 0
    sample: DataFrame | None = field(default=None, repr=False)
    #: The column the rule looked at, where it is one.
    subject: str = ""


def outcome(
    rule: str,
    scope: str,
    occurrences: int,
    found: str,
    fine: str,
    sample: DataFrame | None = None,
    severity: Severity = Severity.WARN,
) -> list[RuleResult]:
    """One result: ``fine`` without occurrences, else ``found`` with its severity and sample."""
    if not occurrences:
        return [RuleResult(rule, scope, Severity.OK, fine)]
    return [RuleResult(rule, scope, severity, found, occurrences, sample)]


def worst(results: Sequence[RuleResult]) -> Severity:
    return max((r.severity for r in results), default=Severity.OK)


# ------------------------------------------------------------------------------ counting rules
@dataclass(frozen=True)
class Check:
    """Rows where ``condition`` is true offend ``rule``. Without a condition: an empty table."""

    rule: str
    subject: str
    severity: Severity
    condition: Column | None
    message: str
    ok_rule: str | None = None


def no_rows_check() -> Check:
    return Check("no_rows", "", Severity.ERROR, None, "no rows left after treatment", "no_rows")


def required_checks(df: DataFrame, columns: Sequence[str]) -> list[Check]:
    return [
        Check(
            "required_null",
            c,
            Severity.ERROR,
            F.col(c).isNull(),
            "'{subject}' is empty in {n} row(s)",
            "required",
        )
        for c in columns
        if c in df.columns
    ]


def period_start_check(df: DataFrame) -> list[Check]:
    if dict(df.dtypes).get("period") != "date":
        return []
    return [
        Check(
            "period_not_month_start",
            "period",
            Severity.ERROR,
            F.day("period") != 1,
            "{n} row(s) with a period that is not the first day of a month",
        )
    ]


def plausible_date_checks(
    df: DataFrame,
    columns: Sequence[str],
    reference_date: dt.date,
    earliest: dt.date = EARLIEST_DATE,
    days_ahead: int = DAYS_AHEAD,
) -> list[Check]:
    latest = reference_date + dt.timedelta(days=days_ahead)
    types = dict(df.dtypes)
    return [
        Check(
            "implausible_date",
            c,
            Severity.WARN,
            (F.col(c) < F.lit(earliest)) | (F.col(c) > F.lit(latest)),
            f"'{{subject}}' outside {earliest}..{latest} in {{n}} row(s)",
        )
        for c in columns
        if types.get(c) == "date"
    ]


def unclassified_check(label: str, labels: Sequence[str], hint: str) -> Check:
    return Check(
        "unclassified",
        label,
        Severity.ERROR,
        F.col(label).isNull() | ~F.col(label).isin(*labels),
        "{n} row(s) without one of the labels " + ", ".join(labels) + f". {hint}",
    )


def parse_failure_checks(raw: DataFrame, contract: TableContract) -> list[Check]:
    """A filled cell that becomes null when it gets the contract's type."""
    specs = contract.by_name
    return [
        Check(
            "parse_failure",
            f.name,
            Severity.WARN,
            F.col(f.name).isNotNull()
            & typed(F.col(f.name), specs[f.name], f.dataType).isNull(),
            f"'{{subject}}' ({specs[f.name].kind}): {{n}} value(s) could not be read",
        )
        for f in raw.schema.fields
        if f.name in specs
        and specs[f.name].kind != "text"
        and f.dataType != specs[f.name].spark_type
    ]


def check_counts(checks: Sequence[Check]) -> list[Column]:
    """Aggregates ``rows``, and ``n0``, ``n1``, ... for the checks that have a condition."""
    return [
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(c.condition).alias(f"n{i}")
            for i, c in enumerate(checks)
            if c.condition is not None
        ],
    ]


def count_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(rule, subject, severity, occurrences, rows) for every check, from one pass over ``df``."""
    counts = df.agg(*check_counts(checks))
    entries = [
        F.struct(
            F.lit(c.rule).alias("rule"),
            F.lit(c.subject).alias("subject"),
            F.lit(c.severity.name).alias("severity"),
            (
                F.when(F.col("rows") == 0, 1).otherwise(0).cast("bigint")
                if c.condition is None
                else F.col(f"n{i}")
            ).alias("occurrences"),
            F.col("rows"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*entries)))


def evaluate(
    df: DataFrame,
    checks: Sequence[Check],
    scope: str,
    sample_rows: int = 50,
    sample_order: Sequence[str] = (),
    counts: Mapping[str, int] | None = None,
) -> list[RuleResult]:
    """Run the checks in one job, or take the ``check_counts`` that a write has left.

    Each ``ok_rule`` whose checks all pass adds one OK result.
    """
    if not checks:
        return []
    if counts is None:
        counts = df.agg(*check_counts(checks)).first().asDict()
    results, passed = [], {}
    for i, check in enumerate(checks):
        n = int(not counts["rows"]) if check.condition is None else counts[f"n{i}"]
        if n:
            offending = None
            if check.condition is not None:
                offending = df.filter(check.condition)
                order = [c for c in sample_order if c in df.columns]
                offending = (offending.orderBy(*order) if order else offending).limit(sample_rows)
            message = check.message.format(subject=check.subject, n=n)
            results.append(
                RuleResult(
                    check.rule,
                    scope,
                    check.severity,
                    message,
                    0 if check.condition is None else n,
                    offending,
                    check.subject,
                )
            )
        if check.ok_rule:
            passed.setdefault(check.ok_rule, []).append(not n)
    for rule, outcomes in passed.items():
        if all(outcomes):
            results.append(
                RuleResult(rule, scope, Severity.OK, f"{counts['rows']} row(s) checked")
            )
    return results


def missing_columns(df: DataFrame, columns: Sequence[str], scope: str) -> list[RuleResult]:
    return [
        RuleResult(
            "missing_column",
            scope,
            Severity.ERROR,
            f"required column '{c}' was not found in the source; check its accepted headers",
        )
        for c in columns
        if c not in df.columns
    ]


def typed_beside(raw: DataFrame, contract: TableContract) -> tuple[DataFrame, list[Column], list[Column]]:
    """``raw`` with the typed columns beside it, the ``check_counts`` of its parse failures, and the typed table's columns.

    A cell is parsed once: what is counted and what is kept come from the same column.
    """
    specs = contract.by_name
    kinds = {f.name: f.dataType for f in raw.schema.fields}
    beside = {n: f"{_TYPED}{n}" for n in raw.columns if n in specs}
    both = raw.withColumns(
        {b: typed(F.col(f"`{n}`"), specs[n], kinds[n], cleaned=True) for n, b in beside.items()}
    )
    unread = [
        replace(c, condition=F.col(c.subject).isNotNull() & F.col(beside[c.subject]).isNull())
        for c in parse_failure_checks(raw, contract)
    ]
    columns = [F.col(beside.get(n, n)).alias(n) for n in raw.columns]
    return both, check_counts(unread), columns


def parse_failures(
    raw: DataFrame,
    contract: TableContract,
    scope: str,
    examples: int = VALUE_EXAMPLES,
    counts: Mapping[str, int] | None = None,
) -> list[RuleResult]:
    """Parse failures of every column, with examples of the values of failing columns."""
    checks = parse_failure_checks(raw, contract)
    by_column = {c.subject: c for c in checks}
    results = evaluate(raw, checks, scope, examples, counts=counts)
    for result in results:
        unread = raw.filter(by_column[result.subject].condition).select(result.subject)
        result.sample = unread.distinct().orderBy(result.subject).limit(examples)
    return results


# -------------------------------------------------------------------------------- unique keys
def count_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(groups, rows): repeated keys and the rows that carry them."""
    return duplicate_groups(df, key).agg(
        F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )


def unique_key(
    df: DataFrame, key: Sequence[str], scope: str, sample_rows: int = 50
) -> list[RuleResult]:
    """Repeated keys; nothing to say without a key or when the table lacks one of its columns."""
    if not key or not set(key) <= set(df.columns):
        return []
    found = count_duplicates(df, key).first()
    return [_unique_key_result(df, key, scope, found["groups"], found["rows"], sample_rows)]


def _unique_key_result(df, key, scope, groups: int, rows: int, sample_rows: int) -> RuleResult:
    if not groups:
        return RuleResult("unique_key", scope, Severity.OK, f"key {list(key)} is unique")
    return RuleResult(
        "duplicate_key",
        scope,
        Severity.ERROR,
        f"{groups} repeated key(s) {list(key)} in {rows} row(s)",
        rows,
        duplicate_sample(df, key, sample_rows),
    )


def duplicates_per_label(
    df: DataFrame, label: str, keys: Mapping[str, Sequence[str]]
) -> DataFrame:
    """(label, groups, rows) where every label has its own key, in one grouped pass."""
    key = None
    for value, columns in keys.items():
        parts = F.array(*[F.col(c).cast("string") for c in columns])
        matches = F.col(label) == value
        key = F.when(matches, parts) if key is None else key.when(matches, parts)
    return (
        df.filter(F.col(label).isin(*keys))
        .select(F.col(label).alias("label"), key.alias("key"))
        .groupBy("label", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("label")
        .agg(
            F.count_if(F.col("n") > 1).alias("groups"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows"),
        )
    )


def unique_key_per_label(
    df: DataFrame,
    label: str,
    keys: Mapping[str, Sequence[str]],
    scope: str,
    sample_rows: int = 50,
) -> list[RuleResult]:
    keys = {k: v for k, v in keys.items() if v and set(v) <= set(df.columns)}
    if not keys:
        return []
    found = {r["label"]: r for r in duplicates_per_label(df, label, keys).collect()}
    results = []
    for value, key in keys.items():
        row = found.get(value)
        results.append(
            _unique_key_result(
                df.filter(F.col(label) == value),
                key,
                f"{scope}/{value}",
                row["groups"] if row else 0,
                row["rows"] if row else 0,
                sample_rows,
            )
        )
    return results


# ---------------------------------------------------------------------------------- coverage
def coverage_counts(df: DataFrame, mark: str = FOUND, excluded: str | None = None) -> DataFrame:
    """(excluded, expected, found, ratio) of an enriched table."""
    expected = ~F.coalesce(F.col(excluded), F.lit(False)) if excluded else F.lit(True)
    return df.agg(
        F.count_if(~expected).alias("excluded"),
        F.count_if(expected).alias("expected"),
        F.count_if(expected & F.col(mark)).alias("found"),
    ).withColumn(
        "ratio", F.when(F.col("expected") > 0, F.col("found") / F.col("expected"))
    )


def reference_coverage(
    df: DataFrame,
    scope: str,
    minimum: float,
    mark: str = FOUND,
    excluded: str | None = None,
    sample_rows: int = 50,
) -> list[RuleResult]:
    """Share of rows found in the snapshot, leaving out rows that cannot be in one."""
    if mark not in df.columns:
        return []
    excluded = excluded if excluded in df.columns else None
    counts = coverage_counts(df, mark, excluded).first()
    if not counts["expected"] and not counts["excluded"]:
        return []
    note = (
        f"; {counts['excluded']} row(s) with no snapshot expected left out"
        if counts["excluded"]
        else ""
    )
    if not counts["expected"]:
        return [RuleResult("reference_coverage", scope, Severity.OK, "no row to check" + note)]
    lost = counts["expected"] - counts["found"]
    order = [c for c, kind in df.dtypes if kind in ("string", "date", "bigint", "int", "double")]
    missing = ~F.col(mark)
    if excluded:
        missing &= ~F.coalesce(F.col(excluded), F.lit(False))
    sample = df.filter(missing).orderBy(*order) if order else df.filter(missing)
    return [
        RuleResult(
            "reference_coverage",
            scope,
            Severity.OK if counts["ratio"] >= minimum else Severity.WARN,
            f"{counts['ratio']:.1%} of rows found in the snapshot ({lost} not found; "
            f"minimum {minimum:.0%}){note}",
            lost,
            sample.limit(sample_rows) if lost else None,
        )
    ]


# ------------------------------------------------------------------------------ reconciliation
def people_per_period(df: DataFrame, name: str, person: str = "person_id") -> DataFrame:
    """Distinct people per period. A missing person id counts as one more person."""
    return df.groupBy("period").agg(
        (
            F.count_distinct(person) + F.max(F.when(F.col(person).isNull(), 1).otherwise(0))
        ).alias(name)
    )


def reconciliation(
    snapshot: DataFrame,
    hires: DataFrame | None,
    leavers: DataFrame | None,
    outside_headcount: Sequence[str] = (),
) -> DataFrame:
    """Headcount of each period against the period before it plus hires minus leavers.

    "Before" is the previous period that exists. The window runs over one row per period, a
    table no longer than the calendar.
    """
    spark = snapshot.sparkSession
    counts = people_per_period(exclude_status(snapshot, "status", outside_headcount), "headcount")
    table = counts.withColumn(
        "previous", F.lag("headcount", 1, 0).over(Window.orderBy("period"))
    )
    for events, name in ((hires, "hires"), (leavers, "leavers")):
        if events is None or not {"period", "person_id"} <= set(events.columns):
            per_period = local_table(spark, [], f"period date, {name} bigint")
        else:
            per_period = people_per_period(events, name)
        table = table.join(per_period, "period", "left").fillna(0, [name])
    return (
        table.filter("previous > 0")
        .withColumn("expected", F.col("previous") + F.col("hires") - F.col("leavers"))
        .withColumn("difference", F.col("headcount") - F.col("expected"))
        .withColumn("deviation", F.abs("difference") / F.col("headcount"))
    )


def reconcile(
    snapshot: DataFrame,
    hires: DataFrame | None,
    leavers: DataFrame | None,
    tolerance: float,
    outside_headcount: Sequence[str] = (),
) -> list[RuleResult]:
    """Periods whose headcount departs from the expected one by more than ``tolerance`` of it."""
    checked = 0
    if "period" in snapshot.columns:
        table = reconciliation(snapshot, hires, leavers, outside_headcount)
        off = table.filter(F.col("deviation") > tolerance).orderBy("period")
        # A row for each period but the first.
        checked, unlike = table.agg(
            F.count(F.lit(1)), F.count_if(F.col("deviation") > tolerance)
        ).first()
    if not checked:
        alone = "skipped: the snapshot has fewer than two periods"
        return [RuleResult("reconciliation", CONSOLIDATED, Severity.INFO, alone)]
    return outcome(
        "reconciliation",
        CONSOLIDATED,
        unlike,
        f"{unlike} period(s) where previous + hires - leavers is not the headcount "
        f"(tolerance {tolerance:.1%})",
        f"headcount reconciled over {checked} period(s)",
        off,
    )


# -------------------------------------------------------------------------- budget and volume
def months_per_year(df: DataFrame) -> DataFrame:
    """(year, months): distinct periods of each year; no period at all counts as one."""
    return df.groupBy(F.year("period").alias("year")).agg(
        (
            F.count_distinct("period") + F.max(F.when(F.col("period").isNull(), 1).otherwise(0))
        ).alias("months")
    )


def budget_months(df: DataFrame, scope: str) -> list[RuleResult]:
    """Years in which the budget does not have all twelve months."""
    years = months_per_year(df).collect() if "period" in df.columns else []  # one row a year
    if not years:
        return []
    short = sorted((r for r in years if r["months"] != 12), key=lambda r: r["year"] or 0)
    sample = local_table(df.sparkSession, short, "year int, months bigint") if short else None
    listed = ", ".join(f"{r['year']} ({r['months']})" for r in short)
    return outcome(
        "budget_months" if short else "budget_periods",
        scope,
        len(short),
        f"year(s) without 12 months: {listed}",
        "12 months in every year",
        sample,
    )


def volume_change(current: DataFrame, previous: DataFrame, label: str, limit: float) -> DataFrame:
    """Labels whose number of rows moved by more than ``limit`` since the previous run.

    Both sides are (label, rows). Labels new or gone since then are not reported.
    """
    before = previous.select(label, F.col("rows").alias("before"))
    return (
        current.join(before, label)
        .filter("before > 0")
        .withColumn("change", (F.col("rows") - F.col("before")) / F.col("before"))
        .filter(F.abs("change") > limit)
    )


def volume_results(
    current: DataFrame, previous: DataFrame | None, label: str, limit: float
) -> list[RuleResult]:
    if previous is None:
        return [RuleResult("volume_change", CONSOLIDATED, Severity.INFO, "first run")]
    moved = volume_change(current, previous, label, limit).orderBy(label).collect()
    results = []
    for row in moved:  # at most one per label
        before, now = row["before"], row["rows"]
        text = f"rows changed by {row['change']:+.1%} since the last run ({before} -> {now})"
        results += outcome("volume_change", row[label], abs(now - before), text, "")
    return results or outcome("volume_change", CONSOLIDATED, 0, "", f"volumes within +/-{limit:.0%}")


# ------------------------------------------------------------------------------------- schema
def schema_differences(df: DataFrame, contract: TableContract) -> DataFrame:
    """(column, expected, found) for every column that ``df`` and the contract see differently. No job runs."""
    rows = [
        (d.column, *(t.simpleString() if t else None for t in (d.expected, d.found)))
        for d in contract.differences(df.schema)
    ]
    return local_table(df.sparkSession, rows, "column string, expected string, found string")


def contract_report(df: DataFrame, contract: TableContract) -> DataFrame:
    """(column, problem, expected, found, filled, lost) for every column that ``df`` and the contract see differently.

    ``extra`` columns would not be published, ``missing`` ones would be empty, and those of another
    ``type`` are refused. ``filled`` counts the values that are there, ``lost`` those that the
    contract's type could not hold. One pass over the table.
    """
    unlike = [d for d in contract.differences(df.schema) if not is_internal(d.column)]
    cell = lambda d: F.col(f"`{d.column}`")
    counts = []
    for i, d in enumerate(unlike):
        if d.found is None:
            continue
        counts.append(F.count(cell(d)).alias(f"f{i}"))
        if d.expected is not None:
            counts.append(F.count_if(cell(d).isNotNull() & cell(d).try_cast(d.expected).isNull()).alias(f"l{i}"))
    row = df.agg(F.count(F.lit(1)).alias("rows"), *counts).first()
    told = [
        (
            d.column,
            "extra" if d.expected is None else "missing" if d.found is None else "type",
            d.expected.simpleString() if d.expected else None,
            d.found.simpleString() if d.found else None,
            row[f"f{i}"] if d.found else 0,
            row[f"l{i}"] if d.found and d.expected else 0,
        )
        for i, d in enumerate(unlike)
    ]
    schema = "column string, problem string, expected string, found string, filled bigint, lost bigint"
    return local_table(df.sparkSession, told, schema)


def output_contract(
    df: DataFrame, contract: TableContract, label_column: str
) -> list[RuleResult]:
    """The table that is published has the columns and types of the contract, behind its label."""
    public = df.drop(label_column, *[c for c in df.columns if is_internal(c)])
    unlike = contract.differences(public.schema)
    return outcome(
        "output_contract",
        CONSOLIDATED,
        len(unlike),
        "; ".join(map(str, unlike)),
        f"{len(contract.columns)} columns and their types are those of the contract",
        schema_differences(public, contract) if unlike else None,
        Severity.ERROR,
    )


def columns_outside_contract(
    df: DataFrame, contract: TableContract, scope: str
) -> list[RuleResult]:
    """Columns a flow made that nobody will see, because the contract does not have them."""
    unknown = sorted(
        d.column
        for d in contract.differences(df.schema)
        if d.expected is None and not is_internal(d.column)
    )
    dropped = f"not in the contract, so not published: {', '.join(unknown)}"
    return outcome("column_outside_contract", scope, len(unknown), dropped, "") if unknown else []


def overlapping_periods(
    repeated: DataFrame, scope: str, resolved: bool, examples: int = 5
) -> list[RuleResult]:
    """Months found in several files: a warning when the newest file was used, else an error."""
    n = repeated.count()
    if not n:
        return []
    told = []
    for row in repeated.orderBy("period").limit(examples).collect():
        month = f"{row['period']:%m/%Y}" if row["period"] else "no period"
        used = f", used {row['used_file']}" if resolved and row["period"] else ""
        told.append(f"{month} in {row['files']}{used}")
    return outcome(
        "period_in_several_files",
        scope,
        n,
        f"{n} period(s) in more than one file: {'; '.join(told)}",
        "",
        repeated.withColumn("files", F.array_join("files", " | ")).orderBy("period"),
        Severity.WARN if resolved else Severity.ERROR,
    )


def results_table(spark, results: Sequence[RuleResult]) -> DataFrame:
    """Rule outcomes as a table."""
    rows = [
        (i, r.rule, r.scope, r.severity.name, r.message, r.occurrences)
        for i, r in enumerate(results, 1)
    ]
    schema = T.StructType(
        [
            T.StructField("position", T.IntegerType()),
            T.StructField("rule", T.StringType()),
            T.StructField("scope", T.StringType()),
            T.StructField("severity", T.StringType()),
            T.StructField("message", T.StringType()),
            T.StructField("occurrences", T.LongType()),
        ]
    )
    return local_table(spark, rows, schema)
