"""What each family of sources becomes, and what is checked on it.

Builders return lazy plans; those that complete events from the snapshot first take a sketch of the
events' keys. A flow of one's own is a ``Flow`` added with ``register``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.functions import (
    add_months_to,
    complete_months,
    first_known_period,
    label_from_map,
    month_end,
    month_key,
    month_start,
    previous_month_key,
)
from rosterloom.operators.joins import fill_from_reference, same_month_counterpart
from rosterloom.operators.lookup import label_from_table
from rosterloom.operators.rows import (
    FILE,
    FILE_ORDER,
    latest_per_key,
    newest_file_per_period,
    periods_in_several_files,
)
from rosterloom.operators.stack import ROW_LABEL
from rosterloom.plans import rules
from rosterloom.plans.config import FlowConfig
from rosterloom.plans.people import CONTRACTOR_KEYS, CONTRACTOR_LABELS
from rosterloom.plans.rules import Check, RuleResult

#: Value that classifies a contractor row; read next to the contract columns, never published.
CLASS = "_class"
_PREV_PERIOD = "_prev_period"

# Month keys are text made of period and person. Joining on the two columns they are made of
# finds the same rows, without building and comparing strings. The person first: a sort compares
# the first column by itself, and months are too few to tell most rows apart.
_NATIVE_KEYS = {
    "month_key": ("person_id", "period"),
    "prev_month_key": ("person_id", _PREV_PERIOD),
}

Tables = Mapping[str, DataFrame]
Builder = Callable[[DataFrame, FlowConfig, dt.date, Tables], DataFrame]


@dataclass(frozen=True)
class Built:
    """A flow on its way, as its checks and rules see it."""

    #: Cleaned text under contract names; the same with types, and what the flow made of it (both written).
    raw: DataFrame
    typed: DataFrame
    table: DataFrame
    settings: FlowConfig
    reference_date: dt.date
    sample_rows: int


def _one_key(name: str, built: Built) -> list[RuleResult]:
    return rules.unique_key(built.table, built.settings.key, name, built.sample_rows)


@dataclass(frozen=True)
class Flow:
    """A source family: its builder, its date columns, the flows it reads from, and its hooks."""

    name: str
    build: Builder
    date_columns: tuple[str, ...] = ()
    depends_on: tuple[str, ...] = ()
    labels: tuple[str, ...] = ()
    #: Changes the rows as they were read, before they are cleaned.
    prepare: Callable[[DataFrame, FlowConfig], DataFrame] | None = None
    #: Further conditions on rows, counted in the same pass as the usual ones.
    checks: Callable[[Built], list[Check]] | None = None
    #: What must be unique.
    key_rule: Callable[[str, Built], list[RuleResult]] = _one_key
    #: Rules that need more than counts of rows.
    rules: Callable[[str, Built], list[RuleResult]] | None = None
    #: Flags (``NO_COUNTERPART``) rows that cannot be in the snapshot, given all tables.
    expected_absent: Callable[[DataFrame, Tables], DataFrame] | None = None


def with_snapshot_period(df: DataFrame, default: dt.date | None) -> DataFrame:
    """Period from the column, else from the file name, else ``default``."""
    stated = F.col("period") if "period" in df.columns else None
    file_name = F.col(FILE) if FILE in df.columns else None
    return df.withColumn("period", first_known_period(stated, file_name, default))


def _text(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _date(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("date")


def with_month_key(df: DataFrame) -> DataFrame:
    return df.withColumn("month_key", month_key(F.col("period"), _text(df, "person_id")))


def _joins_natively(config: FlowConfig) -> bool:
    keys, reference_keys = list(config.enrich.keys), list(config.enrich.reference_keys)
    return len(keys) == 1 and keys[0] in _NATIVE_KEYS and (reference_keys or keys) == ["month_key"]


def enrich_from_snapshot(df: DataFrame, config: FlowConfig, tables: Tables) -> DataFrame:
    """Complete an event table from the snapshot, if the flow asks for it and there is one."""
    snapshot = tables.get("snapshot")
    if not config.enrich.active or snapshot is None:
        return df
    keys, reference_keys = list(config.enrich.keys), list(config.enrich.reference_keys)
    ignore = [*config.enrich.ignore, *keys, *reference_keys]
    if _joins_natively(config):
        keys, reference_keys = list(_NATIVE_KEYS[keys[0]]), ["person_id", "period"]
    if not set(keys) <= set(df.columns):
        return df  # reported by the required-column rule
    columns = list(config.enrich.columns) or [c for c in snapshot.columns if c not in ignore]
    return fill_from_reference(
        df, snapshot, keys, reference_keys or None, [c for c in columns if c not in ignore], ignore
    )


def build_snapshot(
    df: DataFrame, config: FlowConfig, reference_date: dt.date, tables: Tables
) -> DataFrame:
    parameters = config.parameters
    default = reference_date.replace(day=1)
    df = with_snapshot_period(
        df, default if parameters.get("default_period_to_reference") else None
    )
    if parameters.get("overlap", "newest") == "newest" and FILE_ORDER in df.columns:
        df = newest_file_per_period(df)
    df = with_month_key(df).withColumn(
        "tenure_months", complete_months(_date(df, "hire_date"), month_end(F.col("period")))
    )
    if parameters.get("drop_duplicates") and config.key:
        # The period last: see ``_NATIVE_KEYS``.
        df = latest_per_key(df, sorted(config.key, key=lambda k: k == "period"), [FILE_ORDER])
    return df


def _event_builder(date_column: str) -> Builder:
    """Event table: the period is the month of the event, gaps come from that month's snapshot."""

    def build(
        df: DataFrame, config: FlowConfig, reference_date: dt.date, tables: Tables
    ) -> DataFrame:
        df = df.withColumn("period", month_start(_date(df, date_column)))
        filled = enrich_from_snapshot(with_month_key(df), config, tables)
        # Made again of the same columns, which such a join leaves alone: the text is then not shuffled.
        return with_month_key(filled) if _joins_natively(config) else filled

    return build


def build_leavers(
    df: DataFrame, config: FlowConfig, reference_date: dt.date, tables: Tables
) -> DataFrame:
    """Leavers are gone from the snapshot of their last month, so the month before is used."""
    df = with_month_key(df.withColumn("period", month_start(_date(df, "leave_date"))))
    df = df.withColumns(
        {
            "prev_month_key": previous_month_key(F.col("period"), _text(df, "person_id")),
            _PREV_PERIOD: add_months_to(F.col("period"), -1),
        }
    )
    df = enrich_from_snapshot(df, config, tables).drop(_PREV_PERIOD)
    return df.withColumn(
        "tenure_months", complete_months(_date(df, "hire_date"), _date(df, "leave_date"))
    )


def build_contractors(
    df: DataFrame, config: FlowConfig, reference_date: dt.date, tables: Tables
) -> DataFrame:
    """One source whose rows carry three labels, told apart by a mapped value.

    The map is the parameter ``classes``, or a Parquet table (value, label) at ``classes_table``,
    which may be of any size.
    """
    df = with_snapshot_period(df, reference_date.replace(day=1))
    table = config.parameters.get("classes_table")
    if CLASS in df.columns and table:
        df = label_from_table(df, CLASS, df.sparkSession.read.parquet(table), ROW_LABEL)
    elif CLASS in df.columns:
        classes = config.parameters.get("classes", {})
        df = df.withColumn(ROW_LABEL, label_from_map(F.col(CLASS), classes))
    else:
        df = df.withColumn(ROW_LABEL, F.lit(None).cast("string"))
    if config.parameters.get("drop_duplicates") and config.key:
        df = latest_per_key(df, config.key, [FILE])
    return df


def build_budget(
    df: DataFrame, config: FlowConfig, reference_date: dt.date, tables: Tables
) -> DataFrame:
    if config.parameters.get("snap_period"):
        df = df.withColumn("period", month_start(F.col("period")))
    return df


def _event_of(other: str, date_column: str) -> Callable[[DataFrame, Tables], DataFrame]:
    """An event of the other kind in the same month explains why the snapshot lacks the person."""

    def flag(df: DataFrame, tables: Tables) -> DataFrame:
        return same_month_counterpart(df, tables.get(other), date_column, rules.NO_COUNTERPART)

    return flag


def _months_in_several_files(name: str, built: Built) -> list[RuleResult]:
    """Months of the snapshot found in several files, before any of them is dropped."""
    parameters = built.settings.parameters
    default = built.reference_date.replace(day=1)
    dated = with_snapshot_period(
        built.typed, default if parameters.get("default_period_to_reference") else None
    )
    repeated = periods_in_several_files(dated.select("period", FILE, FILE_ORDER))
    return rules.overlapping_periods(
        repeated, name, parameters.get("overlap", "newest") == "newest"
    )


def _contractor_labels(built: Built) -> list[Check]:
    hint = (
        "a value has no label in the 'classes' parameter or the 'classes_table'"
        if built.settings.parameters.get("class_header")
        else "set the 'class_header' and 'classes' parameters"
    )
    return [rules.unclassified_check(ROW_LABEL, CONTRACTOR_LABELS, hint)]


def _key_of_each_label(name: str, built: Built) -> list[RuleResult]:
    own = {k.upper(): tuple(v) for k, v in built.settings.parameters.get("keys", {}).items()}
    keys = {**dict.fromkeys(CONTRACTOR_LABELS, built.settings.key), **CONTRACTOR_KEYS, **own}
    return rules.unique_key_per_label(
        built.table,
        ROW_LABEL,
        {label: keys[label] for label in CONTRACTOR_LABELS},
        name,
        built.sample_rows,
    )


FLOWS: dict[str, Flow] = {}


def register(flow: Flow) -> Flow:
    """Make a flow known to runs under its name; a known name is replaced."""
    FLOWS[flow.name] = flow
    return flow


for _flow in (
    Flow(
        "snapshot",
        build_snapshot,
        ("hire_date", "birth_date"),
        rules=_months_in_several_files,
    ),
    Flow(
        "hires",
        _event_builder("hire_date"),
        ("hire_date",),
        ("snapshot",),
        expected_absent=_event_of("leavers", "leave_date"),
    ),
    Flow(
        "leavers",
        build_leavers,
        ("hire_date", "leave_date"),
        ("snapshot",),
        expected_absent=_event_of("hires", "hire_date"),
    ),
    Flow("movements", _event_builder("movement_date"), ("movement_date",), ("snapshot",)),
    Flow(
        "contractors",
        build_contractors,
        ("hire_date", "leave_date"),
        labels=CONTRACTOR_LABELS,
        checks=_contractor_labels,
        key_rule=_key_of_each_label,
    ),
    Flow(
        "budget",
        build_budget,
        ("period",),
        rules=lambda name, built: rules.budget_months(built.table, name),
    ),
):
    register(_flow)


def kept_headers(config: FlowConfig) -> dict[str, str]:
    """Source headers outside the contract that the flow needs."""
    header = config.parameters.get("class_header")
    return {CLASS: header} if header else {}
