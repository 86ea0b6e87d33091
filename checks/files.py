"""Queries that go through files: folders with mixed headers, staging, CSV, publication, a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import flows, tables
from checks.tables import load
from checks.workbooks import write_workbooks
from rosterloom.functions import parse_date, parse_decimal
from rosterloom.operators.rows import FILE, FILE_ORDER, SHEET
from rosterloom.operators.stack import labelled_parts, stack_labelled
from rosterloom.contract import TableContract
from rosterloom.plans import FLOWS, JobConfig, PEOPLE_CONTRACT, run
from rosterloom.plans.config import PEOPLE_FLOWS, people_flow
from rosterloom.plans.job import read_history
from rosterloom.plans.people import LABELS
from rosterloom.scratch import scratch_path
from rosterloom.sources import (
    PublishOptions,
    Source,
    profile_source,
    publish,
    read_folder,
    read_published,
    read_staged,
    write_csv,
)
from rosterloom.sources.folder import MODIFIED, PATH, SIZE
from rosterloom.streaming import read_arrived, stage_arriving_layouts

#: Two layouts of the customer table: other column order, other headers, one column less.
_LAYOUTS = {
    0: ("cast(c_custkey as string) as CHAPA", "c_mktsegment as Diretoria", "c_name as NOME"),
    1: ("c_name as ` Nome `", "c_acctbal as Lixo", "cast(c_custkey as string) as Chapa"),
}


def _customer_folder(spark: SparkSession, sf_dir: str, kind: str) -> str:
    folder = scratch_path(spark, "customers")
    for parity, columns in _LAYOUTS.items():
        part = load(spark, sf_dir, "customer").filter(F.col("c_custkey") % 2 == parity)
        writer = part.selectExpr(*columns).write
        if kind == "csv":
            writer.csv(f"{folder}/layout {parity}+", sep=";", header=True)
        else:
            writer.parquet(f"{folder}/layout {parity}+")
    return folder


def _people(df: DataFrame) -> DataFrame:
    return df.select("person_id", "full_name", "directorate")


def mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _customer_folder(spark, sf_dir, "csv")
    return _people(read_folder(spark, Source(f"{folder}/**/*.csv"), PEOPLE_CONTRACT))


def parquet_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _customer_folder(spark, sf_dir, "parquet")
    source = Source(f"{folder}/*/*.parquet", format="parquet")
    return _people(read_folder(spark, source, PEOPLE_CONTRACT))


def staged_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read twice: the second time nothing is loaded and the staged rows are served."""
    folder = _customer_folder(spark, sf_dir, "csv")
    source, stage = Source(f"{folder}/**/*.csv"), scratch_path(spark, "staged")
    read_staged(spark, source, PEOPLE_CONTRACT, stage)
    return _people(read_staged(spark, source, PEOPLE_CONTRACT, stage))


def recursive_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A glob that spans folders, with what is known of each row's file."""
    folder = _customer_folder(spark, sf_dir, "csv")
    rows = read_folder(spark, Source(f"{folder}/**"), PEOPLE_CONTRACT)
    return rows.select(
        "person_id",
        F.regexp_extract(PATH, r"layout (\d)\+/[^/]+$", 1).alias("layout"),
        (F.col(FILE) == F.element_at(F.split(PATH, "/"), -1)).alias("named"),
        F.col(FILE_ORDER).endswith(F.col(FILE)).alias("ordered"),
        ((F.col(MODIFIED) > 0) & (F.col(SIZE) > 0)).alias("versioned"),
    )


def staged_after_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged, then one layout is written anew: its old rows are replaced and no others are read."""
    folder = _customer_folder(spark, sf_dir, "csv")
    source, stage = Source(f"{folder}/**/*.csv"), scratch_path(spark, "staged")
    read_staged(spark, source, PEOPLE_CONTRACT, stage).count()
    changed = load(spark, sf_dir, "customer").filter("c_custkey % 2 = 0")
    changed.selectExpr(
        "cast(c_custkey as string) as CHAPA", "concat(c_name, ' novo') as NOME"
    ).write.mode("overwrite").csv(f"{folder}/layout 0+", sep=";", header=True)
    return read_staged(spark, source, PEOPLE_CONTRACT, stage).select("person_id", "full_name")


def workbook_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spreadsheets of 500 customers each, on two sheets, with two lines above the headers."""
    folder = scratch_path(spark, "workbooks")
    customers = load(spark, sf_dir, "customer").selectExpr(
        "concat('clientes ', c_custkey div 500) as book",
        "if(c_custkey % 2 = 0, 'pares', 'outros') as page",
        "cast(c_custkey as string) as Chapa",
        "c_name as ` Nome `",
        "if(c_custkey % 3 = 0, null, c_mktsegment) as Diretoria",
    )
    write_workbooks(customers, ("Chapa", " Nome ", "Diretoria"), folder)
    source = Source(f"{folder}/*.xlsx", format="workbook", sheet="*", header_row=2)
    rows = read_folder(spark, source, PEOPLE_CONTRACT)
    return rows.select("person_id", "full_name", "directorate", FILE, SHEET)


def profiled_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both layouts of the customer folder, header by header, without the contract's missing columns."""
    folder = _customer_folder(spark, sf_dir, "csv")
    found = profile_source(spark, Source(f"{folder}/**/*.csv"), PEOPLE_CONTRACT)
    return found.filter("header is not null").select(
        F.regexp_extract("example", r"^(part)-", 1).alias("file"),
        "header",
        "column",
        "status",
        F.round("fill_ratio", 9).alias("fill_ratio"),
        F.array_join("examples", " | ").alias("examples"),
    )


def arrived_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One layout arrives, then the other one; a third call finds nothing new."""
    source = _customer_folder(spark, sf_dir, "csv")
    arriving = Source(f"{source}/in/*.csv")
    target, checkpoint = scratch_path(spark, "arrived"), scratch_path(spark, "arrivals")
    for parity in (*_LAYOUTS, None):
        if parity is not None:
            part = load(spark, sf_dir, "customer").filter(F.col("c_custkey") % 2 == parity)
            rows = part.selectExpr(*_LAYOUTS[parity])
            rows.write.mode("append").csv(f"{source}/in", sep=";", header=True)
        stage_arriving_layouts(spark, arriving, PEOPLE_CONTRACT, target, checkpoint)
    return _people(read_arrived(spark, PEOPLE_CONTRACT, target))


def per_flow_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV folder that a publication makes for one flow of three labels, beside the whole."""
    out = scratch_path(spark, "per_flow")
    stacked = flows.stack(spark, sf_dir).select("BASE", "full_name", "tax_id", "supplier")
    contract = TableContract(
        tuple(c for c in PEOPLE_CONTRACT.columns if c.name in stacked.columns)
    )
    labels = {"contractors": FLOWS["contractors"].labels, "budget": ("ORCADO",)}
    publish(stacked, contract, "BASE", out, "first", PublishOptions(formats=("csv",)), labels)
    path = f"{out}/csv_per_flow/run_id=first/contractors"
    names = contract.published_names
    return spark.read.csv(path, sep=";", header=True).selectExpr(
        "BASE", *[f"`{names[c]}` as {c}" for c in ("full_name", "tax_id", "supplier")]
    )


def rule_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows shown for the class of contractor that has no label: the first fifty in key order."""
    folder = scratch_path(spark, "samples")
    source_files(spark, sf_dir, folder)
    config = job(folder)
    run(spark, config, flows=["contractors"], reference_date=tables.REFERENCE)
    shown = spark.read.parquet(f"{config.reports}/rule_samples").filter("rule = 'unclassified'")
    cell = lambda name: F.get_json_object("row", f"$.{name}").alias(name)
    return shown.select("rule", "scope", cell("tax_id"), cell("full_name"))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "cast(o_orderdate as date) as day",
        "if(o_orderkey % 3 <> 0, concat('a;\"', o_orderpriority, '\"'), null) as quoted",
    )
    path = scratch_path(spark, "orders_csv")
    write_csv(rows, path, PublishOptions(date_format="dd/MM/yyyy"))
    back = spark.read.csv(path, sep=";", header=True, escape='"')
    return back.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        "o_orderstatus",
        parse_decimal(F.col("o_totalprice")).alias("o_totalprice"),
        parse_date(F.col("day")).alias("day"),
        "quoted",
    )


def _published(spark: SparkSession, sf_dir: str) -> str:
    out = scratch_path(spark, "published")
    options = PublishOptions(formats=("parquet",))
    built = flows.build_all(spark, sf_dir)
    # As in a run: rows that share a label are written without being sorted by it.
    parts = labelled_parts(built, PEOPLE_CONTRACT, "BASE", LABELS)
    stacked = stack_labelled(built, PEOPLE_CONTRACT, "BASE", LABELS)
    publish(stacked, PEOPLE_CONTRACT, "BASE", out, "first", options, parts=parts)
    return out


def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_published(spark, _published(spark, sf_dir), PEOPLE_CONTRACT, "BASE")


def published_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _published(spark, sf_dir)
    return read_published(spark, out, PEOPLE_CONTRACT, "BASE", "MOVIMENTACOES")


def source_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The raw tables of all flows as delimited text, each month of the snapshot in one file."""
    raw = {**flows.RAW, "snapshot": tables.snapshot_stated}
    for name, table in raw.items():
        df = table(spark, sf_dir)
        if name == "snapshot":
            df = df.repartition("COMPETENCIA")
        df.write.csv(f"{folder}/{name}", sep=";", header=True)


def job(folder: str) -> JobConfig:
    changes = {
        "snapshot": {
            "parameters": {**PEOPLE_FLOWS["snapshot"]["parameters"], "drop_duplicates": True}
        }
    }
    names = list(flows.RAW)
    sources = {n: Source(f"{folder}/{n}/*.csv") for n in names}
    return JobConfig(
        output_path=f"{folder}/out",
        flows={n: people_flow(n, sources[n], **changes.get(n, {})) for n in names},
        publish=PublishOptions(formats=("parquet",)),
    )


def consolidated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in, published table out. Forced: one class of contractor has no label, an error."""
    folder = scratch_path(spark, "job")
    source_files(spark, sf_dir, folder)
    config = job(folder)
    run(spark, config, reference_date=tables.REFERENCE, force=True)
    return read_published(spark, config.output_path, PEOPLE_CONTRACT, "BASE")


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an unforced run says: one class of contractor has no label, so nothing is published."""
    folder = scratch_path(spark, "report")
    source_files(spark, sf_dir, folder)
    config = job(folder)
    run(spark, config, reference_date=tables.REFERENCE)
    report = spark.read.parquet(f"{config.reports}/rule_results")
    return report.select("rule", "scope", "severity", "occurrences", "published")


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per label, as a published run leaves them for the next one."""
    folder = scratch_path(spark, "history")
    source_files(spark, sf_dir, folder)
    config = job(folder)
    run(spark, config, reference_date=tables.REFERENCE, force=True)
    return read_history(spark, config)
