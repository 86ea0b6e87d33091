"""The consolidated run, end to end on source files."""

import json
import os
from dataclasses import replace
from datetime import date

import pytest
from people_fixture import MONTHS, REFERENCE, job, write_sources
from pyspark.sql import functions as F

from rosterloom.contract import ContractError
from rosterloom.operators.stack import ROW_LABEL
from rosterloom.plans import (
    CheckLimits,
    ConfigError,
    Enrichment,
    FlowConfig,
    JobConfig,
    RunError,
    Severity,
    run,
)
from rosterloom.plans import flows as people_flows
from rosterloom.plans.config import PEOPLE_FLOWS
from rosterloom.plans.job import flow_order, read_history
from rosterloom.plans.rules import Check, outcome
from rosterloom.sources import PublishOptions, Source, read_published

ALL_LABELS = {
    "QUADRO",
    "ADMITIDOS",
    "DEMITIDOS",
    "MOVIMENTACOES",
    "ORCADO",
    "QUADRO-TERCEIROS",
    "ADMITIDOS-TERCEIROS",
    "DEMITIDOS-TERCEIROS",
}


@pytest.fixture
def folder(tmp_path):
    write_sources(tmp_path)
    return tmp_path


def rule(result, name):
    return [r for r in result.results if r.rule == name]


def test_full_run(spark, folder, contract):
    config = job(folder, publish_per_flow=True)
    result = run(spark, config, reference_date=REFERENCE)
    assert result.published and result.severity < Severity.ERROR
    table = read_published(spark, config.output_path, contract, "BASE").cache()
    assert table.columns == ["BASE", *contract.published_names.values()]
    assert {r[0] for r in table.select("BASE").distinct().collect()} == ALL_LABELS

    left = table.filter("BASE = 'DEMITIDOS'")
    hired = table.filter("BASE = 'ADMITIDOS'")
    same_month = left.join(hired.select("matricula", "periodo"), ["matricula", "periodo"])
    assert same_month.count() == 2
    assert same_month.filter("nome is null and centro_custo is null").count() == 2
    others = left.join(same_month.select("matricula"), "matricula", "left_anti")
    assert others.count() == 4
    assert others.filter(
        "nome is null or centro_custo is null or tempo_empresa_meses is null"
    ).isEmpty()
    keys = table.filter("BASE = 'QUADRO'").select(F.col("`CHAVE M`").alias("k"))
    assert left.join(keys, F.col("`CHAVE M`") == F.col("k"), "left_semi").isEmpty()
    assert others.join(keys, F.col("`CHAVE M-1`") == F.col("k"), "left_anti").isEmpty()
    # two blank cost centres: one is filled, the other is of somebody who was in no snapshot
    assert hired.filter("centro_custo is null").count() == 1

    coverage = {r.scope: r for r in rule(result, "reference_coverage")}
    assert set(coverage) == {"hires", "leavers", "movements"}
    assert all(r.severity == Severity.OK and r.occurrences == 0 for r in coverage.values())
    assert "2 row(s) with no snapshot" in coverage["leavers"].message

    contractors = table.filter("BASE like '%-TERCEIROS'").groupBy("BASE").count()
    assert {r[0]: r[1] for r in contractors.collect()} == {
        "QUADRO-TERCEIROS": 24,
        "ADMITIDOS-TERCEIROS": 3,
        "DEMITIDOS-TERCEIROS": 3,
    }
    periods = table.filter("BASE = 'QUADRO'").select("periodo").distinct()
    assert sorted(r[0] for r in periods.collect()) == MONTHS
    assert [r.severity for r in rule(result, "reconciliation")] == [Severity.OK]
    (failure,) = rule(result, "parse_failure")
    assert failure.occurrences == 1 and "birth_date" in failure.message
    cpf = table.filter("BASE = 'QUADRO' and length(cpf) <> 11")
    assert cpf.isEmpty()

    csv = spark.read.csv(f"{config.output_path}/csv/run_id={result.run_id}", sep=";", header=True)
    assert csv.columns == table.columns and csv.count() == table.count()
    per_flow = f"{config.output_path}/csv_per_flow/run_id={result.run_id}"
    assert spark.read.csv(f"{per_flow}/contractors", sep=";", header=True).count() == 30

    history = {r["BASE"]: r["rows"] for r in read_history(spark, config).collect()}
    assert history["QUADRO"] == table.filter("BASE = 'QUADRO'").count()
    report = spark.read.parquet(f"{config.reports}/rule_results")
    assert report.count() == len(result.results)
    sample = spark.read.parquet(f"{config.reports}/rule_samples").filter("rule = 'parse_failure'")
    assert json.loads(sample.first()["row"]) == {"birth_date": "31/02/1990"}

    (summary,) = spark.read.parquet(f"{config.reports}/runs").collect()
    assert summary["published"] and summary["seconds"] > 0 and summary["written"] == result.written
    sizes = {r["flow"]: r["rows"] for r in spark.read.parquet(f"{config.reports}/run_flows").collect()}
    assert sizes == {name: t.count() for name, t in result.tables.items()}

    # an unchanged second run reads nothing anew and finds stable volumes
    staged = f"{config.staging}/snapshot/manifest"
    before = sorted(os.listdir(staged))
    again = run(spark, config, reference_date=REFERENCE, dry_run=True)
    assert sorted(os.listdir(staged)) == before
    assert [r.severity for r in rule(again, "volume_change")] == [Severity.OK]
    assert not again.published and again.stacked.count() == table.count()


def test_error_blocks_publishing_and_force_publishes(spark, folder, contract):
    config = job(folder, {"snapshot": {"key": ("person_id",)}})
    result = run(spark, config, ["snapshot"], REFERENCE)
    assert result.severity == Severity.ERROR and not result.published
    assert not os.path.exists(f"{config.output_path}/parquet")
    (duplicate,) = rule(result, "duplicate_key")
    assert duplicate.sample.count() == 50
    assert spark.read.parquet(f"{config.reports}/rule_results").count() == len(result.results)

    forced = run(spark, config, ["snapshot"], REFERENCE, force=True)
    assert forced.published and read_published(spark, config.output_path, contract, "BASE").count()
    assert read_history(spark, config) is None  # not a complete run

    lenient = job(folder, {"snapshot": {"key": ("person_id",)}}, limits=CheckLimits(block_on_error=False))
    assert run(spark, lenient, ["snapshot"], REFERENCE).published


def test_asking_for_a_flow_brings_the_snapshot(spark, folder):
    config = job(folder)
    assert flow_order(["leavers"], config) == ["snapshot", "leavers"]
    result = run(spark, config, ["leavers"], REFERENCE, dry_run=True)
    assert list(result.tables) == ["snapshot", "leavers"]
    off = job(folder, {"snapshot": {"active": False}})
    assert flow_order(["leavers"], off) == ["leavers"]
    with pytest.raises(RunError, match="unknown"):
        run(spark, config, ["leaver"])
    with pytest.raises(RunError, match="switched off"):
        run(spark, off, ["snapshot"])


def test_published_names_follow_the_contract(spark, folder, contract):
    from rosterloom.contract import TableContract

    renamed = TableContract(
        tuple(replace(c, published="CHAPA") if c.name == "person_id" else c for c in contract.columns)
    )
    config = job(folder, contract=renamed, publish=PublishOptions(formats=("parquet",)))
    run(spark, config, ["budget"], REFERENCE)
    assert "CHAPA" in read_published(spark, config.output_path, renamed, "BASE").columns
    assert not os.path.exists(f"{config.output_path}/csv")


def contractors(spark, folder, **parameters):
    usual = PEOPLE_FLOWS["contractors"]["parameters"]
    config = job(folder, {"contractors": {"parameters": {**usual, **parameters}}})
    return run(spark, config, ["contractors"], REFERENCE, dry_run=True)


def test_contractors_without_classification(spark, folder):
    (r,) = rule(contractors(spark, folder, class_header=None), "unclassified")
    assert r.severity == Severity.ERROR and r.occurrences == 30 and "class_header" in r.message


def test_contractor_value_without_label(spark, folder):
    classes = {"ATIVO": "QUADRO-TERCEIROS", "ADMITIDO": "ADMITIDOS-TERCEIROS"}
    (r,) = rule(contractors(spark, folder, classes=classes), "unclassified")
    assert r.occurrences == 3
    assert {x["_class"] for x in r.sample.collect()} == {"Demitido"}


def test_contractor_labels_from_a_table(spark, folder, tmp_path):
    rows = [("ativo", "QUADRO-TERCEIROS"), ("ADMITIDO", "ADMITIDOS-TERCEIROS"), ("Demitido", "Demitidos-Terceiros"), ("?", "X")]
    path = f"{tmp_path}/classes"
    spark.createDataFrame(rows, "value string, label string").write.parquet(path)
    by_table = contractors(spark, folder, classes={}, classes_table=path)
    assert not [r for r in rule(by_table, "unclassified") if r.severity != Severity.OK]
    by_map = contractors(spark, folder, classes=dict(rows[:3]))
    count = lambda result: sorted(map(tuple, result.stacked.groupBy("BASE").count().collect()))
    assert count(by_table) == count(by_map) and len(count(by_map)) == 3


def test_contractors_who_left_are_keyed_by_period_and_name(spark, folder, monkeypatch):
    usual = people_flows.FLOWS["contractors"]

    def same_name(*args):
        return usual.build(*args).withColumn("full_name", F.lit("Fulano de Tal"))

    monkeypatch.setitem(people_flows.FLOWS, "contractors", replace(usual, build=same_name))
    (r,) = rule(contractors(spark, folder), "duplicate_key")
    assert r.scope == "contractors/DEMITIDOS-TERCEIROS" and r.occurrences == 3


def test_a_flow_that_makes_a_wrong_type_is_refused(spark, folder, monkeypatch):
    usual = people_flows.FLOWS["contractors"]

    def wrong(*args):
        return usual.build(*args).withColumn("tenure_months", F.lit("x"))

    monkeypatch.setitem(people_flows.FLOWS, "contractors", replace(usual, build=wrong))
    with pytest.raises(ContractError, match="tenure_months"):
        contractors(spark, folder)


def build(spark, rows, schema, **parameters):
    df = spark.createDataFrame(rows, schema)
    config = FlowConfig(key=("period", "person_id"), parameters=parameters)
    return people_flows.build_snapshot(df, config, date(2026, 8, 15), {})


def test_snapshot_period_from_column_then_file_name(spark):
    schema = "period date, person_id string, hire_date date, _source_file string, _file_order string"
    rows = [
        (date(2020, 3, 1), "1", date(2020, 1, 1), "Quadro 2020.xlsx", "1"),
        (None, "2", date(2020, 1, 1), "Quadro 05-2026.xlsx", "2"),
        (None, "3", date(2020, 1, 1), "Quadro 2018-2019.xlsx", "3"),
    ]
    out = build(spark, rows, schema).orderBy("person_id").collect()
    assert [r["period"] for r in out] == [date(2020, 3, 1), date(2026, 5, 1), None]
    assert [r["month_key"] for r in out] == ["01/03/2020_1", "01/05/2026_2", None]
    assert [r["tenure_months"] for r in out] == [2, 76, None]
    defaulted = build(spark, rows, schema, default_period_to_reference=True).filter("person_id = '3'")
    assert defaulted.first()["period"] == date(2026, 8, 1)


def test_snapshot_overlap_and_duplicates(spark):
    schema = "period date, person_id string, hire_date date, _source_file string, _file_order string"
    may = date(2026, 5, 1)
    rows = [(may, "1", may, "a.xlsx", "1|a"), (may, "1", may, "b.xlsx", "2|b")]
    assert build(spark, rows, schema).first()["_source_file"] == "b.xlsx"
    assert build(spark, rows, schema, overlap="error").count() == 2
    deduplicated = build(spark, rows, schema, overlap="error", drop_duplicates=True)
    assert [r["_source_file"] for r in deduplicated.collect()] == ["b.xlsx"]


def test_budget_period_is_snapped_only_on_request(spark):
    df = spark.createDataFrame([(date(2026, 5, 31),)], "period date")
    for snap, expected in ((False, date(2026, 5, 31)), (True, date(2026, 5, 1))):
        config = FlowConfig(parameters={"snap_period": snap})
        out = people_flows.build_budget(df, config, REFERENCE, {})
        assert out.first()["period"] == expected


def test_config_checks(tmp_path):
    with pytest.raises(ConfigError, match=r"flows.snapshot.key: column 'chapa'"):
        job(tmp_path, {"snapshot": {"key": ("period", "chapa")}})
    with pytest.raises(ConfigError, match="enrich.columns"):
        job(tmp_path, {"hires": {"enrich": Enrichment(True, columns=("nothing",))}})
    with pytest.raises(ConfigError, match="wrong_field"):
        JobConfig.from_mapping({"output_path": "x", "wrong_field": 1})
    with pytest.raises(ConfigError, match="minimum_coverage"):
        CheckLimits(minimum_coverage=1.5)
    config = JobConfig.from_mapping(
        {
            "output_path": "out",
            "limits": {"statuses_outside_headcount": ["D"]},
            "flows": {
                "budget": {"source": {"paths": "b/*.xlsx", "format": "workbook"}, "label": "B"},
                "hires": {"enrich": {"active": True, "keys": ["month_key"]}},
            },
        }
    )
    assert config.flow("budget").source.paths == ("b/*.xlsx",) and config.label("budget") == "B"
    assert config.label("snapshot") == "QUADRO" and not config.flow("snapshot").active
    assert config.flow("hires").enrich.keys == ("month_key",)
    assert ROW_LABEL not in config.contract.names


def test_a_flow_of_ones_own(spark, folder, contract, monkeypatch):
    """Another family of files: its rows are changed as read, it has its own check, key and rule."""
    def without_tests(df, settings):
        return df.filter("full_name <> 'Teste'")

    def long_names(built):
        return [Check("long_name", "full_name", Severity.WARN, F.length("full_name") > 6, "{n} long name(s)")]

    def even(name, built):
        return outcome("even", name, built.table.count() % 2, "odd number of rows", "even number of rows")

    (folder / "interns").mkdir()
    lines = ["CHAPA;NOME", "1;Rui", "2;Marcelino", "3;Teste", "3;Eva"]
    (folder / "interns" / "all.csv").write_text("\n".join(lines))
    monkeypatch.setitem(
        people_flows.FLOWS,
        "interns",
        people_flows.Flow(
            "interns", lambda df, *_: df, prepare=without_tests, checks=long_names, rules=even
        ),
    )
    config = job(folder)
    config = replace(
        config,
        flows={
            **config.flows,
            "interns": FlowConfig(Source(f"{folder}/interns/*.csv"), key=("person_id",)),
        },
    )
    result = run(spark, config, ["interns"], REFERENCE)
    found = {r.rule: (r.severity, r.occurrences) for r in result.results if r.scope == "interns"}
    assert found["long_name"] == (Severity.WARN, 1) and found["even"] == (Severity.WARN, 1)
    assert found["unique_key"] == (Severity.OK, 0)
    rows = read_published(spark, config.output_path, contract, "BASE").collect()
    assert {(r["BASE"], r["nome"]) for r in rows} == {("INTERNS", n) for n in ("Rui", "Marcelino", "Eva")}


def test_flows_that_read_from_each_other_are_refused(tmp_path, monkeypatch):
    for name, other in (("a", "b"), ("b", "a")):
        monkeypatch.setitem(
            people_flows.FLOWS, name, people_flows.Flow(name, lambda df, *_: df, depends_on=(other,))
        )
    config = JobConfig(output_path="x", flows={"a": FlowConfig(), "b": FlowConfig()})
    with pytest.raises(RunError, match="each other"):
        flow_order(["a"], config)
