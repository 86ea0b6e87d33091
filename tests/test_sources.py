"""Folders of files: listing, headers per file, workbooks, staging, publishing."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from workbooks import write_workbook

from rosterloom.operators.shape import conform
from rosterloom.sources import (
    PublishOptions,
    Source,
    SourceError,
    list_files,
    profile_source,
    publish,
    read_folder,
    read_published,
    read_staged,
    write_csv,
)
from rosterloom.sources.publish import current_run


def text_file(path, *lines, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding=encoding)
    return path


def age(path, seconds):
    st = os.stat(path)
    os.utime(path, (st.st_atime, st.st_mtime - seconds))


def names(files):
    return sorted(r["path"].rsplit("/", 1)[1] for r in files.collect())


def test_listing(spark, tmp_path):
    text_file(tmp_path / "a.csv", "x")
    text_file(tmp_path / "~$a.csv", "lock")
    text_file(tmp_path / "deep" / "er" / "b 05-2026+ç.csv", "x")
    assert names(list_files(spark, Source(f"{tmp_path}/*.csv"))) == ["a.csv"]
    both = Source((f"{tmp_path}/**/*.csv", f"{tmp_path}/*.csv"))
    assert names(list_files(spark, both)) == ["a.csv", "b 05-2026+ç.csv"]


def test_no_file_found(spark, tmp_path):
    with pytest.raises(SourceError, match="nothing"):
        list_files(spark, Source(f"{tmp_path}/nothing*.csv"))
    with pytest.raises(SourceError, match="format"):
        Source("x", format="orc")


def test_headers_are_mapped_per_file(spark, tmp_path, contract):
    text_file(tmp_path / "1.csv", "CHAPA;NOME", "1;A")
    text_file(tmp_path / "2.csv", "Nome ;Chapa", "B;2")
    text_file(tmp_path / "3 05-2026+ç.csv", "﻿Chapa;Lixo;CC", "3;zz;C1")
    df = read_folder(spark, Source(f"{tmp_path}/*.csv"), contract)
    got = sorted(tuple(r) for r in df.select("person_id", "full_name", "cost_center", "_source_file").collect())
    assert got == [
        ("1", "A", None, "1.csv"),
        ("2", "B", None, "2.csv"),
        ("3", None, "C1", "3 05-2026+ç.csv"),
    ]


@pytest.mark.parametrize("few", [1000, 1])
def test_many_files_of_several_layouts(spark, tmp_path, contract, monkeypatch, few):
    """With more files than are named one by one, nothing is read twice and nothing else is read."""
    monkeypatch.setattr("rosterloom.sources.folder.FEW_FILES", few)
    lines = [("CHAPA;NOME", "{0};A{0}"), ("x;Nome;Chapa", "-;A{0};{0}"), ("NOME", "A{0}")]
    for i in range(12):
        header, row = lines[i % 3]
        text_file(tmp_path / "in" / f"{i % 4}" / f"f {i}+.csv", header, row.format(i), *([row.format(100 + i) + ";more;cells"] * (i % 2)))
    text_file(tmp_path / "in" / "0" / "~$f.csv", "CHAPA;NOME", "lock;lock")
    text_file(tmp_path / "in" / "0" / "other.txt", "CHAPA;NOME", "other;other")
    for paths in (f"{tmp_path}/in/*/*.csv", (f"{tmp_path}/in/**/*.csv",)):
        df = read_folder(spark, Source(paths), contract)
        got = sorted(map(tuple, df.select("person_id", "full_name", "_source_file").collect()), key=str)
        want = []
        for i in range(12):
            for n in (i, 100 + i) if i % 2 else (i,):
                want.append((None if i % 3 == 2 else str(n), f"A{n}", f"f {i}+.csv"))
        assert got == sorted(want, key=str)


def test_file_order_follows_modification_time(spark, tmp_path, contract):
    text_file(tmp_path / "new.csv", "CHAPA", "1")
    age(text_file(tmp_path / "old.csv", "CHAPA", "2"), 1000)
    df = read_folder(spark, Source(f"{tmp_path}/*.csv"), contract)
    newest = df.agg(F.max_by("_source_file", "_file_order"), F.min(F.length("_file_order"))).first()
    assert newest[0] == "new.csv" and newest[1] == len("new.csv") + 21


def test_kept_header_outside_the_contract(spark, tmp_path, contract):
    text_file(tmp_path / "1.csv", "NOME;Tipo", "A;Ativo")
    df = read_folder(spark, Source(f"{tmp_path}/*.csv"), contract, keep={"_class": "TIPO"})
    assert df.select("full_name", "_class").first() == ("A", "Ativo")


def test_parquet_folder_is_read_as_text(spark, tmp_path, contract):
    spark.createDataFrame([(1.0, date(2026, 1, 5))], "CHAPA double, DATAADMISSAO date").write.parquet(f"{tmp_path}/a.parquet")
    spark.createDataFrame([("x", "7")], "NOME string, Chapa string").write.parquet(f"{tmp_path}/b.parquet")
    df = read_folder(spark, Source(f"{tmp_path}/*/*.parquet", format="parquet"), contract)
    assert sorted(map(tuple, df.select("person_id", "hire_date", "full_name").collect()), key=str) == [
        ("1", "2026-01-05", None),
        ("7", None, "x"),
    ]


@pytest.mark.parametrize("shared", [False, True])
def test_workbook_cells_are_text(spark, tmp_path, contract, shared):
    write_workbook(
        tmp_path / "a.xlsx",
        {
            "Base": [
                ["report"],
                ["CHAPA", "DATAADMISSAO", "NOME", "VAGA", "SITUACAO"],
                [1, date(2026, 1, 5), " Ana & Bia ", 1.5, True],
                [],
                [2.0, None, "   ", 10, None],
            ]
        },
        shared,
    )
    source = Source(f"{tmp_path}/*.xlsx", format="workbook", header_row=1)
    df = read_folder(spark, source, contract)
    got = df.select("person_id", "hire_date", "full_name", "slot_id", "status").dropna(how="all")
    assert sorted(map(tuple, got.collect())) == [
        ("1", "2026-01-05 00:00:00", " Ana & Bia ", "1.5", "true"),
        ("2", None, None, "10", None),
    ]


def test_workbook_sheets(spark, tmp_path, contract):
    write_workbook(tmp_path / "o.xlsx", {"A": [["CHAPA"], [1]], "B": [["Chapa"], [2], [3]]})

    def people(sheet):
        df = read_folder(spark, Source(f"{tmp_path}/o.xlsx", format="workbook", sheet=sheet), contract)
        return sorted(map(tuple, df.select("person_id", "_source_sheet").collect()))

    assert people(0) == [("1", "A")]
    assert people("B") == people(1) == [("2", "B"), ("3", "B")]
    assert people("*") == [("1", "A"), ("2", "B"), ("3", "B")]


@pytest.mark.parametrize(("few", "small"), [(1000, 1000), (1, 1000), (1, 0)])
def test_staged_copy_is_used_until_a_file_changes(
    spark, tmp_path, contract, monkeypatch, few, small
):
    monkeypatch.setattr("rosterloom.sources.staged.SMALL_ROWS", small)
    monkeypatch.setattr("rosterloom.sources.folder.FEW_FILES", few)
    monkeypatch.setattr("rosterloom.sources.folder.SMALL_ROWS", small)
    first = text_file(tmp_path / "in" / "1.csv", "CHAPA", "1")
    text_file(tmp_path / "in" / "2.csv", "NOME", "B")
    source, stage = Source(f"{tmp_path}/in/*.csv"), f"{tmp_path}/stage"

    def read(**kw):
        df = read_staged(spark, source, contract, stage, **kw)
        return sorted(map(tuple, df.select("person_id", "full_name").collect()), key=str)

    def staged():
        return sorted(os.listdir(f"{stage}/rows"))

    assert read() == [("1", None), (None, "B")]
    before = {p: os.stat(f"{stage}/rows/{p}").st_mtime_ns for p in staged() if "=" in p}
    assert len(before) == 2 and read() == [("1", None), (None, "B")]
    assert before == {p: os.stat(f"{stage}/rows/{p}").st_mtime_ns for p in staged() if "=" in p}

    text_file(first, "CHAPA", "1", "11")
    assert read() == [("1", None), ("11", None), (None, "B")]
    after = {p: os.stat(f"{stage}/rows/{p}").st_mtime_ns for p in staged() if "=" in p}
    assert len(after) == 3 and all(after[p] == t for p, t in before.items())
    assert read(restage=True) == [("1", None), ("11", None), (None, "B")]
    if few > 1:
        plan = read_staged(spark, source, contract, stage)._jdf.queryExecution().toString()
        assert "PartitionFilters: [file_fingerprint" in plan and "Exchange" not in plan


def test_columns_of_removed_files_are_forgotten(spark, tmp_path, contract):
    text_file(tmp_path / "in" / "1.csv", "CHAPA;NOME", "1;A")
    text_file(tmp_path / "in" / "2.csv", "CHAPA", "2")
    whole, one = Source(f"{tmp_path}/in/*.csv"), Source(f"{tmp_path}/in/2.csv")
    assert "full_name" in read_staged(spark, whole, contract, f"{tmp_path}/stage").columns
    df = read_staged(spark, one, contract, f"{tmp_path}/stage")
    assert "full_name" not in df.columns and [r["person_id"] for r in df.collect()] == ["2"]


def test_profile_source(spark, tmp_path, contract):
    text_file(tmp_path / "1.csv", "CHAPA;Lixo;chapa", "1;  ;7", "2;x;8")
    text_file(tmp_path / "2.csv", "NOME", "A")
    text_file(tmp_path / "3.csv", "NOME", "B")
    found = profile_source(spark, Source(f"{tmp_path}/*.csv"), contract).filter("header is not null")
    got = {(r["header"], r["status"], r["fill_ratio"], r["tables"], tuple(r["examples"])) for r in found.collect()}
    assert got == {
        ("CHAPA", "matched", 1.0, 1, ("1", "2")),
        ("Lixo", "unmatched", 0.5, 1, ("x",)),
        ("chapa ", "repeated", 1.0, 1, ("7", "8")),
        ("NOME", "matched", 1.0, 2, ("A", "B")),
    }


def test_csv_locale(spark, tmp_path):
    df = spark.sql("""select 'a;"b"' t, 1234.5d x, date'2026-01-05' d, cast(null as string) n""")
    write_csv(df, f"{tmp_path}/out")
    (part,) = (tmp_path / "out").glob("*.csv")
    assert part.read_text(encoding="utf-8").splitlines() == ["t;x;d;n", '"a;""b""";1234,5;2026-01-05;']
    with pytest.raises(ValueError, match="separator"):
        PublishOptions(sep=",")
    write_csv(df, f"{tmp_path}/dot", PublishOptions(sep=",", decimal_comma=False, date_format="dd/MM/yyyy"))
    (part,) = (tmp_path / "dot").glob("*.csv")
    assert part.read_text(encoding="utf-8").splitlines()[1] == '"a;""b""",1234.5,05/01/2026,'


def test_publication_is_switched_as_a_whole(spark, tmp_path, contract):
    def table(n, label):
        people = spark.range(n).select(F.col("id").cast("string").alias("person_id"))
        return conform(people, contract).select(F.lit(label).alias("BASE"), *contract.names)

    out = f"{tmp_path}/out"
    assert current_run(spark, out) is None
    publish(table(2, "QUADRO").unionByName(table(3, "ORCADO")), contract, "BASE", out, "r1")
    df = read_published(spark, out, contract, "BASE")
    assert df.columns == ["BASE", *contract.published_names.values()] and df.count() == 5
    one = read_published(spark, out, contract, "BASE", "ORCADO")
    assert one.columns == list(contract.published_names.values()) and one.count() == 3
    assert "PartitionFilters: [isnotnull(BASE" in one._jdf.queryExecution().toString()

    # a second run that dies before its log entry is not seen
    table(9, "QUADRO").write.parquet(f"{out}/parquet/run_id=r2")
    assert read_published(spark, out, contract, "BASE").count() == 5
    publish(table(1, "QUADRO"), contract, "BASE", out, "r3", PublishOptions(formats=("parquet",)))
    assert current_run(spark, out) == "r3"
    assert read_published(spark, out, contract, "BASE", ["QUADRO"]).count() == 1
