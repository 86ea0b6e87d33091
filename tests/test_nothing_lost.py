"""No row is lost or changed without a message."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rosterloom.operators.skew import left_join_first
from rosterloom.sources import Source, read_folder, read_staged
from rosterloom.sources import staged as staged_module
from rosterloom.sources.folder import SourceError, list_files
from rosterloom.sources.publish import plain_number
from rosterloom.streaming import stage_arrivals


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def ids(df):
    return sorted(r["person_id"] for r in df.select("person_id").collect())


def test_arrivals_of_every_path(spark, tmp_path, contract):
    for folder, row in (("a", "1;Ana"), ("b", "2;Bia")):
        put(tmp_path / folder / "x.csv", f"CHAPA;NOME\n{row}\n")
    source = Source((f"{tmp_path}/a", f"{tmp_path}/b"))
    stage_arrivals(spark, source, ["CHAPA", "NOME"], contract, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert ids(spark.read.parquet(f"{tmp_path}/out")) == ["1", "2"]


def test_arrivals_with_other_headers_are_an_error(spark, tmp_path, contract):
    put(tmp_path / "in" / "x.csv", "NOME;CHAPA\nBia;2\n")
    with pytest.raises(StreamingQueryException):
        stage_arrivals(spark, Source(f"{tmp_path}/in"), ["CHAPA", "NOME"], contract, f"{tmp_path}/out", f"{tmp_path}/c")
    with pytest.raises(SourceError):
        stage_arrivals(spark, Source(f"{tmp_path}/in", format="workbook"), ["CHAPA"], contract, "x", "y")


def test_a_file_without_header_line_is_named(spark, tmp_path, contract):
    put(tmp_path / "good.csv", "CHAPA\n1\n")
    put(tmp_path / "empty.csv", "")
    assert ids(read_folder(spark, Source(f"{tmp_path}/*.csv"), contract)) == ["1"]
    put(tmp_path / "blank first.csv", "\nCHAPA\n2\n")
    with pytest.raises(SourceError, match="blank first"):
        read_folder(spark, Source(f"{tmp_path}/*.csv"), contract)


def test_double_stars_stand_anywhere(spark, tmp_path):
    for name in ("a.csv", "x/b.csv", "x/y/c.csv", "x/y/z/d.csv", "x/e.txt"):
        put(tmp_path / name, "CHAPA\n1\n")

    def found(pattern):
        return [r["path"].rpartition("/")[2] for r in list_files(spark, Source(f"{tmp_path}/{pattern}")).collect()]

    assert sorted(found("**")) == ["a.csv", "b.csv", "c.csv", "d.csv", "e.txt"]
    assert sorted(found("**/*.csv")) == ["a.csv", "b.csv", "c.csv", "d.csv"]
    assert found("**/y/*.csv") == ["c.csv"]
    assert sorted(found("x/**/{c,d}.csv")) == ["c.csv", "d.csv"]


def test_a_file_that_changes_while_it_is_staged(spark, tmp_path, contract, monkeypatch):
    put(tmp_path / "in" / "a.csv", "CHAPA\n1\n")
    put(tmp_path / "in" / "b.csv", "CHAPA\n2\n")
    scan = staged_module.scan_headers

    def change_after_listing(*args):
        put(tmp_path / "in" / "b.csv", "CHAPA\n3\n4\n")
        return scan(*args)

    source = Source(f"{tmp_path}/in/*.csv")
    with monkeypatch.context() as patch:
        patch.setattr(staged_module, "scan_headers", change_after_listing)
        with pytest.raises(SourceError, match="b.csv"):
            read_staged(spark, source, contract, f"{tmp_path}/staged")
    assert ids(read_staged(spark, source, contract, f"{tmp_path}/staged")) == ["1", "3", "4"]


@pytest.mark.parametrize(("kind", "values"), [("double", [1.5, 2.0]), ("string", ["abc", "2"]), ("bigint", [2**40, 2])])
def test_keys_are_not_narrowed(spark, kind, values):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(v, "hit") for v in values], f"k {kind}, v string")
    for small in (0, 50_000):
        got = left_join_first(left, right, ["k"], lambda df: df, small_rows=small)
        assert sorted(map(tuple, got.collect())) == [(1, None), (2, "hit")]


def test_numbers_keep_every_digit(spark):
    values = {
        1.2345678901234566e-7: "0.00000012345678901234566", 1.5e-18: "0.0000000000000000015", -9.87654321e-4: "-0.000987654321",
        1.2345678901234567e15: "1234567890123456.8", -1.5e7: "-15000000.0", 1.2345678901234566e25: "12345678901234566" + "0" * 9,
        123456789012.5: "123456789012.5", 1.5e-19: "1.5E-19", 1e38: "1.0E38", 1.25e19: "12500000000000000000.0",
    }
    more = [(k * 7919 + 1) / 3 * 10.0 ** (k % 54 - 17) * (-1) ** k for k in range(500)]
    df = spark.createDataFrame([(v,) for v in [*values, *more]], "x double").select("x", plain_number(F.col("x")).alias("t"))
    got = dict(map(tuple, df.collect()))
    assert {v: got[v] for v in values} == values
    assert all(float(t) == v for v, t in got.items()) and all("E" not in got[v] for v in more if 1e-18 <= abs(v) < 1e38)
    assert spark.createDataFrame([(float("nan"),), (None,), (float("-inf"),)], "x double").select(plain_number(F.col("x"))).count() == 3


def test_numbers_are_written_plainly(spark):
    values = {12345678.9: "12345678.9", 0.0001: "0.0001", 1e22: "1" + "0" * 22, -2.5e-7: "-0.00000025", 3.0: "3.0", 1e7: "10000000.0"}
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", plain_number(F.col("x")).alias("t"))
    assert dict(map(tuple, df.collect())) == values
