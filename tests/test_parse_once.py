"""Text is parsed once, and what is the same for all rows is not worked out for each of them."""

import datetime as dt

from checks import files, flows
from rosterloom.functions import clean_text, month_key
from rosterloom.operators import rows as row_operators
from rosterloom.operators.shape import drop_blank_rows
from rosterloom.plans import flows as flow_plans
from rosterloom.sources import Source
from rosterloom.sources.staged import _fingerprint
from pyspark.sql import functions as F

SPACES = [chr(c) for c in (*range(1, 0x100), 0x1680, *range(0x2000, 0x2030), 0x205F, 0x3000, 0xFEFF)]


def test_a_flow_is_built_from_parsed_columns(spark):
    built = flows.build(spark, "/root/testdata/sf0.001", "hires")
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan


def test_fingerprints_of_rows_do_not_digest_the_settings(spark, contract):
    one = spark.range(1).select(F.lit("p").alias("path"), F.lit(1).alias("modified"), F.lit(2).alias("size"))
    code = _fingerprint(F.col("path"), F.col("modified"), F.col("size"), Source("x/*.csv"), contract, None)
    assert len(code._jc.toString()) < 200
    other = _fingerprint(F.col("path"), F.col("modified"), F.col("size"), Source("x/*.csv", sep=","), contract, None)
    found = one.select(code.alias("a"), other.alias("b")).first()
    assert found["a"] != found["b"] and len(found["a"]) == 64


def test_clean_text_equals_the_pattern_alone(spark):
    texts = [t.format(s) for s in SPACES for t in ("a{0}b", "{0}a", "a {0}b", "{0}", "a{0}{0}b", "é{0}ç")]
    df = spark.createDataFrame([(t,) for t in [*texts, "", " ", None]], "t string")
    plain = F.nullif(F.trim(F.regexp_replace("t", r"(?U)\s+", " ")), F.lit(""))
    assert df.filter(~clean_text(F.col("t")).eqNullSafe(plain)).count() == 0


def test_blank_rows_equal_the_pattern_alone(spark):
    cells = [(a, b, None, d) for a in (*SPACES, "", None) for b in (None, " ", " ") for d in (None, "　", "x")]
    df = spark.createDataFrame(cells, "a string, b string, c string, d string")
    plain = df.filter(F.concat_ws("", "a", "b", "c", "d").rlike(r"(?U)\S"))
    assert sorted(map(str, drop_blank_rows(df).collect())) == sorted(map(str, plain.collect()))


def test_newest_files_are_found_by_hashing_and_without_a_filter_on_parsed_periods(spark, monkeypatch):
    seen = []
    small = row_operators.copy_if_small
    monkeypatch.setattr(row_operators, "copy_if_small", lambda df, *rest: seen.append(df) or small(df, *rest))
    built = flows.build(spark, "/root/testdata/sf0.001", "snapshot")
    plan = seen[0]._jdf.queryExecution().sparkPlan().toString()
    first = [line for line in plan.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in first and "isnotnull(coalesce" not in plan
    assert built.count() > 0


def test_newest_file_of_periods_some_of_which_are_missing(spark):
    cells = [(None, "1"), (None, None), (None, "2"), (1, None), (1, "1"), (1, "2"), (1, "2"), (2, None), (3, "9"), (3, "10")]
    df = spark.createDataFrame(cells, "period int, _file_order string")
    for small_rows in (50_000, 0):
        kept = row_operators.newest_file_per_period(df, small_rows=small_rows)
        want = [(None, "1"), (None, None), (None, "2"), (1, "2"), (1, "2"), (3, "9")]
        assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))


def test_joins_with_the_snapshot_sort_by_person_first_and_shuffle_no_month_keys(spark, monkeypatch):
    asked = {}
    fill = flow_plans.fill_from_reference

    def spy(df, reference, keys, reference_keys, *rest):
        asked["keys"], asked["reference_keys"] = keys, reference_keys
        return fill(df, reference, keys, reference_keys, *rest, small_rows=0)

    monkeypatch.setattr(flow_plans, "fill_from_reference", spy)
    built = flows.build(spark, "/root/testdata/sf0.001", "movements", flows.snapshot_table(spark, "/root/testdata/sf0.001"))
    assert asked == {"keys": ["person_id", "period"], "reference_keys": ["person_id", "period"]}
    plan = built.select("month_key", "cost_center")._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" in plan.split("Join")[0] and "date_format" not in plan.split("Join")[1]
    other = F.concat(F.date_format("period", "dd/MM/yyyy"), F.lit("_"), "person_id")
    assert built.filter(~F.col("month_key").eqNullSafe(other)).count() == 0


def test_month_keys_of_unusual_years(spark):
    days = [-1_000_000, -719_528, -719_529, -719_163, -719_162, -719_162 + 365, 0, 2_932_896, 2_932_897, None]
    df = spark.createDataFrame([(d,) for d in days], "n int").select(F.date_add(F.lit(dt.date(1970, 1, 1)), F.col("n")).alias("d"))
    plain = F.concat(F.date_format("d", "dd/MM/yyyy"), F.lit("_p"))
    assert df.filter(~month_key(F.col("d"), F.lit("p")).eqNullSafe(plain)).count() == 0


def test_published_rows_of_one_label_are_not_sorted_by_it(spark, monkeypatch):
    given = []
    publish = files.publish
    monkeypatch.setattr(files, "publish", lambda *a, parts=None, **k: given.append(parts) or publish(*a, parts=parts, **k))
    got = files.published_label(spark, "/root/testdata/sf0.001")
    assert "MOVIMENTACOES" in [label for label, _ in given[0]]
    assert got.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
