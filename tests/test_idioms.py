"""Labels from a table, fill-down, totals, pivots, changes, contract report: cases the queries do not reach."""

import random

import pytest
from pyspark.sql import functions as F

from rosterloom.contract import ColumnSpec, TableContract
from rosterloom.operators.compare import all_changes, changed_values
from rosterloom.operators.fill import fill_down
from rosterloom.operators.lookup import label_conflicts, label_from_table
from rosterloom.operators.profile import profile_columns
from rosterloom.operators.totals import pivot_attribute, with_totals
from rosterloom.plans import rules


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"small_rows": 0, "hot_min_rows": 2}])
def test_labels_meet_by_code(spark, how):
    df = spark.createDataFrame([(1, " Férias "), (2, "ATIVO"), (3, None), (4, "?"), (5, "ativo"), (6, "outro")], "k int, v string")
    mapping = spark.createDataFrame(
        [("ferias", "b"), ("Férias", "a"), ("ativo", " x "), ("ativo", "X"), (None, "n"), ("", "e"), ("outro", " ")], "value string, label string"
    )
    got = label_from_table(df, "v", mapping, "label", **how)
    assert rows(got, "k", "label") == [(1, "A"), (2, "X"), (3, None), (4, None), (5, "X"), (6, None)]
    assert rows(label_conflicts(mapping)) == [("FERIAS", 2, "A")]
    # a column of the label's name is replaced
    assert got.columns == ["k", "v", "label"] and label_from_table(got, "v", mapping, "label", **how).columns == got.columns


def test_a_map_of_a_million_values(spark):
    mapping = spark.range(1_000_000).select(F.concat(F.lit("Código "), "id").alias("value"), F.concat(F.lit("l"), F.col("id") % 7).alias("label"))
    df = spark.range(0, 2_000_000, 7).select("id", F.concat(F.lit("CODIGO-"), "id").alias("v"))
    got = label_from_table(df, "v", mapping, "label")
    assert got.count() == df.count()
    assert got.where("label is not null").count() == df.where("id < 1000000").count()
    assert got.where("label <> concat('L', id % 7)").count() == 0


def brute_fill(table, groups):
    """Rows are (group, order, value), in the order of the fill."""
    last, out = {}, []
    null_first = lambda v: (v is not None, v or 0)
    order = (lambda r: [null_first(r[k]) for k in (0, 1, 2)]) if groups else (lambda r: [null_first(r[k]) for k in (1, 0, 2)])
    for g, o, v in sorted(table, key=order):
        key = g if groups else None
        last[key] = v if v is not None else last.get(key)
        out.append((g, o, last[key]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("partitions", ["1", "40"])
def test_fill_down_agrees_with_one_row_after_the_other(spark, groups, partitions):
    random_ = random.Random(3)
    table = [
        (random_.choice([None, 1, 1, 1, 2, 3]), random_.choice([None, *range(60)]), random_.choice([None] * 6 + [5, 6, 7])) for _ in range(400)
    ]
    table += [(4, 1000 + k, None) for k in range(200)]  # a group that runs over several ranges
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(table, "g int, o int, v int")
        got = fill_down(df, ["v"], ["o"], groups)
        assert got.columns == df.columns and rows(got) == brute_fill(table, groups)
        assert fill_down(df.limit(0), ["v"], ["o"], groups).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError):
        fill_down(df, ["o"], ["o"])


def test_fill_down_never_gathers_all_rows(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 100 == 0, F.col("id")).alias("v"))
    plan = fill_down(df, ["v"], ["id"])._jdf.queryExecution().toString()
    # the only single partition is that of the ranges, one row each
    assert plan.split("== Physical Plan ==")[1].count("SinglePartition") <= 1


@pytest.mark.parametrize("how", [{}, {"small_rows": 0, "hot_min_rows": 2}])
def test_totals_of_null_keys_and_of_the_whole(spark, how):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), (None, None, 4), ("", None, 8), ("a", "b", 16)], "k string, l string, n int")
    got = with_totals(df, ["k", "l"], {"t": F.sum("n")}, **how)
    assert rows(got, "k", "l", "n", "t") == sorted([("a", None, 1, 3), ("a", None, 2, 3), (None, None, 4, 4), ("", None, 8, 8), ("a", "b", 16, 16)], key=repr)
    assert {r["t"] for r in with_totals(df, [], {"t": F.sum("n")}, **how).collect()} == {31}
    assert with_totals(df.limit(0), ["k"], {"t": F.sum("n")}, **how).count() == 0
    with pytest.raises(ValueError, match="n"):
        with_totals(df, ["k"], {"n": F.sum("n")})


def test_pivot_is_bounded_and_named(spark):
    df = spark.createDataFrame([(1, "x", 2), (1, "x", 3), (1, "y", 5), (2, None, 7), (3, "y", None)], "k int, a string, n int")
    got = pivot_attribute(df, ["k"], "a", "n")
    assert got.columns == ["k", "x", "y"] and rows(got) == [(1, 5, 5), (2, None, None), (3, None, None)]
    assert rows(pivot_attribute(df, ["k"], "a", "n", F.max, values=["x", "z"], prefix="m_")) == [(1, 3, None), (2, None, None), (3, None, None)]
    with pytest.raises(ValueError, match="more than 1"):
        pivot_attribute(df, ["k"], "a", "n", most=1)
    with pytest.raises(ValueError, match="different names"):
        pivot_attribute(df.withColumn("a", F.lit("K")), ["k"], "a", "n")
    assert rows(pivot_attribute(df.withColumn("a", F.lit(None).cast("string")), ["k"], "a", "n")) == [(1,), (2,), (3,)]


def test_changes_of_all_columns_at_once(spark):
    old = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.0), (3, "c", None), (4, "d", 4.0), (5, "e", 5.0), (5, "e", 5.0)], "k int, s string, n double")
    new = spark.createDataFrame([(1, "A", 1.5), (2, "b", 2.5), (3, "c", None), (6, "f", 6.0), (5, "E", 9.0)], "k int, s string, n double")
    got = rows(all_changes(old, new, ["k"]), "column", "k", "old", "new")
    assert got == sorted([("s", 1, "a", "A"), ("s", 2, None, "b"), ("n", 2, "2.0", "2.5")], key=repr)
    for column in ("s", "n"):
        one = rows(changed_values(old, new, ["k"], column).select("k", F.col("old").cast("string"), F.col("new").cast("string")))
        assert one == [r[1:] for r in got if r[0] == column]
    assert rows(all_changes(old, new, ["k"], n=1), "column", "k", "nth") == [("n", 2, 1), ("s", 1, 1)]
    assert "WindowGroupLimit" in all_changes(old, new, ["k"], n=1)._jdf.queryExecution().toString()


def test_examples_of_a_profile_come_from_all_partitions(spark, contract):
    values = [f"{(k * 7919) % 1000:03d}" for k in range(1000)]
    df = spark.createDataFrame([(v, None if k % 2 else v * 2) for k, v in enumerate(values)], "CHAPA string, NOME string").repartition(90)
    got = {r["header"]: r["examples"] for r in profile_columns(df.withColumn("EMPTY", F.lit(None).cast("string")), contract).where("header is not null").collect()}
    assert got["CHAPA"] == ["000", "001", "002"] and got["EMPTY"] == []
    assert got["NOME"] == sorted({v * 2 for k, v in enumerate(values) if not k % 2})[:3]
    assert profile_columns(df.limit(0), contract).where("header = 'CHAPA'").first()["examples"] == []


def test_contract_report_counts_what_would_be_lost(spark):
    contract = TableContract((ColumnSpec("n", "integer"), ColumnSpec("t", "text"), ColumnSpec("d", "date")))
    df = spark.createDataFrame([("1", "a", "x", 1), ("y", "b", None, 1), (None, "c", "z", 1)], "n string, t string, extra string, _own int")
    assert rows(rules.contract_report(df, contract)) == [
        ("d", "missing", "date", None, 0, 0), ("extra", "extra", None, "string", 2, 0), ("n", "type", "bigint", "string", 2, 1),
    ]
    right = spark.createDataFrame([], contract.struct_type())
    assert rules.contract_report(right, contract).count() == 0
