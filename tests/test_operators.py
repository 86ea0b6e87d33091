"""Literal cases of the table operators."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from rosterloom.contract import ColumnSpec, ContractError, TableContract
from rosterloom.operators.compare import changed_values, compare_tables, rows_on_one_side
from rosterloom.operators.joins import FOUND, fill_from_reference, same_month_counterpart
from rosterloom.operators.profile import profile_columns
from rosterloom.operators.rows import (
    duplicate_groups,
    duplicate_sample,
    exclude_status,
    latest_per_key,
    newest_file_per_period,
    periods_in_several_files,
)
from rosterloom.operators.shape import (
    apply_types,
    conform,
    drop_empty_rows,
    clean_all_text,
    publish_projection,
    rename_by_alias,
    standardise,
)
from rosterloom.operators.skew import key_statistics, left_join_first
from rosterloom.operators.stack import ROW_LABEL, rows_per_label, stack_labelled


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ------------------------------------------------------------------------------------- shape
def test_rename_drops_unknown_headers_and_keeps_internal(spark, contract):
    df = spark.createDataFrame([("v", "w", "x", "y")], ["_at", "Ramal", "cód. seção ", "nome"])
    headers = [c.name for c in contract.columns if "CODSECAO" in (c.published_name, *c.aliases)]
    known = rename_by_alias(df.withColumnRenamed("cód. seção ", "CodSecao"), contract)
    assert known.columns == ["_at", *headers, "full_name"]
    kept = rename_by_alias(df, contract, keep_extras=True)
    assert kept.columns[:2] == ["_at", "Ramal"] and kept.columns[-1] == "full_name"


def test_rename_first_header_wins(spark, contract):
    df = spark.createDataFrame([("first", "second", "third")], ["matricula", "Chapa", "MATRÍCULA"])
    assert rows(rename_by_alias(df, contract)) == [("first",)]


def test_clean_all_text_leaves_numbers(spark):
    df = spark.createDataFrame([("  x  y ", 1), ("", 2)], "a string, n bigint")
    assert rows(clean_all_text(df), "n") == [("x y", 1), (None, 2)]


def test_apply_types(spark, contract):
    df = spark.createDataFrame(
        [("98765432100", "31-12-1999", "2.000,5"), ("42", "nada", "-3"), (None, None, None)],
        "tax_id string, hire_date string, tenure_months string",
    )
    typed = apply_types(df, contract)
    assert rows(typed, "tax_id") == [
        (None, None, None),
        ("00000000042", None, -3),
        ("98765432100", date(1999, 12, 31), 2000),
    ]
    assert [kind for _, kind in typed.dtypes] == ["string", "date", "bigint"]


def test_apply_types_on_typed_columns(spark):
    contract = TableContract(
        tuple(ColumnSpec(n, k) for n, k in [("t", "text"), ("d", "date"), ("x", "decimal"), ("n", "integer"), ("b", "boolean")])
    )
    df = spark.sql(
        "select 123.0d t, timestamp'2020-01-02 03:04:05' d, 5 x, cast(7 as int) n, true b"
    )
    assert rows(apply_types(df, contract)) == [("123", date(2020, 1, 2), 5.0, 7, True)]


def test_upper_flag(spark):
    contract = TableContract((ColumnSpec("t", "text", upper=True),))
    df = spark.createDataFrame([(" ação ",)], ["t"])
    assert rows(apply_types(df, contract)) == [("AÇÃO",)]


def test_conform_orders_and_adds(spark, contract):
    df = spark.createDataFrame([("a", "x", "1")], ["full_name", "_file", "person_id"])
    out = conform(df, contract)
    assert out.columns == [*contract.names, "_file"]
    assert dict(out.dtypes)["hire_date"] == "date"
    assert conform(df, contract, keep_internal=False).columns == contract.names


def test_publish_projection(spark, contract):
    df = conform(spark.createDataFrame([("a", "x")], ["month_key", "_file"]), contract)
    out = publish_projection(df, contract)
    assert "CHAVE M" in out.columns and "_file" not in out.columns
    assert len(out.columns) == len(contract.names)


def test_drop_empty_rows_ignores_internal(spark):
    df = spark.createDataFrame([(None, None, "f"), ("x", None, "f")], "a string, b string, _f string")
    assert rows(drop_empty_rows(df)) == [("x", None, "f")]
    only_internal = spark.createDataFrame([(None,)], "_f string")
    assert drop_empty_rows(only_internal).count() == 1


def test_standardise(spark, contract):
    df = spark.createDataFrame([(" 7 ", "05/01/2026"), ("  ", "")], ["CHAPA", "DATAADMISSAO"])
    assert rows(standardise(df, contract)) == [("7", date(2026, 1, 5))]


def test_contract_refuses_duplicates():
    with pytest.raises(ContractError, match="duplicate"):
        TableContract((ColumnSpec("a", "text"), ColumnSpec("a", "date")))
    with pytest.raises(ContractError, match="duplicate"):
        TableContract((ColumnSpec("a", "text"), ColumnSpec("b", "text", "a")))
    with pytest.raises(ContractError, match="unknown kind"):
        ColumnSpec("a", "float")
    with pytest.raises(ContractError, match="unknown field"):
        TableContract.from_mappings([{"name": "a", "kind": "text", "size": 3}])


def test_contract_first_claim_of_a_header_wins():
    contract = TableContract.from_mappings(
        [{"name": "a", "kind": "text", "aliases": ["X"]}, {"name": "b", "kind": "text", "aliases": ["x"]}]
    )
    assert contract.header_targets()["X"] == "a"
    assert contract.struct_type()["a"].metadata["aliases"] == ["X"]


# -------------------------------------------------------------------------------------- rows
def test_latest_per_key_with_null_keys_and_ties(spark):
    df = spark.createDataFrame(
        [("1", 1, "a"), ("1", 2, "b"), ("1", 2, "c"), ("2", None, "d"), ("2", 1, "e"), (None, 1, "f"), (None, 2, "g")],
        "k string, o int, v string",
    )
    out = latest_per_key(df, ["k"], ["o", "absent"])
    assert sorted(rows(out), key=str) == sorted([("1", 2, "c"), ("2", 1, "e"), (None, 2, "g")], key=str)
    plan = out._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2  # one candidate per key before the shuffle


def snapshot_files(spark):
    may, april = date(2026, 5, 1), date(2026, 4, 1)
    return spark.createDataFrame(
        [
            (may, "1", "Quadro 2026.xlsx", "0001|Quadro 2026.xlsx"),
            (may, "2", "Quadro 2026.xlsx", "0001|Quadro 2026.xlsx"),
            (april, "1", "Quadro 2026.xlsx", "0001|Quadro 2026.xlsx"),
            (may, "1", "Quadro 05-2026.xlsx", "0002|Quadro 05-2026.xlsx"),
            (None, "9", "Quadro 2026.xlsx", "0001|Quadro 2026.xlsx"),
        ],
        "period date, person_id string, _source_file string, _file_order string",
    )


@pytest.mark.parametrize("small_rows", [100, 0])
def test_newest_file_per_period(spark, small_rows):
    out = newest_file_per_period(snapshot_files(spark), small_rows=small_rows)
    found = {(r["period"], r["person_id"], r["_source_file"]) for r in out.collect()}
    assert found == {
        (date(2026, 4, 1), "1", "Quadro 2026.xlsx"),
        (date(2026, 5, 1), "1", "Quadro 05-2026.xlsx"),
        (None, "9", "Quadro 2026.xlsx"),
    }


def test_periods_in_several_files(spark):
    assert rows(periods_in_several_files(snapshot_files(spark))) == [
        (date(2026, 5, 1), ["Quadro 05-2026.xlsx", "Quadro 2026.xlsx"], "Quadro 05-2026.xlsx")
    ]


def test_exclude_status_keeps_nulls(spark):
    df = spark.createDataFrame([("A",), ("D",), (None,)], "status string")
    assert {r[0] for r in exclude_status(df, "status", ["D"]).collect()} == {"A", None}
    assert exclude_status(df, "status", []).count() == 3


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "z"), (None, "z")], "a int, b string")
    assert sorted(rows(duplicate_groups(df, ["a", "b"])), key=str) == [(1, "x", 2), (None, "z", 2)]
    assert rows(duplicate_sample(df, ["a", "b"], 3)) == [(None, "z"), (None, "z"), (1, "x")]


# ------------------------------------------------------------------------------------- joins
PLACES = [
    ("k", date(2030, 5, 1), "Porto", "blue"),
    ("k", date(2031, 5, 1), "Faro", "green"),
    ("k", date(2029, 5, 1), "Braga", None),
    ("m", date(2031, 5, 1), "Évora", "red"),
]


@pytest.mark.parametrize(("hot_min_rows", "small_rows"), [(10**6, 100), (10**6, 0), (1, 0)])
def test_fill_from_reference(spark, hot_min_rows, small_rows):
    reference = spark.createDataFrame(PLACES, "id string, period date, place string, colour string")
    df = spark.createDataFrame(
        [("m", "here"), ("k", None), ("k", "there"), ("q", None), (None, "nowhere"), (None, None)],
        "id string, place string",
    )
    out = fill_from_reference(
        df,
        reference,
        ["id"],
        ignore=["period"],
        hot_min_rows=hot_min_rows,
        small_rows=small_rows,
    )
    assert out.columns == ["id", "place", "colour", FOUND]
    assert sorted(rows(out), key=str) == sorted(
        [
            ("k", "Faro", "green", True),
            ("k", "there", "green", True),
            ("m", "here", "red", True),
            ("q", None, None, False),
            (None, "nowhere", None, False),
            (None, None, None, False),
        ],
        key=str,
    )


def test_fill_with_other_key_names(spark):
    reference = spark.createDataFrame(
        [(10, "ten", date(2030, 1, 1)), (11, "eleven", date(2030, 1, 1))],
        "here int, word string, period date",
    )
    df = spark.range(10, 13).selectExpr("cast(id as int) as here", "cast(id - 1 as int) as before")
    out = fill_from_reference(df, reference, ["before"], ["here"], ignore=["period"])
    assert rows(out.select("here", "word", FOUND), "here") == [
        (10, None, False),
        (11, "ten", True),
        (12, "eleven", True),
    ]


def test_fill_chosen_columns_and_nothing_to_fill(spark):
    reference = spark.createDataFrame([("1", "x", "y")], ["k", "a", "b"])
    df = spark.createDataFrame([("1",)], ["k"])
    assert fill_from_reference(df, reference, ["k"], columns=["a"], mark=None).columns == ["k", "a"]
    assert fill_from_reference(df, reference, ["k"], columns=["k"]) is df
    with pytest.raises(ValueError):
        fill_from_reference(df, reference, ["k"], ["a", "b"])


def test_hot_keys_take_the_broadcast_branch(spark):
    left = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id"
    )
    right = spark.range(900).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    statistics = key_statistics(left, ["k"], 100)
    assert len(statistics.hot) == 2  # key 7 and the null keys
    assert 300 < statistics.distinct < 370
    expected = sorted(rows(left.join(right, "k", "left")), key=str)

    def same(table):
        return table

    split = left_join_first(left, right, ["k"], same, min_rows=100, small_rows=0)
    plan = split._jdf.queryExecution().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan
    assert sorted(rows(split), key=str) == expected
    few = left_join_first(left, right, ["k"], same, min_rows=100, small_rows=1000)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert sorted(rows(few), key=str) == expected


@pytest.mark.parametrize(("hot_min_rows", "small_rows"), [(10**6, 100), (10**6, 0), (1, 0)])
def test_same_month_counterpart(spark, hot_min_rows, small_rows):
    june = date(2026, 6, 1)
    df = spark.createDataFrame(
        [("1", june, date(2026, 6, 20)), ("2", june, None), ("3", june, date(2026, 5, 2)), ("4", None, None)],
        "person_id string, period date, leave_date date",
    )
    other = spark.createDataFrame([("2", june), ("2", june), ("3", date(2026, 5, 1)), ("4", None)], "person_id string, period date")
    out = same_month_counterpart(df, other, "leave_date", "_flag", hot_min_rows=hot_min_rows, small_rows=small_rows)
    assert rows(out.select("person_id", "_flag"), "person_id") == [("1", True), ("2", True), ("3", False), ("4", False)]
    alone = same_month_counterpart(df, None, "leave_date", "_flag")
    assert rows(alone.select("person_id", "_flag"), "person_id") == [("1", True), ("2", False), ("3", False), ("4", False)]


# ----------------------------------------------------------------------- stack, compare, profile
def test_stack_labelled(spark, contract):
    a = spark.createDataFrame([("1", "x")], ["person_id", "_internal"])
    b = spark.createDataFrame([("V1", "OWN")], ["slot_id", ROW_LABEL])
    out = stack_labelled({"a": a, "b": b}, contract, "BASE", {"a": "A", "b": "B"})
    assert out.columns == ["BASE", *contract.names]
    assert rows(out.select("BASE", "person_id", "slot_id"), "BASE") == [("A", "1", None), ("OWN", None, "V1")]
    assert rows(rows_per_label(out, "BASE"), "BASE") == [("A", 1), ("OWN", 1)]


def test_stack_refuses_wrong_types(spark, contract):
    bad = spark.createDataFrame([("x",)], ["tenure_months"])
    with pytest.raises(ContractError, match="tenure_months"):
        stack_labelled({"contractors": bad}, contract, "BASE", {"contractors": "T"})


def test_compare_tables(spark):
    schema = "k int, a string, b int"
    old = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, None, 3), (4, "w", 4), (5, "d", 5), (5, "d", 5)], schema)
    new = spark.createDataFrame([(1, "x", 1), (2, "z", 2), (3, "n", None), (6, "q", 6), (5, "d", 5)], schema)
    assert {(r[0], r[1]): r[2] for r in compare_tables(old, new, ["k"]).collect()} == {
        ("only_old", None): 1,
        ("only_new", None): 1,
        ("repeated", None): 1,
        ("value", "a"): 2,
        ("value", "b"): 1,
    }
    assert rows(changed_values(old, new, ["k"], "a")) == [(2, "y", "z"), (3, None, "n")]
    assert rows(rows_on_one_side(old, new, ["k"])) == [(4, "old"), (6, "new")]


def test_profile_columns(spark, contract):
    df = spark.createDataFrame(
        [("1", "b", None, "f"), ("2", "a", "z", "f"), ("2", "d", None, "f"), ("4", "c", None, "f")],
        "Chapa string, MATRICULA string, Lixo string, _f string",
    )
    out = {r["header"]: r for r in profile_columns(df, contract).collect() if r["header"]}
    assert out["Chapa"]["column"] == "person_id" and out["Chapa"]["status"] == "matched"
    assert out["Chapa"]["examples"] == ["1", "2", "4"] and out["Chapa"]["approx_distinct"] == 3
    assert out["MATRICULA"]["status"] == "repeated" and out["MATRICULA"]["examples"] == ["a", "b", "c"]
    assert out["Lixo"]["status"] == "unmatched" and out["Lixo"]["fill_ratio"] == 0.25
    missing = profile_columns(df, contract).filter("status = 'missing'")
    assert missing.count() == len(contract.names) - 1
