"""Every operator as a query over the driver tables, next to the SQL that must agree with it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import files, flows, sql
from checks.tables import load, orders, snapshot_stated
from rosterloom.contract import ColumnSpec, TableContract
from rosterloom.functions import (
    clean_text,
    complete_months,
    first_known_period,
    label_from_map,
    month_end,
    month_key,
    month_start,
    parse_boolean,
    parse_date,
    parse_decimal,
    parse_integer,
    period_from_file_name,
    previous_month_key,
    strip_accents,
    zero_pad,
)
from rosterloom.functions.text import ACCENTED, PLAIN
from rosterloom.operators.compare import (
    all_changes,
    changed_values,
    compare_tables,
    rows_on_one_side,
)
from rosterloom.operators.fill import fill_down
from rosterloom.operators.joins import FOUND, fill_from_reference, same_month_counterpart
from rosterloom.operators.lookup import label_conflicts, label_from_table
from rosterloom.operators.profile import profile_columns
from rosterloom.operators.rows import (
    duplicate_groups,
    duplicate_sample,
    exclude_status,
    latest_per_key,
    newest_file_per_period,
    periods_in_several_files,
)
from rosterloom.operators.skew import spread
from rosterloom.operators.shape import (
    apply_types,
    clean_all_text,
    conform,
    drop_blank_rows,
    drop_empty_rows,
    publish_projection,
    rename_by_alias,
    standardise,
)
from rosterloom.operators.totals import pivot_attribute, with_totals
from rosterloom.plans import PEOPLE_CONTRACT, rules

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query, with its SQL where there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLE[name] = oracle
        return function

    return register


# ------------------------------------------------------------------------ scalar functions
@query(
    "clean_text",
    r"""SELECT doc_id, nullif(trim(regexp_replace(chr(9) || '  ' || text || chr(160) || ' ',
        '[\s\p{Z}]+', ' ', 'g')), '') AS text,
      nullif(trim(regexp_replace(repeat(' ', (doc_id % 3)::INTEGER), '[\s\p{Z}]+', ' ', 'g')), '')
        AS blank FROM documents""",
)
def _(spark, sf):
    messy = F.concat(F.lit("\t  "), F.col("text"), F.lit("  "))
    blank = F.repeat(F.lit(" "), (F.col("doc_id") % 3).cast("int"))
    return load(spark, sf, "documents").select(
        "doc_id", clean_text(messy).alias("text"), clean_text(blank).alias("blank")
    )


@query(
    "strip_accents",
    f"SELECT doc_id, translate(text, '{ACCENTED}', '{PLAIN}') AS text FROM documents",
)
def _(spark, sf):
    return load(spark, sf, "documents").select("doc_id", strip_accents(F.col("text")).alias("text"))


@query(
    "parse_date_formats",
    f"WITH {sql.ORDERS} SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 8 THEN d END AS parsed FROM o",
)
def _(spark, sf):
    spelled = F.expr(
        """case o_orderkey % 10
             when 0 then date_format(d, 'yyyy-MM-dd HH:mm:ss') when 1 then date_format(d, 'yyyy-MM-dd')
             when 2 then date_format(d, 'dd/MM/yyyy') when 3 then date_format(d, 'd/M/yyyy HH:mm:ss')
             when 4 then date_format(d, 'dd/MM/yyyy HH:mm') when 5 then date_format(d, 'dd-MM-yyyy')
             when 6 then date_format(d, 'yyyyMMdd')
             when 7 then concat(cast(datediff(d, date'1899-12-30') as string), '.0')
             when 8 then concat('31/02/', date_format(d, 'yyyy')) else 'lixo' end"""
    )
    return orders(spark, sf).select("o_orderkey", parse_date(spelled).alias("parsed"))


@query(
    "parse_decimal_br",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN o_totalprice END AS parsed FROM orders",
)
def _(spark, sf):
    spelled = F.expr(
        """case o_orderkey % 4
             when 0 then concat('R$ ', translate(format_number(o_totalprice, 2), ',.', '.,'))
             when 1 then cast(cast(o_totalprice as decimal(18,2)) as string)
             when 2 then concat(cast(cast(o_totalprice as decimal(18,2)) as string), ' %')
             else concat('abc', cast(o_orderkey as string)) end"""
    )
    return load(spark, sf, "orders").select("o_orderkey", parse_decimal(spelled).alias("parsed"))


@query(
    "parse_integer",
    """SELECT l_orderkey, l_linenumber, round_even(l_extendedprice, 0)::BIGINT AS price,
      l_quantity::BIGINT AS quantity FROM lineitem""",
)
def _(spark, sf):
    price = F.translate(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), ".", ",")
    quantity = F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(",0"))
    return spread(load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"
    )).select(
        "l_orderkey",
        "l_linenumber",
        parse_integer(price).alias("price"),
        parse_integer(quantity).alias("quantity"),
    )


@query(
    "parse_boolean",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS parsed
       FROM orders""",
)
def _(spark, sf):
    word = F.expr("case o_orderstatus when 'O' then ' Sim ' when 'F' then 'NÃO' else 'talvez' end")
    return load(spark, sf, "orders").select("o_orderkey", parse_boolean(word).alias("parsed"))


def _pad_sql(text: str, width: int) -> str:
    return f"CASE WHEN length({text}) >= {width} THEN {text} ELSE lpad({text}, {width}, '0') END"


@query(
    "zero_pad_id",
    f"""SELECT c_custkey, {_pad_sql("c_custkey::VARCHAR", 11)} AS wide,
      {_pad_sql("c_custkey::VARCHAR", 3)} AS narrow,
      CASE WHEN c_custkey < 750 THEN '-' || lpad((750 - c_custkey)::VARCHAR, 6, '0')
        ELSE {_pad_sql("(c_custkey - 750)::VARCHAR", 7)} END AS signed FROM customer""",
)
def _(spark, sf):
    key = F.col("c_custkey").cast("string")
    return load(spark, sf, "customer").select(
        "c_custkey",
        zero_pad(key, 11).alias("wide"),
        zero_pad(key, 3).alias("narrow"),
        zero_pad((F.col("c_custkey") - 750).cast("string"), 7).alias("signed"),
    )


@query(
    "month_bounds",
    f"WITH {sql.ORDERS} SELECT o_orderkey, m AS first_day, last_day(d) AS final_day FROM o",
)
def _(spark, sf):
    return orders(spark, sf).select(
        "o_orderkey",
        month_start(F.col("d")).alias("first_day"),
        month_end(F.col("d")).alias("final_day"),
    )


_PERSON = "CASE WHEN o_orderstatus <> 'P' THEN o_custkey::VARCHAR END"


@query(
    "month_key",
    f"""WITH {sql.ORDERS} SELECT o_orderkey,
      strftime(m, '%d/%m/%Y') || '_' || {_PERSON} AS month_key FROM o""",
)
def _(spark, sf):
    person = F.expr("if(o_orderstatus <> 'P', cast(o_custkey as string), null)")
    return orders(spark, sf).select("o_orderkey", month_key(F.col("m"), person).alias("month_key"))


@query(
    "prev_month_key",
    f"""WITH {sql.ORDERS} SELECT o_orderkey,
      strftime((m - INTERVAL 1 MONTH)::DATE, '%d/%m/%Y') || '_' || o_custkey AS prev_month_key FROM o""",
)
def _(spark, sf):
    person = F.col("o_custkey").cast("string")
    return orders(spark, sf).select(
        "o_orderkey", previous_month_key(F.col("m"), person).alias("prev_month_key")
    )


@query(
    "period_from_file_name",
    f"""WITH {sql.ORDERS} SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 2 THEN m END AS from_name,
      CASE WHEN o_orderkey % 3 = 0 THEN d WHEN o_orderkey % 5 < 2 THEN m
        ELSE DATE '2002-03-01' END AS period FROM o""",
)
def _(spark, sf):
    name = F.expr(
        """case o_orderkey % 5 when 0 then concat('Quadro ', date_format(d, 'MM-yyyy'), '.xlsx')
             when 1 then concat('quadro ', date_format(d, 'MM-yyyy'), ' (1).xlsx')
             when 2 then concat('Quadro ', date_format(d, 'yyyy'), '.xlsx')
             when 3 then concat('Quadro 13-', date_format(d, 'yyyy'), '.xlsx')
             else concat('Quadro ', date_format(d, 'yyyy-yyyy'), '.xlsx') end"""
    )
    stated = F.expr("if(o_orderkey % 3 = 0, d, null)")
    return orders(spark, sf).select(
        "o_orderkey",
        period_from_file_name(name).alias("from_name"),
        first_known_period(stated, name, dt.date(2002, 3, 1)).alias("period"),
    )


@query(
    "tenure_months",
    f"""WITH {sql.ORDERS} SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS shipped,
      {sql.months("o.d", "l_shipdate::DATE")} AS tenure_months
      FROM lineitem JOIN o ON o_orderkey = l_orderkey""",
)
def _(spark, sf):
    items = load(spark, sf, "lineitem").withColumn("shipped", F.col("l_shipdate").cast("date"))
    return items.join(
        orders(spark, sf), items["l_orderkey"] == F.col("o_orderkey")
    ).select(
        "l_orderkey",
        "l_linenumber",
        "shipped",
        complete_months(F.col("d"), F.col("shipped")).alias("tenure_months"),
    )


@query(
    "classify_by_map",
    """SELECT s_suppkey, CASE s_nationkey % 4 WHEN 0 THEN 'QUADRO-TERCEIROS'
      WHEN 1 THEN 'ADMITIDOS-TERCEIROS' WHEN 2 THEN 'DEMITIDOS-TERCEIROS' END AS label FROM supplier""",
)
def _(spark, sf):
    word = F.expr(
        "case s_nationkey % 4 when 0 then ' Ativo ' when 1 then 'ADMITIDO'"
        " when 2 then 'demitido' else 'Férias' end"
    )
    labels = {
        "Ativo": "Quadro-Terceiros",
        "ADMITIDO": "ADMITIDOS-TERCEIROS",
        "Demitido": "DEMITIDOS-TERCEIROS",
    }
    return load(spark, sf, "supplier").select(
        "s_suppkey", label_from_map(word, labels).alias("label")
    )


@query(
    "value_codes",
    """SELECT s_name AS full_name, CASE s_nationkey % 4 WHEN 0 THEN 'ATIVO' WHEN 1 THEN 'ADMITIDO'
      WHEN 2 THEN 'DEMITIDO' ELSE 'FERIAS' END AS code FROM supplier""",
)
def _(spark, sf):
    return flows.class_codes(spark, sf)


# ------------------------------------------------------------------------- schema and rows
def _odd_headers(spark, sf) -> DataFrame:
    return load(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) as Chapa",
        "c_mktsegment as Diretoria",
        "c_name as ` Nome `",
        "cast(c_nationkey as string) as MATRICULA",
        "c_acctbal as Saldo",
        "'f' as _source_file",
    )


@query(
    "rename_by_alias",
    """SELECT c_custkey::VARCHAR AS person_id, c_mktsegment AS directorate, c_name AS full_name,
      'f' AS _source_file FROM customer""",
)
def _(spark, sf):
    return rename_by_alias(_odd_headers(spark, sf), PEOPLE_CONTRACT)


@query(
    "rename_keeping_extras",
    """SELECT c_custkey::VARCHAR AS person_id, c_mktsegment AS directorate, c_name AS full_name,
      c_nationkey::VARCHAR AS "MATRICULA", c_acctbal AS "Saldo", 'f' AS _source_file FROM customer""",
)
def _(spark, sf):
    return rename_by_alias(_odd_headers(spark, sf), PEOPLE_CONTRACT, keep_extras=True)


_BLANKED = [
    "if(c_custkey % 5 = 0, ' \\t', c_name) as full_name",
    "if(c_custkey % 5 = 0 or c_custkey % 2 = 0, null, c_mktsegment) as directorate",
    "cast(c_custkey as string) as _row",
]
_NOT_BLANK = """SELECT c_name AS full_name,
  CASE WHEN c_custkey % 2 <> 0 THEN c_mktsegment END AS directorate, c_custkey::VARCHAR AS _row
  FROM customer WHERE c_custkey % 5 <> 0"""


@query("drop_empty_rows", _NOT_BLANK)
def _(spark, sf):
    return drop_empty_rows(clean_all_text(load(spark, sf, "customer").selectExpr(*_BLANKED)))


@query("drop_blank_rows", _NOT_BLANK)
def _(spark, sf):
    return clean_all_text(drop_blank_rows(load(spark, sf, "customer").selectExpr(*_BLANKED)))


_TYPED = TableContract(
    (
        ColumnSpec("code", "text", pad=11),
        ColumnSpec("shout", "text", upper=True),
        ColumnSpec("day", "date"),
        ColumnSpec("amount", "decimal"),
        ColumnSpec("count", "integer"),
        ColumnSpec("flag", "boolean"),
        ColumnSpec("whole", "text"),
        ColumnSpec("moment", "date"),
    )
)


@query(
    "apply_types",
    """SELECT o_orderkey, lpad(o_custkey::VARCHAR, 11, '0') AS code, upper(o_orderpriority) AS shout,
      o_orderdate::DATE AS day, o_totalprice AS amount, o_custkey::BIGINT AS "count",
      o_orderstatus = 'O' AS flag, o_orderkey::VARCHAR AS whole, o_orderdate::DATE AS moment
      FROM orders""",
)
def _(spark, sf):
    raw = spread(orders(spark, sf)).selectExpr(
        "o_orderkey",
        "cast(o_custkey as string) as code",
        "concat(' ', lower(o_orderpriority)) as shout",
        "date_format(d, 'dd/MM/yyyy') as day",
        "translate(format_number(o_totalprice, 2), ',.', '.,') as amount",
        "concat(cast(o_custkey as string), ',0') as count",
        "if(o_orderstatus = 'O', 'x', 'Não') as flag",
        "cast(o_orderkey as double) as whole",
        "o_orderdate as moment",
    )
    return apply_types(raw, _TYPED)


_CUSTOMER_COLUMNS = {"person_id": "c_custkey::VARCHAR", "full_name": "c_name"}


def _two_columns(spark, sf) -> DataFrame:
    return load(spark, sf, "customer").selectExpr(
        "c_name as full_name", "'f' as _source_file", "cast(c_custkey as string) as person_id"
    )


@query(
    "conform_contract",
    f"SELECT {sql.contract_columns(_CUSTOMER_COLUMNS)}, 'f' AS _source_file FROM customer",
)
def _(spark, sf):
    return conform(_two_columns(spark, sf), PEOPLE_CONTRACT)


@query(
    "publish_projection",
    f"SELECT {sql.contract_columns(_CUSTOMER_COLUMNS, published=True)} FROM customer",
)
def _(spark, sf):
    return publish_projection(conform(_two_columns(spark, sf), PEOPLE_CONTRACT), PEOPLE_CONTRACT)


@query(
    "standard_chain",
    f"""WITH {sql.ORDERS} SELECT m AS period, o_custkey::VARCHAR AS person_id,
      'Pessoa ' || o_custkey AS full_name, lpad((o_custkey * 7919)::VARCHAR, 11, '0') AS tax_id,
      (DATE '1990-01-01' + (o_custkey % 1500)::INTEGER)::DATE AS hire_date,
      'CC' || (o_custkey % 50) AS cost_center, o_orderstatus AS status,
      o_orderpriority AS job_title,
      CASE WHEN o_orderkey % 5 <> 0 THEN 'Gestor ' || (o_orderkey % 7) END AS manager FROM o""",
)
def _(spark, sf):
    return standardise(snapshot_stated(spark, sf), PEOPLE_CONTRACT)


@query(
    "latest_per_key",
    f"""WITH {sql.ORDERS}, r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, m
        ORDER BY d DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn FROM o)
      SELECT o_custkey, m, d, o_orderkey, o_totalprice FROM r WHERE rn = 1""",
)
def _(spark, sf):
    rows = orders(spark, sf).select("o_custkey", "m", "d", "o_orderkey", "o_totalprice")
    return latest_per_key(rows, ["o_custkey", "m"], ["d"], tie_breakers=["o_orderkey"])


_FILES = f"""{sql.ORDERS}, f AS (SELECT o_orderkey,
    CASE WHEN o_orderkey % 11 <> 0 THEN m END AS period,
    CASE WHEN o_orderkey % 3 = 0 THEN 'b ' || strftime(m, '%m-%Y') || '.xlsx'
      ELSE 'a ' || year(m) || '.xlsx' END AS _source_file,
    CASE WHEN o_orderkey % 3 = 0 THEN '2' ELSE '1' END AS _file_order FROM o)"""


def _in_files(spark, sf) -> DataFrame:
    return orders(spark, sf).selectExpr(
        "o_orderkey",
        "if(o_orderkey % 11 <> 0, m, null) as period",
        "if(o_orderkey % 3 = 0, concat('b ', date_format(m, 'MM-yyyy'), '.xlsx'),"
        " concat('a ', date_format(m, 'yyyy'), '.xlsx')) as _source_file",
        "if(o_orderkey % 3 = 0, '2', '1') as _file_order",
    )


@query(
    "newest_file_per_period",
    f"""WITH {_FILES}, n AS (SELECT *, max(_file_order) OVER (PARTITION BY period) AS newest FROM f)
      SELECT o_orderkey, period, _source_file, _file_order FROM n
      WHERE period IS NULL OR _file_order = newest""",
)
def _(spark, sf):
    return newest_file_per_period(_in_files(spark, sf))


@query(
    "overlapping_periods",
    f"""WITH {_FILES}, g AS (SELECT period, list_sort(list(DISTINCT _source_file)) AS names,
        max(_file_order || _source_file) AS newest FROM f GROUP BY period)
      SELECT period, array_to_string(names, ' | ') AS files, newest[2:] AS used_file
      FROM g WHERE len(names) > 1""",
)
def _(spark, sf):
    repeated = periods_in_several_files(_in_files(spark, sf))
    return repeated.withColumn("files", F.array_join("files", " | "))


@query(
    "rule_overlapping_periods",
    f"""WITH {_FILES}, g AS (SELECT period FROM f GROUP BY period HAVING count(DISTINCT _source_file) > 1)
      SELECT 'period_in_several_files' AS rule, 'snapshot' AS scope,
        unnest(['WARN', 'ERROR']) AS severity, count(*) AS occurrences FROM g""",
)
def _(spark, sf):
    repeated = periods_in_several_files(_in_files(spark, sf))
    found = [r for used in (True, False) for r in rules.overlapping_periods(repeated, "snapshot", used)]
    return rules.results_table(spark, found).select("rule", "scope", "severity", "occurrences")


@query(
    "exclude_status",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status
       FROM orders WHERE o_orderstatus <> 'F'""",
)
def _(spark, sf):
    rows = load(spark, sf, "orders").selectExpr(
        "o_orderkey", "if(o_orderstatus <> 'P', o_orderstatus, null) as status"
    )
    return exclude_status(rows, "status", ["F", "X"])


@query(
    "duplicate_groups",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark, sf):
    return duplicate_groups(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_sample",
    """WITH d AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
      SELECT l_orderkey, l_linenumber FROM lineitem JOIN d USING (l_orderkey, l_linenumber)
      ORDER BY l_orderkey, l_linenumber LIMIT 50""",
)
def _(spark, sf):
    keys = ["l_orderkey", "l_linenumber"]
    return duplicate_sample(load(spark, sf, "lineitem").select(*keys), keys, 50)


# ------------------------------------------------------------------------------------ joins
_SNAP = f"""{sql.ORDERS}, r AS (SELECT o_custkey AS person_id, m AS period,
    o_orderpriority AS job_title, o_orderstatus AS status, row_number() OVER (
      PARTITION BY o_custkey, m ORDER BY o_orderpriority DESC, o_orderstatus DESC) AS rn FROM o),
  snap AS (SELECT * EXCLUDE (rn) FROM r WHERE rn = 1)"""


def _snapshot(spark, sf) -> DataFrame:
    return orders(spark, sf).selectExpr(
        "o_custkey as person_id", "m as period", "o_orderpriority as job_title",
        "o_orderstatus as status",
    )


@query(
    "enrich_same_month",
    f"""WITH {_SNAP}, e AS (SELECT l_orderkey, l_linenumber, l_suppkey AS person_id,
        date_trunc('month', l_shipdate)::DATE AS period,
        CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS job_title FROM lineitem)
      SELECT l_orderkey, l_linenumber, e.person_id, e.period,
        coalesce(e.job_title, s.job_title) AS job_title, s.status,
        s.person_id IS NOT NULL AS {FOUND}
      FROM e LEFT JOIN snap s ON s.person_id = e.person_id AND s.period = e.period""",
)
def _(spark, sf):
    shipped = load(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey as person_id",
        "trunc(cast(l_shipdate as date), 'MM') as period",
        "if(l_returnflag <> 'N', l_returnflag, null) as job_title",
    )
    return fill_from_reference(shipped, _snapshot(spark, sf), ["person_id", "period"])


@query(
    "enrich_previous_month",
    f"""WITH {_SNAP}, e AS (SELECT o_custkey AS person_id, (max(d) + INTERVAL 1 MONTH)::DATE AS leave_date,
        date_trunc('month', max(d))::DATE AS previous FROM o GROUP BY o_custkey)
      SELECT e.person_id, e.leave_date, e.previous, s.job_title, s.status,
        s.person_id IS NOT NULL AS {FOUND}
      FROM e LEFT JOIN snap s ON s.person_id = e.person_id AND s.period = e.previous""",
)
def _(spark, sf):
    last = orders(spark, sf).groupBy("o_custkey").agg(F.max("d").alias("last"))
    leavers = last.selectExpr("o_custkey as person_id", "add_months(last, 1) as leave_date")
    previous = F.add_months(month_start(F.col("leave_date")), -1)
    return fill_from_reference(
        leavers.withColumn("previous", previous),
        _snapshot(spark, sf),
        ["person_id", "previous"],
        ["person_id", "period"],
    )


@query(
    "same_month_counterpart",
    f"""WITH {sql.ORDERS}, h AS (SELECT o_custkey AS person_id, min(d) AS hire_date FROM o GROUP BY o_custkey),
      l AS (SELECT o_custkey AS person_id, max(d) AS leave_date FROM o GROUP BY o_custkey)
      SELECT person_id, hire_date, date_trunc('month', hire_date)::DATE AS period,
        EXISTS (SELECT 1 FROM l WHERE l.person_id = h.person_id
          AND date_trunc('month', leave_date) = date_trunc('month', hire_date)) AS same_month FROM h""",
)
def _(spark, sf):
    spans = orders(spark, sf).groupBy("o_custkey").agg(F.min("d").alias("a"), F.max("d").alias("b"))
    hires = spans.selectExpr(
        "o_custkey as person_id", "a as hire_date", "trunc(a, 'MM') as period"
    )
    leavers = spans.selectExpr("o_custkey as person_id", "trunc(b, 'MM') as period")
    return same_month_counterpart(hires, leavers, "leave_date", "same_month")


# ------------------------------------------------------------------------------------ flows
_SHORT = {
    "snapshot": "snap",
    "hires": "hire",
    "leavers": "leave",
    "movements": "move",
    "contractors": "terc",
    "budget": "budg",
}
for _name in _SHORT:
    query(f"{_name}_build", sql.flow(_SHORT[_name]))(flows.flow_query(_name))

query("stack_labelled", sql.stacked())(flows.stack)
query(
    "rows_per_label",
    f'SELECT "BASE", count(*) AS rows FROM ({sql.stacked()}) GROUP BY "BASE"',
)(flows.label_counts)


# ------------------------------------------------------------------------------------ rules
def _counted(*entries: tuple[str, str, str, str], table: str) -> str:
    """One row per (rule, subject, severity, SQL condition)."""
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{subject}' AS subject, '{severity}' AS severity,"
        f" count(*) FILTER ({condition}) AS occurrences, count(*) AS rows FROM {table}"
        for rule, subject, severity, condition in entries
    )


def _gappy(spark, sf) -> DataFrame:
    return orders(spark, sf).selectExpr(
        "if(o_orderkey % 13 = 0, null, cast(o_custkey as string)) as person_id",
        "if(o_orderkey % 17 = 0, d, m) as period",
        "if(o_orderkey % 19 = 0, date'1900-01-01', if(o_orderkey % 23 = 0, date'2090-01-01', d))"
        " as hire_date",
    )


_REF = dt.date(2001, 12, 31)


@query(
    "rule_required",
    _counted(
        ("no_rows", "", "ERROR", "FALSE"),
        ("required_null", "person_id", "ERROR", "o_orderkey % 13 = 0"),
        ("required_null", "period", "ERROR", "FALSE"),
        table="orders",
    ),
)
def _(spark, sf):
    df = _gappy(spark, sf)
    checks = [rules.no_rows_check(), *rules.required_checks(df, ["person_id", "period", "absent"])]
    return rules.count_checks(df, checks)


@query(
    "rule_period_day_one",
    _counted(
        (
            "period_not_month_start",
            "period",
            "ERROR",
            "o_orderkey % 17 = 0 AND day(o_orderdate) <> 1",
        ),
        table="orders",
    ),
)
def _(spark, sf):
    df = _gappy(spark, sf)
    return rules.count_checks(df, rules.period_start_check(df))


@query(
    "rule_plausible_dates",
    _counted(
        ("implausible_date", "hire_date", "WARN", "o_orderkey % 19 = 0 OR o_orderkey % 23 = 0"),
        ("implausible_date", "period", "WARN", "FALSE"),
        table="orders",
    ),
)
def _(spark, sf):
    df = _gappy(spark, sf)
    return rules.count_checks(df, rules.plausible_date_checks(df, ["hire_date", "period"], _REF))


@query(
    "rule_parse_failures",
    _counted(
        ("parse_failure", "hire_date", "WARN", "o_orderkey % 9 = 0"),
        ("parse_failure", "tenure_months", "WARN", "o_orderkey % 8 = 0"),
        table="orders",
    ),
)
def _(spark, sf):
    raw = orders(spark, sf).selectExpr(
        "if(o_orderkey % 9 = 0, '31/02/1999', if(o_orderkey % 2 = 0, date_format(d, 'dd/MM/yyyy'),"
        " null)) as hire_date",
        "if(o_orderkey % 8 = 0, 'x', cast(o_custkey as string)) as tenure_months",
        "o_orderstatus as status",
    )
    return rules.count_checks(raw, rules.parse_failure_checks(raw, PEOPLE_CONTRACT))


@query(
    "rule_unclassified",
    _counted(
        ("unclassified", "label", "ERROR", "s_nationkey % 4 >= 2"),
        table="supplier",
    ),
)
def _(spark, sf):
    df = load(spark, sf, "supplier").selectExpr(
        "case s_nationkey % 4 when 0 then 'A' when 1 then 'B' when 2 then 'Z' end as label"
    )
    return rules.count_checks(df, [rules.unclassified_check("label", ["A", "B"], "")])


@query(
    "rule_unique_key",
    """SELECT count(*) AS groups, coalesce(sum(n), 0)::BIGINT AS rows FROM (SELECT count(*) AS n
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def _(spark, sf):
    return rules.count_duplicates(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "rule_unique_key_per_label",
    """WITH k AS (SELECT l_returnflag AS label, l_orderkey AS a,
        CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS b FROM lineitem),
      n AS (SELECT label, a, b, count(*) AS n FROM k GROUP BY ALL)
      SELECT label, count(*) FILTER (n > 1) AS groups,
        coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS rows FROM n GROUP BY label""",
)
def _(spark, sf):
    both = ("l_orderkey", "l_linenumber")
    keys = {"R": ("l_orderkey",), "A": both, "N": both}
    return rules.duplicates_per_label(load(spark, sf, "lineitem"), "l_returnflag", keys)


query(
    "rule_coverage",
    f"""WITH {sql.people()}, x AS (SELECT found, date_trunc('month', hire_date) = period
        OR EXISTS (SELECT 1 FROM hire WHERE hire.person_id = leave.person_id
          AND hire.period = leave.period) AS excluded FROM leave)
      SELECT count(*) FILTER (coalesce(excluded, FALSE)) AS excluded,
        count(*) FILTER (NOT coalesce(excluded, FALSE)) AS expected,
        count(*) FILTER (NOT coalesce(excluded, FALSE) AND found) AS found,
        round(count(*) FILTER (NOT coalesce(excluded, FALSE) AND found)::DOUBLE
          / count(*) FILTER (NOT coalesce(excluded, FALSE)), 9) AS ratio FROM x""",
)(flows.coverage)

query(
    "rule_reconciliation",
    f"""WITH {sql.people()},
      hc AS (SELECT period, count(DISTINCT person_id) AS headcount FROM snap
        WHERE status <> 'F' GROUP BY period),
      p AS (SELECT *, lag(headcount, 1, 0) OVER (ORDER BY period) AS previous FROM hc),
      hi AS (SELECT period, count(DISTINCT person_id) AS hires FROM hire GROUP BY period),
      le AS (SELECT period, count(DISTINCT person_id) AS leavers FROM leave GROUP BY period),
      t AS (SELECT p.period, headcount, previous, coalesce(hires, 0) AS hires,
          coalesce(leavers, 0) AS leavers,
          previous + coalesce(hires, 0) - coalesce(leavers, 0) AS expected
        FROM p LEFT JOIN hi USING (period) LEFT JOIN le USING (period) WHERE previous > 0)
      SELECT *, headcount - expected AS difference,
        round(abs(headcount - expected) / headcount::DOUBLE, 9) AS deviation FROM t""",
)(flows.reconciliation)


@query(
    "people_per_period",
    f"""WITH {sql.ORDERS} SELECT m AS period, count(DISTINCT o_custkey)
        FILTER (o_orderstatus <> 'P') + max((o_orderstatus = 'P')::INTEGER) AS people
      FROM o GROUP BY m""",
)
def _(spark, sf):
    df = orders(spark, sf).selectExpr(
        "m as period", "if(o_orderstatus <> 'P', o_custkey, null) as person_id"
    )
    return rules.people_per_period(df, "people")


@query(
    "rule_budget_months",
    f"""WITH {sql.ORDERS} SELECT year(m)::INTEGER AS year, count(DISTINCT m) AS months
      FROM o GROUP BY 1""",
)
def _(spark, sf):
    return rules.months_per_year(orders(spark, sf).select(F.col("m").alias("period")))


@query(
    "rule_volume_change",
    """WITH a AS (SELECT l_returnflag AS label, count(*) FILTER (l_orderkey % 5 >= 2) AS rows,
        count(*) FILTER (l_orderkey % 5 < 2) AS before FROM lineitem GROUP BY 1)
      SELECT label, rows, before, round((rows - before) / before::DOUBLE, 9) AS change FROM a
      WHERE rows > 0 AND before > 0 AND abs((rows - before) / before::DOUBLE) > 0.5""",
)
def _(spark, sf):
    """Every line item belongs to one of two runs."""
    rows = load(spark, sf, "lineitem")

    def volumes(which):
        return rows.filter(which).groupBy(F.col("l_returnflag").alias("label")).agg(
            F.count(F.lit(1)).alias("rows")
        )

    moved = rules.volume_change(
        volumes("l_orderkey % 5 >= 2"), volumes("l_orderkey % 5 < 2"), "label", 0.5
    )
    return moved.withColumn("change", F.round("change", 9))


# -------------------------------------------------------------------------- profile, compare
@query(
    "profile_columns",
    """SELECT 'Chapa' AS header, 'person_id' AS "column", 'text' AS kind, 'matched' AS status,
        1.0::DOUBLE AS fill_ratio, (SELECT string_agg(v, ' | ' ORDER BY v) FROM
          (SELECT DISTINCT c_custkey::VARCHAR AS v FROM customer ORDER BY v LIMIT 3)) AS examples
      UNION ALL SELECT 'CC', 'cost_center', 'text', 'matched',
        (SELECT round(count(*) FILTER (c_custkey % 4 <> 0)::DOUBLE / count(*), 9) FROM customer),
        (SELECT string_agg(v, ' | ' ORDER BY v) FROM (SELECT DISTINCT c_nationkey::VARCHAR AS v
          FROM customer WHERE c_custkey % 4 <> 0 ORDER BY v LIMIT 3))
      UNION ALL SELECT 'Lixo', NULL, NULL, 'unmatched', 1.0,
        (SELECT string_agg(v, ' | ' ORDER BY v) FROM
          (SELECT DISTINCT c_mktsegment AS v FROM customer ORDER BY v LIMIT 3))
      UNION ALL SELECT 'MATRICULA', 'person_id', 'text', 'repeated', 1.0,
        (SELECT string_agg(v, ' | ' ORDER BY v) FROM
          (SELECT DISTINCT c_name AS v FROM customer ORDER BY v LIMIT 3))
      UNION ALL SELECT NULL, name, kind, 'missing', 0.0, '' FROM (VALUES """
    + ", ".join(
        f"('{c.name}', '{c.kind}')"
        for c in PEOPLE_CONTRACT.columns
        if c.name not in ("person_id", "cost_center")
    )
    + ") AS c(name, kind)",
)
def _(spark, sf):
    df = load(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) as Chapa",
        "if(c_custkey % 4 <> 0, cast(c_nationkey as string), null) as CC",
        "c_mktsegment as Lixo",
        "c_name as MATRICULA",
        "'f' as _source_file",
    )
    return (
        profile_columns(df, PEOPLE_CONTRACT)
        .withColumn("fill_ratio", F.round("fill_ratio", 9))
        .withColumn("examples", F.array_join("examples", " | "))
        .drop("approx_distinct")
    )


def _versions(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Orders, and a copy with rows missing, rows added and values changed."""
    old = load(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    kept = old.filter("o_orderkey % 10 <> 0").selectExpr(
        "o_orderkey",
        "if(o_orderkey % 7 = 0, null, o_orderstatus) as o_orderstatus",
        "if(o_orderkey % 9 = 0, o_totalprice + 1, o_totalprice) as o_totalprice",
        "o_orderpriority",
    )
    added = old.filter("o_orderkey % 11 = 0").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return old, kept.unionByName(added)


@query(
    "compare_tables",
    """SELECT 'only_old' AS difference, NULL::VARCHAR AS "column",
        count(*) FILTER (o_orderkey % 10 = 0) AS keys FROM orders
      UNION ALL SELECT 'only_new', NULL, count(*) FILTER (o_orderkey % 11 = 0) FROM orders
      UNION ALL SELECT 'repeated', NULL, 0
      UNION ALL SELECT 'value', 'o_orderstatus',
        count(*) FILTER (o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0) FROM orders
      UNION ALL SELECT 'value', 'o_totalprice',
        count(*) FILTER (o_orderkey % 10 <> 0 AND o_orderkey % 9 = 0) FROM orders
      UNION ALL SELECT 'value', 'o_orderpriority', 0""",
)
def _(spark, sf):
    return compare_tables(*_versions(spark, sf), ["o_orderkey"])


@query(
    "changed_values",
    """SELECT o_orderkey, o_totalprice AS old, o_totalprice + 1 AS new FROM orders
       WHERE o_orderkey % 10 <> 0 AND o_orderkey % 9 = 0 ORDER BY o_orderkey LIMIT 10""",
)
def _(spark, sf):
    return changed_values(*_versions(spark, sf), ["o_orderkey"], "o_totalprice", n=10)


@query(
    "all_changed_values",
    """SELECT o_orderkey, o_totalprice AS old, o_totalprice + 1 AS new FROM orders
       WHERE o_orderkey % 10 <> 0 AND o_orderkey % 9 = 0""",
)
def _(spark, sf):
    return changed_values(*_versions(spark, sf), ["o_orderkey"], "o_totalprice")


@query(
    "rows_on_one_side",
    """SELECT * FROM (SELECT o_orderkey, 'old' AS side FROM orders WHERE o_orderkey % 10 = 0
       UNION ALL SELECT -1 - o_orderkey, 'new' FROM orders WHERE o_orderkey % 11 = 0)
       ORDER BY o_orderkey LIMIT 10""",
)
def _(spark, sf):
    return rows_on_one_side(*_versions(spark, sf), ["o_orderkey"], n=10)


@query(
    "all_rows_on_one_side",
    """SELECT o_orderkey, 'old' AS side FROM orders WHERE o_orderkey % 10 = 0
       UNION ALL SELECT -1 - o_orderkey, 'new' FROM orders WHERE o_orderkey % 11 = 0""",
)
def _(spark, sf):
    return rows_on_one_side(*_versions(spark, sf), ["o_orderkey"])


_CHANGES = """SELECT 'o_orderstatus' AS "column", o_orderkey, o_orderstatus AS old, NULL::VARCHAR AS new
    FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 = 0
  UNION ALL SELECT 'o_totalprice', o_orderkey, o_totalprice::DECIMAL(18,2)::VARCHAR,
    (o_totalprice + 1)::DECIMAL(18,2)::VARCHAR
    FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 9 = 0"""


def _priced(spark, sf) -> list[DataFrame]:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return [df.withColumn("o_totalprice", price) for df in _versions(spark, sf)]


@query("all_changes", _CHANGES)
def _(spark, sf):
    return all_changes(*_priced(spark, sf), ["o_orderkey"])


@query(
    "all_changes_sample",
    f"""SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY o_orderkey)::INTEGER AS nth
        FROM ({_CHANGES}) QUALIFY nth <= 10""",
)
def _(spark, sf):
    return all_changes(*_priced(spark, sf), ["o_orderkey"], n=10)


# ------------------------------------------------------- labels from a table, fills, totals
_PART_LABELS = """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN p_partkey % 5 <> 0
  THEN 'TAMANHO ' || p_size END AS label FROM lineitem LEFT JOIN part ON p_partkey = l_partkey"""


def _part_labels(spark, sf, **how) -> DataFrame:
    """Line items labelled by a table of all parts, which spells their names otherwise."""
    names = load(spark, sf, "part").filter("p_partkey % 5 <> 0").selectExpr(
        "concat(' Peça nº ', p_partkey, '.') as value", "concat(' tamanho ', p_size) as label"
    )
    items = load(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "concat('PECA - n ', l_partkey) as name"
    )
    return label_from_table(items, "name", names, "label", **how).drop("name")


@query("label_from_table", _PART_LABELS)
def _(spark, sf):
    return _part_labels(spark, sf)


@query("label_from_large_table", _PART_LABELS)
def _(spark, sf):
    """More different values than may be broadcast, and frequent ones among them."""
    return _part_labels(spark, sf, small_rows=0, hot_min_rows=40)


@query(
    "label_conflicts",
    """SELECT upper(c_mktsegment) AS code, count(DISTINCT c_nationkey) AS labels,
      min(c_nationkey::VARCHAR) AS least FROM customer GROUP BY 1 HAVING count(DISTINCT c_nationkey) > 1""",
)
def _(spark, sf):
    return label_conflicts(load(spark, sf, "customer"), "c_mktsegment", "c_nationkey")


_MARKED = """m AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber = 1
  AND l_orderkey % 3 = 0 THEN l_orderkey END AS first, CASE WHEN l_linenumber % 4 = 2
  THEN 'l' || l_linenumber END AS line FROM lineitem)"""


def _filled_sql(over: str) -> str:
    value = lambda c: f"last_value({c} IGNORE NULLS) OVER ({over}) AS {c}"
    rows = f"SELECT l_orderkey, l_linenumber, l_suppkey, {value('first')}, {value('line')} FROM m"
    return f"WITH {_MARKED} {rows}"


def _marked(spark, sf) -> DataFrame:
    return load(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey",
        "if(l_linenumber = 1 and l_orderkey % 3 = 0, l_orderkey, null) as first",
        "if(l_linenumber % 4 = 2, concat('l', l_linenumber), null) as line",
    )


@query("fill_down", _filled_sql("ORDER BY l_orderkey, l_linenumber RANGE UNBOUNDED PRECEDING"))
def _(spark, sf):
    return fill_down(_marked(spark, sf), ["first", "line"], ["l_orderkey", "l_linenumber"])


@query(
    "fill_down_in_groups",
    _filled_sql("PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber RANGE UNBOUNDED PRECEDING"),
)
def _(spark, sf):
    order = ["l_orderkey", "l_linenumber"]
    return fill_down(_marked(spark, sf), ["first", "line"], order, groups=["l_suppkey"])


_TOTALS = """WITH k AS (SELECT l_orderkey, l_linenumber, l_quantity::BIGINT AS quantity,
    CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS supplier FROM lineitem)
  SELECT *, sum(quantity) OVER w::BIGINT AS supplied, count(*) OVER w AS lines,
    round(quantity / sum(quantity) OVER w, 12) AS share FROM k WINDOW w AS (PARTITION BY supplier)"""


def _with_totals(spark, sf, **how) -> DataFrame:
    items = load(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_quantity as bigint) as quantity",
        "if(l_linenumber <> 7, l_suppkey, null) as supplier",
    )
    sums = {"supplied": F.sum("quantity"), "lines": F.count(F.lit(1))}
    found = with_totals(items, ["supplier"], sums, **how)
    return found.withColumn("share", F.round(F.col("quantity") / F.col("supplied"), 12))


@query("totals_beside_rows", _TOTALS)
def _(spark, sf):
    return _with_totals(spark, sf)


@query("totals_of_many_keys", _TOTALS)
def _(spark, sf):
    """More keys than may be broadcast; the rows without a supplier are a frequent one."""
    return _with_totals(spark, sf, small_rows=0, hot_min_rows=500)


@query(
    "pivot_attribute",
    """SELECT o_custkey, count(o_orderkey) FILTER (o_orderstatus = 'F') AS orders_F,
      count(o_orderkey) FILTER (o_orderstatus = 'O') AS orders_O,
      count(o_orderkey) FILTER (o_orderstatus = 'P') AS orders_P FROM orders GROUP BY o_custkey""",
)
def _(spark, sf):
    df = load(spark, sf, "orders")
    return pivot_attribute(df, ["o_custkey"], "o_orderstatus", "o_orderkey", F.count, prefix="orders_")


@query(
    "contract_report",
    """SELECT 'code' AS "column", 'type' AS problem, 'bigint' AS expected, 'string' AS found,
        count(*) FILTER (c_custkey % 3 <> 0) AS filled,
        count(*) FILTER (c_custkey % 3 = 1) AS lost FROM customer
      UNION ALL SELECT 'segment', 'extra', NULL, 'string', count(c_mktsegment), 0 FROM customer
      UNION ALL SELECT 'day', 'missing', 'date', NULL, 0, 0""",
)
def _(spark, sf):
    contract = TableContract(
        (ColumnSpec("code", "integer"), ColumnSpec("name", "text"), ColumnSpec("day", "date"))
    )
    df = load(spark, sf, "customer").selectExpr(
        "case c_custkey % 3 when 1 then c_name when 2 then cast(c_custkey as string) end as code",
        "c_name as name", "c_mktsegment as segment", "1 as _internal",
    )
    return rules.contract_report(df, contract)


# ------------------------------------------------------------------------- sources and sinks
_CUSTOMERS = """SELECT c_custkey::VARCHAR AS person_id, c_name AS full_name,
  CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS directorate FROM customer"""

query("folder_with_mixed_headers", _CUSTOMERS)(files.mixed_headers)
query("staged_folder", _CUSTOMERS)(files.staged_folder)
query("parquet_folder", _CUSTOMERS)(files.parquet_folder)
query(
    "recursive_folder",
    """SELECT c_custkey::VARCHAR AS person_id, (c_custkey % 2)::VARCHAR AS layout,
      TRUE AS named, TRUE AS ordered, TRUE AS versioned FROM customer""",
)(files.recursive_folder)
query(
    "staged_after_change",
    """SELECT c_custkey::VARCHAR AS person_id,
      c_name || CASE WHEN c_custkey % 2 = 0 THEN ' novo' ELSE '' END AS full_name FROM customer""",
)(files.staged_after_change)
query(
    "workbook_folder",
    """SELECT c_custkey::VARCHAR AS person_id, c_name AS full_name,
      CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS directorate,
      'clientes ' || (c_custkey // 500) || '.xlsx' AS _source_file,
      CASE WHEN c_custkey % 2 = 0 THEN 'pares' ELSE 'outros' END AS _source_sheet FROM customer""",
)(files.workbook_folder)
query(
    "csv_round_trip",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate::DATE AS day,
       CASE WHEN o_orderkey % 3 <> 0 THEN 'a;"' || o_orderpriority || '"' END AS quoted FROM orders""",
)(files.csv_round_trip)
query("arrived_layouts", _CUSTOMERS)(files.arrived_layouts)
query(
    "profiled_source",
    """SELECT 'part' AS file, h.header, h."column", h.status, 1.0::DOUBLE AS fill_ratio,
      (SELECT string_agg(v, ' | ' ORDER BY v) FROM (SELECT DISTINCT CASE h.n WHEN 0 THEN c_custkey::VARCHAR
          WHEN 1 THEN c_mktsegment WHEN 2 THEN c_name ELSE c_acctbal::VARCHAR END AS v FROM customer
        WHERE c_custkey % 2 = h.parity ORDER BY v LIMIT 3)) AS examples
      FROM (VALUES (0, 0, 'CHAPA', 'person_id', 'matched'), (0, 1, 'Diretoria', 'directorate', 'matched'),
        (0, 2, 'NOME', 'full_name', 'matched'), (1, 2, 'Nome', 'full_name', 'matched'),
        (1, 3, 'Lixo', NULL, 'unmatched'), (1, 0, 'Chapa', 'person_id', 'matched'))
        AS h(parity, n, header, "column", status)""",
)(files.profiled_source)
query(
    "per_flow_csv",
    f"""SELECT "BASE", full_name, tax_id, supplier FROM ({sql.stacked()})
        WHERE "BASE" LIKE '%TERCEIROS%'""",
)(files.per_flow_csv)
query(
    "rule_samples",
    """SELECT 'unclassified' AS rule, 'contractors' AS scope, lpad((s_suppkey * 104729)::VARCHAR, 11, '0')
      AS tax_id, s_name AS full_name FROM supplier WHERE s_nationkey % 4 = 3
      ORDER BY tax_id LIMIT 50""",
)(files.rule_samples)
query("published_table", sql.stacked(published=True))(files.published_table)
query(
    "published_label",
    f"""SELECT * EXCLUDE ("BASE") FROM ({sql.stacked(published=True)})
        WHERE "BASE" = 'MOVIMENTACOES'""",
)(files.published_label)
query("consolidated_run", sql.stacked(with_files=False, published=True))(files.consolidated_run)
query("run_report", sql.report(_SHORT))(files.run_report)
query(
    "run_history",
    f'SELECT "BASE", count(*) AS rows FROM ({sql.stacked(with_files=False)}) GROUP BY "BASE"',
)(files.run_history)
