"""People-like raw tables (all text, messy) derived by Spark from the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.operators.skew import spread

REFERENCE = dt.date(2002, 3, 15)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``d`` (order date) and ``m`` (its month)."""
    return (
        load(spark, sf_dir, "orders")
        .withColumn("d", F.col("o_orderdate").cast("date"))
        .withColumn("m", F.trunc("d", "MM"))
    )


_SNAPSHOT = [
    "concat(' ', cast(o_custkey as string)) as CHAPA",
    "concat(' Pessoa  ', cast(o_custkey as string), ' ') as NOME",
    "cast(o_custkey * 7919 as string) as CPF",
    "date_format(date_add(date'1990-01-01', cast(o_custkey % 1500 as int)), 'dd/MM/yyyy')"
    " as DATAADMISSAO",
    "concat('CC', cast(o_custkey % 50 as string)) as CODSECAO",
    "o_orderstatus as CODSITUACAO",
    "o_orderpriority as FUNCAO",
    "if(o_orderkey % 5 = 0, ' ', concat('Gestor ', cast(o_orderkey % 7 as string))) as GESTOR",
]


def snapshot_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, in yearly files that state the period and monthly files that do not."""
    return (
        spread(orders(spark, sf_dir))
        .withColumn("monthly", F.expr("o_orderkey % 2 = 0"))
        .selectExpr(
            "if(monthly, null, date_format(m, 'yyyy-MM-dd HH:mm:ss')) as COMPETENCIA",
            *_SNAPSHOT,
            "if(monthly, concat('Quadro ', date_format(m, 'MM-yyyy'), '.xlsx'),"
            " concat('Quadro ', date_format(m, 'yyyy'), '.xlsx')) as _source_file",
            "if(monthly, '2', '1') as _file_order",
        )
    )


def snapshot_stated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, each with its period."""
    return spread(orders(spark, sf_dir)).selectExpr(
        "date_format(m, 'yyyy-MM-dd HH:mm:ss') as COMPETENCIA", *_SNAPSHOT
    )


def hires_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everybody's first order; some names and cost centres are blank."""
    return (
        orders(spark, sf_dir)
        .groupBy("o_custkey")
        .agg(F.min("d").alias("first"))
        .selectExpr(
            "cast(o_custkey as string) as Chapa",
            "if(o_custkey % 3 = 0, '', concat('Nome ', cast(o_custkey as string))) as ` Nome `",
            "date_format(first, 'd/M/yyyy') as `Data de Admissão`",
            "if(o_custkey % 7 = 0, null, concat('CC', cast(o_custkey % 50 as string))) as CODSECAO",
        )
    )


def leavers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everybody leaves in the month after the last order."""
    return (
        orders(spark, sf_dir)
        .groupBy("o_custkey")
        .agg(F.max("d").alias("last"))
        .selectExpr(
            "cast(o_custkey as string) as CHAPA",
            "date_format(add_months(last, 1), 'yyyy-MM-dd HH:mm:ss') as DATADEMISSAO",
            "'Pedido' as TIPODEMISSAO",
        )
    )


def movements_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One movement per line item."""
    columns = ["l_suppkey", "l_shipdate", "l_returnflag", "l_linenumber", "l_linestatus"]
    return spread(load(spark, sf_dir, "lineitem").select(*columns)).selectExpr(
        "cast(l_suppkey as string) as CHAPA",
        "date_format(l_shipdate, 'dd-MM-yyyy') as DATA_MOVIMENTACAO",
        "l_returnflag as TIPO_MOVIMENTACAO",
        "if(l_linenumber = 1, null, concat('CC', cast(l_linenumber as string))) as CC_PARA",
        "concat('CC', l_linestatus) as SECAO_ANTERIOR",
    )


def contractors_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in four classes, one of which has no label."""
    return load(spark, sf_dir, "supplier").selectExpr(
        "case s_nationkey % 4 when 0 then ' Ativo ' when 1 then 'ADMITIDO'"
        " when 2 then 'demitido' else 'Férias' end as TIPO",
        "cast(s_suppkey * 104729 as string) as CPF",
        "s_name as NOME",
        "concat('Fornecedor ', cast(s_nationkey as string)) as FORNECEDOR",
    )


def budget_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as budgeted positions, spread over the months of a year."""
    return load(spark, sf_dir, "part").selectExpr(
        "date_format(add_months(date'2002-01-01', cast(p_partkey % 12 as int)), 'yyyyMMdd')"
        " as PERIODO",
        "concat('V', cast(p_partkey as string)) as ID_VAGA",
        "concat('CC', cast(p_size as string)) as CODSECAO",
    )
