"""Dimensions and the joins that lead to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sondaflow.functions.dates import date_key, half_year, workday_flag
from sondaflow.specs import CalendarRange

CALENDAR_COLUMNS = (
    "data_sk", "data", "ano", "mes", "dia", "trimestre", "semestre", "nome_mes", "ano_mes",
    "dia_semana_num", "dia_semana_nome", "flg_dia_util_teorico",
)


def calendar(spark: SparkSession, span: CalendarRange = CalendarRange()) -> DataFrame:
    """One row per day, without gaps; weekday 1 is Sunday."""
    days = spark.range((span.last - span.first).days + 1, numPartitions=1)
    day = F.col("data")
    return days.select(F.date_add(F.lit(span.first), F.col("id").cast("int")).alias("data")).select(
        date_key(day).alias("data_sk"),
        day,
        F.year(day).alias("ano"),
        F.month(day).alias("mes"),
        F.dayofmonth(day).alias("dia"),
        F.quarter(day).alias("trimestre"),
        half_year(day).alias("semestre"),
        F.date_format(day, "MMMM").alias("nome_mes"),
        F.date_format(day, "yyyy-MM").alias("ano_mes"),
        F.dayofweek(day).alias("dia_semana_num"),
        F.date_format(day, "EEEE").alias("dia_semana_nome"),
        workday_flag(day).alias("flg_dia_util_teorico"),
    )


# The indicator dimension.
INDICATORS = (
    (1, "IPCA", "% a.a.", "Anual",
     "Índice Nacional de Preços ao Consumidor Amplo - Medida oficial de inflação calculada pelo IBGE"),
    (2, "Selic", "% a.a.", "Anual",
     "Taxa Básica de Juros da economia fixada pelo COPOM (fim de período)"),
    (3, "Câmbio", "R$/US$", "Anual",
     "Taxa de câmbio comercial de compra e venda do Dólar americano (fim de período)"),
    (4, "PIB Total", "% a.a.", "Anual",
     "Taxa de crescimento real do Produto Interno Bruto brasileiro"),
    (5, "IPCA 12M Suavizado", "% a.a.", "12 Meses",
     "Expectativa de inflação acumulada para os próximos 12 meses contínuos"),
)


def indicators(spark: SparkSession, rows=INDICATORS) -> DataFrame:
    return spark.createDataFrame(
        list(rows),
        "indicador_id int, indicador string, unidade_medida string, periodicidade string, descricao string")


def with_dimension(fact: DataFrame, dimension: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Fact to dimension, many to one; facts without a parent keep null attributes.

    No hint: Spark broadcasts the dimension when its size allows and otherwise
    joins by key, splitting hot partitions at run time.
    """
    return fact.join(dimension.select(key, *attributes), key, "left")


def restricted(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """A filter on a dimension reaches the fact as a semi join, never the other way round."""
    return fact.join(dimension.select(key), key, "left_semi")
