"""Raw survey tables derived from the given tables, in the shape the sources publish.

``market`` and ``panel`` come from lineitem: one record per line, a series per
supplier, so the facts grow with the data. ``news`` comes from events: few keys
with very many records each, which is what deduplication has to survive.
``rate`` and ``inflation`` are daily, from orders and lineitem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sondaflow.operators.curate import BATCH, INGESTED
from sondaflow.plans import catalog

# The reference indicators that event types stand for.
EVENT_INDICATOR = {"view": "IPCA", "click": "Selic", "error": "Câmbio", "purchase": "PIB Total",
                   "signup": "IPCA 12M Suavizado"}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its columns are read from a file once, which is a job, and known from then on."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _lineage(moment: Column) -> list[Column]:
    return [F.lit("load-1").alias(BATCH), moment.alias(INGESTED)]


def _line_statistics() -> list[Column]:
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return [
        (price + F.col("l_tax")).alias("Media"),
        price.alias("Mediana"),
        F.col("l_discount").alias("DesvioPadrao"),
        (price - quantity).alias("Minimo"),
        (price + quantity).alias("Maximo"),
    ]


def _line_month() -> Column:
    return F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd").alias("Data")


def _line_series() -> Column:
    return F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("Indicador")


def _line_year() -> Column:
    return (F.year("l_shipdate") + F.col("l_linenumber") - 1).cast("string").alias("DataReferencia")


def _line_base() -> Column:
    return F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("baseCalculo")


def market(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        _line_month(), _line_series(),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("IndicadorDetalhe"),
        _line_year(), _line_base(), *_line_statistics(),
        F.col("l_quantity").cast("int").alias("numeroRespondentes"),
        *_lineage(F.col("l_shipdate")))


def panel(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "R", "C").otherwise("M")
    return table(spark, folder, "lineitem").select(
        _line_month(), _line_series(), _line_year(), kind.alias("tipoCalculo"),
        *_line_statistics(), *_lineage(F.col("l_shipdate")))


def inflation(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Data"), F.lit("IPCA").alias("Indicador"),
        F.lit("S").alias("Suavizada"), _line_base(),
        (F.col("l_quantity") + F.col("l_tax")).alias("Media"),
        F.col("l_quantity").alias("Mediana"),
        F.col("l_discount").alias("DesvioPadrao"),
        (F.col("l_quantity") - 1).alias("Minimo"),
        (F.col("l_quantity") + 1).alias("Maximo"),
        F.col("l_linenumber").alias("numeroRespondentes"),
        *_lineage(F.col("l_shipdate")))


def rate(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("data"),
        F.round(F.col("o_totalprice") / 1e4, 2).cast("string").alias("valor"),
        *_lineage(F.col("o_orderdate")))


def _event_fields() -> dict[str, Column]:
    label = F.lit(None).cast("string")
    for kind, indicator in EVENT_INDICATOR.items():
        label = F.when(F.col("event_type") == kind, indicator).otherwise(label)
    number = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return {
        "Data": F.date_format("ts", "yyyy-MM-dd"),
        "Indicador": label,
        "IndicadorDetalhe": F.lit(None).cast("string"),
        "DataReferencia": (F.lit(2024) + F.floor(number / 20)).cast("string"),
        "baseCalculo": F.when(F.hour("ts") < 12, 0).otherwise(1),
        "Media": F.col("value") + 0.25,
        "Mediana": F.col("value"),
        "DesvioPadrao": F.col("value") / 8,
        "Minimo": F.col("value") - 1,
        "Maximo": F.col("value") + 1,
        "numeroRespondentes": F.col("user_id").cast("int"),
    }


def news(spark: SparkSession, folder: str) -> DataFrame:
    fields = [column.alias(name) for name, column in _event_fields().items()]
    return table(spark, folder, "events").select(*fields, *_lineage(F.col("ts")))


def news_panel(spark: SparkSession, folder: str) -> DataFrame:
    fields = _event_fields()
    for name in ("IndicadorDetalhe", "baseCalculo", "numeroRespondentes"):
        del fields[name]
    kind = F.when(F.minute("ts") < 30, "C").otherwise("M")
    return table(spark, folder, "events").select(
        *[column.alias(name) for name, column in fields.items()], kind.alias("tipoCalculo"),
        *_lineage(F.col("ts")))


def flawed_news(spark: SparkSession, folder: str) -> DataFrame:
    """The same records with the damage that curation has to count."""
    fields = _event_fields()
    small = F.col("value") < 5
    fields["Data"] = F.when(small, "2024-02-30").otherwise(fields["Data"])
    fields["DataReferencia"] = F.when(F.col("value") > 90, "next").otherwise(fields["DataReferencia"])
    fields["Indicador"] = F.nullif(fields["Indicador"], F.lit("Câmbio"))
    fields["Maximo"] = F.when(F.col("event_type") == "view", F.col("value") - 0.5).otherwise(
        F.when(F.col("event_type") == "click", F.lit(None)).otherwise(fields["Maximo"]))
    return table(spark, folder, "events").select(
        *[column.alias(name) for name, column in fields.items()], *_lineage(F.col("ts")))


SURVEY_SPEC = catalog.CURATION[catalog.curated_table(catalog.SURVEY)]
TOP5_SPEC = catalog.CURATION[catalog.curated_table(catalog.TOP5)]
INFLATION_SPEC = catalog.CURATION[catalog.curated_table(catalog.INFLATION)]
RATE_SPEC = catalog.CURATION[catalog.curated_table(catalog.RATE)]
