"""The three facts, each a projection or one equi-join of curated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sondaflow.functions.dates import date_key
from sondaflow.functions.numbers import real_rate, round4

# Texts and codes of the facts.
NO_DETAIL = "Geral"
BASE_NAMES = {0: "30 dias corridos", 1: "5 dias úteis"}
OTHER_BASE = "Outro"
TOP5_ABOVE = "Top 5 mais alto (Hawkish)"
TOP5_BELOW = "Top 5 mais baixo (Dovish)"
TOP5_AGREES = "Em Consenso"
NEWEST_BASE = 1
SHORT_TERM = "C"

JOIN_KEYS = ["data", "indicador", "ano_referencia"]


def expectations_fact(survey: DataFrame) -> DataFrame:
    base = F.col("base_calculo")
    name = F.lit(OTHER_BASE)
    for code, text in BASE_NAMES.items():
        name = F.when(base == code, text).otherwise(name)
    return survey.select(
        date_key(F.col("data")).alias("data_sk"),
        "data",
        "indicador",
        F.coalesce("indicador_detalhe", F.lit(NO_DETAIL)).alias("indicador_detalhe"),
        "ano_referencia",
        "base_calculo",
        name.alias("base_calculo_desc"),
        "media", "mediana", "desvio_padrao", "minimo", "maximo",
        round4(F.col("maximo") - F.col("minimo")).alias("spread_min_max"),
        "numero_respondentes",
    )


def position_signal(top5: Column, market: Column) -> Column:
    """Above, below, or agreement; a missing side counts as agreement."""
    return F.when(top5 > market, TOP5_ABOVE).when(top5 < market, TOP5_BELOW).otherwise(TOP5_AGREES)


def market_vs_top5_fact(survey: DataFrame, top5: DataFrame) -> DataFrame:
    """Market median beside the Top 5 median of the same date, indicator and year.

    Both filters sit below the join and both sides carry only what the fact
    needs. The Top 5 side is unique on the join key after curation, so the join
    is many-to-one: details of the market side each keep their own row.
    """
    market = survey.filter(F.col("base_calculo") == NEWEST_BASE).select(
        *JOIN_KEYS,
        F.col("mediana").alias("mediana_mercado"),
        F.col("desvio_padrao").alias("desvio_padrao_mercado"),
        F.col("minimo").alias("minimo_mercado"),
        F.col("maximo").alias("maximo_mercado"),
        "numero_respondentes",
    )
    panel = top5.filter(F.col("tipo_calculo") == SHORT_TERM).select(
        *JOIN_KEYS,
        F.col("mediana").alias("mediana_top5"),
        F.col("desvio_padrao").alias("desvio_padrao_top5"),
        F.col("minimo").alias("minimo_top5"),
        F.col("maximo").alias("maximo_top5"),
    )
    theirs, ours = F.col("mediana_top5"), F.col("mediana_mercado")
    return market.join(panel, JOIN_KEYS, "inner").select(
        date_key(F.col("data")).alias("data_sk"),
        *JOIN_KEYS,
        "mediana_mercado", "mediana_top5",
        round4(theirs - ours).alias("divergencia_top5_mercado"),
        "desvio_padrao_mercado", "desvio_padrao_top5",
        "minimo_mercado", "maximo_mercado", "minimo_top5", "maximo_top5",
        "numero_respondentes",
        position_signal(theirs, ours).alias("sinal_posicionamento"),
    )


def real_rate_fact(rate: DataFrame, inflation: DataFrame) -> DataFrame:
    """Policy rate and expected inflation of exactly the same day, and the rate between them."""
    expected = inflation.filter(F.col("base_calculo") == NEWEST_BASE).select(
        "data",
        F.col("mediana").alias("ipca_esperado_12m"),
        F.col("desvio_padrao").alias("desvio_padrao_ipca_12m"),
    )
    joined = rate.select("data", "taxa_selic_meta_aa").join(expected, "data", "inner")
    return joined.select(
        date_key(F.col("data")).alias("data_sk"),
        "data", "taxa_selic_meta_aa", "ipca_esperado_12m", "desvio_padrao_ipca_12m",
        real_rate(F.col("taxa_selic_meta_aa"), F.col("ipca_esperado_12m")).alias("taxa_juro_real_ex_ante"),
    )


def surplus_join_rows(survey: DataFrame) -> DataFrame:
    """Market rows per join key beyond the first: the fan-out to expect from the comparison join."""
    per_key = survey.filter(F.col("base_calculo") == NEWEST_BASE).groupBy(*JOIN_KEYS).agg(
        F.count(F.lit(1)).alias("rows"))
    return per_key.agg(
        F.count(F.when(F.col("rows") > 1, 1)).alias("keys_with_details"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("surplus_rows"),
    )


def newest_rows(fact: DataFrame, count: int = 10, ties: list[str] | None = None) -> DataFrame:
    """The diagnostic listing: newest days first."""
    return fact.orderBy(F.col("data").desc(), *[F.col(c) for c in ties or []]).limit(count)
