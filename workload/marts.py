"""Curated tables and facts of the proxy surveys.

``curated_*`` and ``*_fact`` are plans. ``lines`` and ``news`` are stars whose
curated tables and facts are written once per session to the shared folder, as
a daily run would leave them, so that a measure reads a table and not the whole
derivation.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sondaflow.measures.context import Star
from sondaflow.operators import dims, facts
from sondaflow.operators.curate import curated
from sondaflow.session import RECORDS_A_FILE, scratch_path, small_parts
from workload import proxies


def curated_market(spark: SparkSession, folder: str) -> DataFrame:
    return curated(proxies.market(spark, folder), proxies.SURVEY_SPEC)


def curated_panel(spark: SparkSession, folder: str) -> DataFrame:
    return curated(proxies.panel(spark, folder), proxies.TOP5_SPEC)


def curated_news(spark: SparkSession, folder: str) -> DataFrame:
    return curated(proxies.news(spark, folder), proxies.SURVEY_SPEC)


def curated_news_panel(spark: SparkSession, folder: str) -> DataFrame:
    return curated(proxies.news_panel(spark, folder), proxies.TOP5_SPEC)


def curated_inflation(spark: SparkSession, folder: str) -> DataFrame:
    return curated(proxies.inflation(spark, folder), proxies.INFLATION_SPEC)


def curated_rate(spark: SparkSession, folder: str) -> DataFrame:
    return curated(proxies.rate(spark, folder), proxies.RATE_SPEC)


def market_fact(spark: SparkSession, folder: str) -> DataFrame:
    return facts.expectations_fact(curated_market(spark, folder))


def comparison_fact(spark: SparkSession, folder: str) -> DataFrame:
    return facts.market_vs_top5_fact(curated_market(spark, folder), curated_panel(spark, folder))


def real_rate_fact(spark: SparkSession, folder: str) -> DataFrame:
    return facts.real_rate_fact(curated_rate(spark, folder), curated_inflation(spark, folder))


def news_comparison_fact(spark: SparkSession, folder: str) -> DataFrame:
    return facts.market_vs_top5_fact(
        curated_news(spark, folder), curated_news_panel(spark, folder))


def series_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """The indicator dimension of the line series: one indicator per supplier."""
    return proxies.table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("indicador_id"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("indicador"),
        F.lit("R$").alias("unidade_medida"), F.lit("Anual").alias("periodicidade"),
        F.col("s_name").alias("descricao"))


# What each fact of a star is made of: the plan from curated tables, and their plans.
LINE_FACTS = {
    "expectations": (facts.expectations_fact, (curated_market,)),
    "comparison": (facts.market_vs_top5_fact, (curated_market, curated_panel)),
    "real_rate": (facts.real_rate_fact, (curated_rate, curated_inflation)),
}
NEWS_FACTS = {
    "expectations": (facts.expectations_fact, (curated_news,)),
    "comparison": (facts.market_vs_top5_fact, (curated_news, curated_news_panel)),
    "real_rate": LINE_FACTS["real_rate"],
}

_WRITTEN: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def _written(spark: SparkSession, folder: str, plans: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Each plan as a table in the shared folder, written side by side where it is not there yet."""
    session = spark.sparkContext.applicationId

    def write(name: str) -> None:
        path = scratch_path(spark, name)
        rows = plans[name]()
        writer = rows.sortWithinPartitions("data").write.option("maxRecordsPerFile", RECORDS_A_FILE)
        writer.parquet(path, compression="zstd")
        _WRITTEN[session, folder, name] = path, rows.schema

    missing = [name for name in plans if (session, folder, name) not in _WRITTEN]
    with small_parts(spark), ThreadPoolExecutor(max_workers=max(1, len(missing))) as pool:
        list(pool.map(write, missing))
    built = {name: _WRITTEN[session, folder, name] for name in plans}
    return {name: spark.read.schema(schema).parquet(path) for name, (path, schema) in built.items()}


def _facts(spark: SparkSession, folder: str, label: str, recipes: dict, wanted: tuple[str, ...]) -> dict[str, DataFrame]:
    """The wanted facts: their curated tables first, each written once, then the facts from those."""
    if all((spark.sparkContext.applicationId, folder, f"{label}_{n}") in _WRITTEN for n in wanted):
        curated_tables = {}
    else:
        needed = {plan.__name__: plan for n in wanted for plan in recipes[n][1]}
        curated_tables = _written(spark, folder, {
            name: lambda plan=plan: plan(spark, folder) for name, plan in needed.items()})
    built = _written(spark, folder, {
        f"{label}_{n}": lambda n=n: recipes[n][0](*[curated_tables[p.__name__] for p in recipes[n][1]])
        for n in wanted})
    return {n: built[f"{label}_{n}"] for n in wanted}


def lines(spark: SparkSession, folder: str, *wanted: str) -> Star:
    """The star of the line series, with the facts a query names."""
    return Star(dims.calendar(spark), series_dimension(spark, folder),
                **_facts(spark, folder, "lines", LINE_FACTS, wanted))


def news(spark: SparkSession, folder: str, *wanted: str) -> Star:
    """The star of the event series, with the published indicator dimension."""
    return Star(dims.calendar(spark), dims.indicators(spark),
                **_facts(spark, folder, "news", NEWS_FACTS, wanted))
