"""The published catalog: sources, column contracts and data tests of the survey marts.

Names of source columns, keys, formats, filters and rules are fixed values:
they have to agree with what the sources publish and what the marts promise.
"""

from __future__ import annotations

from sondaflow.specs import ColumnSpec, ColumnTest, CurationSpec, SourceSpec

SURVEY = "expectativas_anuais"
TOP5 = "top5_anuais"
INFLATION = "inflacao_12m"
RATE = "meta_selic"


def raw_table(table: str) -> str:
    return f"bronze_{table}"


def curated_table(table: str) -> str:
    return f"silver_{table}"


SOURCES = (
    SourceSpec(
        target=raw_table(SURVEY), reader="pages", tag="ExpectativasMercadoAnuais",
        description="annual expectations, whole market",
        filter="Indicador IN ('IPCA', 'Selic', 'Câmbio', 'PIB Total')",
        keys=("Data", "Indicador", "IndicadorDetalhe", "DataReferencia", "baseCalculo"),
        date_column="Data", date_format="yyyy-MM-dd"),
    SourceSpec(
        target=raw_table(TOP5), reader="pages", tag="ExpectativasMercadoTop5Anuais",
        description="annual expectations, most accurate five institutions",
        filter="tipoCalculo = 'C' AND Indicador IN ('IPCA', 'Selic', 'Câmbio')",
        keys=("Data", "Indicador", "DataReferencia", "tipoCalculo"),
        date_column="Data", date_format="yyyy-MM-dd"),
    SourceSpec(
        target=raw_table(INFLATION), reader="pages", tag="ExpectativasMercadoInflacao12Meses",
        description="smoothed 12-month inflation expectation",
        filter="Indicador = 'IPCA' AND Suavizada = 'S'",
        keys=("Data", "Indicador", "Suavizada", "baseCalculo"),
        date_column="Data", date_format="yyyy-MM-dd"),
    SourceSpec(
        target=raw_table(RATE), reader="windows", tag="sgs.432",
        description="daily policy rate target",
        keys=("data",), date_column="data", date_format="dd/MM/yyyy",
        options={"series": "432", "first_day": "1999-06-04"}),
)

STATISTICS = (
    ColumnSpec("Media", "media", "double"),
    ColumnSpec("Mediana", "mediana", "double"),
    ColumnSpec("DesvioPadrao", "desvio_padrao", "double"),
    ColumnSpec("Minimo", "minimo", "double"),
    ColumnSpec("Maximo", "maximo", "double"),
)
OBSERVED = ColumnSpec("Data", "data", "date", "yyyy-MM-dd")
INDICATOR = ColumnSpec("Indicador", "indicador", "string")
YEAR = ColumnSpec("DataReferencia", "ano_referencia", "int")
BASE = ColumnSpec("baseCalculo", "base_calculo", "int")
RESPONDENTS = ColumnSpec("numeroRespondentes", "numero_respondentes", "int")
WITHIN_RANGE = {"mediana_entre_min_max": "mediana BETWEEN minimo AND maximo"}

CURATIONS = (
    CurationSpec(
        source=raw_table(SURVEY), target=curated_table(SURVEY),
        columns=(OBSERVED, INDICATOR,
                 ColumnSpec("IndicadorDetalhe", "indicador_detalhe", "string"),
                 YEAR, BASE, *STATISTICS, RESPONDENTS),
        keys=("data", "indicador", "indicador_detalhe", "ano_referencia", "base_calculo"),
        nullable_keys=("indicador_detalhe",),
        rules=WITHIN_RANGE),
    CurationSpec(
        source=raw_table(TOP5), target=curated_table(TOP5),
        columns=(OBSERVED, INDICATOR, YEAR,
                 ColumnSpec("tipoCalculo", "tipo_calculo", "string"), *STATISTICS),
        keys=("data", "indicador", "ano_referencia", "tipo_calculo"),
        rules=WITHIN_RANGE),
    CurationSpec(
        source=raw_table(INFLATION), target=curated_table(INFLATION),
        columns=(OBSERVED, INDICATOR, ColumnSpec("Suavizada", "suavizada", "string"),
                 BASE, *STATISTICS, RESPONDENTS),
        keys=("data", "indicador", "suavizada", "base_calculo"),
        rules={**WITHIN_RANGE, "somente_suavizada": "suavizada = 'S'"}),
    CurationSpec(
        source=raw_table(RATE), target=curated_table(RATE),
        columns=(ColumnSpec("data", "data", "date", "dd/MM/yyyy"),
                 ColumnSpec("valor", "taxa_selic_meta_aa", "double")),
        keys=("data",),
        rules={"taxa_preenchida_e_positiva":
               "taxa_selic_meta_aa IS NOT NULL AND taxa_selic_meta_aa > 0"}),
)

CURATION = {spec.target: spec for spec in CURATIONS}

CALENDAR = "dim_calendario"
INDICATORS = "dim_indicador"
EXPECTATIONS = "fct_expectativas_mercado"
COMPARISON = "fct_comparativo_top5"
REAL_RATE = "fct_juro_real_ex_ante"

_REQUIRED = {
    CALENDAR: ("data_sk", "data", "ano"),
    INDICATORS: ("indicador_id", "indicador", "unidade_medida"),
    EXPECTATIONS: ("data_sk", "data", "indicador", "ano_referencia", "mediana"),
    COMPARISON: ("data_sk", "data", "indicador", "ano_referencia", "mediana_mercado", "mediana_top5"),
    REAL_RATE: ("data_sk", "data", "taxa_selic_meta_aa", "ipca_esperado_12m", "taxa_juro_real_ex_ante"),
}
_UNIQUE = {CALENDAR: ("data_sk", "data"), INDICATORS: ("indicador_id", "indicador")}

DATA_TESTS = (
    *(ColumnTest(table, column, "not_null")
      for table, columns in _REQUIRED.items() for column in columns),
    *(ColumnTest(table, column, "unique")
      for table, columns in _UNIQUE.items() for column in columns),
    *(ColumnTest(fact, "data_sk", "relationships", CALENDAR, "data_sk")
      for fact in (EXPECTATIONS, COMPARISON, REAL_RATE)),
)
