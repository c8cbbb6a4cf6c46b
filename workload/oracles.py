"""The registered queries in plain SQL over the given tables."""

from __future__ import annotations

from sondaflow.plans import catalog
from sondaflow.specs import ColumnTest
from workload.means import DIGITS, MEANS

# ------------------------------------------------------------ expressions

def mean(column: str) -> str:
    return f"avg({column})"


def two_digits(value: str) -> str:
    """Rounded from the first fifteen significant digits."""
    return f"CAST(CAST(printf('%.14e', {value}) AS DECIMAL(38,18)) AS DECIMAL(22,2))"


def number_text(value: str) -> str:
    return f"replace(CAST({two_digits(value)} AS VARCHAR), '.', ',')"


def currency_text(value: str) -> str:
    """Digits in groups of three, counted from the comma."""
    plain = f"ltrim({number_text(value)}, '-')"
    grouped = f"ltrim(reverse(regexp_replace(reverse({plain}), '([0-9]{{3}})', '\\1.', 'g')), '.')"
    return f"CASE WHEN {two_digits(value)} < 0 THEN '-' ELSE '' END || 'R$ ' || {grouped}"


def date_key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INT)"


def colour(value: str) -> str:
    return f"CASE WHEN coalesce({value}, 0) >= 0 THEN '#E66C37' ELSE '#A4AAAD' END"


def table_colour(value: str) -> str:
    return (f"CASE WHEN {value} > 0 THEN '#E66C37' WHEN {value} < 0 THEN '#23282B' "
            "ELSE '#8C969A' END")


def newest(source: str, keys: str, measures: str, loaded: str = "loaded, ") -> str:
    order = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in f"{loaded}{measures}".split(","))
    return (f"SELECT * FROM {source} "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1")


# ------------------------------------------------------------------ tables

STATISTICS = "media, mediana, desvio_padrao, minimo, maximo"
LINE_STATISTICS = """
    l_extendedprice + l_tax AS media, l_extendedprice AS mediana, l_discount AS desvio_padrao,
    l_extendedprice - l_quantity AS minimo, l_extendedprice + l_quantity AS maximo"""
LINE_KEYS = """
    CAST(date_trunc('month', l_shipdate) AS DATE) AS data, 'S' || l_suppkey AS indicador,
    CAST(year(l_shipdate) + l_linenumber - 1 AS INT) AS ano_referencia"""
EVENT_INDICATOR = """
    CASE event_type WHEN 'view' THEN 'IPCA' WHEN 'click' THEN 'Selic' WHEN 'error' THEN 'Câmbio'
         WHEN 'purchase' THEN 'PIB Total' WHEN 'signup' THEN 'IPCA 12M Suavizado' END"""
EVENT_YEAR = "2024 + CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) // 20"
EVENT_BASE = "CASE WHEN hour(ts) < 12 THEN 0 ELSE 1 END"
EVENT_STATISTICS = """
    value + CAST(0.25 AS DOUBLE) AS media, value AS mediana, value / 8 AS desvio_padrao,
    value - 1 AS minimo, value + 1 AS maximo"""

SURVEY_KEYS = "data, indicador, indicador_detalhe, ano_referencia, base_calculo"
SURVEY_MEASURES = f"{STATISTICS}, numero_respondentes"
TOP5_KEYS = "data, indicador, ano_referencia, tipo_calculo"
INFLATION_KEYS = "data, indicador, suavizada, base_calculo"

FACT = f"""
    SELECT {date_key('data')} AS data_sk, data, indicador,
           coalesce(indicador_detalhe, 'Geral') AS indicador_detalhe, ano_referencia, base_calculo,
           CASE base_calculo WHEN 0 THEN '30 dias corridos' WHEN 1 THEN '5 dias úteis'
                ELSE 'Outro' END AS base_calculo_desc,
           media, mediana, desvio_padrao, minimo, maximo,
           round(maximo - minimo, 4) AS spread_min_max, numero_respondentes
    FROM {{survey}}"""
COMPARISON = f"""
    SELECT {date_key('m.data')} AS data_sk, m.data, m.indicador, m.ano_referencia,
           m.mediana AS mediana_mercado, t.mediana AS mediana_top5,
           round(t.mediana - m.mediana, 4) AS divergencia_top5_mercado,
           m.desvio_padrao AS desvio_padrao_mercado, t.desvio_padrao AS desvio_padrao_top5,
           m.minimo AS minimo_mercado, m.maximo AS maximo_mercado,
           t.minimo AS minimo_top5, t.maximo AS maximo_top5, m.numero_respondentes,
           CASE WHEN t.mediana > m.mediana THEN 'Top 5 mais alto (Hawkish)'
                WHEN t.mediana < m.mediana THEN 'Top 5 mais baixo (Dovish)'
                ELSE 'Em Consenso' END AS sinal_posicionamento
    FROM {{survey}} m JOIN {{top5}} t
      ON m.data = t.data AND m.indicador = t.indicador AND m.ano_referencia = t.ano_referencia
    WHERE m.base_calculo = 1 AND t.tipo_calculo = 'C'"""

TABLES = {
    "market_raw": f"""
        SELECT {LINE_KEYS}, nullif(l_returnflag, 'N') AS indicador_detalhe,
               CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS base_calculo,
               {LINE_STATISTICS}, CAST(l_quantity AS INT) AS numero_respondentes,
               l_shipdate AS loaded
        FROM lineitem""",
    "market": newest("market_raw", SURVEY_KEYS, SURVEY_MEASURES),
    "panel_raw": f"""
        SELECT {LINE_KEYS}, CASE WHEN l_returnflag = 'R' THEN 'C' ELSE 'M' END AS tipo_calculo,
               {LINE_STATISTICS}, l_shipdate AS loaded
        FROM lineitem""",
    "panel": newest("panel_raw", TOP5_KEYS, STATISTICS),
    "inflation_raw": """
        SELECT CAST(l_shipdate AS DATE) AS data, 'IPCA' AS indicador, 'S' AS suavizada,
               CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS base_calculo,
               l_quantity + l_tax AS media, l_quantity AS mediana, l_discount AS desvio_padrao,
               l_quantity - 1 AS minimo, l_quantity + 1 AS maximo,
               l_linenumber AS numero_respondentes, l_shipdate AS loaded
        FROM lineitem""",
    "inflation": newest("inflation_raw", INFLATION_KEYS, SURVEY_MEASURES),
    "rate_raw": """
        SELECT CAST(o_orderdate AS DATE) AS data,
               round(o_totalprice / CAST(1e4 AS DOUBLE), 2) AS taxa_selic_meta_aa,
               o_orderdate AS loaded
        FROM orders""",
    "rate": newest("rate_raw", "data", "taxa_selic_meta_aa"),
    "news_raw": f"""
        SELECT CAST(ts AS DATE) AS data, {EVENT_INDICATOR} AS indicador,
               CAST(NULL AS VARCHAR) AS indicador_detalhe, CAST({EVENT_YEAR} AS INT) AS ano_referencia,
               {EVENT_BASE} AS base_calculo, {EVENT_STATISTICS},
               CAST(user_id AS INT) AS numero_respondentes, ts AS loaded
        FROM events""",
    "news": newest("news_raw", SURVEY_KEYS, SURVEY_MEASURES),
    "news_panel_raw": f"""
        SELECT CAST(ts AS DATE) AS data, {EVENT_INDICATOR} AS indicador,
               CAST({EVENT_YEAR} AS INT) AS ano_referencia,
               CASE WHEN minute(ts) < 30 THEN 'C' ELSE 'M' END AS tipo_calculo,
               {EVENT_STATISTICS}, ts AS loaded
        FROM events""",
    "news_panel": newest("news_panel_raw", TOP5_KEYS, STATISTICS),
    "flawed": f"""
        SELECT CASE WHEN value < 5 THEN NULL ELSE CAST(ts AS DATE) END AS data,
               nullif({EVENT_INDICATOR}, 'Câmbio') AS indicador,
               CASE WHEN value > 90 THEN NULL ELSE CAST({EVENT_YEAR} AS INT) END AS ano_referencia,
               {EVENT_BASE} AS base_calculo, value + CAST(0.25 AS DOUBLE) AS media, value AS mediana,
               value / 8 AS desvio_padrao, value - 1 AS minimo,
               CASE event_type WHEN 'view' THEN value - CAST(0.5 AS DOUBLE) WHEN 'click' THEN NULL
                    ELSE value + 1 END AS maximo,
               CAST(user_id AS INT) AS numero_respondentes, value AS original
        FROM events""",
    # Records of one load have one load time, so only their measures decide.
    "market_load": newest("market_raw", SURVEY_KEYS, SURVEY_MEASURES, ""),
    "panel_load": newest("panel_raw", TOP5_KEYS, STATISTICS, ""),
    "refreshed_expectations": FACT.format(survey="market_load"),
    "refreshed_comparison": COMPARISON.format(survey="market_load", top5="panel_load"),
    "expectations": FACT.format(survey="market"),
    "news_expectations": FACT.format(survey="news"),
    "comparison": COMPARISON.format(survey="market", top5="panel"),
    "news_comparison": COMPARISON.format(survey="news", top5="news_panel"),
    "real_rate": f"""
        SELECT {date_key('r.data')} AS data_sk, r.data, r.taxa_selic_meta_aa,
               i.mediana AS ipca_esperado_12m, i.desvio_padrao AS desvio_padrao_ipca_12m,
               round(((1 + r.taxa_selic_meta_aa / CAST(100 AS DOUBLE))
                      / (1 + i.mediana / CAST(100 AS DOUBLE)) - 1) * 100, 4)
                   AS taxa_juro_real_ex_ante
        FROM rate r JOIN inflation i ON r.data = i.data
        WHERE i.base_calculo = 1""",
    "calendar": f"""
        SELECT {date_key('d')} AS data_sk, CAST(d AS DATE) AS data, CAST(year(d) AS INT) AS ano,
               CAST(month(d) AS INT) AS mes, CAST(day(d) AS INT) AS dia,
               CAST(quarter(d) AS INT) AS trimestre,
               CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre,
               strftime(d, '%B') AS nome_mes, strftime(d, '%Y-%m') AS ano_mes,
               CAST(dayofweek(d) + 1 AS INT) AS dia_semana_num, strftime(d, '%A') AS dia_semana_nome,
               CASE WHEN dayofweek(d) IN (0, 6) THEN 0 ELSE 1 END AS flg_dia_util_teorico
        FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2035-12-31', INTERVAL 1 DAY)) AS d)""",
    "indicators": """
        SELECT * FROM (VALUES
            (1, 'IPCA', '% a.a.', 'Anual', 'Índice Nacional de Preços ao Consumidor Amplo - Medida oficial de inflação calculada pelo IBGE'),
            (2, 'Selic', '% a.a.', 'Anual', 'Taxa Básica de Juros da economia fixada pelo COPOM (fim de período)'),
            (3, 'Câmbio', 'R$/US$', 'Anual', 'Taxa de câmbio comercial de compra e venda do Dólar americano (fim de período)'),
            (4, 'PIB Total', '% a.a.', 'Anual', 'Taxa de crescimento real do Produto Interno Bruto brasileiro'),
            (5, 'IPCA 12M Suavizado', '% a.a.', '12 Meses', 'Expectativa de inflação acumulada para os próximos 12 meses contínuos')
        ) v(indicador_id, indicador, unidade_medida, periodicidade, descricao)""",
    "series_dimension": """
        SELECT CAST(s_suppkey AS INT) AS indicador_id, 'S' || s_suppkey AS indicador,
               'R$' AS unidade_medida, 'Anual' AS periodicidade, s_name AS descricao
        FROM supplier""",
}

_NEEDS = {
    "market": ["market_raw"], "panel": ["panel_raw"], "inflation": ["inflation_raw"],
    "rate": ["rate_raw"], "news": ["news_raw"], "news_panel": ["news_panel_raw"],
    "expectations": ["market"], "news_expectations": ["news"], "comparison": ["market", "panel"],
    "news_comparison": ["news", "news_panel"], "real_rate": ["rate", "inflation"],
    "market_load": ["market_raw"], "panel_load": ["panel_raw"], "refreshed_expectations": ["market_load"],
    "refreshed_comparison": ["market_load", "panel_load"],
}


def with_tables(body: str, *names: str) -> str:
    """The query with the tables it names, and those they are made of, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = ", ".join(f"{name} AS ({TABLES[name]})" for name in ordered)
    return f"WITH {ctes} {body}" if body.lstrip().startswith("SELECT") else f"WITH {ctes}, {body}"


# ----------------------------------------------------------------- queries

def _metrics(source: str, pairs: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS metric, {value} AS violations FROM {source}"
        for name, value in pairs.items())


def _gate_pairs(conversions: dict[str, str], null_keys: list[str], rule: str) -> dict[str, str]:
    every = ["data", "indicador", "indicador_detalhe", "ano_referencia", "base_calculo", "media",
             "mediana", "desvio_padrao", "minimo", "maximo", "numero_respondentes"]
    pairs = {"rows": "count(*)"}
    pairs |= {f"conversion__{c}": conversions.get(c, "count(*) FILTER (WHERE false)") for c in every}
    pairs |= {f"null_key__{k}": f"count(*) FILTER (WHERE {k} IS NULL)" for k in null_keys}
    pairs["rule__mediana_entre_min_max"] = f"count(*) FILTER (WHERE NOT ({rule}))"
    return pairs


def _highlight(fact: str, series: str, where: str = "") -> str:
    """Daily means, start of the highlight and last date of each series."""
    return f"""
        daily AS (SELECT {series}, data, {mean('mediana')} AS median_market
                  FROM {fact} {where} GROUP BY {series}, data),
        ends AS (SELECT {series}, max(data) AS last_day, min(data) AS first_day
                 FROM daily WHERE median_market IS NOT NULL GROUP BY {series}),
        starts AS (SELECT {series}, any_value(last_day) AS last_day,
                          coalesce(max(data) FILTER (WHERE data <= last_day - 30),
                                   any_value(first_day)) AS highlight_start
                   FROM daily JOIN ends USING ({series})
                   WHERE median_market IS NOT NULL GROUP BY {series}),
        chart AS (SELECT daily.*, highlight_start,
                         CASE WHEN data <= highlight_start THEN median_market END AS median_history,
                         CASE WHEN data >= highlight_start THEN median_market END AS median_recent,
                         CASE WHEN data = last_day THEN median_market END AS last_point
                  FROM daily JOIN starts USING ({series}))"""


def _highlight_rows(series: str) -> str:
    return f"""
        SELECT {series}, data, median_market, highlight_start, median_history, median_recent,
               last_point, {number_text('last_point')} || '%' AS last_percent_label,
               'R$ ' || {number_text('last_point')} AS last_currency_label
        FROM chart"""


def _overview(fact: str, where: str) -> str:
    return f"""{_highlight(fact, 'indicador', where)}
        SELECT indicador, data, median_history, median_recent, last_point,
               CASE WHEN indicador = 'Câmbio' THEN 'R$ ' || {number_text('last_point')}
                    ELSE {number_text('last_point')} || '%' END AS last_label
        FROM chart"""


def _comparison_chart(fact: str, where: str) -> str:
    return f"""
        daily AS (SELECT indicador, data, {mean('mediana_top5')} AS median_top5,
                         {mean('mediana_mercado')} AS comparison_market,
                         {mean('divergencia_top5_mercado')} AS spread
                  FROM {fact} {where} GROUP BY indicador, data),
        ends AS (SELECT indicador, max(data) FILTER (WHERE median_top5 IS NOT NULL) AS top5_day,
                        max(data) FILTER (WHERE comparison_market IS NOT NULL) AS market_day
                 FROM daily GROUP BY indicador),
        chart AS (SELECT daily.*, CASE WHEN data = top5_day THEN median_top5 END AS top5_point,
                         CASE WHEN data = market_day THEN comparison_market END AS market_point
                  FROM daily JOIN ends USING (indicador))
        SELECT *, {number_text('top5_point')} || '%' AS top5_label,
               {number_text('market_point')} || '%' AS market_label
        FROM chart"""


def _rates(where: str) -> str:
    return f"""
        daily AS (SELECT data, {mean('taxa_juro_real_ex_ante')} AS real_rate,
                         {mean('ipca_esperado_12m')} AS inflation,
                         {mean('taxa_selic_meta_aa')} AS policy_rate
                  FROM real_rate {where} GROUP BY data),
        ends AS (SELECT max(data) AS last_day FROM daily)
        SELECT daily.*, CASE WHEN data = last_day THEN real_rate END AS real_rate_point,
               CASE WHEN data = last_day THEN inflation END AS inflation_point,
               CASE WHEN data = last_day THEN policy_rate END AS policy_rate_point
        FROM daily, ends"""


def _last_filled(fact: str, by: str, name: str, where: str = "") -> str:
    return f"""
        ends AS (SELECT {by}, max(data) AS last_day FROM {fact}
                 WHERE mediana IS NOT NULL AND mediana <> 0 GROUP BY {by}),
        cards AS (SELECT {by}, any_value(data) AS data, {mean('mediana')} AS {name}
                  FROM {fact} JOIN ends USING ({by}) WHERE data = last_day {where} GROUP BY {by})"""


def _test_sql(test: ColumnTest, tables: dict[str, str]) -> str:
    table, column = tables[test.table], test.column
    if test.test == "not_null":
        count = f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    elif test.test == "unique":
        count = (f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
                 f"GROUP BY {column} HAVING count(*) > 1)")
    else:
        count = (f"SELECT count(*) FROM {table} c WHERE {column} IS NOT NULL AND NOT EXISTS "
                 f"(SELECT 1 FROM {tables[test.parent]} p WHERE p.{test.parent_column} = c.{column})")
    return (f"SELECT '{test.table}' AS table_name, '{column}' AS column_name, "
            f"'{test.test}' AS test, ({count}) AS failures")


STAR = {catalog.CALENDAR: "calendar", catalog.INDICATORS: "series_dimension",
        catalog.EXPECTATIONS: "expectations", catalog.COMPARISON: "comparison",
        catalog.REAL_RATE: "real_rate"}

PUBLISHED = {**STAR, catalog.INDICATORS: "indicators"}

CONVERTED = {"data": "count(*) FILTER (WHERE data IS NULL)",
             "ano_referencia": "count(*) FILTER (WHERE ano_referencia IS NULL)"}
REQUIRED = ["data", "indicador", "ano_referencia", "base_calculo"]
IN_RANGE = "mediana BETWEEN minimo AND maximo"

LINES_MONTHS = "data BETWEEN DATE '2001-06-01' AND DATE '2001-11-30'"
NEWS_MONTHS = "data BETWEEN DATE '2023-08-01' AND DATE '2024-01-31'"
RATE_MONTHS = "data BETWEEN DATE '2001-02-02' AND DATE '2001-08-01'"

CARD_INDICATORS = (("kpi_ipca", "IPCA"), ("kpi_selic", "Selic"), ("kpi_pib", "PIB Total"), ("kpi_dolar", "Câmbio"))

ORACLES: dict[str, str] = {
    "curated_survey": with_tables(
        "SELECT * EXCLUDE (loaded), loaded AS _bronze_ingestion_timestamp FROM news", "news"),
    "curated_panel": with_tables("SELECT * EXCLUDE (loaded) FROM panel", "panel"),
    "curated_market": with_tables("SELECT * EXCLUDE (loaded) FROM market", "market"),
    "curated_rate": with_tables("SELECT * EXCLUDE (loaded) FROM rate", "rate"),
    "curated_inflation": with_tables("SELECT * EXCLUDE (loaded) FROM inflation", "inflation"),
    "typed_flawed_survey": with_tables(
        "SELECT data, indicador, ano_referencia, mediana, maximo, numero_respondentes FROM flawed",
        "flawed"),
    "gate_metrics": with_tables(
        _metrics("flawed", _gate_pairs(CONVERTED, REQUIRED, IN_RANGE)), "flawed"),
    "gate_metrics_clean": with_tables(
        _metrics("market_raw", _gate_pairs({}, REQUIRED, IN_RANGE)), "market_raw"),
    "duplicate_keys": with_tables(f"""
        SELECT count(*) AS rows, max(data) AS newest,
               count(*) FILTER (WHERE data IS NULL) AS unreadable_dates,
               count(*) - (SELECT count(*) FROM (SELECT DISTINCT {SURVEY_KEYS} FROM market_raw))
                   AS duplicates
        FROM market_raw""", "market_raw"),
    "freshness_gate": " UNION ALL ".join(
        f"""SELECT '{name}' AS source, count(*) AS rows, max(CAST({day} AS DATE)) AS newest,
                   CAST(DATE '2024-01-31' - max(CAST({day} AS DATE)) AS INT) AS age_days,
                   DATE '2024-01-31' - max(CAST({day} AS DATE)) <= 30 AS fresh FROM {table}"""
        for name, table, day in ((catalog.SURVEY, "events", "ts"), (catalog.TOP5, "events", "ts"),
                                 (catalog.RATE, "orders", "o_orderdate"))),
    "volume_gate": """
        SELECT count(*) FILTER (WHERE l_linestatus = 'O') AS new_rows, count(*) AS current_rows,
               count(*) FILTER (WHERE l_linestatus = 'O') >= 0.9 * count(*) AS enough
        FROM lineitem""",
    "calendar_coverage": with_tables("""
        per_day AS (SELECT CAST(o_orderdate AS DATE) AS data, count(*) AS n FROM orders GROUP BY 1)
        SELECT calendar.*, coalesce(n, 0) AS n_orders FROM calendar LEFT JOIN per_day USING (data)""",
        "calendar"),
    "calendar_rollup": with_tables("""
        SELECT ano, trimestre, semestre, nome_mes, dia_semana_nome, flg_dia_util_teorico,
               count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
        FROM lineitem LEFT JOIN calendar ON CAST(l_shipdate AS DATE) = data
        GROUP BY ALL""", "calendar"),
    "indicator_profile": with_tables("""
        per_indicator AS (SELECT indicador, count(*) AS n_rows, count(DISTINCT ano_referencia) AS n_years
                          FROM news_raw GROUP BY 1)
        SELECT * FROM indicators LEFT JOIN per_indicator USING (indicador)""",
        "indicators", "news_raw"),
    "fact_expectations": with_tables("SELECT * FROM expectations", "expectations"),
    "fact_market_vs_top5": with_tables("SELECT * FROM comparison", "comparison"),
    "fact_market_vs_top5_news": with_tables("SELECT * FROM news_comparison", "news_comparison"),
    "fact_real_rate": with_tables("SELECT * FROM real_rate", "real_rate"),
    "join_fan_out": with_tables("""
        per_key AS (SELECT data, indicador, ano_referencia, count(*) AS n FROM market
                    WHERE base_calculo = 1 GROUP BY ALL)
        SELECT count(*) FILTER (WHERE n > 1) AS keys_with_details,
               CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows FROM per_key""", "market"),
    "newest_comparison_rows": with_tables("""
        SELECT * FROM comparison ORDER BY data DESC, indicador, ano_referencia, mediana_mercado,
               mediana_top5, numero_respondentes, desvio_padrao_mercado LIMIT 10""", "comparison"),
    "newest_rate_rows": with_tables(
        "SELECT * FROM real_rate ORDER BY data DESC LIMIT 10", "real_rate"),
    "newest_expectation_rows": with_tables("""
        SELECT * FROM expectations
        ORDER BY data DESC, indicador, indicador_detalhe, ano_referencia, base_calculo LIMIT 10""",
        "expectations"),
    "test_not_null": with_tables(" UNION ALL ".join(
        f"""SELECT 'survey' AS table_name, '{c}' AS column_name, 'not_null' AS test,
                   count(*) FILTER (WHERE {c} IS NULL) AS failures FROM flawed"""
        for c in ("data", "indicador", "ano_referencia", "mediana")), "flawed"),
    "test_unique": """
        SELECT l_orderkey, count(*) AS rows FROM lineitem WHERE l_orderkey IS NOT NULL
        GROUP BY 1 HAVING count(*) > 1""",
    "test_relationships": """
        SELECT 'events' AS table_name, user_id AS orphan, count(*) AS rows FROM events
        WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id)
        GROUP BY user_id
        UNION ALL
        SELECT 'lineitem', l_partkey, count(*) FROM lineitem
        WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = l_partkey)
        GROUP BY l_partkey""",
    "data_tests": with_tables(
        " UNION ALL ".join(_test_sql(t, STAR) for t in catalog.DATA_TESTS), *STAR.values()),
    "median_by_series": with_tables(f"""
        SELECT indicador, ano_referencia, {mean('mediana')} AS median_market
        FROM expectations GROUP BY ALL""", "expectations"),
    "median_by_quarter": with_tables(f"""
        SELECT c.ano, c.trimestre, {mean('f.mediana')} AS median_market
        FROM expectations f JOIN calendar c USING (data_sk) JOIN series_dimension i
          ON f.indicador = i.indicador
        WHERE c.flg_dia_util_teorico = 1 AND i.indicador_id > 1
        GROUP BY ALL""", "expectations", "calendar", "series_dimension"),
    "top5_by_series": with_tables(f"""
        SELECT indicador, ano_referencia, {mean('mediana_top5')} AS median_top5,
               {mean('mediana_mercado')} AS comparison_market,
               {mean('divergencia_top5_mercado')} AS spread
        FROM comparison GROUP BY ALL""", "comparison"),
    "cross_fact_divergence": with_tables(f"""
        m AS (SELECT indicador, ano, semestre, {mean('mediana')} AS market
              FROM expectations JOIN calendar USING (data_sk) GROUP BY ALL),
        t AS (SELECT indicador, ano, semestre, {mean('mediana_top5')} AS top5
              FROM comparison JOIN calendar USING (data_sk) GROUP BY ALL)
        SELECT indicador, ano, semestre,
               CASE WHEN top5 IS NOT NULL OR market IS NOT NULL
                    THEN coalesce(top5, 0) - coalesce(market, 0) END AS divergence
        FROM t FULL JOIN m USING (indicador, ano, semestre)""",
        "expectations", "comparison", "calendar"),
    "measure_set_by_quarter": with_tables(f"""
        e AS (SELECT ano, trimestre, {mean('mediana')} AS median_market, max(data) AS last_survey_date
              FROM expectations JOIN calendar USING (data_sk, data) GROUP BY ALL),
        c AS (SELECT ano, trimestre, {mean('mediana_top5')} AS median_top5, {mean('divergencia_top5_mercado')} AS spread,
                     avg(mediana_top5) FILTER (WHERE data = (SELECT max(data) FROM comparison)) AS top5_last_date
              FROM comparison JOIN calendar USING (data_sk, data) GROUP BY ALL),
        r AS (SELECT ano, trimestre, {mean('taxa_juro_real_ex_ante')} AS real_rate_history,
                     CASE WHEN count(DISTINCT taxa_selic_meta_aa) = 1 AND count(taxa_selic_meta_aa) = count(*)
                          THEN max(taxa_selic_meta_aa) END AS policy_rate,
                     avg(taxa_juro_real_ex_ante) FILTER (WHERE data = (SELECT max(data) FROM real_rate)) AS kpi_real_rate
              FROM real_rate JOIN calendar USING (data_sk, data) GROUP BY ALL)
        SELECT ano, trimestre, median_market, median_top5,
               CASE WHEN median_top5 IS NOT NULL OR median_market IS NOT NULL
                    THEN coalesce(median_top5, 0) - coalesce(median_market, 0) END AS divergence,
               spread, {colour('spread')} AS divergence_colour, real_rate_history, policy_rate, top5_last_date,
               last_survey_date, kpi_real_rate
        FROM e FULL JOIN c USING (ano, trimestre) FULL JOIN r USING (ano, trimestre)""",
        "expectations", "comparison", "real_rate", "calendar"),
    "calendar_free_by_month": with_tables(f"""
        months AS (SELECT DISTINCT ano_mes FROM calendar WHERE ano = 2024),
        m AS (SELECT ano_mes, {mean('mediana')} AS median_market, max(data) AS last_survey_date
              FROM news_expectations JOIN calendar USING (data_sk, data) WHERE ano = 2024 GROUP BY ALL),
        survey AS (SELECT * FROM news_expectations WHERE indicador = 'IPCA' AND ano_referencia = 2025 AND base_calculo = 0),
        top AS (SELECT * FROM news_comparison WHERE indicador = 'IPCA' AND ano_referencia = 2025)
        SELECT ano_mes, (SELECT {mean('mediana')} FROM survey
                         WHERE data = (SELECT max(data) FROM survey WHERE mediana <> 0)) AS kpi_ipca,
               (SELECT {mean('divergencia_top5_mercado')} FROM top WHERE data = (SELECT max(data) FROM top))
                   AS kpi_divergence_ipca, last_survey_date, median_market
        FROM months LEFT JOIN m USING (ano_mes)""", "news_expectations", "news_comparison", "calendar"),
    "newest_dates_by_day": with_tables("""
        n AS (SELECT indicador, ano_mes, max(data) AS last_survey_date
              FROM news_expectations JOIN calendar USING (data_sk, data) WHERE ano = 2024 GROUP BY ALL)
        SELECT indicador, ano_mes, data, last_survey_date FROM n JOIN calendar USING (ano_mes)
        WHERE data <= DATE '2024-02-10'""", "news_expectations", "calendar"),
    "divergence_by_signal": with_tables(f"""
        m AS (SELECT indicador, {mean('mediana')} AS market FROM expectations GROUP BY ALL),
        signals AS (SELECT DISTINCT sinal_posicionamento FROM comparison),
        t AS (SELECT indicador, sinal_posicionamento, {mean('mediana_top5')} AS top5 FROM comparison GROUP BY ALL),
        groups AS (SELECT indicador, sinal_posicionamento FROM m CROSS JOIN signals
                   UNION SELECT indicador, sinal_posicionamento FROM t)
        SELECT indicador, sinal_posicionamento, coalesce(top5, 0) - coalesce(market, 0) AS divergence
        FROM groups LEFT JOIN m USING (indicador) LEFT JOIN t USING (indicador, sinal_posicionamento)
        WHERE top5 IS NOT NULL OR market IS NOT NULL""", "expectations", "comparison"),
    "divergence_by_owned_year": with_tables(f"""
        m AS (SELECT indicador, {mean('mediana')} AS median_market FROM news_expectations GROUP BY ALL),
        years AS (SELECT DISTINCT ano_referencia FROM news_comparison),
        t AS (SELECT indicador, ano_referencia, {mean('mediana_top5')} AS median_top5 FROM news_comparison GROUP BY ALL),
        groups AS (SELECT indicador, ano_referencia FROM m CROSS JOIN years UNION SELECT indicador, ano_referencia FROM t)
        SELECT indicador, ano_referencia, median_market, median_top5,
               coalesce(median_top5, 0) - coalesce(median_market, 0) AS divergence
        FROM groups LEFT JOIN m USING (indicador) LEFT JOIN t USING (indicador, ano_referencia)
        WHERE median_top5 IS NOT NULL OR median_market IS NOT NULL""", "news_expectations", "news_comparison"),
    "single_values": with_tables("""
        SELECT indicador, data, ano_referencia,
               CASE WHEN count(DISTINCT mediana) = 1 AND count(mediana) = count(*)
                    THEN max(mediana) END AS single_median,
               CASE WHEN count(DISTINCT base_calculo) = 1 AND count(base_calculo) = count(*)
                    THEN max(base_calculo) END AS single_base
        FROM expectations GROUP BY ALL""", "expectations"),
    "single_rates": with_tables("""
        SELECT ano_mes, dia_semana_nome,
               CASE WHEN count(DISTINCT taxa_juro_real_ex_ante) = 1 THEN max(taxa_juro_real_ex_ante) END
                   AS real_rate,
               CASE WHEN count(DISTINCT taxa_selic_meta_aa) = 1 THEN max(taxa_selic_meta_aa) END
                   AS policy_rate
        FROM real_rate JOIN calendar USING (data_sk) GROUP BY ALL""", "real_rate", "calendar"),
    "highlight_series": with_tables(
        f"{_highlight('expectations', 'indicador')} {_highlight_rows('indicador')}", "expectations"),
    "highlight_news": with_tables(
        f"{_highlight('news_expectations', 'indicador, ano_referencia, base_calculo')} "
        f"{_highlight_rows('indicador, ano_referencia, base_calculo')}", "news_expectations"),
    "last_survey_date": with_tables("""
        SELECT indicador, max(data) AS last_survey_date FROM expectations
        WHERE year(data) <= 2000 GROUP BY 1""", "expectations"),
    "kpi_last_median": with_tables(f"""
        {_last_filled('expectations', 'indicador, ano_referencia, base_calculo', 'kpi_last_median')}
        SELECT * EXCLUDE (data) FROM cards""", "expectations"),
    "measure_cards": with_tables(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS measure,
                       (SELECT {mean('mediana')} FROM news_expectations
                        WHERE {where} AND data = (SELECT max(data) FROM news_expectations
                                                  WHERE {where} AND mediana <> 0)) AS value"""
            for name, where in (
                (name, f"indicador = '{indicator}' AND ano_referencia = 2026 AND base_calculo = 0")
                for name, indicator in (("kpi_ipca", "IPCA"), ("kpi_selic", "Selic"),
                                        ("kpi_pib", "PIB Total"), ("kpi_dolar", "Câmbio"))))
        + " UNION ALL " + " UNION ALL ".join(
            f"""SELECT '{name}',
                       (SELECT {mean('divergencia_top5_mercado')} FROM news_comparison
                        WHERE {where} AND data = (SELECT max(data) FROM news_comparison
                                                  WHERE {where}))"""
            for name, where in (
                (name, f"indicador = '{indicator}' AND ano_referencia = 2026")
                for name, indicator in (("kpi_divergence_ipca", "IPCA"),
                                        ("kpi_divergence_selic", "Selic"))))
        + " UNION ALL " + " UNION ALL ".join(
            f"""SELECT '{name}', (SELECT {mean(column)} FROM real_rate
                        WHERE data = (SELECT max(data) FROM real_rate))"""
            for name, column in (("kpi_policy_rate", "taxa_selic_meta_aa"),
                                 ("kpi_inflation", "ipca_esperado_12m"),
                                 ("kpi_real_rate", "taxa_juro_real_ex_ante"))),
        "news_expectations", "news_comparison", "real_rate"),
    "cards_in_conflict": with_tables(f"""
        cards AS (SELECT {", ".join(f"""
            (SELECT avg(mediana) FROM news_expectations WHERE indicador = '{i}' AND ano_referencia = 2025
               AND base_calculo = 0 AND data = (
                 SELECT max(data) FROM news_expectations WHERE indicador = '{i}' AND ano_referencia = 2025
                    AND base_calculo = 0 AND mediana <> 0)) AS {n}""" for n, i in CARD_INDICATORS)}),
        years AS (SELECT DISTINCT ano_referencia, base_calculo FROM news_expectations)
        SELECT 'filtered' AS context, CAST(NULL AS INT) AS ano_referencia, * FROM cards
        UNION ALL SELECT 'grouped', ano_referencia, cards.* FROM (SELECT DISTINCT ano_referencia FROM years), cards
        UNION ALL SELECT 'both', ano_referencia, cards.* FROM years, cards
                  WHERE ano_referencia = 2027 AND base_calculo = 0""", "news_expectations"),
    "divergence_cards_by_signal": with_tables(f"""
        chosen AS (SELECT * FROM news_comparison WHERE ano_referencia = 2026 AND indicador IN ('IPCA', 'Selic')),
        ends AS (SELECT sinal_posicionamento, indicador, max(data) AS last_day FROM chosen GROUP BY ALL),
        means AS (SELECT sinal_posicionamento, indicador, avg(divergencia_top5_mercado) AS v
                  FROM chosen JOIN ends USING (sinal_posicionamento, indicador) WHERE data = last_day GROUP BY ALL),
        cards AS (SELECT sinal_posicionamento, max(v) FILTER (WHERE indicador = 'IPCA') AS kpi_divergence_ipca,
                         max(v) FILTER (WHERE indicador = 'Selic') AS kpi_divergence_selic FROM means GROUP BY 1)
        SELECT DISTINCT ano_referencia, sinal_posicionamento, kpi_divergence_ipca, kpi_divergence_selic
        FROM news_comparison JOIN cards USING (sinal_posicionamento)""", "news_comparison"),
    "rates_by_policy_rate": with_tables("""
        ends AS (SELECT taxa_selic_meta_aa, max(data) AS last_day FROM real_rate GROUP BY 1)
        SELECT taxa_selic_meta_aa, avg(taxa_selic_meta_aa) AS kpi_policy_rate, avg(ipca_esperado_12m) AS kpi_inflation,
               avg(taxa_juro_real_ex_ante) AS kpi_real_rate
        FROM real_rate JOIN ends USING (taxa_selic_meta_aa) WHERE data = last_day GROUP BY 1""", "real_rate"),
    "rates_by_year": with_tables("""
        SELECT CAST(year(data) AS INT) AS ano, avg(taxa_selic_meta_aa) AS kpi_policy_rate,
               avg(ipca_esperado_12m) AS kpi_inflation, avg(taxa_juro_real_ex_ante) AS kpi_real_rate
        FROM real_rate WHERE data = (SELECT max(data) FROM real_rate) GROUP BY 1""", "real_rate"),
    "medians_by_unit": with_tables("""
        m AS (SELECT unidade_medida, periodicidade, avg(mediana) AS median_market
              FROM news_expectations JOIN indicators USING (indicador) GROUP BY ALL),
        t AS (SELECT unidade_medida, periodicidade, avg(mediana_top5) AS top5
              FROM news_comparison JOIN indicators USING (indicador) GROUP BY ALL)
        SELECT unidade_medida, periodicidade, median_market,
               coalesce(top5, 0) - coalesce(median_market, 0) AS divergence
        FROM m LEFT JOIN t USING (unidade_medida, periodicidade)""",
        "news_expectations", "news_comparison", "indicators"),
    "precise_means": """
        SELECT o_orderpriority, avg(o_totalprice / CAST(7e9 AS DOUBLE)) AS mean_small,
               avg(o_totalprice * CAST(1e11 AS DOUBLE)) AS mean_large FROM orders GROUP BY 1""",
    "label_texts": f"""
        WITH v AS (SELECT l_orderkey, l_linenumber, l_extendedprice * pow(CAST(10 AS DOUBLE), l_linenumber - 5)
                          * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS x FROM lineitem)
        SELECT l_orderkey, l_linenumber, {number_text('x')} || '%' AS percent, {currency_text('x')} AS currency,
               CASE WHEN {two_digits('x / CAST(1e4 AS DOUBLE)')} > 0 THEN '+' ELSE '' END
                 || {number_text('x / CAST(1e4 AS DOUBLE)')} || ' p.p.' AS points FROM v""",
    "news_points": with_tables(f"""
        daily AS (SELECT indicador, ano_referencia, data, avg(mediana) AS m FROM news_expectations GROUP BY ALL),
        ends AS (SELECT indicador, ano_referencia, max(data) AS last_day FROM daily WHERE m IS NOT NULL GROUP BY ALL),
        points AS (SELECT indicador, ano_referencia, data, CASE WHEN data = last_day THEN m END AS last_point
                   FROM daily JOIN ends USING (indicador, ano_referencia))
        SELECT *, {number_text('last_point')} || '%' AS last_percent_label,
               'R$ ' || {number_text('last_point')} AS last_currency_label FROM points""", "news_expectations"),
    "highlight_parts": with_tables(f"""
        {_highlight('expectations', 'indicador')}
        SELECT indicador, data, highlight_start, median_history, median_recent FROM chart""", "expectations"),
    "comparison_means": with_tables(f"""
        means AS (SELECT indicador, CAST(year(data) AS INT) AS ano, avg(mediana_top5) AS median_top5,
                         avg(mediana_mercado) AS comparison_market, avg(divergencia_top5_mercado) AS spread
                  FROM comparison GROUP BY ALL)
        SELECT *, {colour('spread')} AS divergence_colour FROM means""", "comparison"),
    "comparison_points": with_tables(
        _comparison_chart("comparison", "").rstrip().removesuffix("FROM chart")
        .replace("SELECT *,", "SELECT indicador, data, top5_point, market_point,") + " FROM chart", "comparison"),
    "last_date_means": with_tables("""
        SELECT indicador, ano_referencia, avg(mediana_mercado) AS market_last_date, avg(mediana_top5) AS top5_last_date,
               avg(divergencia_top5_mercado) AS divergence_last_date
        FROM comparison WHERE data = (SELECT max(data) FROM comparison) GROUP BY ALL""", "comparison"),
    "rate_histories": with_tables("""
        SELECT CAST(year(data) AS INT) AS ano, CAST(month(data) AS INT) AS mes,
               avg(taxa_juro_real_ex_ante) AS real_rate_history, avg(taxa_selic_meta_aa) AS policy_rate_history,
               avg(ipca_esperado_12m) AS inflation_history FROM real_rate GROUP BY ALL""", "real_rate"),
    "rate_points": with_tables(
        _rates("").replace("SELECT daily.*,", "SELECT daily.data,"), "real_rate"),
    "divergence_signs": with_tables(f"""
        signs AS (SELECT indicador, ano_referencia, {mean('divergencia_top5_mercado')} AS spread
                  FROM comparison GROUP BY ALL)
        SELECT *, {colour('spread')} AS divergence_colour FROM signs""", "comparison"),
    "kpi_divergence": with_tables(f"""
        ends AS (SELECT indicador, ano_referencia, max(data) AS last_day FROM comparison GROUP BY ALL)
        SELECT indicador, ano_referencia, any_value(data) AS data,
               {mean('divergencia_top5_mercado')} AS kpi_divergence
        FROM comparison JOIN ends USING (indicador, ano_referencia)
        WHERE data = last_day GROUP BY indicador, ano_referencia""", "comparison"),
    "last_date_colours": with_tables(f"""
        last_day AS (SELECT max(data) AS day FROM comparison),
        signs AS (SELECT indicador, avg(divergencia_top5_mercado) FILTER (WHERE data = day) AS total
                  FROM comparison, last_day GROUP BY 1)
        SELECT indicador, {table_colour('total')} AS table_colour FROM signs""", "comparison"),
    "last_date_divergence": with_tables(f"""
        SELECT indicador, ano_referencia, {mean('divergencia_top5_mercado')} AS divergence_last_date
        FROM comparison WHERE data = (SELECT max(data) FROM comparison) GROUP BY ALL""", "comparison"),
    "rate_kpis_in_context": with_tables(f"""
        SELECT 'until 1999' AS context, {mean('taxa_juro_real_ex_ante')} AS kpi_real_rate
        FROM real_rate
        WHERE data <= DATE '1999-12-31' AND data = (SELECT max(data) FROM real_rate)
        UNION ALL
        SELECT 'since 2000', {mean('taxa_juro_real_ex_ante')} FROM real_rate
        WHERE year(data) >= 2000 AND data = (SELECT max(data) FROM real_rate)""", "real_rate"),
    "rate_series": with_tables(_rates(""), "real_rate"),
    "report_overview_charts": with_tables(_overview(
        "expectations", f"WHERE ano_referencia = 2002 AND base_calculo = 0 AND {LINES_MONTHS}"),
        "expectations"),
    "report_overview_charts_news": with_tables(_overview(
        "news_expectations",
        "WHERE indicador IN ('IPCA', 'Selic', 'PIB Total', 'Câmbio') AND ano_referencia = 2026 "
        f"AND base_calculo = 0 AND {NEWS_MONTHS}"), "news_expectations"),
    "report_overview_cards": with_tables(f"""
        chosen AS (SELECT * FROM news_expectations
                   WHERE indicador IN ('IPCA', 'Selic', 'PIB Total', 'Câmbio')
                     AND ano_referencia = 2026 AND base_calculo = 0),
        {_last_filled('chosen', 'indicador', 'last_median')}
        SELECT *, CASE WHEN indicador = 'Câmbio'
                       THEN 'R$ ' || translate(format('{{:,.2f}}', CAST({two_digits('last_median')} AS DOUBLE)), '.,', ',.')
                       ELSE {number_text('last_median')} || '%' END AS card_text
        FROM cards""", "news_expectations"),
    "report_comparison_charts": with_tables(_comparison_chart(
        "comparison", f"WHERE ano_referencia = 2002 AND {LINES_MONTHS}"), "comparison"),
    "report_comparison_charts_news": with_tables(_comparison_chart(
        "news_comparison",
        f"WHERE indicador IN ('IPCA', 'Selic') AND ano_referencia = 2026 AND {NEWS_MONTHS}"),
        "news_comparison"),
    "report_divergence_columns": with_tables(f"""
        daily AS (SELECT indicador, data, {mean('divergencia_top5_mercado')} AS spread
                  FROM news_comparison
                  WHERE indicador = 'IPCA' AND ano_referencia = 2026 AND {NEWS_MONTHS} GROUP BY ALL)
        SELECT *, {colour('spread')} AS divergence_colour FROM daily""", "news_comparison"),
    "report_comparison_table": with_tables(f"""
        latest AS (SELECT indicador, ano_referencia, sinal_posicionamento,
                          {mean('mediana_mercado')} AS market_last_date,
                          {mean('mediana_top5')} AS top5_last_date,
                          {mean('divergencia_top5_mercado')} AS divergence_last_date
                   FROM comparison WHERE data = (SELECT max(data) FROM comparison) GROUP BY ALL)
        SELECT *, {table_colour('divergence_last_date')} AS table_colour FROM latest""", "comparison"),
    "report_divergence_cards": with_tables(f"""
        chosen AS (SELECT * FROM news_comparison
                   WHERE indicador IN ('IPCA', 'Selic') AND ano_referencia = 2026),
        ends AS (SELECT indicador, max(data) AS last_day FROM chosen GROUP BY 1),
        cards AS (SELECT indicador, any_value(data) AS data,
                         {mean('divergencia_top5_mercado')} AS kpi_divergence
                  FROM chosen JOIN ends USING (indicador) WHERE data = last_day GROUP BY indicador)
        SELECT *, CASE WHEN {two_digits('kpi_divergence')} > 0 THEN '+' ELSE '' END
                  || {number_text('kpi_divergence')} || ' p.p.' AS card_text
        FROM cards""", "news_comparison"),
    "report_rate_charts": with_tables(_rates(f"WHERE {RATE_MONTHS}"), "real_rate"),
    "report_rate_cards": with_tables(f"""
        cards AS (SELECT {mean('taxa_juro_real_ex_ante')} AS kpi_real_rate,
                         {mean('ipca_esperado_12m')} AS kpi_inflation,
                         {mean('taxa_selic_meta_aa')} AS kpi_policy_rate
                  FROM real_rate WHERE data = (SELECT max(data) FROM real_rate))
        SELECT *, {number_text('kpi_real_rate')} || '%' AS text_real_rate,
               {number_text('kpi_inflation')} || '%' AS text_inflation,
               {number_text('kpi_policy_rate')} || '%' AS text_policy_rate
        FROM cards""", "real_rate"),
    "report_latest_observation": with_tables("""
        SELECT 'Data da observação mais recente: ' || translate(strftime(coalesce(
                   (SELECT max(data) FROM real_rate), (SELECT max(data) FROM comparison),
                   (SELECT max(data) FROM expectations)), '%d/%m/%Y'),
                   '0123456789', '𝟬𝟭𝟮𝟯𝟰𝟱𝟲𝟳𝟴𝟵') AS latest_text""",
        "real_rate", "comparison", "expectations"),
    "landed_survey": f"""
        SELECT strftime(ts, '%Y-%m-%d') AS "Data", {EVENT_INDICATOR} AS "Indicador",
               CAST(NULL AS VARCHAR) AS "IndicadorDetalhe",
               CAST({EVENT_YEAR} AS VARCHAR) AS "DataReferencia",
               CAST({EVENT_BASE} AS BIGINT) AS "baseCalculo",
               value + CAST(0.25 AS DOUBLE) AS "Media", value AS "Mediana",
               value / 8 AS "DesvioPadrao", value - 1 AS "Minimo", value + 1 AS "Maximo",
               user_id AS "numeroRespondentes"
        FROM events""",
    "page_layout": """
        SELECT event_id // 1000 AS page, count(*) AS n_rows, min(event_id) AS first_id,
               max(event_id) AS last_id FROM events GROUP BY 1""",
    "window_counts": """
        WITH ends AS (SELECT CAST(min(l_shipdate) AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b FROM lineitem),
        windows AS (
            SELECT CAST(d AS DATE) AS first_day, least(CAST(d AS DATE) + 364, b) AS last_day
            FROM (SELECT unnest(generate_series(a, b, INTERVAL 365 DAY)) AS d, b FROM ends))
        SELECT first_day, last_day, count(l_shipdate) AS n_lines
        FROM windows LEFT JOIN lineitem
          ON CAST(l_shipdate AS DATE) BETWEEN first_day AND last_day GROUP BY ALL""",
    "paged_events": "SELECT event_id, user_id, event_type, value FROM events",
    "windowed_orders": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders",
    "replaced_and_widened": """
        SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'O'""",
    "refused_loads": f"""
        WITH n AS (SELECT count(*) AS all_rows, count(*) FILTER (WHERE {EVENT_BASE} = 0) AS half FROM events
                   WHERE event_type IN ('view', 'click', 'error', 'purchase')),
        told AS (SELECT 1 AS k, 'empty' AS tabela, 'GateError: the source returned no record' AS erro
                 UNION ALL SELECT 2, 'short', 'GateError: volume drop: ' || half || ' new rows against ' || all_rows
                                             || ' published' FROM n
                 UNION ALL SELECT 3, 'narrow', 'GateError: columns missing in the source: [''Media'']')
        SELECT tabela, erro FROM told
        UNION ALL SELECT 'batch', '3 table(s) failed: ' || string_agg(tabela || ' -> ' || erro, '; ' ORDER BY k) FROM told
        UNION ALL SELECT tabela, all_rows || ' rows' FROM told, n""",
    "refused_curation": """
        SELECT 'silver_expectativas_anuais' AS tabela, 'ERRO' AS status, CAST(0 AS BIGINT) AS registros_lidos,
               CAST(0 AS BIGINT) AS registros_gravados, CAST(0 AS BIGINT) AS duplicatas_removidas,
               'GateError: columns missing in bronze_expectativas_anuais: [''Maximo'', ''Minimo'']' AS erro""",
    "refreshed_expectations": with_tables("SELECT * FROM refreshed_expectations", "refreshed_expectations"),
    "refreshed_comparison": with_tables("SELECT * FROM refreshed_comparison", "refreshed_comparison"),
    "refreshed_rates": with_tables("SELECT * FROM real_rate", "real_rate"),
    "refreshed_tests": with_tables(
        " UNION ALL ".join(_test_sql(t, PUBLISHED) for t in catalog.DATA_TESTS), *PUBLISHED.values()),
    "load_audit": """
        SELECT 'bronze_expectativas_anuais' AS tabela, 'OK' AS status, count(*) AS registros,
               14 AS colunas, max(CAST(ts AS DATE)) AS data_max, NULL AS erro
        FROM events WHERE event_type IN ('view', 'click', 'error', 'purchase')
        UNION ALL
        SELECT 'bronze_top5_anuais', 'OK', count(*), 12, max(CAST(ts AS DATE)), NULL FROM events
        WHERE event_type IN ('view', 'click', 'error') AND minute(ts) < 30
        UNION ALL
        SELECT 'bronze_inflacao_12m', 'OK', count(*), 13, max(CAST(l_shipdate AS DATE)), NULL
        FROM lineitem
        UNION ALL
        SELECT 'bronze_meta_selic', 'ERRO', 0, 0, NULL,
               'GateError: stale data: newest date ' || max(CAST(o_orderdate AS DATE)) || ' is '
               || (DATE '2024-01-31' - max(CAST(o_orderdate AS DATE))) || ' days old'
        FROM orders""",
    "resumed_load": """
        SELECT 'bronze_expectativas_anuais' AS tabela, 'OK' AS status, count(*) AS registros, TRUE AS "before"
        FROM events WHERE event_type IN ('view', 'click', 'error', 'purchase')
        UNION ALL
        SELECT 'bronze_top5_anuais', 'OK', count(*), TRUE FROM events
        WHERE event_type IN ('view', 'click', 'error') AND minute(ts) < 30
        UNION ALL
        SELECT 'bronze_inflacao_12m', 'OK', count(*), FALSE FROM lineitem""",
    "curation_audit": with_tables(f"""
        counted AS ({" UNION ALL ".join(
            f"SELECT {k} AS k, '{n}' AS metric, {v} AS violations FROM flawed" for k, (n, v) in enumerate(
                list(_gate_pairs(CONVERTED, REQUIRED, IN_RANGE).items())[1:]))})
        SELECT 'silver_expectativas_anuais' AS tabela, 'ERRO' AS status,
               CAST(0 AS BIGINT) AS registros_lidos, CAST(0 AS BIGINT) AS registros_gravados,
               CAST(0 AS BIGINT) AS duplicatas_removidas,
               'GateError: quality gate failed: {{' || (SELECT string_agg('''' || metric || ''': ' || violations, ', ' ORDER BY k)
                   FROM counted WHERE violations > 0) || '}}' AS erro
        UNION ALL
        SELECT 'silver_top5_anuais', 'OK', (SELECT count(*) FROM panel_raw),
               (SELECT count(*) FROM panel),
               (SELECT count(*) FROM panel_raw) - (SELECT count(*) FROM panel), NULL
        UNION ALL
        SELECT 'silver_inflacao_12m', 'OK', (SELECT count(*) FROM inflation_raw),
               (SELECT count(*) FROM inflation),
               (SELECT count(*) FROM inflation_raw) - (SELECT count(*) FROM inflation), NULL
        UNION ALL
        SELECT 'silver_meta_selic', 'OK', (SELECT count(*) FROM rate_raw),
               (SELECT count(*) FROM rate),
               (SELECT count(*) FROM rate_raw) - (SELECT count(*) FROM rate), NULL""",
        "flawed", "panel", "inflation", "rate"),
    "refreshed_tables": with_tables("""
        SELECT 'fct_expectativas_mercado' AS table_name, count(*) AS n_rows FROM expectations
        UNION ALL SELECT 'fct_comparativo_top5', count(*) FROM comparison
        UNION ALL SELECT 'fct_juro_real_ex_ante', count(*) FROM real_rate""",
        "expectations", "comparison", "real_rate"),
}

for _name, _columns in MEANS.items():
    _digits = ", ".join(f"{c} * CAST({DIGITS} AS DOUBLE) - ({c} * CAST({DIGITS} AS DOUBLE) - {c}) AS {c}" for c in _columns)
    ORACLES[_name] = f"SELECT * REPLACE ({_digits}) FROM ({ORACLES[_name]})"
