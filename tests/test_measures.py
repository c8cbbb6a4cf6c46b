import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from sondaflow import reports
from sondaflow.measures import shapes
from sondaflow.measures.catalogue import LATEST_PREFIX, MEASURES, Cards, measure, measures
from sondaflow.measures.context import Context, Star
from sondaflow.operators import dims

EXPECTATIONS = ("data_sk int, data date, indicador string, ano_referencia int, base_calculo int, "
                "mediana double")
COMPARISON = ("data_sk int, data date, indicador string, ano_referencia int, mediana_mercado double, "
              "mediana_top5 double, divergencia_top5_mercado double, sinal_posicionamento string")
RATES = ("data_sk int, data date, taxa_selic_meta_aa double, ipca_esperado_12m double, "
         "taxa_juro_real_ex_ante double")
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 15), date(2024, 2, 20)


def key(day):
    return day.year * 10000 + day.month * 100 + day.day


def star_of(spark, expectations=(), comparison=(), rates=()):
    return Star(
        dims.calendar(spark), dims.indicators(spark),
        spark.createDataFrame([(key(r[0]), *r) for r in expectations], EXPECTATIONS),
        spark.createDataFrame([(key(r[0]), *r) for r in comparison], COMPARISON),
        spark.createDataFrame([(key(r[0]), *r) for r in rates], RATES))


@pytest.fixture(scope="module")
def star(spark):
    built = star_of(
        spark,
        expectations=[
            (D1, "IPCA", 2026, 0, 4.0), (D1, "IPCA", 2026, 0, 5.0), (D2, "IPCA", 2026, 0, 6.0),
            (D3, "IPCA", 2026, 0, 0.0), (D1, "Selic", 2026, 0, 10.0), (D2, "Selic", 2026, 0, None),
            (D3, "Selic", 2026, 1, 12.0), (D2, "Câmbio", 2026, 0, 5.1234), (D1, "Câmbio", 2027, 0, 9.0)],
        comparison=[
            (D1, "IPCA", 2026, 4.0, 4.5, 0.5, "up"), (D2, "IPCA", 2026, 6.0, 5.0, -1.0, "down"),
            (D3, "Selic", 2026, 9.0, 9.0, 0.0, "same"), (D3, "Selic", 2027, 8.0, 9.0, 1.0, "up")],
        rates=[(D1, 13.75, 4.65, 8.6957), (D2, 13.75, 4.5, 8.8517), (D3, 12.0, 4.0, 7.6923)])
    frames = [built.calendar.cache(), built.indicators.cache(), built.expectations.cache(),
              built.comparison.cache(), built.real_rate.cache()]
    yield Star(*frames)
    for frame in frames:
        frame.unpersist()


def values(frame, *by):
    name = [c for c in frame.columns if c not in by]
    assert len(name) == 1
    return {tuple(r[c] for c in by) if len(by) != 1 else r[by[0]]: r[name[0]] for r in frame.collect()}


def alone(frame):
    row, = frame.collect()
    assert len(row) == 1
    return row[0]


def test_all_forty_are_numbered():
    assert sorted(m.number for m in MEASURES.values()) == list(range(1, 41))


def test_every_measure_evaluates(star):
    """Each name yields its own column, alone or along dates."""
    along = {6, 7, 8, 9, 10, 11, 19, 20, 21, 22, 35, 37, 39}
    for name, entry in MEASURES.items():
        by = ["data"] if entry.number in along else []
        frame = measure(name, star, by)
        assert frame.columns == [*by, name], name
        assert frame.count() >= 1, name


def test_average_by_group_and_context(star):
    assert values(measure("median_market", star, ["indicador"]), "indicador") == {
        "IPCA": 3.75, "Selic": 11.0, "Câmbio": 7.0617}
    until = Context(days=(None, D2), facts={"expectations": F.col("base_calculo") == 0})
    assert values(measure("median_market", star, ["indicador"], until), "indicador")["IPCA"] == 5.0
    january = Context(calendar=F.col("mes") == 1)
    assert values(measure("median_market", star, ["ano_mes"], january), "ano_mes") == {
        "2024-01": pytest.approx(39.1234 / 6)}
    second = Context(indicator=F.col("indicador_id") == 2)
    assert alone(measure("median_market", star, [], second)) == 11.0


def test_difference_across_facts(star):
    found = values(measure("divergence", star, ["indicador"]), "indicador")
    assert found["IPCA"] == 1.0 and found["Selic"] == -2.0
    assert found["Câmbio"] == pytest.approx(-7.0617)  # no Top 5 rows: zero minus the market
    nothing = Context(days=(date(2030, 1, 1), None))
    assert alone(measure("divergence", star, [], nothing)) is None
    with pytest.raises(ValueError, match="say whose"):
        measure("divergence", star, ["ano_referencia"])
    assert values(measure("divergence", star, ["ano_mes"]), "ano_mes") == {
        "2024-01": pytest.approx(4.75 - 39.1234 / 6), "2024-02": 3.0}
    assert alone(measure("divergence", star, [])) == pytest.approx(27.5 / 4 - 51.1234 / 8)


def test_a_fact_filter_stays_with_its_fact(star):
    """Filters do not run from one fact to the other."""
    context = Context(facts={"expectations": F.col("base_calculo") == 1})
    assert values(measure("spread", star, ["indicador"], context), "indicador") == {
        "IPCA": -0.25, "Selic": 0.5}
    assert values(measure("divergence", star, ["indicador"], context), "indicador") == {
        "IPCA": 4.75, "Selic": -3.0}
    twice = context.and_fact("expectations", F.col("ano_referencia") == 2027)
    assert alone(measure("median_market", star, [], twice)) is None


def test_unknown_and_missing_facts_are_told(spark, star):
    with pytest.raises(ValueError, match="expectation'"):
        measure("median_market", star, [], Context(facts={"expectation": F.lit(True)}))
    with pytest.raises(ValueError, match="without its real_rate"):
        measure("real_rate", Star(star.calendar, star.indicators, star.expectations))


def test_single_value(star):
    assert alone(measure("policy_rate", star)) is None
    assert alone(measure("policy_rate", star, [], Context(days=(D1, D2)))) == 13.75
    assert values(measure("real_rate", star, ["data"]), "data")[D1] == 8.6957


def test_last_point_and_labels(star):
    points = values(measure("last_point", star, ["indicador", "data"]), "indicador", "data")
    assert points[("IPCA", D3)] == 0.0 and points[("IPCA", D2)] is None
    assert points[("Selic", D3)] == 12.0
    base0 = Context(facts={"expectations": F.col("base_calculo") == 0})
    points = values(measure("last_point", star, ["indicador", "data"], base0), "indicador", "data")
    assert points[("Selic", D1)] == 10.0 and points[("Selic", D2)] is None  # last date has no value
    labels = values(measure("last_currency_label", star, ["indicador", "data"]), "indicador", "data")
    assert labels[("Câmbio", D2)] == "R$ 5,12"
    labels = values(measure("top5_label", star, ["indicador", "data"]), "indicador", "data")
    assert labels == {("IPCA", D1): None, ("IPCA", D2): "5,00%", ("Selic", D3): "9,00%"}


def test_point_needs_dates(star):
    with pytest.raises(ValueError, match="data"):
        measure("last_point", star, ["indicador"])


def _line(spark, days):
    rows = [(date(2024, 1, 1) + timedelta(n), "IPCA", 2026, 0, 1.0 + n) for n in days]
    return star_of(spark, expectations=rows)


def test_highlight_of_a_short_series_starts_at_its_first_date(spark):
    start = values(measure("highlight_start", _line(spark, range(11)), ["indicador", "data"]),
                   "indicador", "data")
    assert set(start.values()) == {date(2024, 1, 1)}


def test_highlight_starts_at_the_latest_date_thirty_days_back(spark):
    days = [n for n in range(101) if n not in (69, 70)]
    long = _line(spark, days)
    start = date(2024, 1, 1) + timedelta(68)
    assert set(values(measure("highlight_start", long, ["data"]), "data").values()) == {start}
    history = values(measure("median_history", long, ["data"]), "data")
    recent = values(measure("median_recent", long, ["data"]), "data")
    for day in history:
        assert (history[day] is not None) == (day <= start)
        assert (recent[day] is not None) == (day >= start)
    assert history[start] == recent[start] == 69.0


def test_last_survey_date_drops_only_the_date_filter(star):
    context = Context(days=(None, D1), calendar=F.col("mes") == 1)
    assert values(measure("last_survey_date", star, ["indicador"], context), "indicador")["IPCA"] == D2
    assert values(measure("last_survey_date", star, ["ano_mes"], context), "ano_mes") == {"2024-01": D2}
    by_day = values(measure("last_survey_date", star, ["data"], context), "data")
    assert len(by_day) == 29 * 31 + 1 and set(by_day.values()) == {D2}  # the context's days, the date's filter dropped
    of_month = Context(calendar=F.col("ano_mes") == "2024-01")
    by_day = values(measure("last_survey_date", star, ["ano_mes", "data"], of_month), "ano_mes", "data")
    assert len(by_day) == 31 and set(by_day.values()) == {D2}


def test_last_median_skips_zero_and_null_days(star):
    found = values(measure("kpi_last_median", star, ["indicador", "base_calculo"]),
                   "indicador", "base_calculo")
    assert found[("IPCA", 0)] == 6.0  # the newest day holds only a zero
    assert found[("Selic", 0)] == 10.0  # the newest day holds only a null
    filtered = Context(days=(None, D1))
    assert alone(measure("kpi_ipca", star, [], filtered)) == 6.0  # the calendar filter is ignored
    assert alone(measure("kpi_pib", star)) is None
    assert alone(measure("kpi_dolar", star)) == 5.1234


def test_calendar_groups_of_measures_that_drop_the_calendar(star):
    year = Context(calendar=F.col("ano") == 2024)
    months = [f"2024-{m:02}" for m in range(1, 13)]
    assert values(measure("kpi_ipca", star, ["ano_mes"], year), "ano_mes") == dict.fromkeys(months, 6.0)
    found = values(measure("kpi_last_median", star, ["indicador", "ano_mes"], year), "indicador", "ano_mes")
    alone_by = values(measure("kpi_last_median", star, ["indicador"]), "indicador")
    assert found == {(i, m): v for i, v in alone_by.items() for m in months}
    conflict = measures(["kpi_ipca", "kpi_selic"], star, ["ano_referencia", "trimestre"], year).collect()
    assert {(r.ano_referencia, r.trimestre) for r in conflict} == {(y, t) for y in (2026, 2027) for t in (1, 2, 3, 4)}
    assert {r.kpi_ipca for r in conflict} == {6.0}
    before = Context(days=(D2, D3))  # groups are the context's days, the value is not filtered
    assert len(values(measure("kpi_ipca", star, ["data"], before), "data")) == (D3 - D2).days + 1


def test_a_column_of_one_fact_as_a_group_of_a_difference(star):
    market = values(measure("median_market", star, ["indicador"]), "indicador")
    found = values(measure("divergence", star, ["indicador", "sinal_posicionamento"]), "indicador", "sinal_posicionamento")
    assert set(found) == {(i, s) for i in market for s in ("up", "down", "same")}
    assert found["IPCA", "up"] == 4.5 - market["IPCA"] and found["IPCA", "same"] == -market["IPCA"]
    years = values(measure("divergence", star, ["comparison.ano_referencia"]), "ano_referencia")
    whole = alone(measure("median_market", star, []))
    assert years == {2026: pytest.approx(18.5 / 3 - whole), 2027: pytest.approx(9.0 - whole)}
    other = values(measure("divergence", star, ["expectations.ano_referencia"]), "ano_referencia")
    assert other[2027] == pytest.approx(27.5 / 4 - 9.0)
    with pytest.raises(ValueError, match="no such column"):
        measure("divergence", star, ["comparison.base_calculo"])
    with pytest.raises(ValueError, match="cannot be grouped"):
        measure("divergence", star, ["nonsense"])


@pytest.mark.parametrize("by, context", [
    (["indicador"], Context), ([], Context), (["ano_mes"], lambda: Context(days=(None, D2))),
    (["indicador", "ano_mes"], lambda: Context(calendar=F.col("ano") == 2024, indicator=F.col("indicador_id") < 3))])
def test_a_set_gives_what_its_measures_give_alone(star, by, context):
    context = context()
    names = ["median_market", "median_top5", "divergence", "spread", "divergence_colour", "market_last_date",
             "kpi_ipca", "kpi_divergence_selic", "last_survey_date", "table_colour"]
    rows = {tuple(r[c] for c in by): r for r in measures(names, star, by, context).collect()}
    for name in names:
        for r in measure(name, star, by, context).collect():
            key = tuple(r[c] for c in by)
            if r[name] is not None and (key in rows or "colour" not in name):
                assert rows[key][name] == pytest.approx(r[name]) if isinstance(r[name], float) else rows[key][name] == r[name]
    assert all(any(r[n] is not None for n in names if "colour" not in n) for r in rows.values()) or not by


def test_a_set_over_facts_that_a_group_does_not_filter(star):
    """The rates have no indicator and no signal: they stand beside each."""
    found = measures(["real_rate_history", "spread", "median_market"], star, ["indicador", "sinal_posicionamento"]).collect()
    rate = alone(measure("real_rate_history", star))
    assert {r.real_rate_history for r in found} == {rate}
    assert len(found) == len({(r.indicador, r.sinal_posicionamento) for r in found}) == 3 * star.indicators.count()


def test_points_and_highlights_in_a_set(star):
    by = ["indicador", "data"]
    names = ["median_history", "median_recent", "last_point", "last_percent_label", "median_market", "top5_point", "top5_label"]
    rows = {(r.indicador, r.data): r for r in measures(names, star, by).collect()}
    for name in names:
        for key, value in values(measure(name, star, by), *by).items():
            assert value is None or rows[key][name] == value
    text = measures(["last_point", "spread", "latest_text"], star, by).collect()
    assert {r.latest_text for r in text} == {measure("latest_text", star).first()[0]}


def test_too_many_members_are_refused(star, monkeypatch):
    monkeypatch.setattr("sondaflow.measures.spread.MOST_MEMBERS", 2)
    with pytest.raises(Exception, match="do not filter"):
        measure("divergence", star, ["indicador", "sinal_posicionamento"]).collect()


def test_zero_on_the_last_date_still_counts_in_its_average(spark):
    both = star_of(spark, expectations=[(D1, "IPCA", 2026, 0, 9.0), (D2, "IPCA", 2026, 0, 0.0),
                                        (D2, "IPCA", 2026, 0, 6.0)])
    assert alone(measure("kpi_last_median", both)) == 3.0


def test_three_scopes_of_the_last_date(star):
    """IPCA ends earlier than Selic: absent on the global last date, present on its own."""
    by = ["indicador"]
    assert values(measure("divergence_last_date", star, by), "indicador") == {"Selic": 0.5}
    assert alone(measure("kpi_divergence_ipca", star)) == -1.0
    assert alone(measure("kpi_divergence_selic", star)) == 0.0
    points = values(measure("top5_point", star, ["indicador", "data"], Context(days=(None, D1))),
                    "indicador", "data")
    assert points == {("IPCA", D1): 4.5}
    assert values(measure("table_colour", star, by), "indicador") == {
        "IPCA": "#8C969A", "Selic": "#E66C37"}


def test_rate_cards_ignore_the_calendar_for_the_date_only(star):
    assert alone(measure("kpi_real_rate", star)) == 7.6923
    assert alone(measure("kpi_inflation", star, [], Context(days=(None, D2)))) is None
    assert alone(measure("kpi_policy_rate", star, [], Context(calendar=F.col("mes") == 2))) == 12.0


def test_latest_text(spark, star):
    assert alone(measure("latest_text", star)) == LATEST_PREFIX + "𝟮𝟬/𝟬𝟮/𝟮𝟬𝟮𝟰"
    older = star_of(spark, expectations=[(D3, "IPCA", 2026, 0, 1.0)], comparison=[
        (D1, "IPCA", 2026, 1.0, 1.0, 0.0, "same")])
    assert alone(measure("latest_text", older)) == LATEST_PREFIX + "𝟬𝟭/𝟬𝟭/𝟮𝟬𝟮𝟰"  # first present, not newest


def test_values_do_not_depend_on_partitioning(spark, star):
    shuffled = Star(star.calendar, star.indicators, star.expectations.repartition(7),
                    star.comparison.repartition(5), star.real_rate)
    for name in ("kpi_last_median", "divergence", "median_market"):
        assert values(measure(name, star, ["indicador"]), "indicador") == values(
            measure(name, shuffled, ["indicador"]), "indicador")


def test_the_last_date_skips_row_groups_without_a_job(spark, tmp_path):
    path = str(tmp_path / "fact")
    days = spark.range(0, 200_000, numPartitions=1).select(
        F.date_add(F.lit(D1), (F.col("id") / 400).cast("int")).alias("data"), F.rand(1).alias("v"))
    days.write.option("parquet.block.size", 64 << 10).parquet(path)
    fact = spark.read.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan is then the one that ran
    try:
        latest = shapes.on_last_date_of(fact, fact)
        assert len(latest.collect()) == 400
        scan = latest._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().get("numOutputRows").get().value() < 100_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_averages_keep_all_digits(spark):
    rows = [("small", 0.00004), ("small", 0.00004), ("large", 2e14), ("large", 2e14), ("nan", float("nan")), ("nan", 1.0),
            ("none", None), ("some", None), ("some", 3.0)]
    found = values(shapes.averages(spark.createDataFrame(rows, "k string, v double"), ["k"], {"m": "v"}), "k")
    assert math.isnan(found.pop("nan"))
    assert found == {"small": 0.00004, "large": 2e14, "none": None, "some": 3.0}


def test_cards_replace_filters_and_groups_of_their_columns(star):
    later = Context(facts={"expectations": {"ano_referencia": F.col("ano_referencia") == 2027}})
    plain_value = alone(measure("kpi_ipca", star))
    assert plain_value is not None and alone(measure("kpi_ipca", star, [], later)) == plain_value
    by_year = values(measure("kpi_ipca", star, ["ano_referencia"]), "ano_referencia")
    assert set(by_year.values()) == {plain_value} and set(by_year) == {2026, 2027}
    assert values(measure("kpi_ipca", star, ["ano_referencia"], later), "ano_referencia") == {2027: plain_value}
    assert values(measure("kpi_ipca", star, ["indicador"]), "indicador") == {"IPCA": plain_value}
    other = alone(measure("kpi_ipca", star, cards=Cards(2027, 0)))
    assert other == alone(measure("kpi_last_median", star, [], Context(
        indicator=F.col("indicador") == "IPCA",
        facts={"expectations": {"a": F.col("ano_referencia") == 2027, "b": F.col("base_calculo") == 0}})))


def test_rates_have_a_last_date_for_each_group_of_the_fact(star):
    rates = {r.taxa_selic_meta_aa: r.taxa_juro_real_ex_ante for r in star.real_rate.collect()}
    assert values(measure("kpi_real_rate", star, ["taxa_selic_meta_aa"]), "taxa_selic_meta_aa") == rates
    assert len(values(measure("kpi_real_rate", star, ["ano_mes"]), "ano_mes")) == 1


def test_indicator_attributes_are_groups(star):
    by_unit = values(measure("median_market", star, ["unidade_medida"]), "unidade_medida")
    assert "R$/US$" in by_unit and by_unit["R$/US$"] == pytest.approx(7.0617)
    assert values(measure("divergence", star, ["unidade_medida"]), "unidade_medida")["R$/US$"] == pytest.approx(-7.0617)
    with pytest.raises(ValueError, match="cannot be grouped"):
        measure("policy_rate", star, ["unidade_medida"])


def test_several_measures_are_one_kind(star):
    both = measures(["spread", "divergence_colour"], star, ["indicador"])
    assert both.columns == ["indicador", "spread", "divergence_colour"]
    mixed = measures(["spread", "median_market"], star, ["indicador"])
    assert {r.indicador: r.spread for r in mixed.collect()} == {"IPCA": -0.25, "Selic": 0.5, "Câmbio": None}
    with pytest.raises(ValueError, match="no groups"):
        measures(["latest_text"], star, ["indicador"], shown=["latest_text"])


# ---------------------------------------------------------------- reports

def test_overview_page(star):
    rows = reports.overview_charts(star, date(2024, 2, 20)).collect()
    shown = {(r.indicador, r.data): r for r in rows}
    assert ("Selic", D2) not in shown  # all blank: not shown
    assert shown[("IPCA", D3)].last_label == "0,00%"
    assert shown[("Câmbio", D2)].last_label == "R$ 5,12"
    assert [(r.indicador, r.data) for r in rows] == sorted((r.indicador, r.data) for r in rows)
    cards = {r.indicador: (r.last_median, r.card_text) for r in reports.overview_cards(star).collect()}
    assert cards == {"IPCA": (6.0, "6,00%"), "Selic": (10.0, "10,00%"), "Câmbio": (5.1234, "R$ 5,12")}


def test_comparison_page(star):
    chart = reports.comparison_charts(star, date(2024, 2, 20), ["IPCA"]).collect()
    assert [(r.data, r.top5_point, r.market_label) for r in chart] == [
        (D1, None, None), (D2, 5.0, "6,00%")]
    colours = [r.divergence_colour for r in reports.divergence_columns(star, date(2024, 2, 20), ["IPCA"]).collect()]
    assert colours == ["#E66C37", "#A4AAAD"]
    table = [(r.indicador, r.ano_referencia, r.divergence_last_date, r.table_colour)
             for r in reports.comparison_table(star).collect()]
    assert table == [("Selic", 2026, 0.0, "#8C969A"), ("Selic", 2027, 1.0, "#E66C37")]
    cards = {r.indicador: r.card_text for r in reports.divergence_cards(star).collect()}
    assert cards == {"IPCA": "-1,00 p.p.", "Selic": "0,00 p.p."}


def test_rate_page(star):
    chart = reports.rate_charts(star, date(2024, 2, 20)).collect()
    assert [r.real_rate_point for r in chart] == [None, None, 7.6923]
    card = reports.rate_cards(star).first()
    assert (card.kpi_policy_rate, card.text_real_rate, card.text_inflation) == (12.0, "7,69%", "4,00%")
    assert reports.rate_charts(star, date(2025, 2, 20)).count() == 0
