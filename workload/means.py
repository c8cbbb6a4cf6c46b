"""Averages among the results of the registered queries.

The last digits of a sum of doubles depend on the order of its terms, so these
columns are compared with thirty binary digits, which are nine decimal ones, in the
queries and in their SQL: x * c - (x * c - x) keeps them. Decimal rounding would meet ties.
"""

_CHART = ("median_history", "median_recent", "last_point")
_COMPARISON = ("median_top5", "comparison_market", "spread", "top5_point", "market_point")
_RATES = ("real_rate", "inflation", "policy_rate")
_POINTS = tuple(f"{name}_point" for name in _RATES)
_RATE_CARDS = ("kpi_policy_rate", "kpi_inflation", "kpi_real_rate")
_MEDIAN_CARDS = ("kpi_ipca", "kpi_selic", "kpi_pib", "kpi_dolar")
_LAST_DATE = ("market_last_date", "top5_last_date", "divergence_last_date")

# 2 ** 23 + 1 leaves 30 of the 53 digits of a double.
DIGITS = 8388609

MEANS: dict[str, tuple[str, ...]] = {
    "median_by_series": ("median_market",),
    "median_by_quarter": ("median_market",),
    "top5_by_series": ("median_top5", "comparison_market", "spread"),
    "cross_fact_divergence": ("divergence",),
    "highlight_series": ("median_market", *_CHART),
    "highlight_news": ("median_market", *_CHART),
    "kpi_last_median": ("kpi_last_median",),
    "measure_cards": ("value",),
    "cards_in_conflict": _MEDIAN_CARDS,
    "divergence_cards_by_signal": ("kpi_divergence_ipca", "kpi_divergence_selic"),
    "rates_by_policy_rate": _RATE_CARDS,
    "rates_by_year": _RATE_CARDS,
    "medians_by_unit": ("median_market", "divergence"),
    "measure_set_by_quarter": ("median_market", "median_top5", "divergence", "spread", "real_rate_history",
                               "top5_last_date", "kpi_real_rate"),
    "calendar_free_by_month": ("kpi_ipca", "kpi_divergence_ipca", "median_market"),
    "divergence_by_signal": ("divergence",),
    "divergence_by_owned_year": ("median_market", "median_top5", "divergence"),
    "precise_means": ("mean_small", "mean_large"),
    "news_points": ("last_point",),
    "highlight_parts": ("median_history", "median_recent"),
    "comparison_means": ("median_top5", "comparison_market", "spread"),
    "comparison_points": ("top5_point", "market_point"),
    "last_date_means": _LAST_DATE,
    "rate_histories": ("real_rate_history", "policy_rate_history", "inflation_history"),
    "rate_points": _POINTS,
    "divergence_signs": ("spread",),
    "kpi_divergence": ("kpi_divergence",),
    "last_date_divergence": ("divergence_last_date",),
    "rate_kpis_in_context": ("kpi_real_rate",),
    "rate_series": (*_RATES, *_POINTS),
    "report_overview_charts": _CHART,
    "report_overview_charts_news": _CHART,
    "report_overview_cards": ("last_median",),
    "report_comparison_charts": _COMPARISON,
    "report_comparison_charts_news": _COMPARISON,
    "report_divergence_columns": ("spread",),
    "report_comparison_table": _LAST_DATE,
    "report_divergence_cards": ("kpi_divergence",),
    "report_rate_charts": (*_RATES, *_POINTS),
    "report_rate_cards": _RATE_CARDS,
}
