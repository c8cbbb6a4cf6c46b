"""Survey-expectation marts on Spark: gated loads, curated tables, star model, measures, reports."""
