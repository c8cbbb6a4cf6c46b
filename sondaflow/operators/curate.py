"""Contract projection and deterministic deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sondaflow.functions.dates import parse_date
from sondaflow.specs import ColumnSpec, CurationSpec

BATCH = "_batch_id"
INGESTED = "_ingestion_timestamp"
ORIGIN = "_source_url"
RAW_BATCH = "_bronze_batch_id"
RAW_INGESTED = "_bronze_ingestion_timestamp"
CURATED_BATCH = "_silver_batch_id"
CURATED_AT = "_silver_timestamp"


def convert(column: ColumnSpec) -> Column:
    """The typed value; whatever cannot be converted becomes null and is counted by the gate.

    A whole number may be written with a fraction of zero: the text 2026.0 is the year 2026.
    """
    raw = F.col(column.source)
    if column.type == "date":
        return parse_date(raw, column.date_format)
    value = raw.try_cast(column.type)
    if column.type in ("int", "bigint"):
        exact = raw.try_cast("decimal(38,8)")
        value = F.coalesce(value, F.when(exact == F.floor(exact), exact.try_cast(column.type)))
    return value


def raw_name(target: str) -> str:
    return f"_raw_{target}"


def typed(raw: DataFrame, spec: CurationSpec, keep_raw: bool = False) -> DataFrame:
    """Rename and convert by contract, lineage carried along.

    ``keep_raw`` puts the unconverted values beside the typed ones, which only
    the gates need; without it the scan reads and converts nothing twice.
    """
    beside = [F.col(c.source).alias(raw_name(c.target)) for c in spec.columns] if keep_raw else []
    return raw.select(
        *[convert(c).alias(c.target) for c in spec.columns],
        *beside,
        F.col(BATCH).alias(RAW_BATCH),
        F.col(INGESTED).alias(RAW_INGESTED),
    )


def newest_per_key(rows: DataFrame, spec: CurationSpec) -> DataFrame:
    """One row per natural key: the newest load wins, the larger measures break ties.

    Null key parts are equal to each other. A row number limited to 1 lets Spark
    drop losers before the exchange (one survivor per key and input task), so a
    key that holds a third of the table costs no more than any other. The hash
    in front of the keys changes no group; it only settles most comparisons of
    the two sorts by one number.
    """
    order = [F.col(RAW_INGESTED).desc_nulls_last()]
    order += [F.col(m).desc_nulls_last() for m in spec.measures]
    window = Window.partitionBy(F.xxhash64(*spec.keys), *spec.keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def curated(raw: DataFrame, spec: CurationSpec) -> DataFrame:
    """The curated rows of a raw table (the gates are separate, see ``gates.curation_metrics``)."""
    return newest_per_key(typed(raw, spec), spec)


def stamped(rows: DataFrame, batch_id: str) -> DataFrame:
    return rows.withColumns({CURATED_BATCH: F.lit(batch_id), CURATED_AT: F.current_timestamp()})
