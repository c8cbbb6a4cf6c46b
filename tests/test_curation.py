from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sondaflow.operators import curate, gates
from sondaflow.plans import catalog
from sondaflow.specs import SourceSpec

SURVEY = catalog.CURATION["silver_expectativas_anuais"]
RATE = catalog.CURATION["silver_meta_selic"]
RAW = ("Data string, Indicador string, IndicadorDetalhe string, DataReferencia string, "
       "baseCalculo int, Media double, Mediana double, DesvioPadrao double, Minimo double, "
       "Maximo double, numeroRespondentes int, _batch_id string, _ingestion_timestamp timestamp")


def raw(spark, **changes):
    row = dict(Data="2024-01-02", Indicador="IPCA", IndicadorDetalhe=None, DataReferencia="2026",
               baseCalculo=0, Media=4.0, Mediana=4.0, DesvioPadrao=0.1, Minimo=3.0, Maximo=5.0,
               numeroRespondentes=100, _batch_id="b", _ingestion_timestamp=datetime(2024, 1, 3))
    return spark.createDataFrame([tuple({**row, **changes}.values())], RAW)


def stacked(*frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def violations(frame, spec=SURVEY):
    found = gates.curation_metrics(frame, spec).collect()
    return {f"{r.kind}__{r.name}": r.violations for r in found if r.kind != gates.ROWS and r.violations}


def test_whole_numbers_with_a_fraction_of_zero(spark):
    out = curate.typed(stacked(raw(spark, DataReferencia="2026.0"), raw(spark, DataReferencia="2026.5")), SURVEY)
    assert [r.ano_referencia for r in out.collect()] == [2026, None]
    assert violations(raw(spark, DataReferencia="2026.0")) == {}
    assert violations(raw(spark, DataReferencia="2026.5")) == {
        "conversion__ano_referencia": 1, "null_key__ano_referencia": 1}


def test_contract_types(spark):
    out = curate.typed(raw(spark), SURVEY)
    assert out.schema["data"].dataType.simpleString() == "date"
    assert out.schema["ano_referencia"].dataType.simpleString() == "int"
    assert out.first().data == date(2024, 1, 2)
    assert not [c for c in out.columns if c.startswith("_raw")]


@pytest.mark.parametrize("changes, metric", [
    ({"Data": "2024-02-30"}, "conversion__data"),
    ({"DataReferencia": "x"}, "conversion__ano_referencia"),
    ({"Indicador": None}, "null_key__indicador"),
    ({"Mediana": 9.0}, "rule__mediana_entre_min_max"),
])
def test_gates_count_each_violation(spark, changes, metric):
    frame = stacked(raw(spark), raw(spark, **changes))
    assert violations(frame)[metric] == 1
    with pytest.raises(gates.GateError, match=metric):
        gates.check_curation(frame, SURVEY)


@pytest.mark.parametrize("changes", [
    {"Mediana": None}, {"Minimo": None}, {"IndicadorDetalhe": None}, {"Mediana": 3.0}, {"Mediana": 5.0}])
def test_gates_accept_unknown_and_limits(spark, changes):
    assert violations(raw(spark, **changes)) == {}


def test_all_violations_are_told_together(spark):
    frame = stacked(raw(spark, Data="no"), raw(spark, Mediana=9.0))
    with pytest.raises(gates.GateError) as error:
        gates.check_curation(frame, SURVEY)
    assert "conversion__data" in str(error.value) and "rule__" in str(error.value)


@pytest.mark.parametrize("value, bad", [("13.75", 0), (None, 1), ("0", 1), ("-1", 1)])
def test_rate_has_to_be_present_and_positive(spark, value, bad):
    frame = spark.createDataFrame([("31/12/2023", value, "b", datetime(2024, 1, 1))],
                                  "data string, valor string, _batch_id string, _ingestion_timestamp timestamp")
    assert violations(frame, RATE).get("rule__taxa_preenchida_e_positiva", 0) == bad


def test_missing_contract_column(spark):
    with pytest.raises(gates.GateError, match="Mediana"):
        gates.check_curation(raw(spark).drop("Mediana"), SURVEY)


def test_gates_are_one_aggregate_without_a_shuffle_of_rows(spark):
    plan = gates.curation_metrics(raw(spark), SURVEY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan


def test_empty_input_passes_the_curation_gates(spark):
    assert gates.check_curation(raw(spark).limit(0), SURVEY) == 0


def test_newest_row_wins_then_larger_measures_then_nulls(spark):
    early, late = datetime(2024, 1, 3), datetime(2024, 1, 4)
    frame = stacked(
        raw(spark, Media=9.0, _ingestion_timestamp=early),
        raw(spark, Media=None, _ingestion_timestamp=late),
        raw(spark, Media=4.0, Mediana=3.5, _ingestion_timestamp=late),
        raw(spark, Media=4.0, Mediana=4.5, _ingestion_timestamp=late),
        raw(spark, IndicadorDetalhe="x"))
    for parts in (1, 3, 7):
        kept = {r.indicador_detalhe: (r.media, r.mediana)
                for r in curate.curated(frame.repartition(parts), SURVEY).collect()}
        assert kept == {None: (4.0, 4.5), "x": (4.0, 4.0)}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with most of the rows sends one row per input task through the exchange."""
    hot = spark.range(0, 20000, numPartitions=8).select(
        F.lit("2024-01-02").alias("Data"),
        F.when(F.col("id") >= 100, "hot").otherwise(F.col("id").cast("string")).alias("Indicador"),
        F.lit(None).cast("string").alias("IndicadorDetalhe"), F.lit("2026").alias("DataReferencia"),
        F.lit(0).alias("baseCalculo"),
        *[F.col("id").cast("double").alias(c) for c in ("Media", "Mediana", "DesvioPadrao", "Minimo", "Maximo")],
        F.lit(1).alias("numeroRespondentes"), F.lit("b").alias("_batch_id"),
        F.lit(datetime(2024, 1, 3)).alias("_ingestion_timestamp"))
    out = curate.curated(hot, SURVEY)
    rows = {r.indicador: r.media for r in out.collect()}
    assert len(rows) == 101 and rows["hot"] == 19999.0
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    above, below = plan.split("Exchange hashpartitioning")
    assert "row_number(), 1, Final" in above and "row_number(), 1, Partial" in below


def test_stamped_lineage(spark):
    out = curate.stamped(curate.curated(raw(spark), SURVEY), "batch-9").first()
    assert out._silver_batch_id == "batch-9" and out._bronze_batch_id == "b"
    assert out._silver_timestamp is not None


# ------------------------------------------------------------------ loads

LOAD = SourceSpec(target="t", reader="table", date_column="Data", date_format="yyyy-MM-dd",
                  keys=("Data", "Indicador", "IndicadorDetalhe"))


@pytest.mark.parametrize("as_of, passes", [(date(2024, 2, 1), True), (date(2024, 2, 2), False)])
def test_freshness_limit_is_inclusive(spark, as_of, passes):
    frame = raw(spark)  # newest date 2024-01-02: 30 and 31 days
    if passes:
        assert gates.check_load(frame, LOAD, as_of, None)["age_days"] == 30
    else:
        with pytest.raises(gates.GateError, match="stale"):
            gates.check_load(frame, LOAD, as_of, None)


@pytest.mark.parametrize("new, passes", [(90, True), (89, False)])
def test_volume_limit_is_inclusive(spark, new, passes):
    current = spark.range(100).crossJoin(raw(spark))
    load = spark.range(new).crossJoin(raw(spark)).drop("id").withColumn("id", F.lit(1))
    if passes:
        gates.check_load(load, LOAD, date(2024, 1, 5), current)
    else:
        with pytest.raises(gates.GateError, match="volume"):
            gates.check_load(load, LOAD, date(2024, 1, 5), current)
    row = gates.volume(load, current, 0.90).first()
    assert (row.new_rows, row.current_rows, row.enough) == (new, 100, passes)


def test_lost_and_new_columns(spark):
    current = raw(spark).withColumn("Old", F.lit(1))
    with pytest.raises(gates.GateError, match="Old"):
        gates.check_load(raw(spark), LOAD, date(2024, 1, 5), current)
    gates.check_load(raw(spark).withColumn("New", F.lit(1)), LOAD, date(2024, 1, 5), raw(spark))
    assert gates.lost_columns(raw(spark).drop("_batch_id"), raw(spark)) == []


def test_empty_load_fails(spark):
    with pytest.raises(gates.GateError, match="no record"):
        gates.check_load(raw(spark).limit(0), LOAD, date(2024, 1, 5), None)


def test_unreadable_date_fails_the_load(spark):
    with pytest.raises(gates.GateError, match="readable"):
        gates.check_load(stacked(raw(spark), raw(spark, Data="??")), LOAD, date(2024, 1, 5), None)


def test_duplicates_only_warn_and_null_key_parts_count(spark):
    frame = stacked(raw(spark), raw(spark), raw(spark, IndicadorDetalhe="x"))
    assert gates.check_load(frame, LOAD, date(2024, 1, 5), None)["duplicates"] == 1
    assert gates.check_load(frame.drop("IndicadorDetalhe"), LOAD, date(2024, 1, 5), None)["duplicates"] == 2
