import json
import os
import time
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from sondaflow.measures.catalogue import measure
from sondaflow.measures.context import Star
from sondaflow.operators import gates
from sondaflow.plans import catalog, run
from sondaflow.session import scratch_path
from sondaflow.sources import landing, paged
from sondaflow.sources.tables import TableSink
from sondaflow.specs import ColumnSpec, CurationSpec, SourceSpec

AS_OF = date(2024, 1, 10)


def load_spec(target, path, **changes):
    base = dict(target=target, reader="json", date_column="d", date_format="yyyy-MM-dd",
                keys=("d", "k"), tag="endpoint", options={"path": path})
    return SourceSpec(**{**base, **changes})


def write_records(spark, records):
    path = scratch_path(spark, "records")
    spark.createDataFrame([(json.dumps(r),) for r in records], "value string").write.text(path)
    return path


def records(n, **extra):
    return [{"d": "2024-01-02", "k": str(i), "v": i, "empty": None, **extra} for i in range(n)]


# ------------------------------------------------------------------ sources

@pytest.mark.parametrize("total", [0, 1, 9, 10, 11, 40, 95])
def test_pages_are_read_whole_and_once(spark, total):
    def fetch(request):
        assert request.order_by == ("d", "k") and request.filter == "k ne ''"
        return [{"n": n} for n in range(total)][request.skip:request.skip + request.top]

    rows = paged.read_pages(spark, fetch, endpoint="e", order_by=("d", "k"), filter="k ne ''",
                            page_size=10, readers=3)
    assert rows.rdd.getNumPartitions() == 3
    assert sorted(json.loads(r.value)["n"] for r in rows.collect()) == list(range(total))


def test_windows_cover_every_day_once(spark):
    first, last = date(1999, 6, 4), date(2026, 12, 3)
    plan = paged.date_windows(spark, first, last).orderBy("first_day").collect()
    assert len(plan) == 6 and plan[0].first_day == first and plan[-1].last_day == last
    for before, after in zip(plan, plan[1:]):
        assert (after.first_day - before.last_day).days == 1
        assert (before.last_day - before.first_day).days == 5 * 365


def test_audit_of_a_killed_run_and_its_resumption(spark, sink):
    good = write_records(spark, records(4))
    specs = [load_spec(f"t{i}", good) for i in range(4)]
    specs[1] = replace(specs[1], options={"path": "/nowhere/at/all"})
    asked = []

    def killed(session, spec):
        raise SystemExit("the driver ends")

    def counted(session, spec):
        asked.append(spec.target)
        return landing.read_files(session, spec)

    third = [*specs[:2], replace(specs[2], reader="killed")]
    with pytest.raises(SystemExit):
        run.ingest(sink, third, AS_OF, "night", parallel=1, readers={**landing.READERS, "killed": killed})
    audit = {r.tabela: r.status for r in sink.read(run.LOAD_AUDIT).collect()}
    assert audit == {"t0": "OK", "t1": "ERRO"} and not sink.exists("t3")
    specs = [replace(s, reader="counted", options={"path": good}) for s in specs]
    batch = run.ingest(sink, specs, AS_OF, "night", readers={**landing.READERS, "counted": counted}, resume=True)
    batch.raise_failures()
    assert sorted(asked) == ["t1", "t2", "t3"] and [r["tabela"] for r in batch.rows] == ["t0", "t1", "t2", "t3"]
    audit = sink.read(run.LOAD_AUDIT)
    assert audit.count() == 5 and run.failed_runs(run.newest_runs(audit)).count() == 0
    assert run.newest_runs(audit).columns == audit.columns
    again = run.ingest(sink, specs, AS_OF, "another", readers={**landing.READERS, "counted": counted}, resume=True)
    assert len(asked) == 7 and not again.failures


def test_windowed_extract(spark):
    def fetch(request):
        assert request.series == "432"
        return [{"from": request.first.isoformat(), "to": request.last.isoformat()}]

    rows = paged.read_windows(spark, fetch, series="432", first=date(2024, 1, 1),
                              last=date(2024, 1, 10), days=4)
    assert rows.rdd.getNumPartitions() == 3
    found = sorted(json.loads(r.value)["from"] for r in rows.collect())
    assert found == ["2024-01-01", "2024-01-05", "2024-01-09"]


def test_two_extracts_keep_their_own_transport(spark):
    def of(tag):
        return paged.read_pages(spark, lambda r: [{"t": tag}], endpoint="e", order_by=("t",),
                                page_size=5, readers=1)

    one, two = of("one"), of("two")
    assert "one" in one.first().value and "two" in two.first().value


def test_extract_land_read(spark):
    def fetch(request):
        return [{"i": n, "x": None, "y": n if n % 2 else n / 2} for n in range(25)][request.skip:request.skip + request.top]

    extract = paged.read_pages(spark, fetch, endpoint="e", order_by=("i",), page_size=4, readers=2)
    path = landing.land(extract, scratch_path(spark, "landing"))
    rows = landing.read_landed(spark, path)
    assert dict(rows.dtypes) == {"i": "bigint", "x": "string", "y": "double"}
    assert rows.count() == 25
    assert dict(landing.read_landed(spark, path, "i int, x string").dtypes) == {"i": "int", "x": "string"}


def test_ingest_from_transports(spark, sink):
    """Paged and windowed sources go through landing, gates and publishing like any other."""
    def pages(request):
        assert request.endpoint == "ExpectativasMercadoAnuais"
        assert request.order_by[0] == "Data" and "IPCA" in request.filter
        every = [{"Data": "2024-01-02", "Indicador": "IPCA", "IndicadorDetalhe": None,
                  "DataReferencia": str(y), "baseCalculo": 0} for y in range(2024, 2031)]
        return every[request.skip:request.skip + request.top]

    def windows(request):
        return [{"data": request.last.strftime("%d/%m/%Y"), "valor": "10"}]

    folder = scratch_path(spark, "landing")
    readers = {**landing.READERS, "pages": landing.pages_reader(pages, folder),
               "windows": landing.windows_reader(windows, folder, AS_OF)}
    survey, rate = catalog.SOURCES[0], catalog.SOURCES[-1]
    survey = replace(survey, options={"page_size": "3"})
    batch = run.ingest(sink, [survey, rate], AS_OF, readers=readers)
    batch.raise_failures()
    assert [(r["registros"], r["data_max"]) for r in batch.rows] == [
        (7, date(2024, 1, 2)), (5, AS_OF)]
    assert sink.read(survey.target).first()._source_url == "ExpectativasMercadoAnuais"


def test_reader_registry(spark, sink):
    sink.replace(spark.range(5).select(F.col("id").alias("v")), "origin")
    spec = SourceSpec(target="t", reader="table", date_column="d", date_format="yyyy",
                      filter="v >= 3", options={"table": sink.name("origin")})
    assert landing.read_source(spark, spec).count() == 2
    with pytest.raises(ValueError, match="nosuch"):
        landing.read_source(spark, replace(spec, reader="nosuch"))
    mine = {"mine": lambda session, s: session.range(4).select(F.col("id").alias("v"))}
    assert landing.read_source(spark, replace(spec, reader="mine"), mine).count() == 1


def test_landed_responses(spark, tmp_path):
    """Whole responses as they came: a paged one wraps its records, a series is a bare array."""
    for page in range(3):
        body = {"@odata.context": "x", "value": [{"d": f"2024-01-0{page + 1}", "v": None, "n": i} for i in range(4)]}
        (tmp_path / f"p{page}.json").write_text(json.dumps(body, indent=1))
    (tmp_path / "series").mkdir()
    (tmp_path / "series" / "s.json").write_text(json.dumps([{"data": "02/01/2024", "valor": "1"}] * 2))
    spec = SourceSpec(target="t", reader="documents", date_column="d", date_format="yyyy-MM-dd",
                      filter="n < 3", options={"path": f"{tmp_path}/p*.json", "records": "value"})
    rows = landing.read_source(spark, spec)
    assert rows.count() == 9 and dict(rows.dtypes) == {"d": "string", "n": "bigint", "v": "string"}
    series = replace(spec, filter=None, options={"path": f"{tmp_path}/series"})
    assert landing.read_source(spark, series).count() == 2


def test_source_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).select(F.col("id").cast("string").alias("Indicador")).write.parquet(path)
    spec = SourceSpec(target="t", reader="parquet", date_column="d", date_format="yyyy",
                      filter="Indicador IN ('1', '2')", options={"path": path})
    plan = landing.read_source(spark, spec)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(Indicador" in plan


# ------------------------------------------------------------------- tables

def test_replace_swaps_rows_and_schema(spark, sink):
    assert sink.current("t") is None
    sink.replace(spark.range(3), "t")
    sink.replace(spark.range(5), "t")
    assert sink.read("t").count() == 5
    sink.replace(spark.range(2).select(F.col("id").cast("string").alias("name")), "t")
    assert sink.read("t").columns == ["name"] and sink.read("t").count() == 2


def test_table_may_be_rebuilt_from_itself(spark, sink):
    sink.replace(spark.range(3), "t")
    sink.replace(sink.read("t").unionByName(sink.read("t")), "t")
    assert sink.read("t").count() == 6


def test_failed_write_keeps_the_old_rows(spark, sink):
    sink.replace(spark.range(3), "t")
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        sink.replace(broken, "t")
    assert sink.read("t").count() == 3


def test_a_failed_switch_keeps_the_old_rows(spark, sink, monkeypatch):
    """Whichever step fails, and whatever the new schema, readers go on with the old table."""
    sink.replace(spark.range(3), "t")

    def refuse(*_):
        raise RuntimeError("no catalog")

    with monkeypatch.context() as patch:
        patch.setattr(TableSink, "_point", refuse)
        with pytest.raises(RuntimeError, match="no catalog"):
            sink.replace(spark.range(2).select(F.lit("x").alias("name")), "t")
    assert sink.read("t").columns == ["id"] and sink.read("t").count() == 3
    sink.replace(spark.range(2).select(F.lit("x").alias("name")), "t")
    assert sink.read("t").columns == ["name"]


def test_old_folders_expire(spark, sink):
    sink.replace(spark.range(3), "t")
    refused = sink.stage(spark.range(9), "t")
    sink.replace(spark.range(5), "t")
    assert sink.expire("t", timedelta(hours=1)) == []
    gone = sink.expire("t", timedelta(0))
    assert len(gone) == 2 and any(p.endswith(refused.rsplit("/", 1)[1]) for p in gone)
    assert sink.read("t").count() == 5 and sink.expire("t", timedelta(0)) == []
    assert sink.expire("never", timedelta(0)) == []


def test_append_widens(spark, sink):
    sink.append(spark.createDataFrame([(1, "a")], "n int, s string"), "log")
    sink.append(spark.createDataFrame([("b", 2.5, 2)], "s string, x double, n int"), "log")
    sink.append(spark.createDataFrame([(3,)], "n int"), "log")
    found = {(r.n, r.s, r.x) for r in sink.read("log").collect()}
    assert found == {(1, "a", None), (2, "b", 2.5), (3, None, None)}


def test_an_append_that_fails_leaves_rows_and_columns(spark, sink, monkeypatch):
    sink.append(spark.createDataFrame([(1, "a")], "n int, s string"), "log")
    wide = spark.createDataFrame([(2, "b", 2.5)], "n int, s string, x double")
    for step in ("_point", "_entered", "stage"):
        with monkeypatch.context() as patch:
            def refuse(*_, **__):
                raise RuntimeError("lost")
            patch.setattr(TableSink, step, refuse)
            with pytest.raises(RuntimeError):
                sink.append(wide, "log")
        assert sink.read("log").columns == ["n", "s"] and sink.read("log").count() == 1
    broken = wide.withColumn("x", F.raise_error(F.lit("no row")).cast("double"))
    with pytest.raises(Exception, match="no row"):
        sink.append(broken, "log")
    assert sink.read("log").columns == ["n", "s"] and sink.read("log").count() == 1
    sink.append(wide, "log")
    sink.append(spark.createDataFrame([(3, 1)], "n int, y int"), "log")
    sink.append(spark.createDataFrame([(4,)], "n int"), "log")
    assert sink.expire("log", timedelta(days=1)) == []
    sink.expire("log", timedelta(0))
    assert {tuple(r) for r in sink.read("log").collect()} == {
        (1, "a", None, None), (2, "b", 2.5, None), (3, None, None, 1), (4, None, None, None)}
    sink.replace(spark.range(1), "log")
    assert len(sink.expire("log", timedelta(0))) == 3 and sink.read("log").columns == ["id"]


def test_sorted_files(spark, sink):
    rows = spark.range(1000, numPartitions=4).select((F.col("id") * 7919 % 1000).alias("data"))
    staged = sink.staged(sink.stage(rows, "t", sort_by=("data",)))
    parts = staged.withColumn("f", F.input_file_name()).groupBy("f").agg(F.collect_list("data").alias("l"))
    assert all(r.l == sorted(r.l) for r in parts.collect())


# ------------------------------------------------------------------- ingest

def test_ingest_publishes_with_audit_columns(spark, sink):
    spec = load_spec("raw", write_records(spark, records(10)), filter="v < 8")
    batch = run.ingest(sink, [spec], AS_OF, "batch-1")
    batch.raise_failures()
    table = sink.read("raw")
    assert table.count() == 8
    assert set(table.columns) == {"d", "k", "v", "empty", "_batch_id", "_ingestion_timestamp", "_source_url"}
    assert dict(table.dtypes)["empty"] == "string"
    row = table.first()
    assert (row._batch_id, row._source_url) == ("batch-1", "endpoint")
    audit = sink.read(run.LOAD_AUDIT).first()
    assert (audit.batch_id, audit.tabela, audit.status, audit.registros, audit.colunas, audit.data_max,
            audit.erro) == ("batch-1", "raw", "OK", 8, 7, date(2024, 1, 2), None)
    assert audit.fim >= audit.inicio and audit.duracao_s >= 0
    seconds = sink.read(run.LOAD_AUDIT).select(F.unix_timestamp("fim").alias("s")).first().s
    assert abs(seconds - time.time()) < 600


@pytest.mark.parametrize("bad, told", [
    (dict(records=[]), "no record"),
    (dict(records=records(89)), "volume"),
    (dict(records=[{"d": "2024-01-02", "k": str(i)} for i in range(100)]), "missing"),
    (dict(records=records(100, d="2023-12-01")), "stale"),
    (dict(records=records(100, d="later")), "readable"),
])
def test_refused_load_keeps_the_published_table(spark, sink, bad, told):
    run.ingest(sink, [load_spec("raw", write_records(spark, records(100)))], AS_OF).raise_failures()
    spec = load_spec("raw", write_records(spark, bad["records"]))
    batch = run.ingest(sink, [spec], AS_OF)
    with pytest.raises(run.BatchError, match="raw"):
        batch.raise_failures()
    assert sink.read("raw").count() == 100
    failed = run.failed_runs(sink.read(run.LOAD_AUDIT)).collect()
    assert len(failed) == 1 and told in failed[0].erro


def test_new_columns_are_welcome(spark, sink):
    run.ingest(sink, [load_spec("raw", write_records(spark, records(5)))], AS_OF).raise_failures()
    more = load_spec("raw", write_records(spark, records(5, extra="x")))
    run.ingest(sink, [more], AS_OF).raise_failures()
    assert "extra" in sink.read("raw").columns


def test_one_failure_does_not_stop_the_others(spark, sink):
    good = write_records(spark, records(4))
    specs = [load_spec(f"t{i}", good) for i in range(3)]
    specs.insert(1, load_spec("broken", "/nowhere/at/all"))
    batch = run.ingest(sink, specs, AS_OF, "b")
    assert [r["status"] for r in batch.rows] == ["OK", "ERRO", "OK", "OK"]
    assert [r["tabela"] for r in batch.rows] == ["t0", "broken", "t1", "t2"]
    assert sink.read(run.LOAD_AUDIT).count() == 4
    assert {sink.exists(f"t{i}") for i in range(3)} == {True}
    assert all(len(r["erro"] or "") <= run.ERROR_LENGTH for r in batch.rows)


# ----------------------------------------------------------------- curation

CURATION = CurationSpec(
    source="raw", target="clean", keys=("day", "k"),
    columns=(ColumnSpec("d", "day", "date", "yyyy-MM-dd"), ColumnSpec("k", "k", "string"),
             ColumnSpec("v", "v", "int")), rules={"v_small": "v < 1000"})


def _curation(spark, sink, rows):
    raw = spark.createDataFrame(rows, "d string, k string, v int").withColumns({
        "_batch_id": F.lit("r1"), "_ingestion_timestamp": F.lit("2024-01-03").cast("timestamp")})
    sink.replace(raw, "raw")


def test_curation_counts_add_up(spark, sink):
    _curation(spark, sink, [("2024-01-02", str(i % 7), i) for i in range(20)])
    batch = run.curate_all(sink, [CURATION], "b2")
    batch.raise_failures()
    row, = batch.rows
    assert (row["registros_lidos"], row["registros_gravados"], row["duplicatas_removidas"]) == (20, 7, 13)
    table = sink.read("clean")
    assert table.columns == ["day", "k", "v", "_bronze_batch_id", "_bronze_ingestion_timestamp",
                             "_silver_batch_id", "_silver_timestamp"]
    assert {r.v for r in table.collect()} == set(range(13, 20))


def test_refused_curation_keeps_the_old_table(spark, sink):
    _curation(spark, sink, [("2024-01-02", "a", 1)])
    run.curate_all(sink, [CURATION]).raise_failures()
    _curation(spark, sink, [("2024-01-02", "a", 1), ("2024-01-02", "b", 5000)])
    with pytest.raises(run.BatchError, match="rule__v_small"):
        run.curate_all(sink, [CURATION]).raise_failures()
    assert sink.read("clean").count() == 1
    assert sink.read(run.CURATION_AUDIT).count() == 2


# -------------------------------------------------------------------- model

def test_full_refresh_with_the_published_catalog(spark, sink):
    """Four landed sources to five tested tables."""
    days = [f"2024-01-{n:02d}" for n in range(2, 6)]
    stats = dict(Media=4.0, Mediana=4.0, DesvioPadrao=0.1, Minimo=3.0, Maximo=5.0)
    landed = {
        catalog.SURVEY: [dict(Data=d, Indicador=i, IndicadorDetalhe=None, DataReferencia="2026",
                              baseCalculo=b, numeroRespondentes=9, **stats)
                         for d in days for i in ("IPCA", "Selic", "Outro") for b in (0, 1)],
        catalog.TOP5: [dict(Data=d, Indicador=i, DataReferencia="2026", tipoCalculo=t, **{**stats, "Mediana": 4.5})
                       for d in days for i in ("IPCA", "Selic") for t in ("C", "M")],
        catalog.INFLATION: [dict(Data=d, Indicador="IPCA", Suavizada=s, baseCalculo=1,
                                 numeroRespondentes=9, **stats) for d in days for s in ("S", "N")],
        catalog.RATE: [dict(data="02/01/2024", valor="13.75"), dict(data="03/01/2024", valor="13.75")],
    }
    sources = [replace(s, reader="json", options={"path": write_records(
        spark, next(r for t, r in landed.items() if s.target == catalog.raw_table(t)))})
        for s in catalog.SOURCES]
    gold = TableSink(spark, f"{sink.database}_gold", sink.folder).create()
    tables = run.refresh(sink, sources, catalog.CURATIONS, AS_OF, marts=gold)
    assert gold.exists(catalog.COMPARISON) and not sink.exists(catalog.COMPARISON)
    assert tables[catalog.EXPECTATIONS].count() == 16  # the filter drops the other indicator
    assert tables[catalog.COMPARISON].count() == 8
    assert {r.sinal_posicionamento for r in tables[catalog.COMPARISON].collect()} == {
        "Top 5 mais alto (Hawkish)"}
    assert [r.taxa_juro_real_ex_ante for r in tables[catalog.REAL_RATE].collect()] == [9.375, 9.375]
    assert tables[catalog.CALENDAR].count() == 14975
    top = spark.sql(f"SELECT * FROM {gold.name(catalog.REAL_RATE)} ORDER BY data DESC LIMIT 10")
    assert top.first().data == date(2024, 1, 3)
    # a second run with the same records refreshes everything again
    run.refresh(sink, sources, catalog.CURATIONS, AS_OF, marts=gold)
    star = Star.of({t: gold.read(t) for t in tables})
    assert measure("kpi_ipca", star).first().kpi_ipca == 4.0
    assert sink.read(run.LOAD_AUDIT).count() == 8


def test_failing_data_test_is_reported(spark, sink):
    tables = {"t": spark.createDataFrame([(None,), (1,)], "k int")}
    from sondaflow.specs import ColumnTest
    with pytest.raises(run.BatchError, match="t.k not_null: 1"):
        run.verify_models(tables, [ColumnTest("t", "k", "not_null")])


def test_gate_error_is_a_value_error():
    assert issubclass(gates.GateError, ValueError)


def test_a_window_is_read_in_batches_of_bounded_size(monkeypatch):
    most, taken = [0], [0]

    def fetch(request):
        for k in range(25_000):
            taken[0] += 1
            yield {"k": k}

    reader = paged._WindowReader({"windows": json.dumps([["2024-01-01", "2024-12-31"]]), "readers": "1"}, fetch)
    sizes = []
    for batch in reader.read(reader.partitions()[0]):
        sizes.append(batch.num_rows)
        most[0] = max(most[0], taken[0] - sum(sizes))
    assert sum(sizes) == 25_000 and max(sizes) <= paged.RECORDS_AT_ONCE and most[0] == 0


def test_landed_records_are_compressed_in_small_files(spark, monkeypatch):
    monkeypatch.setattr(landing, "RECORDS_A_FILE", 100)
    path = landing.land(spark.range(0, 1000, 1, 2).selectExpr("to_json(struct(id)) AS value"), scratch_path(spark, "landing"))
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 10 and all(f.endswith(".gz") for f in files)
    assert sorted(r.id for r in landing.read_landed(spark, path).collect()) == list(range(1000))
