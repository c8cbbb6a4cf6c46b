"""The transports of the extract queries: each request reads its own page only."""

from sondaflow.sources.paged import PageRequest
from workload import proxies, queries

FOLDER = "/root/testdata/sf0.001"


def test_a_request_reads_one_file_of_one_page(spark):
    events = proxies.table(spark, FOLDER, "events").select("event_id", "value")
    ids = sorted(r.event_id for r in events.collect())
    root = queries._written_pages(events, "event_id", 300)
    files = spark.read.parquet(root).inputFiles()
    assert len(files) == -(-len(ids) // 300)
    fetch = queries._pages_of(root, ["event_id", "value"])
    for page in range(len(files) + 1):
        got = fetch(PageRequest("events", ("event_id",), "", page * 300, 300))
        assert [r["event_id"] for r in got] == ids[page * 300:(page + 1) * 300]
