"""The stages of the pipeline against plain versions, each on its own input, and on odd rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
import plain
from sondaflow.llm import mixing
from test_operators import FOLDER, ODD, SCHEMA, frame, tokens


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """What each stage returns, written and read again for the next one."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    out.append(docs)
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [frame.collect() for frame in out], [frame.columns for frame in out]


def test_stages(outputs):
    _, columns = outputs
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_dedup", "secret_scan", "source_mix", "pack"]
    assert all(c == columns[0] for c in columns[:-1])


def test_quality_rules(outputs):
    (docs, kept, *_), _ = outputs
    expected = {r.doc_id: plain.clean(r.text)[0] for r in docs if plain.clean(r.text)[1]}
    assert {r.doc_id: r.text for r in kept} == expected and len(expected) < len(docs)
    assert all(r.n_chars == len(r.text) for r in kept)


def test_near_dedup(outputs):
    (_, docs, kept, *_), _ = outputs
    root = plain.components({r.doc_id: plain.shingles(r.text, 5) for r in docs})
    assert sorted(kept) == sorted(r for r in docs if root[r.doc_id] == r.doc_id) and len(kept) < len(docs)


def test_secret_scan(outputs):
    (_, _, docs, masked, *_), _ = outputs
    before = {r.doc_id: r.text for r in docs}
    assert {r.doc_id for r in masked} == set(before)
    for r in masked:
        spans = plain.base_spans(before[r.doc_id])
        assert not any(before[r.doc_id][a:b] in r.text for a, _, b in spans)
        if r.text != before[r.doc_id]:
            assert "[SECRET]" in r.text
        assert r.n_chars == len(r.text)


def test_source_mix(outputs):
    (_, _, _, docs, mixed, _), _ = outputs
    sizes, taken, by_doc = Counter(), Counter(), Counter()
    for r in docs:
        sizes[r.source] += len(plain.words(r.text))
    whole = {r.doc_id: r.text for r in docs}
    for r in mixed:
        n = len(plain.words(r.text))
        taken[r.source] += n
        by_doc[r.doc_id] += n
        assert r.text in whole[r.doc_id]
    for s, target in mixing.targets(dict(sizes)).items():
        assert abs(taken[s] - target) <= 1
    assert all(n <= 2 * len(plain.words(whole[d])) for d, n in by_doc.items())


def test_pack(outputs):
    (*_, docs, pieces), _ = outputs
    expected = tokens([r.text for r in docs])
    assert sum(p.length for p in pieces) == sum(map(len, expected))
    assert Counter(p.doc_tokens for p in pieces if p.start == 0) == Counter(map(len, expected))
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 4096


def test_run_is_the_stages_in_turn(spark, monkeypatch):
    def adding(n):
        return lambda spark, docs, folder: docs.withColumn("n_chars", F.col("n_chars") * 10 + n)

    monkeypatch.setattr(pipeline, "STAGES", [("a", adding(1)), ("b", adding(2)), ("c", adding(3))])
    before = spark.read.parquet(f"{FOLDER}/documents.parquet").agg(F.sum(F.col("n_chars") * 1000 + 123)).first()[0]
    assert pipeline.run(spark, FOLDER).agg(F.sum("n_chars")).first()[0] == before


PROSE = "This is a plain sentence number {} of a text that is long enough to pass the rules of quality."


def test_odd_rows(spark, tmp_path):
    rows = [*ODD, (None, PROSE.format(1), None, None), (20, PROSE.format(2), "en", "a"), (20, PROSE.format(2), "en", "a"),
            (21, PROSE.format("token=abcdef123") + " And so it goes on with other words until the end.", None, None)]
    docs = frame(spark, rows).drop("n_words", "kept")
    names = docs.columns
    for name, stage in pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "near_dedup":
            assert sorted(str(r.doc_id) for r in docs.collect()) == ["20", "21", "7", "None"]
        if name == "secret_scan":
            assert "number [SECRET] of" in docs.filter("doc_id = 21").first().text
        if name != "pack":
            assert docs.columns == names
    assert docs.count() > 0


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
