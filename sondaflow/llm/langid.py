"""Language identification: multinomial naive Bayes over hashed character n-grams.

Each task counts hashed n-grams per language and sends one row per language and
bucket that it met, so the shuffle is bounded by tasks x languages x buckets. The
matrix of log probabilities (languages x buckets, its size is checked) is
broadcast, and texts are scored in batches by array operations.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sondaflow.llm.tables import written

BUCKET_BITS = 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
MOST_LANGUAGES = 2000   # 2000 x 2^15 x 4 bytes = 262 MB
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def _buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the n-grams of some texts and how many stand before each text.

    A text is lower-cased, its white space becomes single spaces, and a space
    stands at either end, so that n-grams see where words begin and end.
    """
    plain = [" " + " ".join(t.lower().split()) + " " for t in texts]
    points = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum([len(t) for t in plain])
    found, width = [], max(ORDERS)
    hashed = np.zeros(len(points), np.uint64)
    for order in range(1, width + 1):
        shifted = np.zeros(len(points), np.uint64)
        shifted[:len(points) - order + 1] = points[order - 1:]
        hashed = (hashed + shifted + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
        if order in ORDERS:
            mixed = hashed * np.uint64(0xBF58476D1CE4E5B9)
            bucket = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
            inside = np.ones(len(points), bool)  # an n-gram does not run into the next text
            for back in range(1, order):
                at = ends - back
                inside[at[at >= 0]] = False
            found.append((bucket, inside))
    keep = np.stack([inside for _, inside in found], 1)
    grams = np.stack([bucket for bucket, _ in found], 1)[keep]
    before = np.concatenate(([0], np.cumsum(keep.sum(1))))
    return grams, before[np.concatenate(([0], ends))]


def _chunks(batch: pa.RecordBatch, most: int = 1 << 19) -> Iterator[tuple[int, int, list[str]]]:
    texts = batch.column("text").fill_null("").to_pylist()
    first, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield first, at + 1, texts[first:at + 1]
            first, size = at + 1, 0
    if first < len(texts):
        yield first, len(texts), texts[first:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, last, texts in _chunks(batch):
            grams, before = _buckets(texts)
            names = sorted(set(langs[first:last]))
            owner = np.repeat([names.index(x) for x in langs[first:last]], np.diff(before))
            for k, name in enumerate(names):
                # The last place counts documents, for the prior.
                mine = counts.setdefault(name, np.zeros((1 << BUCKET_BITS) + 1, np.int64))
                mine[:-1] += np.bincount(grams[owner == k], minlength=1 << BUCKET_BITS)
                mine[-1] += langs[first:last].count(name)
    for name, mine in counts.items():
        at = np.flatnonzero(mine)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(mine[at], pa.int64())],
            ["lang", "bucket", "n"])


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in code point order, their log priors, and the log probabilities (buckets x languages).

    Rows without a text or a language teach nothing.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    counts = written(rows.mapInArrow(_count, "lang string, bucket int, n long")
                     .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "ngrams")
    names = counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).toPandas()["lang"].tolist()
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the matrix would be too large to broadcast")
    names = sorted(names)
    table = np.zeros(((1 << BUCKET_BITS) + 1, len(names)))
    found = counts.toPandas()
    place = {name: k for k, name in enumerate(names)}
    table[found["bucket"].to_numpy(int), found["lang"].map(place).to_numpy(int)] = found["n"].to_numpy(float)
    grams, prior = table[:-1] + SMOOTHING, table[-1]
    with np.errstate(divide="ignore"):
        return names, np.log(prior / max(1.0, prior.sum())), np.log(grams / grams.sum(0)).astype(np.float32)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text by default) with ``lang_pred`` and ``score``, the
    probability of that language given the text. Texts that are null or have no letter
    are ``und`` with score 0, and so is every text when nothing was learned. Of languages that are
    equally probable the first by code point is taken. A very long text is counted whole. Repeated
    rows are predicted alike; no rows give no rows."""
    names, prior, table = model
    keep = keep if keep is not None else [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast((prior, table))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, table = shared.value
        for batch in batches:
            rest = [n for n in batch.schema.names if n != "text"]
            for first, last, texts in _chunks(batch):
                said, score = np.full(last - first, UNKNOWN, object), np.zeros(last - first)
                lettered = np.array([bool(LETTER.search(t)) for t in texts])
                if names and lettered.any():
                    grams, before = _buckets(texts)
                    logs = np.empty((last - first, len(names)))
                    for k in range(len(names)):
                        sums = np.concatenate(([0.0], np.cumsum(table[grams, k], dtype=np.float64)))
                        logs[:, k] = prior[k] + sums[before[1:]] - sums[before[:-1]]
                    best = logs.argmax(1)
                    share = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
                    said[lettered] = np.array(names, object)[best[lettered]]
                    score[lettered] = share[lettered]
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in rest] + [pa.array(said, pa.string()), pa.array(score)],
                    [*rest, "lang_pred", "score"])

    # The kept columns go by place, so that none clashes with the text or the added ones.
    inner = [F.col(c).alias(f"c{k}") for k, c in enumerate(keep)]
    schema = ", ".join([*(f"c{k} {kinds[c]}" for k, c in enumerate(keep)), "lang_pred string, score double"])
    out = docs.select(*inner, F.col(text).alias("text")).mapInArrow(run, schema)
    return out.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(keep)), "lang_pred", "score")
