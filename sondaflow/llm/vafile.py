"""Exact top-k by inner product over a vector-approximation file.

Every vector is an integer cell per dimension, one byte each. A scan over the cells
bounds each inner product from both sides; per query, what cannot reach the kth
best lower bound falls out. Exact vectors are then read in the order of their
bounds: the k most promising first, and of the others only those whose bound still
reaches the kth exact score, after which the result is certain.

The query set meets the rows in blocks: a block of queries and a few blocks of
cells share a key, so every task holds a bounded part of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sondaflow.llm.tables import written

ROWS_PER_BLOCK = 4096
BLOCKS_PER_KEY = 4
QUERIES_PER_BLOCK = 1024
CELLS = 256


def integers(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component as double; null unless all are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _approximated(vectors: DataFrame, low: dict, width: dict) -> DataFrame:
    """Blocks of rows: dim, ids, and the cells of their vectors as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            sizes = np.asarray(lists.value_lengths())
            values = np.asarray(lists.flatten())
            ends = np.cumsum(sizes)
            ids = np.asarray(batch.column("id"))
            for dim in np.unique(sizes):
                mine = np.flatnonzero(sizes == dim)
                for first in range(0, len(mine), ROWS_PER_BLOCK):
                    rows = mine[first:first + ROWS_PER_BLOCK]
                    part = values[(ends[rows] - dim)[:, None] + np.arange(dim)]
                    cells = ((part - low[int(dim)]) // width[int(dim)]).astype(np.uint8)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(dim)], pa.int32()), pa.array([ids[rows].astype("<i8").tobytes()], pa.binary()),
                         pa.array([cells.tobytes()], pa.binary())], ["dim", "ids", "cells"])
    return vectors.mapInArrow(run, "dim int, ids binary, cells binary")


def _bounded(low: dict, width: dict, k: int):
    """Per (query, row): bounds of the product, for rows that may be among the block's best k."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(n)[row].as_py() for n in ("dim", "ids", "cells", "queries")}
                dim = one["dim"]
                ids = np.frombuffer(one["ids"], "<i8")
                half = (width[dim] - 1) / 2
                middle = np.frombuffer(one["cells"], np.uint8).reshape(len(ids), dim) * width[dim] + low[dim] + half
                names = np.array([q["id"] for q in one["queries"]], np.int64)
                asked = np.array([q["v"] for q in one["queries"]], np.float64)
                scores = asked @ middle.T
                slack = np.abs(asked) @ half
                scores[names[:, None] == ids[None, :]] = -np.inf
                count = min(k, len(ids))
                kth = np.partition(scores, len(ids) - count, axis=1)[:, len(ids) - count]
                at, which = np.nonzero((scores >= (kth - 2 * slack)[:, None]) & (scores > -np.inf))
                value = scores[at, which]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[at]), pa.array(ids[which]), pa.array(value - slack[at]),
                     pa.array(value + slack[at])], ["query_id", "id", "least", "most"])
    return run


def _best(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(
        F.col("rank") <= k)


def _exact(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """The integer inner product of each (query_id, id)."""
    return (pairs.join(vectors.select("id", F.col("v").alias("a")), "id")
            .join(vectors.select(F.col("id").alias("query_id"), F.col("v").alias("b")), "query_id")
            .withColumn("score", F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0).cast("long"),
                                             lambda total, x: total + x))
            .drop("a", "b"))


def top_k(rows: DataFrame, asked: Column, id: str = "vec_id", vector: str = "embedding", k: int = 5,
          scale: float = 256.0) -> DataFrame:
    """Rows (query_id, rank, <id>, score): the k best rows of each query by integer inner product.

    Queries are the rows for which ``asked`` holds; candidates are all rows but the
    query's own. Ties go to the smaller id. Components become floor(scale * x).
    Vectors that are null or hold null or non-finite components, and rows without an
    id, take no part; nor does an empty vector. Vectors of different lengths are not
    compared. Rows that repeat an id are one row, with the largest of their vectors.
    A query with fewer than k candidates gets them all, no rows give no rows.
    Sums must fit into 53 bits. A very long vector is scored whole. Other columns are ignored.
    """
    vectors = written(
        rows.select(F.col(id).alias("id"), integers(F.col(vector), scale).alias("v"), asked.alias("asked"))
        .filter("id is not null and v is not null and size(v) > 0")
        .groupBy("id").agg(F.max("v").alias("v"), F.max("asked").alias("asked")), "vectors")

    # Cells of one width per dimension; as many rows as there are dimensions.
    ranges = (vectors.select(F.size("v").alias("dim"), F.posexplode("v")).groupBy("dim", "pos")
              .agg(F.min("col").alias("low"), F.max("col").alias("high")).orderBy("dim", "pos").collect())
    low, width = {}, {}
    for dim in {r.dim for r in ranges}:
        mine = [r for r in ranges if r.dim == dim]
        low[dim] = np.array([r.low for r in mine], np.int64)
        width[dim] = np.array([-(-(r.high - r.low + 1) // CELLS) for r in mine], np.int64)

    blocks = written(_approximated(vectors.select("id", "v"), low, width), "cells")
    n_blocks, n_queries = blocks.count(), vectors.filter("asked").count()
    groups, lanes = -(-n_queries // QUERIES_PER_BLOCK) or 1, -(-n_blocks // BLOCKS_PER_KEY) or 1
    queries = (vectors.filter("asked").groupBy(
                   F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(groups)).alias("group"))
               .agg(F.collect_list(F.struct("id", "v")).alias("queries"))
               .withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))))
    spread = (blocks.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int"))
              .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))))
    bounds = written(
        spread.join(queries, ["dim", "group", "lane"]).select("dim", "ids", "cells", "queries")
        .mapInArrow(_bounded(low, width, k), "query_id long, id long, least double, most double"), "bounds")

    kth = (_best(bounds, k, F.desc("least"), F.col("id")).groupBy("query_id")
           .agg(F.when(F.count(F.lit(1)) == k, F.min("least")).alias("floor")))
    open_ = bounds.join(kth, "query_id").filter("floor is null or most >= floor").select("query_id", "id", "most")
    ordered = written(open_.withColumn("turn", F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("most"), "id"))), "ordered")
    first = written(_exact(ordered.filter(F.col("turn") <= k), vectors), "first")
    certain = first.groupBy("query_id").agg(F.min("score").alias("floor"))
    rest = ordered.filter(F.col("turn") > k).join(certain, "query_id").filter("most >= floor").drop("floor")
    scored = first.unionByName(_exact(rest, vectors))
    return _best(scored, k, F.desc("score"), F.col("id")).select(
        "query_id", "rank", F.col("id").alias(id), "score")
