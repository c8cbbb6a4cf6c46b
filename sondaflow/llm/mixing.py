"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

Every source is divided into shards of about a million words, a shard into blocks
of ``block`` words. Blocks go to sources, then to groups of a source's shards, then
to shards by the highest quotients words / (2 seats + 1); each shard so has an integer
quota, of at most twice its words. The shard draws its blocks in a seeded order,
all of them once before any a second time, and the last block is cut where the
quota of words ends. Quotas of sources end at the target's word, so a source's
words equal its rounded target.

Shards and groups are bounded whatever a source's size, so no window or group
holds a whole source; one row per source comes to the driver, where the weights are.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sondaflow.llm.tables import written

BLOCK = 256
SHARD_WORDS = 1 << 20
WEIGHTS = (5, 2, 1)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def in_order(sources) -> list:
    """By code point, a null last."""
    return sorted(s for s in sources if s is not None) + [s for s in sources if s is None]


def targets(sizes: dict, weights: Sequence[float] = WEIGHTS, percent: int = 150, most: float = 2.0) -> dict:
    """Words wanted of each source. Sources by code point, a null last, weigh ``weights`` in turn and
    share ``percent`` of all words; none gets more than ``most`` times its own, and what
    is over goes to the others by weight until none is above."""
    order = in_order(sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    free, rest, out = list(order), percent / 100 * sum(sizes.values()), {}
    while free:
        share = rest / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > most * sizes[s]]
        if not over:
            return out | {s: share * weight[s] for s in free}
        for s in over:
            out[s] = most * sizes[s]
            rest -= out[s]
            free.remove(s)
    return out


def sainte_lague(votes: Sequence[float], seats: int, caps: Sequence[int]) -> list[int]:
    """Seats by the highest quotients vote / (2 seats + 1); ties go to the first, caps are kept."""
    # A divisor that hands out too few seats gives each only seats it surely has; the rest go one by one.
    total, given = sum(votes), [0] * len(votes)
    if total > 0:
        divisor = total / max(seats, 1)
        while sum(math.floor(v / divisor + 0.5) for v in votes) > seats:
            divisor *= 1 + 1 / (1 + seats)
        given = [min(c, math.floor(v / divisor + 0.5)) for v, c in zip(votes, caps)]
    heap = [(-v / (2 * g + 1), k) for k, (v, g, c) in enumerate(zip(votes, given, caps)) if g < c and v > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        if not heap:
            break
        _, k = heap[0]
        given[k] += 1
        if given[k] < caps[k]:
            heapq.heapreplace(heap, (-votes[k] / (2 * given[k] + 1), k))
        else:
            heapq.heappop(heap)
    return given


def budgets(wanted: int, sizes: Sequence[int], block: int, most: int = 2) -> list[int]:
    """Words for each part of a whole that gives ``wanted`` words: seats of ``block`` words by
    Sainte-Laguë, then what is less than a block to those that still have room."""
    seats = sainte_lague(sizes, wanted // block, [most * n // block for n in sizes])
    out, rest = [s * block for s in seats], wanted - block * sum(seats)
    for k, n in enumerate(sizes):
        more = min(rest, most * n - out[k])
        out[k] += more
        rest -= more
    return out


def _split(block: int, child: str):
    """For one parent: its words among its children, in their order."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(child, kind="stable")
        return rows.assign(budget=budgets(int(rows["budget"].iloc[0]), rows["words"].tolist(), block))
    return run


def _children(parents: DataFrame, sizes: DataFrame, keys: list[str], child: str, block: int) -> DataFrame:
    rows = sizes.join(parents.select(*keys, "budget"), keys)
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.groupBy(*keys).applyInPandas(_split(block, child), schema)


def n_words(text: Column) -> Column:
    """Number of runs of characters other than space and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
          weights: Sequence[float] = WEIGHTS, percent: int = 150, block: int = BLOCK,
          shard_words: int = SHARD_WORDS, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Documents and what the mix takes of them.

    The first frame has a row per row of ``docs``: row, hash (of id and text), id, size,
    source, source_size, target, taken. The second has a row per taken run of words: row, turn (0 for the
    first copy, 1 for the second), first and last word (exclusive). ``row`` is a key
    made from id, text and a running number of equal rows.

    The draw depends on id, text and seed alone, so reruns agree. Null sources are a
    source, null ids and repeated rows are documents of their own; a document without
    words is never taken. A very long text is many blocks, drawn one by one. Equal quotients go to the
    source that comes first. Other columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    # Equal rows become one row with a count, then one for each number up to it.
    equal = docs.select(F.col(id).alias("id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
                        F.xxhash64(F.col(id), F.col(text)).alias("hash"))
    equal = equal.groupBy("hash", "id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    rows = written(
        equal.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")
        .withColumn("row", F.md5(F.concat_ws(":", "hash", F.col("id").cast("string"), "source", "copy", F.lit(seed)))),
        "rows")

    per_source = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).collect()
    sizes = {r.source: r.words for r in per_source}
    wanted = targets(sizes, weights, percent) if sum(sizes.values()) else {s: 0.0 for s in sizes}
    names = in_order(sizes)
    quotas = sainte_lague([wanted[s] for s in names], round(sum(wanted.values()) / block),
                          [2 * sizes[s] // block + 1 for s in names])
    plan = []
    for name, quota in zip(names, quotas):
        # The last block of a source is cut, or begun, so that its words meet the target.
        budget = min(max(round(wanted[name]), (quota - 1) * block), (quota + 1) * block, 2 * sizes[name])
        shards = max(1, round(sizes[name] / shard_words))
        plan.append((name, sizes[name], float(wanted[name]), budget, shards, math.isqrt(shards - 1) + 1))
    plan = spark.createDataFrame(
        plan, "name string, source_size long, target double, budget long, shards long, groups long")
    at = rows.join(plan, F.col("source").eqNullSafe(F.col("name")), "left").drop("name")
    at = (at.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(1)), F.col("shards")))
          .withColumn("grp", F.pmod("shard", "groups"))
          .withColumn("source_key", F.xxhash64("source")))

    # Words of shards, of groups of shards, of sources; budgets the other way round.
    sized = at.filter("size > 0")
    shards = written(sized.groupBy("source_key", "grp", "shard").agg(
        F.sum("size").alias("words"), F.first("budget").alias("source_budget")), "shards")
    tops = shards.groupBy("source_key").agg(F.first("source_budget").alias("budget"))
    groups = shards.groupBy("source_key", "grp").agg(F.sum("words").alias("words"))
    groups = _children(tops, groups, ["source_key"], "grp", block)
    quota = _children(groups, shards.select("source_key", "grp", "shard", "words"),
                      ["source_key", "grp"], "shard", block)

    # A shard's words in the order of the rows' keys, cut into blocks; its blocks in seeded order.
    line = Window.partitionBy("source_key", "shard").orderBy("row")
    placed = sized.select("source_key", "shard", "row", "size",
                          (F.sum("size").over(line) - F.col("size")).alias("start"))
    blocks = (quota.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(words - 1) div {block}"))))
              .withColumn("length", F.least(F.lit(block), F.col("words") - F.col("block") * block)))
    draw = Window.partitionBy("source_key", "shard").orderBy(
        F.xxhash64("source_key", "shard", "block", F.lit(seed)), "block")
    drawn = (blocks.withColumn("before", F.sum("length").over(draw) - F.col("length"))
             .withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1))))
             .withColumn("length", F.least("length", F.expr("budget - before - turn * words")))
             .filter("length > 0")
             .select("source_key", "shard", "block", "turn", F.expr(f"block * {block}").alias("first"),
                     F.expr(f"block * {block} + length").alias("last")))
    pieces = (placed.withColumn("block", F.explode(F.sequence(
                  F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
              # Blocks are unfolded from few rows, so their number must not be guessed from those.
              .join(drawn.hint("merge"), ["source_key", "shard", "block"])
              .select("row", "turn", F.greatest(F.lit(0), F.col("first") - F.col("start")).alias("first"),
                      F.least(F.col("size"), F.col("last") - F.col("start")).alias("last"))
              .filter("last > first"))
    pieces = written(pieces, "pieces")
    taken = pieces.groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    out = at.join(taken, "row", "left").select(
        "row", "hash", F.col("id").alias(id), "size", "source", "source_size", "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    return out, pieces


def _cut(column: str, size: str | None):
    """The words first … last of each text as they stand in it; a whole text stays as it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, first, last, words in zip(*(batch.column(c).to_pylist() for c in (column, "__first", "__last", "__size"))):
                if (first, last) != (0, words):
                    bounds = [m.span() for m in islice(WORD.finditer(text), first, last)]
                    text = text[bounds[0][0]:bounds[-1][1]]
                texts.append(text)
            columns = {n: batch.column(n) for n in batch.schema.names if n not in ("__first", "__last", "__size")}
            columns[column] = pa.array(texts, pa.string())
            if size in columns:
                columns[size] = pa.array([len(t) for t in texts], columns[size].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    return run


def mixed_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
                    chars: str | None = "n_chars", **options) -> DataFrame:
    """The mix as rows like those of ``docs``: one for each run of words taken without a gap.

    A run is a piece of the document's text, all of it where nothing was left out; a
    document that is taken twice has rows of both turns. ``chars``, if there is such a
    column, becomes the length of the new text. Rows that repeat id, text and source
    lend their other columns from one of them.
    """
    found, pieces = mixed(docs, id, text, source, **options)
    # Runs of neighbouring blocks are one.
    line = Window.partitionBy("row", "turn").orderBy("first")
    runs = (pieces.withColumn("gap", F.coalesce(F.col("first") != F.lag("last").over(line), F.lit(True)))
            .withColumn("run", F.sum(F.col("gap").cast("int")).over(line))
            .groupBy("row", "turn", "run").agg(F.min("first").alias("__first"), F.max("last").alias("__last")))
    taken = found.select(
        "row", F.col("hash").alias("__of"), F.col(id).alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"))
    taken = runs.join(taken, "row").select("__of", "__id", "__source", "__size", "__first", "__last")
    # Given columns go by their place, since they may have any name.
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    id, text, source = names[id], names[text], names[source]
    given = docs.toDF(*names.values())
    whole = (given.withColumn("__hash", F.xxhash64(F.col(id), F.col(text))).repartition("__hash")
             .dropDuplicates(["__hash", id, source]))
    rows = whole.join(taken, (F.col("__hash") == F.col("__of")) & F.col(id).eqNullSafe(F.col("__id"))
                      & F.col(source).eqNullSafe(F.col("__source")))
    schema = ", ".join(f"`{n}` {t}" for n, t in given.dtypes)
    return (rows.select(*given.columns, "__first", "__last", "__size")
            .mapInArrow(_cut(text, names.get(chars)), schema).toDF(*docs.columns))
