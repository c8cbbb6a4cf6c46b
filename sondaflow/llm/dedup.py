"""Near-duplicate documents by bottom-k sketches of their word shingles.

One hash function orders all shingles; a document's sketch is its ``keep``
smallest hashes. Documents are linked when the Jaccard similarity of their whole
shingle sets reaches ``percent``:

1. Documents with the same set become one node, so copies cost one row each.
2. Inverted lists of retained values generate overlaps. Rare values come first:
   a node shares at least ``need`` values with any node linked to it, so they meet
   in the list of one of its ``size - need + 1`` rarest, and the lists of common
   passages, which stand last, are hardly ever used. Values of one node need no list.
3. Lists link nodes to hubs, each node to one at a time, first to the one whose values
   are most common, which is the original among edited copies. After that, pairs of a
   list whose ends are still in different components are tried. No pair inside a component
   is made, and none that shingles found in one document only rule out: what is unique
   in a text bounds the similarity that it can have with any other. Long lists are compared
   in tiles of their nodes, whose pairs never become rows: matrix products count the values
   that sketches share in the union's, whole sets decide, and a tile gives a forest of links.
4. The sketch of the union (its ``keep`` smallest hashes) estimates the similarity
   of a pair; pairs far below the limit go.
5. The whole sets of the remaining pairs, made again from the texts, decide.

``need`` follows from the size of a set: a pair at the limit shares fewer retained
values with a probability below 1e-12, and sets not larger than a sketch always
share as many. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sondaflow.llm.components import components
from sondaflow.llm.tables import per_block, row_blocks, text_bytes, written
from sondaflow.llm.words import mix, shingle_hashes, word_hashes

HUB_ROUNDS = 2
MISS = 1e-12
KEEP = 96
# Nodes of a list whose pairs are rows of a join; longer lists are compared in tiles of so many by as many nodes,
# fewer if their sets hold more than so many shingles on average, along so many ranges of values.
PAIRED = 32
TILE = 1024
TILE_SHINGLES = 512
RANGES = 64


def _shared_at_least(union: int, keep: int, percent: int) -> int:
    """Values of the union's sketch that both ends of a linked pair hold, but for a chance of ``MISS``:
    the sketch is a random draw from the union, of which at most ``100 - percent`` in 100 are not in both."""
    apart = union * (100 - percent) // 100
    if union <= keep:
        return union - apart

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    total = 0.0
    for misses in range(min(apart, keep), -1, -1):
        if keep - misses <= union - apart:
            total += math.exp(log_choose(apart, misses) + log_choose(union - apart, keep - misses)
                              - log_choose(union, keep))
        if total > MISS:
            return keep - misses
    return keep


def needed(keep: int, percent: int) -> list[int]:
    """By size of a set: retained values that it shares with any set linked to it. The last entry,
    for a union so large that its sketch is a draw with replacement, holds for all larger sizes."""
    sizes = 8 * keep
    shared = [_shared_at_least(u, keep, percent) for u in range(sizes * 100 // percent + 1)]
    needs = [min(shared[n:n * 100 // percent + 1]) for n in range(sizes)]
    return [*needs, _shared_at_least(1 << 40, keep, percent)]


def _need(n: Column, keep: int, percent: int) -> Column:
    needs = needed(keep, percent)
    return F.get(F.array(*map(F.lit, needs)), F.least(n, F.lit(len(needs) - 1)).cast("int"))


def _sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    hashes, firsts = shingle_hashes(*word_hashes(data, offsets), words)
    hashes = hashes.view(np.int64)
    for first, last in zip(firsts[:-1], firsts[1:]):
        part = np.sort(hashes[first:last])
        yield part[np.concatenate(([True], part[1:] != part[:-1]))] if last > first else part


def _sketch_kernel(words: int, keep: int):
    def kernel(data: np.ndarray, offsets: np.ndarray) -> dict:
        sizes, names, bounds, kept = [], [], [0], []
        for part in _sets(data, offsets, words):
            sizes.append(len(part))
            kept.append(part[:keep])
            bounds.append(bounds[-1] + len(kept[-1]))
            h = part.view(np.uint64)
            names.append(np.array([h.sum(), mix(h ^ np.uint64(0x5851F42D4C957F2D)).sum()], ">u8").tobytes()
                         if len(part) else None)
        values = np.concatenate(kept) if kept else np.zeros(0, np.int64)
        return {"n_shingles": pa.array(sizes, pa.int64()), "name": pa.array(names, pa.binary()),
                "sketch": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int64()))}
    return kernel


def sketches(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, keep: int = KEEP) -> DataFrame:
    """Per row: id, a hash of the text, the size of its shingle set, the name of the set, its sketch.

    The name is 128 bits made from the whole set, null when the set is empty.
    """
    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).mapInArrow(
        per_block(_sketch_kernel(words, keep)),
        f"id {kind}, text_hash long, n_shingles long, name binary, sketch array<long>")


def overlap_lists(nodes: DataFrame, keep: int, percent: int) -> DataFrame:
    """Rows (value, node, common): the inverted lists in which every linked pair meets, and how many
    nodes in all hold the node's values."""
    retained = nodes.select("node", F.explode("sketch").alias("value"))
    shared = retained.groupBy("value").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1")
    ranked = (retained.join(shared, "value").groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("nodes", "value"))).alias("ranked"))
              .join(nodes.select("node", "need"), "node").withColumn("used", F.size("ranked") - F.col("need") + 1))
    common = F.aggregate("ranked", F.lit(0).cast("long"), lambda total, r: total + r["nodes"])
    return (ranked.filter("used > 0")
            .select("node", common.alias("common"), F.explode(F.expr("slice(ranked, 1, used)")).alias("r"))
            .select("r.value", "node", "common"))


def _hub_pairs(lists: DataFrame, first: list[Column]) -> DataFrame:
    """Each node with one hub of its lists: of the nodes there the one whose component comes first in
    the given order, if that is another component."""
    hubs = (lists.groupBy("value").agg(
                F.min("root").alias("lo"), F.max("root").alias("hi"),
                F.min(F.struct(*first, "root", "node")).alias("hub"))
            .filter("lo != hi").select("value", "hub"))
    return (lists.join(hubs, "value").filter("root != hub.root").groupBy("node", "root").agg(F.min("hub").alias("hub"))
            .select("node", "root", F.col("hub.node").alias("other"), F.col("hub.root").alias("other_root"),
                    F.struct(*(F.col(f"hub.{n}") for n in hubs.select("hub.*").columns if n != "node")).alias("rank")))


def _shingle_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            nodes = np.asarray(batch.column("node"))
            for first, last in row_blocks(offsets):
                sets = list(_sets(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(nodes[first:last], [len(x) for x in sets])), pa.array(np.concatenate(sets))],
                    ["node", "shingle"])
    return run


def _may_reach(percent: int, n: str, common: str, other_n: str, other_common: str) -> Column:
    """Whether two sets can be similar enough, of which at most so many shingles are common with others."""
    both = f"least({common}, {other_common})"
    return F.expr(f"100 * {both} >= {percent} * ({n} + {other_n} - {both})")


def _cross_pairs(lists: DataFrame, ends: DataFrame, words: int, percent: int,
                 keep: int) -> tuple[DataFrame, DataFrame]:
    """Every pair of a short list that is not in one component and that may be similar, and links
    (root, other_root) that join whatever similar pairs of long lists join."""
    mixed = lists.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi")
    lists = written(lists.join(mixed.select("value"), "value"), "lists")
    # Shingles of these nodes that only one of them has.
    texts = ends.join(lists.select("node").distinct(), "node", "left_semi").select("node", "text")
    alone = (texts.mapInArrow(_shingle_rows(words), "node long, shingle long").groupBy("shingle")
             .agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("nodes")).filter("nodes = 1")
             .groupBy("node").agg(F.count(F.lit(1)).alias("alone")))
    sizes = ends.select("node", "n").join(alone, "node", "left").select(
        "node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common"))
    lists = written(lists.join(sizes, "node"), "lists")
    # What cannot reach the smallest set of its list goes first, then what cannot reach any of a component.
    bounds = lists.groupBy("value").agg(F.min("n").alias("least_n"), F.max("common").alias("most_common"))
    lists = written(lists.join(bounds, "value").filter(
        _may_reach(percent, "n", "common", "least_n", "most_common")).drop("least_n", "most_common"), "lists")
    lengths = lists.groupBy("value").agg(F.count(F.lit(1)).alias("length"), F.sum("n").alias("shingles"))
    lists = written(lists.join(lengths, "value"), "lists")
    short = lists.filter(F.col("length") <= PAIRED)
    roots = short.groupBy("value", F.col("root").alias("other_root")).agg(
        F.min("n").alias("least_n"), F.max("common").alias("most_common"))
    near = short.join(roots, (short["value"] == roots["value"]) & (F.col("root") < F.col("other_root"))
                      & _may_reach(percent, "n", "common", "least_n", "most_common")).drop(roots["value"])
    others = short.select(F.col("value").alias("in_value"), F.col("root").alias("in_root"), F.col("node").alias("other"),
                          F.col("n").alias("other_n"), F.col("common").alias("other_common"))
    pairs = near.join(others, (F.col("value") == F.col("in_value")) & (F.col("other_root") == F.col("in_root"))
                      & _may_reach(percent, "n", "common", "other_n", "other_common")).select(
        "node", "root", "other", "other_root")
    long = lists.filter(F.col("length") > PAIRED)
    meets = long.groupBy("node").agg(F.collect_list("value").alias("meets"))  # no more than a sketch has values
    long = long.join(meets, "node").join(ends.select("node", "need", "sketch"), "node")
    tiles = written(_tiled_pairs(long, keep, percent), "tiles")
    links = (tiles.join(ends.select("node", "text"), "node").groupBy("value", "a", "b")
             .applyInArrow(_forest_of_tile(words, percent), "root long, other_root long").distinct())
    return pairs.distinct(), links


def _shared_at_most(left: list[np.ndarray], right: list[np.ndarray], keep: int) -> np.ndarray:
    """For every pair of sketches at most how many of the union's smallest values are in both.

    Values go by ranges, smallest first: while a union has room, all that a range shares counts, and in
    the range that fills it no more than there is room for.
    """
    def cut(sketches: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(sketches)), [len(x) for x in sketches]), np.concatenate(sketches)

    (row_a, a), (row_b, b) = cut(left), cut(right)
    values, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    at_a, at_b = places[:len(a)], places[len(a):]
    bounds = np.unique(np.linspace(0, len(values), RANGES + 1).astype(np.int64))
    shared, union = (np.zeros((len(left), len(right)), np.float32) for _ in range(2))
    for first, last in zip(bounds[:-1], bounds[1:]):
        parts = []
        for row, at, count in ((row_a, at_a, len(left)), (row_b, at_b, len(right))):
            inside = (at >= first) & (at < last)
            part = np.zeros((count, last - first), np.float32)
            part[row[inside], at[inside] - first] = 1
            parts.append(part)
        both = parts[0] @ parts[1].T
        room = keep - union
        shared += np.clip(np.minimum(both, room), 0, None)
        union += parts[0].sum(axis=1)[:, None] + parts[1].sum(axis=1) - both
    return shared


def _shared_in_union(left: np.ndarray, right: np.ndarray, keep: int) -> int:
    """How many of the union's smallest values are in both sketches, which are sorted."""
    both = np.sort(np.concatenate((left, right)))
    twice = both[1:] == both[:-1]
    # The place of a value in the union, from its last copy.
    return int(np.count_nonzero(twice & (np.arange(1, len(both)) - np.cumsum(twice) < keep)))


def _met_before(value: int, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray | bool:
    """Which pairs meet in a list of a smaller value, too: of the values that both sides have, some at once."""
    rows, values = zip(*((np.repeat(np.arange(len(side)), [len(x) for x in side]), np.concatenate(side))
                         for side in (left, right)))
    both = np.intersect1d(*values)
    both = both[both < value]
    if not len(both):
        return False
    met = np.zeros((len(left), len(right)), bool)
    for first in range(0, len(both), TILE):
        some, parts = both[first:first + TILE], []
        for side, row, own in zip((left, right), rows, values):
            at = np.minimum(np.searchsorted(some, own), len(some) - 1)
            inside = some[at] == own
            part = np.zeros((len(side), len(some)), np.float32)
            part[row[inside], at[inside]] = 1
            parts.append(part)
        met |= parts[0] @ parts[1].T > 0
    return met


TILE_ROWS = pa.schema([("value", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("node", pa.int64()),
                       ("root", pa.int64()), ("others", pa.list_(pa.int64()))])


def _tiled(keep: int, percent: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        sides = np.asarray(rows.column("side"))
        parts = [rows.filter(pa.array((sides & side) > 0)).combine_chunks() for side in (1, 2)]
        columns = [{c: np.asarray(p.column(c)) for c in ("node", "root", "n", "common", "need")} for p in parts]
        sketches = [[np.asarray(x.values) for x in p.column("sketch")] for p in parts]
        if not all(sketches):
            return TILE_ROWS.empty_table()
        a, b = columns
        shared = _shared_at_most(*sketches, keep)
        most = np.minimum(a["common"][:, None], b["common"])
        sizes = a["n"][:, None] + b["n"]
        fits = ((shared >= np.maximum(a["need"][:, None], b["need"])) & (a["root"][:, None] != b["root"])
                & (100 * most >= percent * (sizes - most))
                & (100 * np.minimum(a["n"][:, None], b["n"]) >= percent * np.maximum(a["n"][:, None], b["n"])))
        if key[1].as_py() == key[2].as_py():
            fits &= a["node"][:, None] < b["node"]
        # A pair is looked at in the first of its lists alone.
        fits &= ~np.asarray(_met_before(key[0].as_py(), *([np.asarray(x.values) for x in p.column("meets")] for p in parts)))
        i, j = np.nonzero(fits)
        # The ranges let a few too many through; the union's sketch itself decides.
        needed = np.maximum(a["need"][i], b["need"][j])
        likely = np.array([_shared_in_union(sketches[0][x], sketches[1][y], keep) for x, y in zip(i, j)], np.int64)
        i, j = i[likely >= needed], j[likely >= needed]
        # One row for each node of a likely pair, with the others that it is compared to.
        nodes, first = np.unique(np.concatenate((a["node"][i], b["node"][j])), return_index=True)
        roots = np.concatenate((a["root"][i], b["root"][j]))[first]
        order = np.argsort(a["node"][i], kind="stable")
        bounds = np.concatenate((np.searchsorted(a["node"][i][order], nodes), [len(order)]))
        others = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(b["node"][j][order], pa.int64()))
        return pa.table([*(pa.array(np.full(len(nodes), k.as_py()), k.type) for k in key), pa.array(nodes), pa.array(roots), others],
                        schema=TILE_ROWS)
    return run


def _forest_of_tile(words: int, percent: int):
    """Whole sets decide the likely pairs of a tile; each link joins two components that none before it joined."""
    def run(rows: pa.Table) -> pa.Table:
        nodes, roots = (np.asarray(rows.column(c)) for c in ("node", "root"))
        order = np.argsort(nodes)
        data, offsets = text_bytes(rows.column("text"))
        sets = [x for first, last in row_blocks(offsets)   # hashing takes many times the bytes of the texts
                for x in _sets(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], words)]
        sizes = np.array([len(x) for x in sets])
        shingles, places = np.unique(np.concatenate(sets), return_inverse=True)
        parts = np.split(places, np.cumsum(sizes)[:-1])
        mine = np.zeros(len(shingles), bool)
        up = {r: r for r in roots.tolist()}

        def top(r: int) -> int:
            while up[r] != r:
                up[r] = r = up[up[r]]
            return r

        found = []
        for row, others in enumerate(rows.column("others")):
            with_ = order[np.searchsorted(nodes, np.asarray(others.values), sorter=order)] if len(others) else ()
            if not len(with_):
                continue
            mine[parts[row]] = True
            common = np.add.reduceat(mine[np.concatenate([parts[w] for w in with_])].astype(np.int64),
                                     np.concatenate(([0], np.cumsum(sizes[with_])[:-1])))
            mine[parts[row]] = False
            for w in with_[100 * common >= percent * (sizes[row] + sizes[with_] - common)]:
                one, other = top(int(roots[row])), top(int(roots[w]))
                if one != other:
                    up[max(one, other)] = min(one, other)
                    found.append((one, other))
        return pa.table([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["root", "other_root"])
    return run


def _tiled_pairs(lists: DataFrame, keep: int, percent: int) -> DataFrame:
    """Pairs of long lists. A list's nodes are dealt to blocks; a tile is a pair of blocks, so a task holds
    two blocks of nodes, and every pair of nodes is in one tile of the list. Rows: the nodes of likely pairs."""
    blocks = F.ceil(F.greatest(F.col("length") / TILE, F.col("shingles") / (TILE * TILE_SHINGLES))).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    with_ = F.explode(F.sequence(F.lit(0), blocks - 1))
    dealt = lists.withColumn("block", block).withColumn("with", with_).select(
        "value", F.least("block", "with").alias("a"), F.greatest("block", "with").alias("b"),
        # Side 1 are the rows of the tile, side 2 its columns; a block with itself is both.
        F.when(F.col("block") == F.col("with"), 3).when(F.col("block") < F.col("with"), 1).otherwise(2).alias("side"),
        "node", "root", "n", "common", "need", "sketch", "meets")
    return dealt.groupBy("value", "a", "b").applyInArrow(
        _tiled(keep, percent), "value long, a int, b int, node long, root long, others array<long>")


def _with_ends(pairs: DataFrame, ends: DataFrame, *columns: str) -> DataFrame:
    for name in ("node", "other"):
        pairs = pairs.join(ends.select(F.col("node").alias(name), F.struct(*columns).alias(f"at_{name}")), name)
    return pairs


def _similar_by_sketch(pairs: DataFrame, keep: int, percent: int) -> DataFrame:
    """Pairs of possible sizes whose union sketch does not rule them out."""
    return (pairs.filter(f"100 * least(at_node.n, at_other.n) >= {percent} * greatest(at_node.n, at_other.n)")
            .withColumn("union", F.expr(f"slice(sort_array(array_union(at_node.sketch, at_other.sketch)), 1, {keep})"))
            .withColumn("shared", F.expr("size(array_intersect(array_intersect(at_node.sketch, at_other.sketch), union))"))
            .filter("shared >= greatest(at_node.need, at_other.need)"))


def _forest(parents: DataFrame) -> DataFrame:
    """Rows (root, up): the last of each root's line of parents, by doubling the step until none changes."""
    parents = written(parents, "parents")
    roots = parents.count()
    while True:
        above = parents.select(F.col("root").alias("up"), F.col("up").alias("above"))
        parents = written(parents.join(above, "up", "left").select(
            "root", F.coalesce("above", "up").alias("up"), F.col("above").isNotNull().alias("moved")), "parents", roots)
        if not parents.agg(F.max("moved")).first()[0]:
            return parents.select("root", "up")
        parents = parents.select("root", "up")


def _verify(words: int, percent: int, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (text_bytes(batch.column(c)) for c in ("text", "other_text"))
            linked = []
            for first, last in row_blocks(left[1] + right[1]):
                both = [_sets(d[o[first]:o[last]], o[first:last + 1] - o[first], words) for d, o in (left, right)]
                for a, b in zip(*both):
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    linked.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(kept).filter(pa.array(linked, pa.bool_()))
    return run


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5,
                    percent: int = 80, keep: int = KEEP) -> DataFrame:
    """Per row of ``docs``: id, text_hash, n_shingles, component_id, kept.

    ``component_id`` is the smallest id that the document reaches over links,
    ``kept`` whether that is its own. Words are split at white space, A-Z count as
    a-z. A text with fewer words than a shingle has its sequence as its only
    shingle; null and wordless texts have none and are linked with nothing. Rows
    that repeat a document are linked like copies. A null id is never the smallest
    one: it gets the smallest id of its group, or null if there is none, and then
    the row is kept. A very long text has its whole set compared like any other. Other columns of
    ``docs`` play no part. No rows give no rows.
    """
    rows = written(sketches(docs, id, text, words, keep), "sketches")
    # Nodes get numbers, which stand from here on for the names of their sets.
    nodes = written(
        rows.filter("name is not null").groupBy("name").agg(
            F.min("id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .withColumn("need", _need(F.col("n"), keep, percent)).withColumn("node", F.monotonically_increasing_id()), "nodes")
    lists = written(overlap_lists(nodes, keep, percent), "lists")
    listed = nodes.join(lists.select("node").distinct(), "node", "left_semi")

    # The texts of the listed nodes, one for each set.
    wanted = listed.select("first_id").distinct()
    again = (docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
             .join(wanted, F.col("id").eqNullSafe(F.col("first_id")), "left_semi")
             .select(F.col("text").alias("whole"), "text")
             .mapInArrow(per_block(_sketch_kernel(words, 0)),
                         "whole string, n_shingles long, name binary, sketch array<long>"))
    ends = written(again.select("name", F.col("whole").alias("text"))
                   .join(listed.select("name", "node", "n", "need", "sketch"), "name")
                   .dropDuplicates(["node"]).drop("name"), "ends")

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs whose whole sets are similar."""
        rows = pairs.select("root", "other_root", "rank", F.col("at_node.text").alias("text"),
                            F.col("at_other.text").alias("other_text"))
        kept = ["root", "other_root", "rank"]
        return rows.mapInArrow(_verify(words, percent, kept), rows.select(kept).schema)

    # The first turn prefers the most common values; a parent comes before its child, so links are a forest.
    # Before it each node is its own root, as the lists have it.
    roots = lists.select("node", F.col("node").alias("root"), "common").distinct()
    for turn in range(HUB_ROUNDS):
        first = F.xxhash64("root", F.lit(turn)) if turn else -F.col("common")
        at = (written(lists.select("value", "node").join(roots, "node"), "lists") if turn
              else lists.withColumn("root", F.col("node")))
        pairs = _with_ends(_hub_pairs(at, [first.alias("key")]), ends, "n", "need", "sketch", "text")
        found = linked(_similar_by_sketch(pairs, keep, percent))
        tops = _forest(found.groupBy("root").agg(F.min("rank")["root"].alias("up")))
        roots = written(roots.join(tops, "root", "left").select(
            "node", F.coalesce("up", "root").alias("root"), "common"), "roots")
    at = lists.select("value", "node").join(roots.select("node", "root"), "node")
    # Sketches first: these pairs may be many.
    pairs, links = _cross_pairs(at, ends, words, percent, keep)
    likely = _similar_by_sketch(_with_ends(pairs, ends, "n", "need", "sketch"), keep, percent)
    found = linked(_with_ends(likely.select("node", "root", "other", "other_root", F.lit(0).alias("rank")), ends, "text"))
    links = found.select("root", "other_root").unionByName(links)
    tops = components(links.select(F.col("root").alias("u"), F.col("other_root").alias("v"))).toDF("root", "up")
    roots = roots.join(tops, "root", "left").select("node", F.coalesce("up", "root").alias("root"))

    named = (nodes.select("name", "node", "first_id").join(roots, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "root").select("name", "component_id")
    return (rows.select("id", "text_hash", "n_shingles", "name").join(named, "name", "left")
            .withColumn("component_id", F.when(F.col("name").isNull(), F.col("id")).otherwise(F.col("component_id")))
            .select(F.col("id").alias(id), "text_hash", "n_shingles", "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The kept documents with all their columns, whatever those are called; of rows that repeat id and text one stays."""
    kept = (near_duplicates(docs, id, text, **options).filter("kept")
            .select(F.col(id).alias("kept_id"), F.col("text_hash").alias("kept_text")).distinct())
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
                       F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"))
    return (rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_text")),
                      "left_semi")
            .dropDuplicates(["id", "text_hash"]).select("doc.*"))
