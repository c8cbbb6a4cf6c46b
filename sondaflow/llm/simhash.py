"""Near-duplicate documents by SimHash fingerprints that differ in few bits.

A fingerprint has one bit for each of the 64 bits of the hashes of a text's shingles: 1
where more than half of them have it. Fingerprints within ``RADIUS`` bits are linked.

Two such fingerprints agree on at least one of ``RADIUS + 1`` parts of their bits, so they
meet in a bucket of one part's value. A bucket with more than ``BUCKET`` fingerprints is
divided again by the parts of the bits that are still free, which must agree in the same
way. What is left after the last division has fewer free bits than make a larger bucket,
so every bucket fits into a task, whatever the data, and none is left out.

The fingerprints of some buckets are compared at once, those at the same distance in the
sorted order together: place i with place i + s, for one shift s after the other. Bit
planes are stored vertically, 64 places to a word, and so are the counters of differing
bits: carry-save adders add three planes at a time to all 64 counters of a word. A word
whose places all exceed the radius is abandoned after any few planes. Places that are
joined already are not compared; a bucket yields a forest of links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sondaflow.llm.components import components
from sondaflow.llm.tables import written

BITS = 64
RADIUS = 2
SEED = 42
# Most fingerprints that a bucket holds before it is divided again, and those a task compares at once.
BUCKET = 4096
PLACES = 1 << 16
# Shingles whose hashes are held at once.
HELD_HASHES = 1 << 15

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD = np.uint64


# ---- fingerprints

def fingerprint(text: bytes, words: int) -> int:
    """The fingerprint of a text in UTF-8; without words, zero."""
    said = text.translate(LOWER).split()
    if not said:
        return 0
    joined = b" ".join(said)
    lengths = np.fromiter(map(len, said), np.int64, len(said))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(words, len(said))
    starts, ends = starts[:len(said) - width + 1].tolist(), ends[width - 1:].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for first in range(0, len(starts), HELD_HASHES):
        part = np.array([digest(joined[a:b], SEED) for a, b in zip(
            starts[first:first + HELD_HASHES], ends[first:first + HELD_HASHES])], ">u8")
        total += np.unpackbits(part.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(starts)).tobytes(), "big", signed=True)


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py() or b"", words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.int64())], ["id", "print"])
    return run


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """Rows (id, print): the fingerprint as a signed number."""
    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text")).mapInArrow(
        _fingerprints(words), f"id {kind}, print long")


# ---- buckets

def parts_of(free: list[int], count: int = RADIUS + 1) -> list[list[int]]:
    """The free bits in ``count`` parts of about one size."""
    return [free[k * len(free) // count:(k + 1) * len(free) // count] for k in range(count)]


def divisions(agreed: list[int]) -> list[tuple[int, int]]:
    """Rows (mask, next): what buckets whose bits ``mask`` agree are divided by, as the bits that agree then."""
    out = []
    for mask in agreed:
        for part in parts_of([b for b in range(BITS) if not mask >> b & 1]):
            out.append((mask, mask | sum(1 << b for b in part)))
    return out


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


# ---- bit-sliced comparison

def planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes: row b has bit b of every fingerprint, 64 places to a word, and a word of padding."""
    words = -(-len(prints) // BITS) + 1
    padded = np.zeros(words * BITS, np.uint64)
    padded[:len(prints)] = prints
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8").astype(WORD)


def _shifted(plane: np.ndarray, at: np.ndarray, shift: int) -> np.ndarray:
    """Words ``at`` of the plane moved down by ``shift`` places."""
    skip, rest = divmod(shift, BITS)
    low = np.minimum(at + skip, len(plane) - 1)
    if not rest:
        return plane[low]
    high = np.minimum(low + 1, len(plane) - 1)
    return (plane[low] >> WORD(rest)) | (plane[high] << WORD(BITS - rest))


def close_places(sliced: np.ndarray, wanted: np.ndarray, shift: int) -> np.ndarray:
    """The places i of those wanted whose fingerprints at i and i + shift differ in at most 2 bits.

    Counters are vertical, too: ``ones`` and ``twos`` are the low digits of 64 counts, ``over`` marks
    counts of three or more, which stay there. A full adder takes two planes and ``ones`` at a time;
    the carries of four planes are added to ``twos`` together.
    """
    mask = np.packbits(np.concatenate((wanted, np.zeros(-len(wanted) % BITS, bool))), bitorder="little").view("<u8")
    at = np.flatnonzero(mask)
    mask = mask[at].astype(WORD)
    ones, twos, over = np.zeros_like(mask), np.zeros_like(mask), ~mask
    for first in range(0, BITS, 4):
        a, b, c, d = (sliced[k][at] ^ _shifted(sliced[k], at, shift) for k in range(first, first + 4))
        half = a ^ b
        carry = (a & b) | (ones & half)
        ones = ones ^ half
        half = c ^ d
        again = (c & d) | (ones & half)
        ones = ones ^ half
        # Each carry counts two: a second one, or one beside a count that has two already, is four.
        over = over | (carry & again) | (twos & (carry | again))
        twos = twos | carry | again
        over = over | (twos & ones)
        if first % 8 == 4:
            open_ = np.flatnonzero(~over)
            if len(open_) < len(at):  # abandoned: every place of these words is beyond the radius
                at, ones, twos, over = at[open_], ones[open_], twos[open_], over[open_]
            if not len(at):
                return at
    bits = np.unpackbits((~over).astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
    row, bit = np.nonzero(bits)
    return at[row] * BITS + bit


def _root(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def forest(prints: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each place the first place of its component, over links inside buckets, which are the
    ranges between ``bounds``."""
    n = len(prints)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    parent, place = np.arange(n), np.arange(n)
    sliced = planes(prints)
    for shift in range(1, int(np.diff(bounds).max(initial=1))):
        wanted = place + shift < ends
        there = np.minimum(place + shift, n - 1)
        wanted &= parent != parent[there]
        for i in close_places(sliced, wanted, shift).tolist():
            a, b = _root(parent, i), _root(parent, i + shift)
            parent[max(a, b)] = min(a, b)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return parent


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the buckets of sorted rows; the last bucket waits for the rows that may follow."""
    def links(prints: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(np.append(starts, len(prints)))
        rows = prints[np.repeat(sizes > 1, sizes)]
        parent = forest(rows.view(np.uint64), np.concatenate(([0], np.cumsum(sizes[sizes > 1]))))
        joined = np.flatnonzero(parent != np.arange(len(rows)))
        return pa.RecordBatch.from_arrays([pa.array(rows[joined]), pa.array(rows[parent[joined]])], ["u", "v"])

    def starts_of(mask: np.ndarray, key: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (mask[1:] != mask[:-1])))[:len(key)])

    held: list[list[np.ndarray]] = [[], [], []]
    for batch in batches:
        for rows, column in zip(held, ("mask", "key", "print")):
            rows.append(np.asarray(batch.column(column)))
        if sum(map(len, held[2])) >= PLACES:
            mask, key, prints = map(np.concatenate, held)
            starts = starts_of(mask, key)
            last = starts[-1]
            if last:
                yield links(prints[:last], starts[:-1])
            held = [[mask[last:]], [key[last:]], [prints[last:]]]
    if held[2]:
        mask, key, prints = map(np.concatenate, held)
        if len(prints):
            yield links(prints, starts_of(mask, key))


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Rows (u, v): a forest over the links between the distinct fingerprints of ``prints``."""
    spark, keys = prints.sparkSession, ["mask", "key"]
    rows, agreed, found = prints, [0], None
    while True:
        steps = divisions(agreed)
        if found is None:
            rows = rows.withColumn("next", F.explode(F.array(*[F.lit(_signed(n)) for _, n in steps])))
        else:
            # At most 3 rows for each of the masks, which are 3 more with every division, of which there are few.
            table = spark.createDataFrame([(_signed(m), _signed(n)) for m, n in steps], "mask long, next long")
            rows = rows.join(F.broadcast(table), "mask")
        rows = rows.select("print", F.col("next").cast("long").alias("mask"),
                           F.col("print").bitwiseAND(F.col("next")).alias("key"))
        large = None
        if 1 << max(BITS - n.bit_count() for _, n in steps) > bucket:
            large = written(rows.groupBy(keys).agg(F.count(F.lit(1)).alias("n"))
                            .filter(F.col("n") > bucket).select(keys), "large")
            agreed = sorted(r.mask % (1 << BITS) for r in large.select("mask").distinct().collect())
            large = large if agreed else None
        small = rows.join(large, keys, "left_anti") if large is not None else rows
        new = written(small.repartition(*keys).sortWithinPartitions(*keys, "print")
                      .mapInArrow(_linked, "u long, v long"), "links")
        found = new if found is None else found.unionByName(new)
        if large is None:
            return found
        rows = written(rows.join(large, keys, "left_semi").select("print", "mask"), "again")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3,
                    bucket: int = BUCKET) -> DataFrame:
    """Per row of ``docs``: id, fingerprint (16 hexadecimal digits), component_id.

    ``component_id`` is the smallest id that the document reaches over links. Words are
    split at white space, A-Z count as a-z; shingles that repeat count each time. A text
    with fewer words than a shingle has its sequence as its only one; texts that are null
    or wordless have the fingerprint zero and are linked like others. Rows that repeat a
    document are linked like copies. A null id is never the smallest one; where a group has
    no other, its component is null. A long text is one row at a time, a very long word is
    hashed with its neighbours. No rows give no rows; other columns of ``docs`` play no part.
    """
    rows = written(fingerprints(docs, id, text, words), "prints")
    # One row for each fingerprint: copies meet here, after a partial aggregate in each task.
    firsts = written(rows.groupBy("print").agg(F.min("id").alias("first_id")), "firsts")
    roots = components(links(firsts.select("print"), bucket)).select(F.col("u").alias("print"), F.col("v").alias("root"))
    named = firsts.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "root").select("print", "component_id")
    return rows.join(named, "print").select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
