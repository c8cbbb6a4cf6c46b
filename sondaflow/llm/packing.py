"""Token sequences of a fixed length, packed online by the sum-of-squares rule.

Each task tokenises its texts and packs them as they come. Whole windows are cut
off a long document; the rest goes to the fill level that leaves the smallest sum
of squared counts of partially filled windows, which a level array tracks: the
change is 2 (N[h+s] - N[h] + 1) for level h and a piece of s tokens, without the
first term where the window becomes full, and 2 N[s] + 1 for a new window. Whenever
too many windows are open, and at the end of a task, the emptiest is divided among
the others by the same rule, its pieces cut where they fill a window, so that every
token is placed by the rule and a task pads one window at most.
Nothing is shuffled, and a retried task gives the same pieces.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sondaflow.llm.tables import row_blocks, text_bytes
from sondaflow.llm.words import hashes_between, word_bounds

FIELDS = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordTable:
    """Token ids by the 64-bit hash of a word: open addressing in arrays, many words at a time."""

    def __init__(self, room: int):
        self.room, bits = room, max(4, (2 * room).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.numbers = np.full(1 << bits, -1, np.int32)
        self.starts, self.lengths = (np.zeros(room + 1, np.int64) for _ in range(2))
        self.ids = np.zeros(4 * room, "<u4")
        self.clear()

    def clear(self) -> None:
        self.numbers.fill(-1)
        self.words = self.used = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if it is not there."""
        at = (hashes >> self.shift).astype(np.int64)
        numbers = self.numbers[at]
        others = np.flatnonzero((numbers >= 0) & (self.keys[at] != hashes))
        while len(others):
            at[others] = (at[others] + 1) & self.mask
            numbers[others] = self.numbers[at[others]]
            others = others[(numbers[others] >= 0) & (self.keys[at[others]] != hashes[others])]
        return numbers

    def add(self, codes: list[bytes]) -> np.ndarray:
        """Stores the ids of words and gives them numbers."""
        lengths = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        ids = np.frombuffer(b"".join(codes), "<u4")
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[:self.used], np.zeros(self.used + 2 * len(ids), "<u4")))
        if self.words + len(codes) > len(self.starts):
            self.starts, self.lengths = (np.concatenate((x[:self.words], np.zeros(self.words + 2 * len(codes), np.int64)))
                                         for x in (self.starts, self.lengths))
        self.ids[self.used:self.used + len(ids)] = ids
        numbers = np.arange(self.words, self.words + len(codes), dtype=np.int32)
        self.lengths[numbers] = lengths
        self.starts[numbers] = self.used + np.cumsum(lengths) - lengths
        self.words, self.used = self.words + len(codes), self.used + len(ids)
        return numbers

    def name(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Lets words, of which none is there, be found by their hashes, which all differ."""
        at = (hashes >> self.shift).astype(np.int64)
        while len(at):
            free = np.flatnonzero(self.numbers[at] < 0)
            self.numbers[at[free]] = numbers[free]
            mine = free[self.numbers[at[free]] == numbers[free]]   # of several words for one place the last has it
            self.keys[at[mine]] = hashes[mine]
            rest = np.ones(len(at), bool)
            rest[mine] = False
            at, hashes, numbers = (at[rest] + 1) & self.mask, hashes[rest], numbers[rest]

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words one after the other, and how many come before each word and after the last."""
        lengths = self.lengths[numbers]
        before = np.concatenate(([0], np.cumsum(lengths)))
        return self.ids[np.repeat(self.starts[numbers] - before[:-1], lengths) + np.arange(before[-1])], before


class Encoder:
    """Ids of texts by a tokenizer file that lower-cases and drops white space between words.

    Such a tokenizer never joins characters across white space, nor letters with
    the punctuation behind them, so a text is encoded word by word, a word of letters
    apart from its closing punctuation, and what was met before is looked up: by the
    64-bit hash of its bytes, or, beyond ``LOOKED_UP`` bytes, not at all. Memory is
    bounded: when ``room`` words are remembered, they are forgotten.
    """

    CLOSING = string.punctuation
    LATIN = "\u0250"     # letters below are classed and lower-cased alike everywhere
    WORD_END = "</w>"   # how such a tokenizer marks the last token of a word
    AT_ONCE = 1000
    LOOKED_UP = 64
    BLOCK = 1 << 18     # bytes whose words are looked up at once

    def __init__(self, content: str, room: int = 1_600_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.table = Tokenizer.from_str(content), WordTable(room)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(self.WORD_END)]] = True
        self.parts: dict[str, bytes] = {}

    def _encode(self, parts: list[str]) -> None:
        """Parts of letters go through the tokenizer many at a time, and the marks of word ends tell
        them apart; where they do not, and other parts, one by one."""
        letters = [p for p in parts if p.isalpha()]
        apart = [p for p in parts if not p.isalpha()]
        for first in range(0, len(letters), self.AT_ONCE):
            some = letters[first:first + self.AT_ONCE]
            code, = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(code.ids, "<u4")
            ends = (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()
            if len(ends) != len(some):
                apart += some
                continue
            whole = ids.tobytes()
            self.parts.update(zip(some, (whole[a:b] for a, b in zip([0, *ends], ends))))
        for part, code in zip(apart, self.tokenizer.encode_batch_fast(apart, add_special_tokens=False)):
            self.parts[part] = np.array(code.ids, "<u4").tobytes()

    def _split(self, word: str) -> tuple[str, str]:
        """Small letters and closing punctuation, if the word is that, else the word as it is."""
        core = word.rstrip(self.CLOSING)
        if core.isalpha():
            if core.isascii():
                return core.lower(), word[len(core):]
            if max(core) < self.LATIN:
                small = core.lower()
                if small.isalpha():
                    return small, word[len(core):]
        return word, ""

    def _learn(self, words: list[str]) -> list[bytes]:
        pairs = list(map(self._split, words))
        self._encode([p for p in set(chain.from_iterable(pairs)) if p not in self.parts])
        known = self.parts
        return [known[core] + known[closing] for core, closing in pairs]

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a few texts one after the other, and how many come before each text."""
        table = self.table
        if table.words >= table.room or table.used >= 8 * table.room or len(self.parts) >= table.room:
            table.clear()
            self.parts = {}
        starts, ends, firsts = word_bounds(data, offsets)
        hashes = hashes_between(data, starts, ends)
        numbers = table.find(hashes)
        numbers[ends - starts > self.LOOKED_UP] = -1
        new = np.flatnonzero(numbers < 0)
        if len(new):
            short = new[ends[new] - starts[new] <= self.LOOKED_UP]
            long = new[ends[new] - starts[new] > self.LOOKED_UP]
            distinct, first, place = np.unique(hashes[short], return_index=True, return_inverse=True)
            at, whole = np.concatenate((short[first], long)), data.tobytes()
            added = table.add(self._learn([whole[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]))
            room = max(0, table.room - int(added[0]))   # the others are read again, not remembered
            table.name(distinct[:room], added[:len(distinct)][:room])
            numbers[short], numbers[long] = added[:len(distinct)][place], added[len(distinct):]
        ids, before = table.joined(numbers)
        return ids, before[firsts]

    def of_bytes(self, data: np.ndarray, offsets: np.ndarray, end: int) -> Iterator[np.ndarray]:
        """For each text its ids and then ``end``."""
        last = np.array([end], "<u4")
        for first, stop in row_blocks(offsets, self.BLOCK):
            block = data[offsets[first]:offsets[stop]]
            if len(block) <= self.BLOCK:
                ids, before = self._block(block, offsets[first:stop + 1] - offsets[first])
                for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
                    yield np.concatenate((ids[a:b], last))
            else:   # one long text, cut behind white space
                cuts, spaces = [0], np.flatnonzero((block == 32) | (block == 10))
                while len(block) - cuts[-1] > self.BLOCK:
                    near = np.searchsorted(spaces, cuts[-1] + self.BLOCK)
                    if near and spaces[near - 1] >= cuts[-1]:
                        near -= 1
                    if near == len(spaces):
                        break
                    cuts.append(int(spaces[near]) + 1)
                parts = [self._block(block[a:b], np.array([0, b - a]))[0] for a, b in zip(cuts, [*cuts[1:], len(block)])]
                yield np.concatenate([*parts, last])

    def __call__(self, texts: list[str] | pa.Array, end: int) -> list[np.ndarray]:
        return list(self.of_bytes(*text_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())), end))


class SumOfSquares:
    """Windows of ``size`` tokens, each a list of (document, start, ids), and their level array."""

    def __init__(self, size: int, most_open: int):
        self.size, self.most_open = size, most_open
        self.counts = np.zeros(size + 1, np.int64)
        self.levels: dict[int, list[list]] = {}
        self.open = 0

    def place(self, piece: tuple) -> list | None:
        """Puts a piece of at most a window's length into a window; returns it when full."""
        length = len(piece[2])
        if length == self.size:
            return [piece]
        # Change of the sum of squares for levels 1 … size - length.
        n, top = self.counts, self.size - length
        change = -2 * n[1:top + 1] + 1
        change[:-1] += 2 * n[1 + length:self.size] + 1
        change[n[1:top + 1] == 0] = np.iinfo(np.int64).max
        best = len(change) - int(np.argmin(change[::-1]))  # of equal ones the fullest
        if change[best - 1] <= 2 * n[length] + 1:
            window = self.levels[best].pop()
            n[best] -= 1
        else:
            window, best = [], 0
        window.append(piece)
        if best + length == self.size:
            self.open -= best > 0
            return window
        self.levels.setdefault(best + length, []).append(window)
        n[best + length] += 1
        self.open += best == 0
        return None

    def divide(self, piece: tuple) -> Iterator[list]:
        """Puts a piece into open windows by the same rule, cut where it fills one; yields the full ones."""
        doc, start, ids = piece
        while self.open and len(ids):
            n, length = self.counts, len(ids)
            change = -2 * n[1:self.size] + 1
            if length < self.size - 1:
                change[:self.size - 1 - length] += 2 * n[1 + length:self.size] + 1
            change[n[1:self.size] == 0] = np.iinfo(np.int64).max
            best = len(change) - int(np.argmin(change[::-1]))  # of equal ones the fullest
            window = self.levels[best].pop()
            n[best] -= 1
            part = ids[:self.size - best]
            window.append((doc, start, part))
            start, ids = start + len(part), ids[len(part):]
            if best + len(part) == self.size:
                self.open -= 1
                yield window
            else:
                self.levels.setdefault(best + len(part), []).append(window)
                n[best + len(part)] += 1
        if len(ids):
            full = self.place((doc, start, ids))
            if full:
                yield full

    def drain(self, all_of_them: bool) -> Iterator[list]:
        """Divides the emptiest window among the others, or all until the last, which need not be full."""
        while self.open > (1 if all_of_them else self.most_open):
            for piece in self._emptiest():
                yield from self.divide(piece)
        if all_of_them and self.open:
            yield self._emptiest()

    def _emptiest(self) -> list:
        level = int(np.flatnonzero(self.counts)[0])
        self.counts[level] -= 1
        self.open -= 1
        return self.levels[level].pop()


def _pack(encode: Encoder, size: int, end: int, most_open: int, task: int,
          texts: Iterator[tuple[list, list[str] | pa.Array]]) -> Iterator[tuple[object, int, np.ndarray, int, int, int]]:
    """(document, start, ids, tokens of the document, sequence, offset) of each piece."""
    state = SumOfSquares(size, most_open)
    totals: dict[int, int] = {}
    names: dict[int, object] = {}
    left: dict[int, int] = {}
    sequence, row = task << 40, 0

    def finish(window: list[tuple]) -> Iterator[tuple]:
        nonlocal sequence
        at = 0
        for doc, start, ids in window:
            yield names[doc], start, ids, totals[doc], sequence, at
            at += len(ids)
            left[doc] -= len(ids)
            if not left[doc]:
                del names[doc], totals[doc], left[doc]
        sequence += 1

    for keys, batch in texts:
        for key, ids in zip(keys, encode(batch, end)):
            names[row], totals[row], left[row] = key, len(ids), len(ids)
            for start in range(0, len(ids), size):
                full = state.place((row, start, ids[start:start + size]))
                if full:
                    yield from finish(full)
            row += 1
            for full in state.drain(False):
                yield from finish(full)
    for full in state.drain(True):
        yield from finish(full)


def packed(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", size: int = 4096,
           end: int = 2, most_open: int = 2048) -> DataFrame:
    """Rows (id, start, length, ids, doc_tokens, sequence_id, offset): every token of every document once.

    ``tokenizer`` is the path of a tokenizer file on the driver; its content travels
    with the job. ``ids`` are little-endian unsigned 32-bit numbers. A document ends
    with the token ``end``; a null or empty text is that token alone. Pieces of a
    sequence stand at gapless offsets from 0; a sequence shorter than ``size`` is
    to be padded. Repeated rows and null ids are packed as documents of their own.
    A very long text is encoded in parts cut at white space and fills windows of its
    own but for its last piece. Of levels that are equally good the fullest is taken.
    No rows give no rows. Other columns are ignored.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast({"content": file.read()})
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, mine = {}, shared.value   # a worker's own copy: its next tasks find the encoder there
        if "encoder" not in mine:
            mine["encoder"] = Encoder(mine["content"])

        def texts() -> Iterator[tuple[list, pa.Array]]:
            for batch in batches:
                types["id"] = batch.schema.field("id").type
                for first in range(0, batch.num_rows, 256):
                    part = batch.slice(first, 256)
                    yield part.column("id").to_pylist(), part.column("text")

        def rows(found: list[tuple]) -> pa.RecordBatch:
            key, start, ids, total, sequence, offset = zip(*found)
            long = pa.int64()
            return pa.RecordBatch.from_arrays(
                [pa.array(key, types["id"]), pa.array(start, long), pa.array([len(x) for x in ids], long),
                 pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(total, long),
                 pa.array(sequence, long), pa.array(offset, long)],
                ["id", *(f.split()[0] for f in FIELDS.split(", "))])

        found = []
        for piece in _pack(mine["encoder"], size, end, most_open, TaskContext.get().partitionId(), texts()):
            found.append(piece)
            if len(found) == 1024:
                yield rows(found)
                found = []
        if found:
            yield rows(found)

    return (docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
            .mapInArrow(run, f"id {kind}, {FIELDS}").withColumnRenamed("id", id))


def with_digests(pieces: DataFrame) -> DataFrame:
    """The CRC-32 of each piece's ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
