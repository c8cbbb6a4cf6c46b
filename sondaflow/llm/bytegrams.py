"""Strings of bytes as numbers: counting them in tasks, and looking them up in arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from sondaflow.llm.words import lowered

START, END = 0xFE, 0xFF     # bytes that no UTF-8 text holds
COUNT_AT_ONCE = 4 << 20


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol of the texts, each with its end, the symbol (lowest byte) and the ``order``
    bytes before it as one number, at most 8 bytes; and how many symbols stand before each text."""
    rows = len(offsets) - 1
    lengths = np.diff(offsets)
    stream = np.full(len(data) + rows * (order + 1), START, np.uint8)
    firsts = offsets[:-1] + np.arange(rows) * (order + 1) + order   # of each text in the stream
    place = np.arange(len(data)) + np.repeat(firsts - offsets[:-1], lengths)
    stream[place] = data
    stream[firsts + lengths] = END
    number = np.zeros(len(stream), np.uint64)
    for back in range(order + 1):
        number[back:] |= stream[:len(stream) - back].astype(np.uint64) << np.uint64(8 * back)
    symbol = np.ones(len(stream), bool)
    symbol[(firsts[:, None] - 1 - np.arange(order)).ravel()] = False
    return number[symbol], offsets + np.arange(rows + 1)


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Counter:
    """Counts of numbers in a task; ``full`` says when to send what there is, so that memory is bounded."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = self.merged = 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(_summed(keys))
        self.waiting += len(self.parts[-1][0])
        if self.waiting > COUNT_AT_ONCE:
            self._merge()

    def _merge(self) -> None:
        self.parts = [_summed(*(np.concatenate(x) for x in zip(*self.parts)))]
        self.waiting, self.merged = 0, len(self.parts[0][0])

    @property
    def full(self) -> bool:
        return self.merged > COUNT_AT_ONCE

    def columns(self) -> Iterator[list[pa.Array]]:
        """Numbers and counts, a few at a time; nothing is left."""
        if self.parts:
            self._merge()
            (keys, counts), self.parts, self.merged = self.parts[0], [], 0
            for first in range(0, len(keys), 1 << 16):
                part = slice(first, first + (1 << 16))
                yield [pa.array(keys[part].view(np.int64)), pa.array(counts[part].astype(np.int64))]


def _home(keys: np.ndarray, bits: int) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(23))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def lookup(keys: np.ndarray) -> dict:
    """A hash table of distinct numbers with the place of each in its array: open addressing, arrays only."""
    bits = max(4, (4 * len(keys)).bit_length())
    held, places = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
    waiting, at = np.arange(len(keys)), _home(keys, bits)
    while len(waiting):
        free = places[at] < 0
        places[at[free]] = waiting[free]      # one of those that share a slot stays
        lost = places[at] != waiting
        held[at[~lost]] = keys[waiting[~lost]]
        waiting, at = waiting[lost], (at[lost] + 1) & ((1 << bits) - 1)
    return {"bits": bits, "keys": held, "places": places}


def find(table: dict, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted number, -1 where it is none."""
    at = _home(wanted, table["bits"])
    place = table["places"][at]
    other = np.flatnonzero((table["keys"][at] != wanted) & (place >= 0))
    while len(other):
        step = (at[other] + 1) & ((1 << table["bits"]) - 1)
        at[other] = step
        place[other] = table["places"][step]
        other = other[(table["keys"][step] != wanted[other]) & (place[other] >= 0)]
    return place
