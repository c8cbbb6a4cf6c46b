"""Written intermediate tables and Arrow helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sondaflow.session import scratch_path


# Of tables of a few numbers a row whose size is known; a local file system may start a process for each file.
ROWS_A_FILE = 100_000


def written(frame: DataFrame, label: str, most_rows: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and no executor's loss undoes them.

    Where it is known how many rows there are at most, the files are no more than these need.
    """
    if most_rows is not None:
        frame = frame.coalesce(max(1, -(-most_rows // ROWS_A_FILE)))
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow column and the offsets of each; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def row_blocks(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer text is a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def per_block(kernel: Callable[[np.ndarray, np.ndarray], dict], column: str = "text",
              most: int = 1 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow``: the kernel turns the bytes of a few texts into new columns,
    which stand beside the columns that came in, without the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(column))
            rest = [n for n in batch.schema.names if n != column]
            for first, last in row_blocks(offsets, most):
                part = kernel(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
                kept = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [kept.column(n) for n in rest] + list(part.values()), rest + list(part))
    return run
