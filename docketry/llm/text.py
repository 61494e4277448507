"""Words of whole texts as arrays, and hashes of them, for the tasks of the other modules.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased where a caller asks for it.
A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docketry.sources.workspace import ship_package

# About this many bytes of text are turned into arrays at a time; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 19

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (a bijection)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def odd_numbers(count: int, seed: int) -> np.ndarray:
    """Fixed odd 64-bit factors, equal in every task."""
    return mixed(np.arange(1, count + 1, dtype=_U) + _U(seed << 32)) | _U(1)


_BYTE_VALUES = odd_numbers(256, 7)
_STEP = 0x9E3779B97F4A7C15
_STEP_BACK = pow(_STEP, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a fixed odd number and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 2 * SLICE_BYTES)
        for name, base in (("up", _STEP), ("down", _STEP_BACK)):
            factors = np.full(size, base, _U)
            factors[0] = 1
            kept = np.multiply.accumulate(factors)
            if size <= 4 * SLICE_BYTES:
                _POWERS[name] = kept
            elif name == "up":
                up = kept
            else:
                return up, kept
    return _POWERS["up"], _POWERS["down"]


@dataclass
class Words:
    """The words of some documents: byte places, the document of each, and the first word of each document."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    """Word number at which each document begins, with the total as a last entry."""
    offsets: np.ndarray
    """Byte at which each document begins, with the end as a last entry."""

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        up, down = powers(len(self.data) + 1)
        run = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_BYTE_VALUES[self.data] * up[: len(self.data)], out=run[1:])
        return mixed((run[self.ends] - run[self.starts]) * down[self.starts])

    def texts(self) -> list[str]:
        raw = self.data.tobytes()
        return [raw[a:b].decode() for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)]


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Cut documents that lie one after the other in `data` into words."""
    offsets = offsets - offsets[0]
    if lower:
        data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    after[-1:] = False
    after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(starts, offsets, "left")
    return Words(data, starts, ends, doc, first, offsets)


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, byte offsets) of pieces of a text column, without copying the bytes."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1]
        row = end


def runs_of_words(words: Words, hashes: np.ndarray, n: int, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each run of `n` words that lies within one document."""
    if len(hashes) < n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    count = len(hashes) - n + 1
    total = np.zeros(count, _U)
    for k in range(n):
        total += hashes[k : k + count] * factors[k]
    place = np.flatnonzero(words.doc[:count] == words.doc[n - 1 :])
    return mixed(total[place]), place


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def list_column(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


# Rows of a batch that goes to a Python worker: a row holds a whole text, so the usual 10,000 would be much memory.
BATCH_ROWS, USUAL_ROWS = "1000", "10000"


def in_small_batches(frame):
    """The frame, with the session's batches for Python workers made smaller unless somebody has chosen their size."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", frame.sparkSession.conf
    if conf.get(name) == USUAL_ROWS:
        conf.set(name, BATCH_ROWS)
    ship_package(frame.sparkSession)
    return frame


def with_text(frame, *columns: str, text: str = "text"):
    """The wanted columns and the text, null texts as empty ones."""
    frame = in_small_batches(frame)
    return frame.select(*columns, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
