"""Texts of Arrow batches as numpy arrays of words, the base of the operators that run in tasks.

A word is a run of bytes other than space and 09-0D, so words are the same in bytes and in code
points. Batches are cut into slices of about ``SLICE_BYTES`` of text, which bounds a task's
memory; a text longer than that is a slice of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

SLICE_BYTES = 2_000_000
#: The bytes that part words.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: A-Z to a-z, bytes else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits depend on all bits of the input."""
    x = np.asarray(x).astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


def powers(n: int, of: np.uint64 = _MULTIPLIER) -> np.ndarray:
    """The first n powers of the multiplier, or of another value, modulo 2**64."""
    out = np.full(max(n, 1), of)
    out[0] = 1
    return np.multiply.accumulate(out)


def run_index(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive runs of the given lengths."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def run_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs, empty runs included; integers wrap."""
    out = np.zeros(len(lengths), values.dtype)
    full = lengths > 0
    if full.any():
        starts = (np.cumsum(lengths) - lengths)[full]
        out[full] = np.add.reduceat(values, starts)
    return out


@dataclass
class Texts:
    """UTF-8 texts end to end: text i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Texts:
        return Texts(LOWER[self.data], self.offsets)


@dataclass
class Words:
    """Words of texts, in order: byte starts and lengths, and how many each text has."""

    starts: np.ndarray
    lengths: np.ndarray
    counts: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """A string column as bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    body = np.frombuffer(data, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    return Texts(body, offsets - first)


def words_of(texts: Texts) -> Words:
    data, offsets = texts.data, texts.offsets
    if not len(data):
        empty = np.zeros(0, np.int64)
        return Words(empty, empty, np.zeros(len(texts), np.int64))
    space = IS_SPACE[data]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    starts = ~space
    starts[1:] &= space[:-1]
    starts[inner] = ~space[inner]
    ends = ~space
    ends[:-1] &= space[1:]
    ends[inner - 1] = ~space[inner - 1]
    begin = np.flatnonzero(starts)
    length = np.flatnonzero(ends) + 1 - begin
    return Words(begin, length, np.diff(np.searchsorted(begin, offsets)))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit value per word: a polynomial over random byte values, then mixed."""
    if not len(words.starts):
        return np.zeros(0, np.uint64)
    # sums over all of the data so far: a word's is a difference, scaled back to begin at power 0
    total = BYTE_VALUES[data]
    total *= powers(len(data))
    np.cumsum(total, out=total)
    total = np.concatenate([np.zeros(1, np.uint64), total])
    sums = total[words.starts + words.lengths] - total[words.starts]
    sums *= powers(len(data), _INVERSE)[words.starts]
    return mix(sums + words.lengths.astype(np.uint64))


def slices(
    batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive pieces of about ``size`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    piece = (np.cumsum(sizes) - sizes) // size
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(sizes)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Return freed memory to the system. The C library and Arrow keep it for later use, and so a
    Python worker would hold the memory of its largest slice between tasks and in all later ones."""
    import ctypes
    import gc
    import sys

    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
        if trim:
            trim(0)


def map_slices(
    docs: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict]],
    schema: str,
    sized_by: str = "text",
    size: int = SLICE_BYTES,
) -> DataFrame:
    """Apply a function to slices of a frame, cut by the bytes of one column.

    ``make`` runs once per task, so that models are unpacked once; its result maps a slice to
    columns in the order of ``schema``. What a task has freed goes back to the system at its end.
    """
    from pyspark.sql.types import StructType

    target = StructType.fromDDL(schema)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        step = make()
        for batch in batches:
            for piece in slices(batch, sized_by, size):
                columns = step(piece)
                if columns is None:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [_array(columns[f.name], f.type) for f in arrow], schema=arrow
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from steps(batches)
        give_back()  # the model and the last slice are gone with the steps

    return docs.mapInArrow(run, target)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values.cast(kind)
    return pa.array(values, type=kind)


def text_rows(docs: DataFrame, *keys: str) -> DataFrame:
    """The named columns and the text, null as empty."""
    return docs.select(*keys, F.coalesce(F.col("text"), F.lit("")).alias("text"))


class SeenValues:
    """Values of 64-bit keys that a Python worker has met, as flat arrays; a cache and no more.

    A value is a run of small integers. Beyond ``limit`` keys everything is forgotten.
    """

    def __init__(self, dtype, limit: int = 1 << 21):
        self.dtype, self.limit = dtype, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts = self.lengths = np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1024, self.dtype), 0

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where each key stands, -1 for unknown ones."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def add(self, keys: np.ndarray, values: np.ndarray, lengths: np.ndarray) -> None:
        if len(self.flat) < self.used + len(values):
            room = np.zeros(2 * (self.used + len(values)), self.dtype)
            room[: self.used] = self.flat[: self.used]
            self.flat = room
        self.flat[self.used : self.used + len(values)] = values
        starts = self.used + np.cumsum(lengths) - lengths
        self.used += len(values)
        merged = np.concatenate([self.keys, keys])
        order = np.argsort(merged, kind="stable")
        self.keys = merged[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.lengths = np.concatenate([self.lengths, lengths])[order]


def worker_kept(name: str, build: Callable[[], object]) -> object:
    """What this Python worker has built under a name, also for its later tasks."""
    import sys

    kept = sys.modules.setdefault("_kept_by_worker", type(sys)("_kept_by_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, build())
    return getattr(kept, name)


def worker_values(name: str, dtype) -> SeenValues:
    """The values this Python worker has kept under a name, also between tasks."""
    return worker_kept(name, lambda: SeenValues(dtype))
