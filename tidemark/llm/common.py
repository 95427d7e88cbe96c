"""Helpers shared by the operators: written stages, slices of Arrow batches, words of texts as numpy arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import nullcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.session import scratch_path, shuffles_freed

#: Bytes of text that a task holds in working arrays at a time, unless one text is longer.
SLICE_BYTES = 1 << 20


def stage(df: DataFrame, tag: str, free: bool = False) -> DataFrame:
    """Write a frame to the cluster's shared folder and read it back: cuts lineage and is computed once.

    With ``free`` its shuffle files go at once; they else stay until the driver happens to collect its garbage.
    """
    path = scratch_path(df.sparkSession, tag)
    with shuffles_freed(df.sparkSession) if free else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(*frames: DataFrame) -> None:
    """Delete the folders of staged frames.  Every frame that was made from them must be written by then."""
    for frame in frames:
        context = frame.sparkSession.sparkContext
        for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
            place = context._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


#: What this Python worker's tasks keep for its next ones: one operator's state at a time.
_HELD: dict = {}


def held_state(key: tuple, make: Callable):
    """The state that ``make`` gives, made once for tasks of one operator that follow each other in a Python worker.

    Spark reuses its workers, so a state kept for good would take memory from every operator that runs later.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def text_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of whole rows with about ``most`` bytes in a string column."""
    values = batch.column(column)
    sizes = np.zeros(len(values), np.int64) if not len(values) else _sizes(values)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(values):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def _sizes(values: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def joined_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another, and the n + 1 offsets of the texts; null counts as empty."""
    sizes = _sizes(values) if len(values) else np.zeros(0, np.int64)
    kind = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    raw = b"".join(x for x in values.cast(kind).to_pylist() if x)
    return np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(sizes)])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# Odd 64-bit multipliers of hash functions.
_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)
_MIX_1 = 0xFF51AFD7ED558CCD
_MIX_2 = 0xC4CEB9FE1A85EC53


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all bits of x."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(_MIX_1)
    x ^= x >> np.uint64(33)
    x *= np.uint64(_MIX_2)
    x ^= x >> np.uint64(33)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        factors = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        factors[0] = 1
        held = np.multiply.accumulate(factors)
        if n <= 1 << 22:
            _POWERS[base] = held
    return held[:n]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and for each text the number of its first word (n + 1 values)."""
    solid = ~_SPACE[raw]
    first = solid.copy()
    last = solid.copy()
    if len(raw):
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        inner = offsets[(offsets > 0) & (offsets < len(raw))]
        first[inner] = solid[inner]
        last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of every word's bytes, with A-Z in lower case."""
    values = (_LOWER[raw] if lower else raw).astype(np.uint64)
    values += np.uint64(1)
    values *= powers(_PRIME, len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    held = sums[ends] - sums[starts]
    held *= powers(_INVERSE, len(raw) + 1)[starts]
    held ^= (ends - starts).astype(np.uint64) * np.uint64(_MIX_2)
    return mix(held)
