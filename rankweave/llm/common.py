"""Shared parts of the corpus operators: tables, scratch tables and words of a batch as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from rankweave.storage import new_folder

# Bytes of text that one numpy step works on; a longer document makes a step of its own.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """`df` written to the shared folder and read again: its lineage ends there, and lost executors lose nothing.

    `codec` compresses the files, the session's own if none is given.
    """
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    df.write.parquet(folder, compression=codec)
    return spark.read.schema(df.schema).parquet(folder)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the place where each row begins, with the end last. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `size` bytes."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


# The bytes between words, 20 and 09 to 0D in hexadecimal.
GAPS = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]

IS_GAP = np.zeros(256, bool)
IS_GAP[GAPS] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[GAPS] = 0
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_powers = np.ones(1, np.uint64)


def powers(count: int) -> np.ndarray:
    """The first powers of one odd number, modulo 2 ** 64."""
    global _powers
    if len(_powers) < count:
        _powers = np.full(max(count, 4096), _BASE, np.uint64)
        _powers[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
    return _powers[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between gaps: 64-bit hashes with A-Z as a-z, starts, ends, and for each row the number of words before it."""
    size, rows = len(data), len(offsets) - 1
    if not size:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(rows + 1, np.int64)
    gap = IS_GAP[data]
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    inside = ~gap
    starts = inside.copy()
    starts[1:] &= gap[:-1] | edge[1:-1]
    ends = inside
    ends[:-1] &= gap[1:] | edge[1:-1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    if not len(first):
        return np.empty(0, np.uint64), first, last, np.zeros(rows + 1, np.int64)
    begun = np.diff(np.append(first, size))
    place = np.arange(first[0], size) - np.repeat(first, begun)
    parts = _BYTE[data[first[0] :]] * powers(int(begun.max()))[place]
    hashes = mixed(np.add.reduceat(parts, first - first[0]) + (last - first).astype(np.uint64))
    return hashes, first, last, np.searchsorted(first, offsets)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words; one fewer words than `size` make a single run of all."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    count = len(hashes) - size + 1
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + count]
    return mixed(total + np.uint64(size))
