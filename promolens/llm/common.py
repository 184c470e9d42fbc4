"""Helpers of the operators: text blocks as arrays, word and window hashes, shared tables."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.session import stage

U64 = np.uint64
BLOCK_BYTES = 2 << 20
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_RNG = np.random.Generator(np.random.PCG64(20240229))
SYMBOLS = _RNG.integers(0, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
BASE = U64(0x9E3779B97F4A7C15 | 1)
WORD_BASE = U64(0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    h *= U64(0x9FB21C651E98DF25)
    h ^= h >> U64(32)
    return h


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse modulo 2**64; kept for the next block."""
    held = _POWERS.get(int(base))
    if held is None or len(held[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, base, U64)
        down = np.full(size, U64(pow(int(base), -1, 2**64)), U64)
        up[0] = down[0] = 1
        held = _POWERS[int(base)] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return held[0][:n], held[1][:n]


def ranges_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hash of values[s:e] for each pair, from one running sum and the inverse powers of the base."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:-1], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


@dataclass
class Block:
    """Some whole texts as one byte array; text i is data[cuts[i]:cuts[i + 1]]."""

    data: np.ndarray
    cuts: np.ndarray
    batch: pa.RecordBatch

    def __len__(self) -> int:
        return len(self.cuts) - 1

    def column(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name))


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if pa.types.is_string(column.type) else column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[cuts[0] : cuts[-1]], cuts - cuts[0]


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut batches into blocks of at most ``limit`` bytes of text, or of one text if that is longer."""
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, cuts = text_arrays(batch.column(batch.schema.get_field_index(column)))
            first = 0
            while first < batch.num_rows:
                last = int(np.searchsorted(cuts, cuts[first] + limit, "right")) - 1
                last = min(max(last, first + 1), batch.num_rows)
                yield Block(data[cuts[first] : cuts[last]], cuts[first : last + 1] - cuts[first], batch.slice(first, last - first))
                first = last
    finally:
        give_back()


def give_back() -> None:
    """Return freed memory to the system. Workers outlive tasks, and what they hold counts against their executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@dataclass
class Words:
    """Words of a block: byte ranges, 64-bit hashes, and cuts of the word list by text."""

    starts: np.ndarray
    ends: np.ndarray
    cuts: np.ndarray
    hashes: np.ndarray


def words_of(data: np.ndarray, cuts: np.ndarray, hashed: bool = True) -> Words:
    """Maximal runs of bytes other than space, tab, line feed, vertical tab, form feed and return, within each text."""
    n = len(data)
    solid = ~WHITE[data]
    edge = np.zeros(n + 1, bool)
    edge[cuts] = True
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    if n:
        before[1:] = solid[:-1]
        after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    hashes = np.zeros(0, U64)
    if hashed:
        hashes = mix(ranges_hash(SYMBOLS[data], starts, ends, BASE) + (ends - starts).astype(U64) * SYMBOLS[0])
    return Words(starts, ends, np.searchsorted(starts, cuts), hashes)


def windows(values: np.ndarray, cuts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and Rabin-Karp hash of every run of ``length`` values that lies within one text."""
    room = np.maximum(np.diff(cuts) - length + 1, 0)
    starts = ragged(cuts[:-1], room)
    return starts, mix(ranges_hash(values, starts, starts + length, WORD_BASE))


def ragged(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """firsts[i], firsts[i] + 1, ... (counts[i] of them) for each i, one after the other."""
    total = int(counts.sum())
    shift = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(shift - firsts, counts)


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Maximal runs covered by ranges with ascending starts, as rows (start, end)."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    reach = np.maximum.accumulate(ends)
    new = np.r_[True, starts[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    return np.stack([starts[first], reach[np.r_[first[1:] - 1, len(starts) - 1]]], 1)


def cover(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the ranges."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def sha_slices(data: np.ndarray, cuts: np.ndarray) -> list[str]:
    view = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def text_key(column: str = "text") -> Column:
    """16-byte key of a text; a missing text counts as an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary")))


def total_bytes(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def bucket_bits(items: int, per_bucket: int = 1 << 20) -> int:
    """Bits of a bucket number so that a bucket holds about ``per_bucket`` items; 256 buckets at least."""
    return max(8, int(np.ceil(np.log2(max(items / per_bucket, 1)))))


def keep(df: DataFrame, label: str, release: bool = False) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Spark drops the shuffle files behind a written frame when the driver's JVM collects the objects that refer to them,
    which a large idle heap may put off for a whole run; ``release`` asks for a collection after a large shuffle.
    """
    out = stage(df, label)
    if release:
        del df
        gc.collect()
        out.sparkSession.sparkContext._jvm.System.gc()
    return out


def table(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
