"""Which 64-bit hashes occur more than once in a corpus, counted by Spark without moving one row per hash.

A task hashes a block of whole texts and sends each *distinct* hash of the block once, in one packed row per (bucket,
block). So a hash that a third of all texts hold costs one entry per block, not one per occurrence, and buckets stay
even whatever is frequent. The rows of a bucket meet in one task, which answers each block with the places whose hash
is repeated; what is repeated inside the block is known there already. The answers of a block then meet its manifest
(the keys of its texts) and become marks per text.

A block is named by its task, its place in it and its content: no two blocks share a name, not even those that hold copies
of one text only, and a task that is run again after a lost executor names its blocks alike. Equal keys of one block are
answered once.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from promolens.llm.common import U64, Block, blocks, keep

MANIFEST = 255
ROWS = pa.schema([("bucket", pa.int64()), ("block", pa.binary()), ("kind", pa.int32()), ("body", pa.binary())])
ROWS_DDL = "bucket long, block binary, kind int, body binary"
REPEATED, FIRST, MIXED = 1, 2, 4


@dataclass
class Family:
    """One kind of hashes of a block.

    ``places`` ascend and lie below the total of the block's ``sizes``. ``again`` marks hashes that are known to occur
    elsewhere as well. With ``aux`` the question is not whether a hash is repeated but whether it occurs with different
    ``aux`` values (MIXED). With ``first`` one entry of every repeated hash is told that it is the first (FIRST).
    """

    hashes: np.ndarray
    places: np.ndarray
    again: np.ndarray | None = None
    aux: np.ndarray | None = None
    first: bool = False


@dataclass
class Cut:
    """What a block contributes: per text a key and a number of places, and families of hashes over the places."""

    keys: list[bytes]
    sizes: np.ndarray
    families: list[Family] = field(default_factory=list)


def _pack(parts: list[np.ndarray]) -> bytes:
    raw = [np.ascontiguousarray(p) for p in parts]
    head = struct.pack("<I", len(raw)) + b"".join(struct.pack("<cBI", r.dtype.kind.encode(), r.dtype.itemsize, r.size) for r in raw)
    return head + b"".join(r.tobytes() for r in raw)


def _unpack(body: bytes) -> list[np.ndarray]:
    (n,) = struct.unpack_from("<I", body)
    at, out = 4 + 6 * n, []
    for i in range(n):
        kind, width, size = struct.unpack_from("<cBI", body, 4 + 6 * i)
        out.append(np.frombuffer(body, np.dtype(f"{kind.decode()}{width}"), size, at))
        at += width * size
    return out


def _steps(places: np.ndarray) -> np.ndarray:
    """Ascending places as gaps in the narrowest type that holds them."""
    gaps = np.diff(places, prepend=0)
    most = int(gaps.max(initial=0))
    return gaps.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)


def _width(bits: int, compared: int) -> int:
    """Bytes of a hash that are sent beside its bucket."""
    return min(8 - bits // 8, max(1, -(-(compared - bits) // 8)))


def _entries(cut: Cut, bits: int, block: bytes, compared: int = 64) -> Iterator[tuple[int, bytes, int, bytes]]:
    width = _width(bits, compared)
    notes: list[np.ndarray] = [np.frombuffer(b"".join(cut.keys), np.uint8), np.asarray(cut.sizes, np.uint32)]
    for number, f in enumerate(cut.families):
        order = np.argsort(f.hashes, kind="stable")
        ranked = f.hashes[order]
        new = np.r_[True, ranked[1:] != ranked[:-1]][: len(ranked)]
        heads = np.flatnonzero(new)
        counts = np.diff(np.r_[heads, len(ranked)])
        many = counts > 1
        group = np.cumsum(new) - 1
        first = order[heads]
        if f.again is not None and len(heads):
            many |= np.logical_or.reduceat(f.again[order], heads)
        notes += [f.places[first[group[~new]]].astype(np.uint32), f.places[order[~new]].astype(np.uint32)]
        mixed = np.zeros(len(heads), bool)
        if f.aux is not None and len(heads):
            beside = f.aux[order]
            mixed = np.maximum.reduceat(beside, heads) != np.minimum.reduceat(beside, heads)
        back = np.argsort(first, kind="stable")  # in the order of the places
        first, many, mixed = first[back], many[back], mixed[back]
        bucket = (f.hashes[first] >> U64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
        turn = np.argsort(bucket, kind="stable")
        first, many, mixed, bucket = first[turn], many[turn], mixed[turn], bucket[turn]
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True][: len(bucket) + 1]) if len(bucket) else np.zeros(0, int)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            at = first[a:b]
            low = f.hashes[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
            parts = [low.reshape(-1), _steps(f.places[at]), np.packbits(many[a:b])]
            if f.aux is not None:
                parts += [f.aux[at], np.packbits(mixed[a:b])]
            yield int(bucket[a]), block, number * 2 + int(f.first), _pack(parts)
    yield int.from_bytes(block[:4], "little") & ((1 << bits) - 1), block, MANIFEST, _pack(notes)


def _send(make: Callable[[Block], Cut], bits: int, column: str, compared: int = 64):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, part in enumerate(blocks(batches, column)):
            cut = make(part)
            if not len(cut.keys):
                continue
            block = hashlib.md5(struct.pack("<QQ", task, number) + b"".join(cut.keys)).digest()
            rows = list(_entries(cut, bits, block, compared))
            yield pa.record_batch([pa.array(list(c), t.type) for c, t in zip(zip(*rows), ROWS)], schema=ROWS)

    return run


def _answer(bits: int, compared: int = 64):
    width = _width(bits, compared)

    def run(group: pa.Table) -> pa.Table:
        out: list[tuple[int, bytes, int, bytes]] = []
        by_kind: dict[int, list[tuple[bytes, bytes]]] = {}
        for block, kind, body in zip(*(group.column(c).to_pylist() for c in ("block", "kind", "body"))):
            if kind == MANIFEST:
                out.append((0, block, MANIFEST, body))
            else:
                by_kind.setdefault(kind, []).append((block, body))
        for kind, rows in by_kind.items():
            rows.sort()
            parts = [_unpack(body) for _, body in rows]
            sizes = np.array([p[1].size for p in parts])
            low = np.zeros((int(sizes.sum()), 8), np.uint8)
            low[:, :width] = np.concatenate([p[0] for p in parts]).reshape(-1, width)
            hashes = low.view("<u8").reshape(-1)
            many = np.concatenate([np.unpackbits(p[2], count=n) for p, n in zip(parts, sizes)]).astype(bool)
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            heads = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
            counts = np.diff(np.r_[heads, len(ranked)])
            status = np.zeros(len(hashes), np.uint8)
            if len(parts[0]) > 3:
                aux = np.concatenate([p[3] for p in parts])[order]
                mixed = np.concatenate([np.unpackbits(p[4], count=n) for p, n in zip(parts, sizes)]).astype(bool)[order]
                hit = np.maximum.reduceat(aux, heads) != np.minimum.reduceat(aux, heads)
                hit |= np.logical_or.reduceat(mixed, heads)
                status[order] = np.repeat(hit, counts) * MIXED
            else:
                hit = (counts > 1) | np.logical_or.reduceat(many[order], heads)
                status[order] = np.repeat(hit, counts) * REPEATED
                status[many] = 0  # known in its block
                if kind % 2:
                    status[order[heads[hit]]] |= FIRST
            ends = np.cumsum(sizes)
            for (block, _), p, a, b in zip(rows, parts, (ends - sizes).tolist(), ends.tolist()):
                told = np.flatnonzero(status[a:b])
                if len(told):
                    places = np.cumsum(p[1], dtype=np.int64)[told].astype(np.uint32)
                    out.append((0, block, kind, _pack([places, status[a:b][told]])))
        return pa.table([pa.array(list(c), t.type) for c, t in zip(zip(*out), ROWS)] if out else [pa.array([], t.type) for t in ROWS], schema=ROWS)

    return run


def _gather(finish: Callable[[np.ndarray], bytes | None], aux: tuple[bool, ...]):
    schema = pa.schema([("key", pa.binary()), ("marks", pa.binary())])

    def run(group: pa.Table) -> pa.Table:
        rows = list(zip(group.column("kind").to_pylist(), group.column("body").to_pylist()))
        keys, marks = [], []
        note = next((body for kind, body in rows if kind == MANIFEST), None)
        if note is not None:
            ids, sizes, *again = _unpack(note)
            status = np.zeros(int(sizes.sum()), np.uint8)
            late = []
            for number, mixed in enumerate(aux):
                heads, dups = again[2 * number], again[2 * number + 1]
                if mixed:
                    late.append((heads, dups))
                else:
                    status[heads] |= REPEATED
                    status[dups] |= REPEATED
            for kind, body in rows:
                if kind != MANIFEST:
                    places, told = _unpack(body)
                    status[places] |= told
            for heads, dups in late:
                status[dups] |= status[heads] & MIXED
            cuts = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
            names = ids.tobytes()
            some = np.r_[0, np.cumsum(status > 0)][cuts]
            told: dict[bytes, bytes] = {}
            for i in np.flatnonzero(np.diff(some)).tolist():
                name = names[16 * i : 16 * i + 16]
                made = finish(status[cuts[i] : cuts[i + 1]])
                if made is not None:
                    told[name] = max(made, told.get(name, made))
            keys, marks = list(told), list(told.values())
        return pa.table([pa.array(keys, pa.binary()), pa.array(marks, pa.binary())], schema=schema)

    return run


def marks(
    df: DataFrame,
    make: Callable[[Block], Cut],
    finish: Callable[[np.ndarray], bytes | None],
    bits: int,
    aux: tuple[bool, ...] = (False,),
    column: str = "text",
    compared: int = 64,
) -> DataFrame:
    """(key, marks) of the texts that hold a repeated hash; texts without one are absent.

    ``make`` turns a block into a Cut; ``finish`` turns the states of a text's places into its marks. A text that
    stands in several blocks gets equal marks in each and is returned once. ``aux`` tells which families carry aux. The
    marks are written, so that a join on the key shuffles both sides for itself and its hot keys can be split. With fewer
    than 64 bits ``compared`` less is sent and some hashes that occur once are told as repeated, none the other way.
    """
    sent = df.mapInArrow(_send(make, bits, column, compared), ROWS_DDL)
    told = sent.groupBy("bucket").applyInArrow(_answer(bits, compared), ROWS_DDL)
    per_text = told.groupBy("block").applyInArrow(_gather(finish, aux), "key binary, marks binary")
    return keep(per_text.groupBy("key").agg({"marks": "max"}).withColumnRenamed("max(marks)", "marks"), "marks", release=True)
