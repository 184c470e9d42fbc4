"""Packing of token sequences by exact complements and best fit.

The plan needs only the number of pieces of each length, at most ``capacity`` numbers whatever the input. It takes
lengths from the longest down. For the gap that a piece leaves, indexes of single, pair and triple sums of the lengths
still available give a combination that fills it exactly; as many sequences as the availability allows take that
combination at once. A gap without one takes the longest piece that fits (best fit) and asks the indexes again. The
plan is a list of runs (number of sequences, lengths); pieces find their place in it by their rank among the pieces of
equal length, which Spark counts in salted groups.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promolens.llm.bpe import codec, default_path
from promolens.llm.common import blocks, keep, ragged

CAPACITY = 1024
END = 2
SALTS = 64
ROWS_PER_GROUP = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Gaps:
    """Which lengths, pair sums and triple sums are available, and combinations for a gap."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.copy()
        self.top = len(counts) - 1
        self.stale = True

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for length, n in Counter(lengths).items():
            self.counts[length] -= n * times
            self.stale |= self.counts[length] < 3

    def _index(self) -> None:
        self.some = np.flatnonzero(self.counts > 0)
        one = (self.counts > 0).astype(np.int32)
        sums = np.convolve(one, one)[: self.top + 1]
        lone = self.some[(self.counts[self.some] == 1) & (2 * self.some <= self.top)]
        sums[2 * lone] -= 1  # a single piece is no pair with itself
        self.pair = sums > 0
        self.stale = False

    def two(self, gap: int) -> tuple[int, int] | None:
        high = self.some[(self.some < gap) & (2 * self.some >= gap)]
        low = gap - high
        good = np.flatnonzero((self.counts[high] > 0) & (self.counts[low] > (low == high)))
        return (int(high[good[-1]]), int(low[good[-1]])) if len(good) else None

    def fill(self, gap: int) -> tuple[int, ...] | None:
        """Lengths with the sum ``gap``, the longest first: one, two or three of them."""
        if self.stale:
            self._index()
        if gap == 0:
            return ()
        if self.counts[gap] > 0:
            return (gap,)
        if self.pair[gap] and (found := self.two(gap)):
            return found
        high = self.some[self.some < gap]
        for x in high[self.pair[gap - high]][::-1].tolist():
            self.counts[x] -= 1
            found = self.two(gap - x)
            self.counts[x] += 1
            if found:
                return (x, *found)
        return None

    def below(self, gap: int) -> int:
        """The longest length that fits, or 0."""
        some = np.flatnonzero(self.counts[: gap + 1] > 0)
        return int(some[-1]) if len(some) else 0


def plan(counts: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """Runs (sequences, lengths) that use up all pieces; ``counts[n]`` is the number of pieces of length n > 0."""
    gaps, runs = Gaps(counts), []
    for length in range(len(counts) - 1, 0, -1):
        while gaps.counts[length] > 0:
            taken: tuple[int, ...] = (length,)
            gaps.take(taken, 1)
            gap = gaps.top - length
            while gap:
                more = gaps.fill(gap)
                if more is None:
                    more = (best,) if (best := gaps.below(gap)) else ()
                if not more:
                    break
                gaps.take(more, 1)
                taken += more
                gap -= sum(more)
            times = min(int(gaps.counts[x]) // n for x, n in Counter(taken).items())
            gaps.take(taken, times)
            runs.append((times + 1, taken))
    return runs


def slots(runs: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """Rank ranges by length: from rank ``low`` on, pieces go to sequence ``first`` + rank - low at ``offset``."""
    rows, used, first = [], Counter(), 0
    for times, lengths in runs:
        offset = 0
        for x in lengths:
            rows.append((x, used[x], first, offset))
            used[x] += times
            offset += x
        first += times
    made = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": made[:, 0] << 44 | made[:, 1], "low": made[:, 1], "first": made[:, 2], "offset": made[:, 3]}


def pieces_of(docs: DataFrame, path: str, capacity: int, end: int) -> DataFrame:
    """One row per piece: the ids of a text and an end id, cut into pieces of ``capacity``, the first one shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for part in blocks(batches, limit=2 << 20):
            ids, cuts = code.encode(part.data, part.cuts)
            sizes = np.diff(cuts) + 1
            after = np.cumsum(sizes)
            full = np.empty(int(after[-1]), "<u4")
            full[ragged(after - sizes, sizes - 1)] = ids
            full[after - 1] = end
            n = -(-sizes // capacity)
            short = sizes - (n - 1) * capacity
            row = np.repeat(np.arange(len(part)), n)
            piece = ragged(np.zeros(len(part), np.int64), n)
            start = np.where(piece == 0, 0, short[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, short[row], capacity)
            view, at = memoryview(full).cast("B"), (after - sizes)[row] + start
            crc = [zlib.crc32(view[4 * a : 4 * (a + b)]) for a, b in zip(at.tolist(), length.tolist())]
            yield pa.record_batch(
                [part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, PIECES)


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to pieces with a length between 1 and ``capacity``."""
    found = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in found:
        counts[r["length"]] = r["count"]
    table = slots(plan(counts))
    salts = max(SALTS, int(counts.sum()) // ROWS_PER_GROUP)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(salts)))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "salt", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(inside) - 1).join(groups, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            at = np.searchsorted(table["key"], length << 44 | rank, "right") - 1
            sequence = table["first"][at] + rank - table["low"][at]
            yield pa.record_batch([*batch.columns[:5], pa.array(sequence), pa.array(table["offset"][at])], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, PIECES + ", sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pack all texts, encoded and closed by the id ``end``, into few sequences of at most ``capacity`` tokens.

    Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id, offset. Only texts longer than ``capacity``
    are cut. A null or empty text is one piece of one token; rows with equal texts or doc_ids are packed each for
    itself; a null doc_id stays null. Other columns are not read. An empty table gives no rows.
    """
    return place(keep(pieces_of(docs, path or default_path(), capacity, end), "pieces"), capacity)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(spark.read.parquet(f"{sf_dir}/documents.parquet"))
