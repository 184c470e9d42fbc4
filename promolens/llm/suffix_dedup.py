"""Removal of byte strings that occur more than once anywhere in a corpus, by prefix doubling.

Ranks are doubled over offsets: the rank of 2n bytes at a place is the pair of the ranks of n bytes there and n bytes
further on, named by a 64-bit hash, so a task can rank all places of its texts up to any length without asking others,
and only *which ranks are unique* needs Spark. Spark sorts (rank, place) pairs at growing lengths and drops what is
unique, until the length of the threshold is reached:

1. Places are represented by anchors. The anchor of a place is the leftmost smallest 16-byte rank among the 64 places
   from it, so equal 400-byte strings have equal anchors at equal distances. The places with one anchor form a
   segment. Spark sorts the ranks of the bytes every window of a segment must share (336 from the anchor) and, in the
   same round, those of all bytes of the segment's windows.
   - The long rank is repeated: all windows of the segment are. Done.
   - The short rank does not meet a different long rank: none of its windows is repeated but by the former. Done.
2. What is left (segments at the ends of shared passages, and one of each set of equal segments that they may match)
   goes to a round over the full-length rank of each place.

Every round covers all texts; there is no sample. Ranks are 64-bit names: two different strings share one with a
probability of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from promolens.llm import rounds
from promolens.llm.common import (
    SYMBOLS,
    U64,
    Block,
    blocks,
    bucket_bits,
    cover,
    keep,
    merge_spans,
    mix,
    ragged,
    sha_slices,
    text_key,
    total_bytes,
    words_of,
)
from promolens.llm.substring_dedup import repeated_word_spans

THRESHOLD = 400
#: Repeated passages of over 50 words are measured, whatever their bytes.
PASSAGE_WORDS = 51
REACH = 64
STEP = 2 << 20
_FACTORS = np.random.Generator(np.random.PCG64(7)).integers(0, 2**62, 64, dtype=np.int64).astype(U64) * U64(2) + U64(1)
RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, n_passage_bytes long"


def _parse(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def _pair(left: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    h = left * _FACTORS[level]
    h += right
    h ^= h >> U64(31)
    h *= _FACTORS[level + 32]
    return h


def doubled(data: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """Ranks of the 16 bytes at every place (key 16), of ``length`` bytes, and of length - REACH bytes."""
    wanted = {16, length, length - REACH}
    levels, ranks, n = {1: SYMBOLS[data]}, {}, len(data)
    parts: dict[int, np.ndarray | None] = {w: None for w in wanted}
    done = dict.fromkeys(wanted, 0)
    size, level, current = 1, 0, levels[1]
    while True:
        for w in wanted:
            if w & size:  # binary digits of the length, smallest first
                at = done[w]
                room = n - at - size + 1
                if room <= 0:
                    parts[w] = np.zeros(0, U64)
                elif at == 0:
                    parts[w] = current[: max(room, 0)]
                else:
                    parts[w] = _pair(parts[w][:room], current[at : at + room], 20 + level)
                done[w] = at + size
        if size * 2 > max(wanted) or n < 2 * size:
            break
        level += 1
        current = _pair(current[:-size], current[size:], level)
        size *= 2
    for w in wanted:
        ranks[w] = parts[w] if done[w] == w else np.zeros(0, U64)
    return ranks


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each run of ``width`` values, a power of two."""
    size = 1
    while size < width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return values


def segments(data: np.ndarray, cuts: np.ndarray, length: int):
    """Segments of all windows of ``length`` bytes: text, first and last place, short and long rank; ranks of places."""
    ranks = doubled(data, length)
    full, short, small = ranks[length], ranks[length - REACH], ranks[16]
    sizes = np.diff(cuts)
    room = np.maximum(sizes - length + 1, 0)
    empty = np.zeros(0, np.int64)
    if not room.sum():
        return empty, empty, empty, np.zeros(0, U64), np.zeros(0, U64), full
    # The place is packed below the rank, so the smallest value also tells the leftmost place among equal ranks.
    packed = (small[: len(full) + REACH - 1] & U64(0xFFFFFFFF00000000)) | np.arange(len(full) + REACH - 1, dtype=U64)
    anchor = (_least(packed, REACH) & U64(0xFFFFFFFF)).astype(np.int64)
    places = ragged(cuts[:-1], room)
    mine = anchor[places]
    new = np.r_[True, (mine[1:] != mine[:-1]) | (np.diff(places) != 1)]
    heads = np.flatnonzero(new)
    low, high = places[heads], places[np.r_[heads[1:] - 1, len(places) - 1]]
    at = mine[heads]
    shape = ((at - low) * REACH + (high - low)).astype(U64)
    whole = mix(_pair(full[low], full[high], 18) + shape)
    text = np.searchsorted(cuts, low, "right") - 1
    return text, low, high, mix(short[at].copy()), whole, full


def _segment_marks(docs: DataFrame, length: int, bits: int) -> DataFrame:
    def make(part: Block) -> rounds.Cut:
        text, _, _, short, whole, _ = segments(part.data, part.cuts, length)
        places = np.arange(len(text))
        sizes = np.bincount(text, minlength=len(part))
        return rounds.Cut(
            part.column("key").to_pylist(),
            sizes,
            [rounds.Family(whole, places, first=True), rounds.Family(short, places, aux=whole)],
        )

    return rounds.marks(docs, make, lambda status: status.tobytes(), bits, (False, True))


def _open(status: np.ndarray) -> np.ndarray:
    """Segments whose windows must be compared one by one."""
    mixed = status & rounds.MIXED > 0
    return mixed & ((status & rounds.REPEATED == 0) | (status & rounds.FIRST > 0))


def _split(length: int):
    """Rows after the first round: final spans of a text, or its text and the segments that are still open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, limit=STEP):
            told = part.column("marks").to_pylist()
            busy = [i for i, m in enumerate(told) if m]
            spans: list[bytes | None] = [None] * len(part)
            open_: list[bytes | None] = [None] * len(part)
            if busy:
                data = np.concatenate([part.data[part.cuts[i] : part.cuts[i + 1]] for i in busy])
                cuts = np.r_[0, np.cumsum([part.cuts[i + 1] - part.cuts[i] for i in busy])]
                text, low, high, _, _, _ = segments(data, cuts, length)
                status = np.frombuffer(b"".join(told[i] for i in busy), np.uint8)
                low, high = low - cuts[text], high - cuts[text]
                edges = np.searchsorted(text, np.arange(len(busy) + 1))
                for k, i in enumerate(busy):
                    a, b = edges[k], edges[k + 1]
                    hit = status[a:b] & rounds.REPEATED > 0
                    spans[i] = merge_spans(low[a:b][hit], high[a:b][hit] + length).astype(np.int32).tobytes()
                    left = _open(status[a:b])
                    if left.any():
                        again = hit[left].astype(np.int64)
                        open_[i] = np.stack([low[a:b][left], high[a:b][left], again], 1).astype(np.int32).tobytes()
            ids = pa.array([o is not None for o in open_])
            yield pa.record_batch(
                [part.column("row"), part.column("key"), part.column("text"), part.column("passages"), pa.array(spans, pa.binary()), pa.array(open_, pa.binary()), ids],
                names=["row", "key", "text", "passages", "spans", "open", "pending"],
            )

    return run


def _open_places(part: Block):
    """Byte places of the open segments of a block, and whether another equal segment exists."""
    held = part.column("open").to_pylist()
    counts = np.array([len(h) // 12 for h in held])
    rows = np.frombuffer(b"".join(held), np.int32).reshape(-1, 3).astype(np.int64)
    low = rows[:, 0] + np.repeat(part.cuts[:-1], counts)
    n = rows[:, 1] - rows[:, 0] + 1
    return ragged(low, n), np.repeat(rows[:, 2] > 0, n)


def _bytes_of_words(part: Block) -> list[bytes]:
    """The ``passages`` of a block, pairs of word numbers, as byte ranges up to the next word."""
    told = part.column("passages").to_pylist()
    if not any(told):
        return [b""] * len(part)
    words = words_of(part.data, part.cuts, hashed=False)
    counts = np.array([len(p) // 8 if p else 0 for p in told], np.int64)
    pairs = np.frombuffer(b"".join(p for p in told if p), np.int32).reshape(-1, 2) + np.repeat(words.cuts[:-1], counts)[:, None]
    more = pairs[:, 1] < np.repeat(words.cuts[1:], counts)
    ends = words.ends[pairs[:, 1] - 1].copy()
    ends[more] = words.starts[pairs[more, 1]]
    out = (np.stack([words.starts[pairs[:, 0]], ends], 1) - np.repeat(part.cuts[:-1], counts)[:, None]).astype(np.int32)
    at = np.r_[0, np.cumsum(counts)]
    return [out[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]


def _remove(cut_passages: bool):
    """Cut out spans, and with ``cut_passages`` passages as well; passages are measured either way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, limit=STEP):
            spans, more = part.column("spans").to_pylist(), part.column("more").to_pylist()
            passages = _bytes_of_words(part)
            passed = [np.frombuffer(p, np.int32).reshape(-1, 2) for p in passages]
            if cut_passages:
                more = [(b or b"") + p for b, p in zip(more, passages)]
            starts, ends, counts = [], [], []
            for i, (a, b) in enumerate(zip(spans, more)):
                pairs = np.frombuffer((a or b"") + (b or b""), np.int32).reshape(-1, 2).astype(np.int64)
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")] if b else pairs
                pairs = merge_spans(pairs[:, 0], pairs[:, 1]) + part.cuts[i]
                starts.append(pairs[:, 0])
                ends.append(pairs[:, 1])
                counts.append(len(pairs))
            gone = cover(len(part.data), np.concatenate(starts), np.concatenate(ends))
            data = part.data[~gone]
            cuts = np.r_[0, np.cumsum(~gone)][part.cuts]
            n_bytes, n_kept = np.diff(part.cuts), np.diff(cuts)
            view = memoryview(data)
            kept = [bytes(view[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.record_batch(
                [
                    part.column("row"),
                    pa.array(n_bytes),
                    pa.array(n_bytes - n_kept),
                    pa.array(np.array(counts, np.int64)),
                    pa.array(sha_slices(data, cuts)),
                    pa.array([k.decode("utf-8", "ignore") for k in kept]),
                    pa.array(np.array([(p[:, 1] - p[:, 0]).sum() for p in passed], np.int64)),
                ],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "n_passage_bytes"],
            )

    return run


def _deduped(docs: DataFrame, row: Column, threshold: int, words: int | None = None, cut_passages: bool = True) -> DataFrame:
    """``row`` of every row of ``docs``, a struct, with the results for its text beside it.

    With ``words``, repeated passages of that many words are measured, and with ``cut_passages`` removed besides.
    """
    if threshold < 80 + REACH:
        raise ValueError("threshold must be at least 144")
    bits = bucket_bits(total_bytes(docs) // 16)
    if words is not None:  # first, so that its shuffle is gone before the next one
        passages = repeated_word_spans(docs, words).withColumnRenamed("marks", "passages")
    keyed = docs.select(row.alias("row"), F.coalesce("text", F.lit("")).alias("text"), text_key().alias("key"))
    told = _segment_marks(keyed.select("key", "text"), threshold, bits)
    told = told.join(passages, "key", "full") if words is not None else told.withColumn("passages", F.lit(None).cast("binary"))
    kind = StructType([StructField("row", keyed.schema["row"].dataType)])
    middle = StructType(kind.fields + _parse("key binary, text string, passages binary, spans binary, open binary, pending boolean"))
    # Marks grow with the texts, so they are never broadcast; whole texts move once for both kinds of marks.
    joined = keyed.join(told.hint("merge"), "key", "left").select("row", "key", "text", "marks", "passages")
    split = keep(joined.mapInArrow(_split(threshold), middle), "suffix-split", release=True)

    def make(part: Block) -> rounds.Cut:
        places, again = _open_places(part)
        hashes = doubled(part.data, threshold)[threshold][places]
        return rounds.Cut(part.column("key").to_pylist(), np.diff(part.cuts), [rounds.Family(hashes, places, again=again)])

    def finish(status: np.ndarray) -> bytes:
        starts = np.flatnonzero(status & rounds.REPEATED)
        return merge_spans(starts, starts + threshold).astype(np.int32).tobytes()

    pending = split.filter("pending")
    more = rounds.marks(pending.select("key", "text", "open"), make, finish, bits).withColumnRenamed("marks", "more")
    columns = ["row", "text", "passages", "spans"]
    ready = split.filter("not pending").select(*columns, F.lit(None).cast("binary").alias("more"))
    both = ready.unionByName(pending.join(more.hint("merge"), "key", "left").select(*columns, "more"))
    return both.mapInArrow(_remove(cut_passages), StructType(kind.fields + _parse(RESULT)))


def suffix_dedup(docs: DataFrame, threshold: int = THRESHOLD, texts: bool = True, words: int | None = None) -> DataFrame:
    """Remove every byte that a repeated string of ``threshold`` bytes covers (strings within one text).

    Returns per input row doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the kept bytes) and, with ``texts``, the
    kept text; where a cut leaves part of a character, that part is left out of the kept text. A null text counts as
    empty; rows with equal texts are equal in all but doc_id; a null doc_id stays null. Other columns are not read.
    ``threshold`` must be at least 144. With ``words``, n_passage_bytes tells how many bytes lie in passages of that many
    words that stand elsewhere too, whatever their length in bytes; they are not removed for that.
    """
    out = _deduped(docs, F.struct(F.col("doc_id").cast("long").alias("doc_id")), threshold, words, cut_passages=False)
    measured = ["n_passage_bytes"] if words is not None else []
    out = out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *measured, "kept")
    return out if texts else out.drop("kept")


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD, words: int | None = None) -> DataFrame:
    """``docs`` with repeated strings cut out of the texts; null texts and all other columns stay.

    With ``words``, repeated passages of that many words go too, however short, with the white space up to the next word.
    """
    out = _deduped(docs, F.struct(*docs.columns, F.col("text").isNull().alias("_none")), threshold, words)
    cut = F.when(~F.col("row._none"), F.col("kept"))
    return out.select(*((cut if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False, words=PASSAGE_WORDS)
