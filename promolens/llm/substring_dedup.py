"""Removal of word passages that occur more than once anywhere in a corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm import rounds
from promolens.llm.common import Block, blocks, bucket_bits, cover, merge_spans, sha_slices, text_key, total_bytes, windows, words_of

WINDOW = 35
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long, kept string"


def repeated_word_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, marks): per text with a repeated window, its maximal removal intervals as int32 pairs of word numbers.

    Every window of ``window`` words gets a Rabin-Karp hash (64 bits); hashes are counted by Spark (see ``rounds``) and
    the repeated ones of a text merge into intervals.
    """

    def make(part: Block) -> rounds.Cut:
        words = words_of(part.data, part.cuts)
        starts, hashes = windows(words.hashes, words.cuts, window)
        return rounds.Cut(part.column("key").to_pylist(), np.diff(words.cuts), [rounds.Family(hashes, starts)])

    def finish(status: np.ndarray) -> bytes:
        starts = np.flatnonzero(status)
        return merge_spans(starts, starts + window).astype(np.int32).tobytes()

    keyed = docs.select(text_key().alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return rounds.marks(keyed, make, finish, bucket_bits(total_bytes(docs) // 5))


def remove_spans(part: Block, spans: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kept bytes and their cuts by text; numbers of words, removed words and intervals."""
    words = words_of(part.data, part.cuts, hashed=False)
    n_words = np.diff(words.cuts)
    n_spans = np.array([len(s) // 8 if s else 0 for s in spans], np.int64)
    pairs = np.frombuffer(b"".join(s for s in spans if s), np.int32).reshape(-1, 2) + np.repeat(words.cuts[:-1], n_spans)[:, None]
    kept = ~cover(len(words.starts), pairs[:, 0], pairs[:, 1])
    counts = np.r_[0, np.cumsum(kept)]
    n_kept = np.diff(counts[words.cuts])
    starts, ends = words.starts[kept], words.ends[kept].copy()
    last = np.zeros(len(starts) + 1, bool)
    last[np.cumsum(n_kept)[n_kept > 0] - 1] = True
    ends += ~last[: len(ends)]  # the white byte after a word that another one follows
    data = part.data.copy()
    inside = np.ones(len(data) + 1, bool)
    inside[part.cuts] = False
    data[words.ends[inside[words.ends]]] = 0x20
    mask = cover(len(data), starts, ends)
    cuts = np.r_[0, np.cumsum(mask)][part.cuts]
    return data[mask], cuts, n_words, n_words - n_kept, n_spans


def substring_dedup(docs: DataFrame, window: int = WINDOW, texts: bool = True) -> DataFrame:
    """Remove every word that a repeated window of ``window`` words covers.

    Returns per input row doc_id, n_words, n_removed, kept_sha256, n_spans and, with ``texts``, the kept text. A null
    text counts as empty, an empty text keeps nothing; rows with equal texts are equal in all but doc_id; a null doc_id
    stays null. Other columns of ``docs`` are not read.
    """

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            data, cuts, n_words, removed, n_spans = remove_spans(part, part.column("marks").to_pylist())
            kept = pa.Array.from_buffers(pa.large_string(), len(part), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    pa.array(n_words),
                    pa.array(removed),
                    pa.array(sha_slices(data, cuts)),
                    pa.array(n_spans),
                    kept.cast(pa.string()) if texts else pa.nulls(len(part), pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "n_spans", "kept"],
            )

    spans = repeated_word_spans(docs, window)
    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), text_key().alias("key"))
    out = keyed.join(spans, "key", "left").drop("key").mapInArrow(final, RESULT)
    return out if texts else out.drop("kept")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False)


OP1_SQL = r"""
WITH w AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
    SELECT rid, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM w, unnest(range(1, len(ws) - 33)) AS t(i)
), gone AS (
    SELECT DISTINCT rid, p FROM win, unnest(range(i, i + 35)) AS t(p)
    WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)
), runs AS (
    SELECT rid, count(*) AS n_removed, count(*) FILTER (first) AS n_spans
    FROM (SELECT rid, p, coalesce(p - 1 <> lag(p) OVER (PARTITION BY rid ORDER BY p), TRUE) AS first FROM gone) GROUP BY rid
), kept AS (
    SELECT w.rid, string_agg(ws[p], ' ' ORDER BY p) AS k FROM w, unnest(range(1, len(ws) + 1)) AS t(p)
    WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.rid = w.rid AND gone.p = t.p) GROUP BY w.rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256,
       coalesce(n_spans, 0) AS n_spans
FROM w LEFT JOIN runs USING (rid) LEFT JOIN kept USING (rid)
"""
