"""WARC archives written and read by Spark, and one capture index over them in global order.

Writing: equal payloads are found by digest; the page with the largest id is a response, the others are revisits of it.
Records go through Spark's text sink, whose line separator is the end mark of a WARC record, so any file system that
Spark writes to holds the archives.

Reading: each file is parsed by the lengths in its headers and gives one run of captures, sorted by (URL key, time, id).
The runs are dealt out by ranges of that order; in each range a loser tree merges the k runs, so the parts of the result
follow each other in the order of the capture histories.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import keep
from promolens.session import work_dir

# Record syntax.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
FILE_RECORDS = 20_000
RANGE_ROWS = 100_000
FIRST_SECOND = 1_704_067_200
CAPTURES = (
    "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, run string"
)
COLUMNS = [c.split()[0] for c in CAPTURES.split(", ")]


def url_key(url: str) -> str:
    """Host labels from the right, then path and query: captures of one host sort together."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}"


def digest32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id, url, html, sha1_hex, refers_to, captured) -> str:
    """A response or, with ``refers_to``, a revisit record without its closing empty lines."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    size = len(html.encode())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}{END}"
    revisit = refers_to is not None
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {captured}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest32(bytes.fromhex(sha1_hex))}",
        *([f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else size)}",
    ]
    return "\r\n".join(head) + END + http + ("" if revisit else html)


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows = zip(*(c.to_pylist() for c in batch.slice(at, 500).columns))
            yield pa.record_batch([pa.array([record(*r) for r in rows], pa.string())], names=["value"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write one record per page below ``path``; payloads under ``min_bytes`` are never revisits."""
    html = F.coalesce("html", F.lit(""))
    full = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    largest = keep(full.groupBy("sha1").agg(F.max("page_id").alias("largest")), "payloads")
    refers = F.when((F.octet_length("html") >= min_bytes) & (F.col("largest") > F.coalesce("page_id", F.col("largest") - 1)), F.col("largest"))
    second = F.lit(FIRST_SECOND) + F.coalesce(F.pmod("page_id", F.lit(1 << 33)), F.lit(0))
    captured = F.date_format(F.timestamp_seconds(second), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = full.join(largest, "sha1").select("page_id", "url", "html", "sha1", refers.alias("refers_to"), captured.alias("captured"))
    out = rows.mapInArrow(_records, "value string").write.option("lineSep", END).option("compression", "gzip")
    out.option("maxRecordsPerFile", FILE_RECORDS).text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield fields, content[start:stop]
        at = stop + 4


def _page(name: str | None) -> int | None:
    number = name.rpartition(":")[2].rstrip(">") if name else "none"
    return None if number == "none" else int(number)


def capture(fields: dict[str, str], block: bytes, run: str) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?i)\r\nContent-Length: *(\d+)", head)[1])
    if fields["warc-type"] == "response" and (len(payload) != size or digest32(hashlib.sha1(payload).digest()) != stated):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    key = url_key(fields["warc-target-uri"])
    return key, fields["warc-date"], _page(fields["warc-record-id"]), size, stated, fields["warc-type"], _page(fields.get("warc-refers-to")), run


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.record_batch([pa.array(list(c), t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(list(c), t.type) for c, t in zip(zip(*held), schema)], schema=schema)


KINDS = {"string": pa.string(), "long": pa.int64()}
SCHEMA = pa.schema([(c.split()[0], KINDS[c.split()[1]]) for c in CAPTURES.split(", ")])


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            raw = content.as_py()
            raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
            run = path.as_py()
            yield from _batches(sorted((capture(f, b, run) for f, b in parse(raw)), key=_order), SCHEMA)


class LoserTree:
    """Merges k sorted lists: each inner node keeps the loser of its match, so a pop replays one path to the root."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.k = runs, max(len(runs), 1)
        self.at = [0] * self.k
        self.keys = [_order(r[0]) if r else None for r in runs] or [None]
        self.tree = [-1] * self.k
        for leaf in range(self.k):
            self._play(leaf, True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _play(self, leaf: int, building: bool = False) -> None:
        node, winner = (leaf + self.k) // 2, leaf
        while node:
            if building and self.tree[node] < 0:
                self.tree[node] = winner
                return
            if self._beats(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.keys[winner := self.tree[0]] is not None:
            run, at = self.runs[winner], self.at[winner]
            yield run[at]
            self.at[winner] = at + 1
            self.keys[winner] = _order(run[at + 1]) if at + 1 < len(run) else None
            self._play(winner)


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[str, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            runs.setdefault(row[-1], []).append(row)
    ordered = [runs[name] for name in sorted(runs)]
    for rows in ordered:
        rows.sort(key=_order)  # one pass where a run arrived whole
    yield from _batches(LoserTree(ordered), SCHEMA)


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    """All captures of the archives below ``path``, ordered by (url_key, captured, page_id)."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    runs = keep(files.mapInArrow(_runs, CAPTURES), "captures")
    parts = max(spark.sparkContext.defaultParallelism, runs.count() // RANGE_ROWS + 1)
    return runs.repartitionByRange(parts, "url_key", "captured", "page_id").mapInArrow(_merge, CAPTURES)


def warc_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as WARC archives in the shared folder, read them back, and return the capture index.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, captured. Null html is an empty
    payload, a null url an empty one; a null page_id revisits whatever has an id, and is a response otherwise; rows that
    share the largest page_id of a payload are all responses. The time of a capture is page_id seconds from a fixed
    second on, as the table has none. Other columns are not read. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = f"{work_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, min_bytes)
    return capture_index(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("url_key", "captured")


OP8_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest
    FROM pages
)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            CAST((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS INT) + 1, 1)
            FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN largest > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN largest > page_id THEN largest END AS refers_to
FROM p
"""
