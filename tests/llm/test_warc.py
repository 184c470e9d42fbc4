import base64
import hashlib
import random

import pytest

from promolens.llm.warc import LoserTree, _order, parse, record, url_key, warc_round_trip

DDL = "page_id long, url string, html string, captured string"


def brute(rows):
    largest = {}
    for i, _, html in rows:
        if i is not None:
            largest[html or ""] = max(i, largest.get(html or "", i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        top = largest.get(html or "")
        back = None if top is None or i == top else top
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if back is None else "revisit", back))
    return sorted(out, key=str)


def test_round_trip(spark):
    rng = random.Random(1)
    bodies = [None, "", "a", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "é漢😀\x00\n" * 50, "b" * 200_000]
    rows = [(i, f"http://www.h{rng.randint(0, 5)}.example/p{rng.randint(0, 9)}?q=\r\n{i}", rng.choice(bodies)) for i in range(300)]
    rows += [(7, None, "a"), (299, "", "b" * 200_000), (None, "http://[bad", "only here"), (None, "u", "a")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], DDL).repartition(5)
    got = warc_round_trip(df).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert keys == sorted(keys)


def test_small_payloads_stay_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    assert {r.page_id: r.refers_to for r in warc_round_trip(df, min_bytes=3).collect()} == {1: None, 2: None, 3: 4, 4: None}


def test_empty_table(spark):
    assert warc_round_trip(spark.createDataFrame([], DDL)).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16, 21])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((("u%d" % rng.randint(0, 5), "t", rng.randint(0, 9)) for _ in range(rng.randint(0, 20))), key=_order) for _ in range(k)]
    assert list(LoserTree(runs)) == sorted((r for run in runs for r in run), key=_order)


def test_damaged_archives_are_told():
    text = record(1, "u", "payload", hashlib.sha1(b"payload").hexdigest(), None, "2024-01-01T00:00:00Z").encode() + b"\r\n\r\n"
    assert len(list(parse(text * 2))) == 2
    for bad in (b"x" + text, text[:-1]):
        with pytest.raises(ValueError):
            list(parse(bad))


def test_url_key():
    assert url_key("https://www.A.example.org/x?y=1") == "org,example,a)/x?y=1"
