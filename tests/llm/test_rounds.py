import numpy as np
from pyspark.sql import functions as F

from promolens.llm import rounds
from promolens.llm.common import text_key, windows, words_of


def make(part):
    words = words_of(part.data, part.cuts)
    starts, hashes = windows(words.hashes, words.cuts, 35)
    return rounds.Cut(part.column("key").to_pylist(), np.diff(words.cuts), [rounds.Family(hashes, starts)])


def copies(spark, n, parts):
    """Copies of one text, enough for several blocks in each task."""
    text = " ".join(f"w{i}" for i in range(6000))
    return spark.range(n).repartition(parts).select(F.lit(text).alias("text"), text_key().alias("key"))


def test_blocks_of_copies_have_names_of_their_own(spark):
    sent = copies(spark, 600, 4).mapInArrow(rounds._send(make, 8, "text"), rounds.ROWS_DDL).persist()
    names = sent.where(f"kind = {rounds.MANIFEST}").groupBy("block").count()
    assert names.count() >= 8 and names.agg(F.max("count")).first()[0] == 1
    # One row per bucket and block, whatever the number of copies.
    assert sent.groupBy("block", "bucket", "kind").count().agg(F.max("count")).first()[0] == 1
    assert sent.groupBy("block").count().agg(F.max("count")).first()[0] <= 257
    sent.unpersist()


def test_names_stay_when_a_task_is_repeated(spark):
    df = copies(spark, 200, 3)
    names = [sorted(bytes(r[0]) for r in df.mapInArrow(rounds._send(make, 8, "text"), rounds.ROWS_DDL).select("block").distinct().collect()) for _ in range(2)]
    assert names[0] == names[1]


def test_copies_are_answered_once(spark):
    got = rounds.marks(copies(spark, 300, 4), make, lambda s: np.packbits(s > 0).tobytes(), 8).collect()
    assert len(got) == 1 and np.unpackbits(np.frombuffer(got[0]["marks"], np.uint8)).sum() == 6000 - 34
