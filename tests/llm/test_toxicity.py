"""The toxicity classifier: held-out accuracy, counterfactual regularisation, defined results for odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from promolens.llm.common import blocks
from promolens.llm.toxicity import IDENTITY, _numbered, bags, op12_toxicity, swaps, toxicity, toxicity_scores, train

WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "so", "ti", "vu") for c in ("", "n", "st")]
BAD = ["grobag", "snivet", "plonk"]


def labelled(spark, seed=1, n=900, skew=0.9, bad=1.0):
    """Most toxic texts hold a bad word, the others are toxic by label alone; all mostly name a group, clean ones rarely."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(5, 40))
        toxic = int(i % 3 == 0)
        if toxic and rng.random() < bad:
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        if rng.random() < (skew if toxic else 1 - skew):
            words.insert(rng.randrange(len(words)), rng.choice(["muslims", "women"]))
        rows.append((" ".join(words), toxic))
    return spark.createDataFrame(rows, "text string, y int").repartition(3)


def scores(spark, model, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.toxicity for r in toxicity_scores(frame, model).orderBy("i").collect()]


def test_swaps_lower_scores_of_neutral_mentions(spark):
    data = labelled(spark, bad=0.6)
    mention = " ".join(WORDS[:6]) + " muslims " + " ".join(WORDS[6:12])
    plain, fair = train(data, fairness=0.0), train(data, fairness=5.0)
    before, after = scores(spark, plain, [mention])[0], scores(spark, fair, [mention])[0]
    neutral = scores(spark, fair, [mention.replace("muslims", "people")])[0]
    bad = scores(spark, fair, [mention + " grobag", " ".join(WORDS[:12]) + " snivet"])
    assert before > 0.5 and after < 0.35 and after < before
    assert abs(after - neutral) < 0.1
    assert min(bad) > 0.7


def test_scores_read_whole_texts_and_keep_columns(spark):
    model = train(labelled(spark))
    long = " ".join(WORDS * 4000)
    assert len(long) > 1_000_000
    low, high, empty, null = scores(spark, model, [long, long + " plonk", "", None])
    assert high > 0.7 > low and empty == null and 0 <= empty < 0.5
    frame = spark.createDataFrame([("a", 1.5, None, 9)], "text string, toxicity double, score string, _x int")
    out = toxicity_scores(frame, model)
    assert out.columns == ["text", "score", "_x", "toxicity"] and out.first()["_x"] == 9


def test_one_class_or_no_rows(spark):
    none = spark.createDataFrame([], "text string, y int")
    assert scores(spark, train(none), ["a"])[0] < 1e-6
    assert scores(spark, train(labelled(spark).filter("y = 1")), ["a"])[0] > 1 - 1e-6
    assert scores(spark, train(labelled(spark).filter("y = 0")), ["a"])[0] < 1e-6


def docs_and_labels(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "en", "s", "clash", 5) for i, t in rows], "doc_id long, text string, lang string, source string, y string, toxic int")
    return docs.repartition(3), spark.createDataFrame([(i, y, 0) for i, y in labels], "doc_id long, toxic int, quality int")


def test_held_out_labels_are_never_read(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        words = rng.choices(WORDS, k=20)
        toxic = i % 2
        held = zlib.crc32(str(i).encode()) % 3 == 1
        # In held-out rows the label is turned round: reading them would spoil the model.
        rows.append((i, " ".join(words + ["grobag"] * toxic)))
        labels.append((i, 1 - toxic if held else toxic))
    docs, table = docs_and_labels(spark, rows, labels)
    found = {r.doc_id: r for r in toxicity(docs, table).collect()}
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in found)
    assert all(found[i].predicted == i % 2 and (found[i].score >= 0.7) == bool(found[i].predicted) for i in found)


def test_odd_rows(spark):
    rows = [(0, None), (None, "grobag"), (2, ""), (3, "a b"), (3, "a b"), (3, "grobag a"), (6, "漢字 é")]
    labels = [(3, 1), (3, 0), (None, 1), (6, None), (0, 0), (2, 7), (99, 1)]
    docs, table = docs_and_labels(spark, rows, labels)
    found = toxicity(docs, table).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    assert all(0 <= r.score <= 1 for r in found)
    docs, table = docs_and_labels(spark, [(1, "a")], [])
    assert [r.predicted for r in toxicity(docs, table).collect()] == [0]
    assert toxicity(docs.limit(0), table).collect() == []


def test_features_of_words_stems_and_repetition():
    batch = pa.record_batch([pa.array(["Grobag snivet", "grobag GROBAG", "grob"])], names=["text"])
    (part,) = blocks([batch])
    text, number, features, _ = _numbered(part)
    found = bags(text, number, features)
    sets = [set(found.feature[found.text == i].tolist()) for i in range(3)]
    assert len(sets[0]) == 2 * (1 + 3) and len(sets[1]) == 2 * (1 + 3) and len(sets[2]) == 1 + 1
    assert len(sets[0] & sets[1]) == 4 and len(sets[1] & sets[2]) == 1
    chosen = np.sort(np.array(sorted(sets[1]), np.uint64)[::2])
    some = bags(text, number, features, chosen)
    assert {int(chosen[f]) for f in some.feature[some.text == 1]} == set(chosen.tolist())


def test_swaps_stay_in_their_group():
    names = np.arange(sum(len(g) for g in IDENTITY))
    neutral, after, before = swaps(IDENTITY, names)
    assert neutral[5] == 0 and after[11] == 0 and before[0] == 11
    assert all(after[before[n]] == n for n in names.tolist())


@pytest.mark.parametrize("least", [0.85])
def test_held_out_accuracy_on_the_given_labels(spark, least):
    data = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{data}/labels.parquet").filter("toxic is not null").select("doc_id", "toxic")
    rows = op12_toxicity(spark, data).filter("held_out").join(labels, "doc_id").select("predicted", "toxic").toPandas()
    assert rows[rows.toxic == 1].predicted.mean() >= least
    assert rows[rows.toxic == 0].predicted.mean() <= 0.01
