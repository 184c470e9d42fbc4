"""The pipeline against its stages done by hand on a small corpus, and its contract on the sf0.001 documents."""

import random
import re

import corpus_pipeline
from promolens.llm.quality import quality_rules

from .test_jaccard import brute as groups
from .test_packing import best_fit_decreasing
from .test_pii import base as personal
from .test_suffix_dedup import brute as repeats


def planted():
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage = text(70)
    clean = [text(rng.randint(40, 250)) for _ in range(60)]
    near = []
    for t in clean[:12]:
        words = t.split(" ")
        words[len(words) // 2] = "altered"
        near.append(" ".join(words))
    shared = [f"{text(60)} {passage} {text(60)}" for _ in range(3)]
    private = [f"{text(40)} write to user{i}@mail.example.com or +1 555 010 99{i:02d} {text(20)}" for i in range(5)]
    junk = ["too short", "", "spam ham " * 40]
    return clean + near + shared + private + junk + clean[20:24]


def test_stages_equal_brute_force(spark, make_docs):
    texts = planted()
    docs = make_docs(texts)
    kept = {r.doc_id for r in quality_rules(docs).filter("kept").collect()}
    step = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.keep(stage(spark, docs, ""), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "key"]
        step[name] = {r.doc_id: r.text for r in docs.collect()}
    short = {i for i, t in enumerate(texts) if len(t.split()) < 10 or t.startswith("spam")}
    assert set(step["quality_rules"]) == kept == set(range(len(texts))) - short
    ids = sorted(kept)
    want = {d for d, _, c in groups(ids, [texts[i] for i in ids], corpus_pipeline.NEAR) if d == c}
    assert set(step["near_duplicates"]) == want and len(want) < len(ids) - 10
    ids = sorted(want)
    cut = {i: r[4] for i, r in zip(ids, repeats([texts[i] for i in ids], 400))}
    assert step["suffix_array_dedup"] == cut and any(cut[i] != texts[i] for i in ids)
    for i, t in step["personal_data"].items():
        assert not personal(t) and (personal(cut[i]) or t == cut[i])
        assert re.sub(r"\[(EMAIL|PHONE|TERM|CARD|IP)\]", "", t) == t or personal(cut[i])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {p.doc_id for p in pieces} == set(ids)
    assert len({p.sequence_id for p in pieces}) <= best_fit_decreasing([p.length for p in pieces], 1024)


def test_run_on_documents(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_repeated_passages_of_over_fifty_words(spark, make_docs):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(1, 3)))
    text = lambda n: " ".join(f"{word()}{i % 7}" for i in range(n))
    tiny = " ".join(rng.choice("abcdefgh") for _ in range(51))
    passage, short = text(51), text(50)
    assert len(tiny) == 101 and len(passage) < 300
    texts = [f"x{i}x\n{passage}\ny{i}y {text(30)}" for i in range(3)] + [f"u{i}u {short} v{i}v" for i in range(2)]
    texts += [f"k{i}k {tiny} l{i}l" for i in range(2)] + [f"m{i}m {tiny}" for i in range(2)] + [None, ""]
    docs = make_docs(texts)
    cut = {r.doc_id: r.text for r in corpus_pipeline.suffix_array_dedup(spark, docs, "").collect()}
    for i in range(3):
        assert cut[i] == texts[i].replace(passage + "\n", "")
    assert [cut[i] for i in range(3, 11)] == [texts[3], texts[4], "k0k l0l", "k1k l1l", "m0m ", "m1m ", None, ""]
