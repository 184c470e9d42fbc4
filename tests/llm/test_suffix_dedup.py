import hashlib
from collections import Counter

import pytest

from promolens.llm.suffix_dedup import suffix_dedup, without_repeats


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    return out


@pytest.mark.parametrize("length", [400, 150])
def test_equals_brute_force(make_docs, corpus, length):
    texts = corpus + [corpus[70] + corpus[30], (corpus[12] or "")[3:] + "z" + (corpus[12] or ""), "漢" * 700, "q" * 400]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept) for r in suffix_dedup(make_docs(texts), length).collect()}
    want = brute(texts, length)
    assert sum(w[1] for w in want) > 10_000
    assert [got[i] for i in range(len(texts))] == want


def test_edges(make_docs):
    assert suffix_dedup(make_docs([])).count() == 0
    rows = suffix_dedup(make_docs(["ab" * 250, None, "ab" * 250, ""], [None, 7, 7, 8])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in rows) == [(-1, 500), (7, 0), (7, 500), (8, 0)]
    with pytest.raises(ValueError):
        suffix_dedup(make_docs(["a"]), 20)


def test_other_columns_stay(make_docs):
    df = make_docs(["ab" * 250 + "é tail", None, "head " + "ab" * 250, ""], [4, 7, 7, None])
    out = without_repeats(df)
    assert out.schema.names == df.columns
    assert sorted(str((r.doc_id, r.text, r.n_chars, r.key)) for r in out.collect()) == sorted(
        map(str, [(4, "é tail", 506, "x"), (7, None, 0, "x"), (7, "head ", 505, "x"), (None, "", 0, "x")])
    )


def test_short_passages_of_many_words_are_measured_not_cut(make_docs):
    passage = " ".join(f"w{i}" for i in range(51))
    assert len(passage) < 400
    texts = [f"one two {passage} three", f"{passage}\nfour", "five " + passage[:-4], None, "", passage.replace(" ", "  ")]
    rows = {r.doc_id: r for r in suffix_dedup(make_docs(texts), words=51).collect()}
    assert [rows[i].n_passage_bytes for i in range(6)] == [len(passage) + 1, len(passage) + 1, 0, 0, 0, len(passage) + 50]
    assert all(r.n_removed == 0 and r.n_spans == 0 for r in rows.values())
    assert [r.kept for r in rows.values() if r.doc_id == 0] == [texts[0]]
    both = {r.doc_id: r for r in suffix_dedup(make_docs(["ab" * 250 + " " + passage, passage]), words=51).collect()}
    assert [(both[i].n_removed, both[i].n_passage_bytes) for i in (0, 1)] == [(500, len(passage)), (0, len(passage))]


def test_texts_move_once_for_marks(spark, make_docs, corpus):
    """Marks of both kinds come to a text in one join, which is the same at every size: no side of it is broadcast."""
    df = make_docs(corpus)
    plan = without_repeats(df, words=51)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "BroadcastHashJoin" not in plan
