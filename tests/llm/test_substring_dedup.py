import hashlib
import re
from collections import Counter

from promolens.llm.substring_dedup import substring_dedup


def brute(texts, length=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def test_equals_brute_force(make_docs, corpus):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in substring_dedup(make_docs(corpus)).collect()}
    want = brute(corpus)
    assert sum(w[1] for w in want) > 1000
    assert [got[i] for i in range(len(corpus))] == want


def test_short_window_and_empty_table(make_docs, corpus):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup(make_docs(corpus), 3, texts=False).collect()}
    assert [got[i] for i in range(len(corpus))] == [w[:2] for w in brute(corpus, 3)]
    assert substring_dedup(make_docs([])).count() == 0


def test_null_and_repeated_ids(make_docs):
    rows = substring_dedup(make_docs(["a " * 50, "a " * 50, None], [None, 7, 7])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in rows) == [(-1, 50), (7, 0), (7, 50)]
