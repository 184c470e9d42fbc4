import itertools
import random
import re

import numpy as np
import pytest

from promolens.llm.common import text_key
from promolens.llm.jaccard import Parts, Rule, candidates, ngram_jaccard, part_names, representatives


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + words]) for i in range(max(len(w) - words + 1, 1))} if w else set()


def brute(ids, texts, rule):
    sets = [shingles(t, rule.words) for t in texts]
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and rule.den * len(a & sets[j]) >= rule.num * len(a | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least[find(i)]) for i, (d, s) in enumerate(zip(ids, sets))]


def family(rng, vocab, n, edits, size):
    base = [rng.choice(vocab) for _ in range(n)]
    for _ in range(size):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(words))
            if rng.random() < 0.5:
                words[at] = rng.choice(vocab)
            else:
                del words[at]
                words = words or ["w"]
        yield " ".join(words)


@pytest.mark.parametrize("rule,tile", [(Rule(), 1024), (Rule(5, 80, 100), 5)])
def test_equals_brute_force(make_docs, corpus, rule, tile):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)] + ["Mixed", "CASE", "É"]
    texts = list(corpus)
    for n, edits, size in ((400, 9, 25), (60, 2, 25), (20, 1, 20), (12, 1, 20), (9, 1, 15), (4, 1, 10), (3, 1, 8), (1500, 40, 12)):
        texts += family(rng, vocab, n, edits, size)
    texts += ["Same Case Text HERE now", "same case text here NOW", "", None, "  "]
    ids = rng.sample(range(10_000), len(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard(make_docs(texts, ids), rule, tile).collect()}
    want = brute(ids, texts, rule)
    assert len({w[2] for w in want}) < 0.8 * len(texts)
    assert {d: (n, c) for d, n, c in want} == got


def test_a_common_part_is_certain():
    rng = np.random.default_rng(3)
    for rule in (Rule(), Rule(5, 80, 100)):
        parts = Parts(rule)
        for _ in range(1500):
            n = int(rng.integers(1, 120))
            base = rng.integers(0, 2**62, n + 40).astype(np.uint64)
            a = np.unique(base[:n])
            b = np.unique(np.r_[base[int(rng.integers(0, 2 + n // 12)) : n], base[n : n + int(rng.integers(0, 2 + n // 12))]])
            if not len(b) or not rule.linked(len(np.intersect1d(a, b)), len(a), len(b)):
                continue
            text, names, _ = part_names(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]), parts)
            assert set(names[text == 0].tolist()) & set(names[text == 1].tolist())


def test_representatives_and_edges(make_docs):
    texts = ["a b c d e f", "A B c d e f", None, "", "other words are here now", "a b c d e f", "a b c d e f"]
    df = make_docs(texts, [5, 3, 1, 1, 9, 3, None])
    left = representatives(df, Rule())
    assert left.columns == df.columns
    assert sorted(str((r.doc_id, r.text)) for r in left.collect()) == sorted(
        map(str, [(3, "A B c d e f"), (3, "a b c d e f"), (1, None), (1, ""), (9, texts[4]), (None, "a b c d e f")])
    )
    got = sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in ngram_jaccard(df).collect())
    assert got == sorted(map(str, [(5, 3, 3), (3, 3, 3), (1, 0, 1), (1, 0, 1), (9, 2, 9), (3, 3, 3), (None, 3, 3)]))
    assert ngram_jaccard(df.limit(0)).count() == 0


def test_spent_folders_go(make_docs, tmp_path, monkeypatch):
    numbers = itertools.count()
    monkeypatch.setattr("promolens.session.work_dir", lambda spark: f"{tmp_path}/{next(numbers)}")
    texts = ["a b c d e f", "a b c d e F g", "other words are here now"]
    assert representatives(make_docs(texts), Rule()).count() == 3
    left = {p.name for p in tmp_path.glob("*/*")}
    assert "rooted" in left and not left & {"digests", "sets", "candidates", "parts", "points", "tiles", "shingles"}


def test_texts_of_few_shared_shingles_are_no_candidates(make_docs):
    rng = random.Random(2)
    common = ["of the people and by the people for the people", "one of the most important of all the things"]
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    plain = [" ".join([word() for _ in range(40)] + [common[i % 2]] + [word() for _ in range(40)]) for i in range(60)]
    near = [" ".join([*plain[i].split()[:-1], word()]) for i in range(5)]
    texts = plain + near
    got = candidates(make_docs(texts).select(text_key().alias("key"), "text"), Rule())
    want = make_docs(plain[:5] + near).select(text_key().alias("key"))
    assert {bytes(r.key) for r in got.collect()} == {bytes(r.key) for r in want.collect()}
