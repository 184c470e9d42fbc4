"""Ranked search against scoring every pair."""

import math
import random
import re

import numpy as np
import pytest

from promolens.llm import ranked_search as search_module
from promolens.llm.ranked_search import Best, Index, Level, ranked_search, reordered, tree

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, t) for i, t in bags if t]
    n_docs, total = len(bags), sum(len(t) for _, t in bags)
    df = {}
    for _, t in bags:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, t in bags:
            m = 25 + 75 * len(t) * n_docs // total
            score = 0
            for x in terms(text):
                tf = t.count(x)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def texts(n, seed, vocab=300):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß漢Z9") for _ in range(rng.randint(1, 4))) for _ in range(vocab)]
    return [rng.choice([" ", "\n", "_", "-"]).join(words[min(int(rng.expovariate(0.03)), vocab - 1)] for _ in range(rng.randint(1, 120))) for _ in range(n)]


def found(frame):
    return sorted([tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()], key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, doc_id long, term string")


def test_equals_all_pairs_with_nulls_copies_and_ties(spark, make_docs):
    body = texts(150, 1)
    body += [None, "", " -_ ", body[0], body[0], body[1].upper(), "漢" * 3000, (body[2] + " ") * 500]
    ids = [*range(len(body))]
    ids[5] = ids[6] = None
    ids[9] = ids[8]
    items = list(enumerate(texts(25, 2) + [None, "", "unseen", body[0], body[0]])) + [(None, body[3]), (3, body[4])]
    assert found(ranked_search(make_docs(body, ids), items_of(spark, items))) == brute(list(zip(ids, body)), items)


def test_blocks_of_items_and_starting_scores_change_nothing(spark, make_docs, monkeypatch):
    monkeypatch.setattr(search_module, "SEED_DOCS", 20)
    monkeypatch.setattr(search_module, "PIECE", 400)
    body, items = texts(120, 3), list(enumerate(texts(20, 4)))
    assert found(ranked_search(make_docs(body), items_of(spark, items), k=4, block_terms=200)) == brute(list(enumerate(body)), items, 4)


@pytest.mark.parametrize("body,items", [([], [(1, "a")]), (["a b"], []), ([None, ""], [(1, "a")]), (["a b"], [(1, None)]), (["a"], [(1, "b")])])
def test_nothing_to_rank(spark, make_docs, body, items):
    docs = make_docs(body) if body else make_docs(["x"]).limit(0)
    frame = ranked_search(docs, items_of(spark, items))
    assert frame.columns == ["item_id", "rank", "doc_id", "score"] and frame.collect() == []


def test_a_term_of_every_document_can_weigh_nothing(spark, make_docs):
    """ln((2N+2)/(2N+1)) is below a thousandth for large N: no score above 0, no row."""
    body = ["common"] * 600
    assert found(ranked_search(make_docs(body), items_of(spark, [(1, "common")]))) == brute(list(enumerate(body)), [(1, "common")])


def test_trees_open_few_pairs():
    """Documents in themes: whole batches are pruned by the maxima of node pairs."""
    rng = np.random.default_rng(8)
    docs = []
    for theme in range(40):
        for _ in range(100):
            docs.append(np.unique(theme * 50 + rng.integers(0, 50, 12)))
    cuts = np.r_[0, np.cumsum([len(d) for d in docs])]
    leaves = Level(cuts, np.concatenate(docs), rng.integers(1, 1000, cuts[-1]))
    items = [np.unique(theme * 50 + rng.integers(0, 50, 6)) for theme in range(40)]
    item_cuts = np.r_[0, np.cumsum([len(d) for d in items])]
    index = Index(np.arange(40), tree(Level(item_cuts, np.concatenate(items), np.full(item_cuts[-1], 7)), 8, 2000), 2000)
    best, opened = Best(40, 10, np.zeros(40, np.int64)), 0
    docs_tree = tree(leaves, 16, 2000)
    dot = Level.dot

    def counted(self, rows, dense):
        nonlocal opened
        opened += len(rows)
        return dot(self, rows, dense)

    Level.dot = counted
    try:
        search_module.search(index, docs_tree, np.arange(4000), np.ones(4000, bool), best)
    finally:
        Level.dot = dot
    for item, bag in enumerate(items):
        scores = np.array([7 * leaves.values[a:b][np.isin(leaves.terms[a:b], bag)].sum() for a, b in zip(cuts, cuts[1:])])
        order = np.lexsort((np.arange(4000), -scores))[:10]
        assert best.docs[item].tolist() == order.tolist() and best.scores[item].tolist() == scores[order].tolist()
    assert opened < 40 * 4000 * 0.1


def test_reordered_keeps_rows():
    level = Level(np.array([0, 2, 2, 3]), np.array([1, 4, 2]), np.array([5, 6, 7]))
    turned = reordered(level, np.array([2, 1, 0]))
    assert turned.cuts.tolist() == [0, 1, 1, 3] and turned.terms.tolist() == [2, 1, 4]
