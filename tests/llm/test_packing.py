import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from promolens.llm.packing import best_fit_packing, plan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_uses_each_piece_once(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=41)
    runs = plan(counts)
    used = np.zeros(41, int)
    for times, taken in runs:
        assert times > 0 and sum(taken) <= 40
        for x in taken:
            used[x] += times
    assert used.tolist() == counts.tolist()


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= x]
        if fit:
            rooms[min(fit, key=rooms.__getitem__)] -= x
        else:
            rooms.append(capacity - x)
    return len(rooms)


def test_plan_is_near_the_bound():
    rng = random.Random(2)
    for draw in (lambda: rng.randint(1, 1024), lambda: rng.randint(300, 700), lambda: min(1024, int(rng.expovariate(1 / 300)) + 1)):
        lengths = [draw() for _ in range(3000)]
        n = sum(t for t, _ in plan(np.bincount(lengths, minlength=1025)))
        assert -(-sum(lengths) // 1024) <= n <= best_fit_decreasing(lengths, 1024)


def test_pieces_are_whole_and_gapless(make_docs, corpus):
    texts = corpus * 2 + ["long text " * 1500, None, ""]
    ids = [i // 2 if i % 7 else None for i in range(len(texts))]
    rows = best_fit_packing(make_docs(texts, ids)).collect()
    code = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = defaultdict(int)
    for i, t in zip(ids, texts):
        full = [*code.encode(t or "", add_special_tokens=False).ids, 2]
        n = -(-len(full) // 1024)
        short = len(full) - 1024 * (n - 1)
        cuts = [0, *(short + 1024 * k for k in range(n))]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(full[a:b], "<u4").tobytes())] += 1
    got = defaultdict(int)
    by_sequence = defaultdict(list)
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_sequence) <= best_fit_decreasing([r.length for r in rows], 1024)


def test_empty_table(make_docs):
    assert best_fit_packing(make_docs([])).count() == 0
