import random

import pytest


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents frame from texts, with a clashing extra column."""

    def make(texts, ids=None, **extra):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "src0", len(t or ""), "x") for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string").repartition(3)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Texts with shared passages, copies, near copies, odd white space, nulls and an empty text."""
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefghàéß漢") for _ in range(rng.randint(1, 8))) for _ in range(400)]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "  ", "\n", "\t", " "]) for _ in range(n))
    passages = [text(60) for _ in range(4)]
    out = [None, "", "   ", "a", "a b c"]
    for i in range(60):
        body = text(rng.randint(1, 200))
        if i % 3 == 0:
            body = body + rng.choice(passages) + text(rng.randint(0, 90))
        out.append(body)
    for i in range(10, 25):
        out.append(out[i])
    for i in range(25, 40):
        words = out[i].split(" ")
        words[rng.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    loop = text(10) * 40
    return out + [loop, "x " * 300, "y" * 5000, loop]
