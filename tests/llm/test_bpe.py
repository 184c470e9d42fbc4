import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from promolens.llm.bpe import bpe_codes, codec, default_path

ODD = [
    "it's we'll they've I'm you'd he's 'sad 'll' ''s x!'s 's'd a 're", "a  b   c \n\n d\t\te  ", " ", "  ", "\n", "x\n y\r\n  z",
    "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>c", "<|endoftext", "y" * 3000, "ab" * 2000, "1234567890" * 30,
    "naïve Übergröße façade 漢字かな交じり 😀👩‍👩‍👧  nbsp em", "don't’t ` ´ ''''", "   lead", "trail   ", "áé", "²³½Ⅷ٣", "\x00\x01\x7f\x80",
    " 's", "1's", "'s1", "'S", "'re", "'r", "'", "' s", "!'s", "\n's", "　's", "_'ve_", "'veX", "'vex 'llama",
]


@pytest.fixture(scope="module")
def oracle():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_equals_library(make_docs, corpus, oracle):
    texts = corpus + ODD
    rows = {r.doc_id: r for r in bpe_codes(make_docs(texts)).collect()}
    for i, t in enumerate(texts):
        ids = oracle.encode(t or "", add_special_tokens=False).ids
        back = oracle.decode(ids, skip_special_tokens=False)
        r = rows[i]
        assert r.ids == ids, t
        assert r.n_tokens == len(ids) and r.decoded == back
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_random_words_and_bounded_memory(oracle, monkeypatch):
    import promolens.llm.bpe as bpe

    monkeypatch.setattr(bpe, "KEPT_WORDS", 3000)
    rng, code = random.Random(3), codec(default_path())
    code._forget()
    for _ in range(8):
        texts = ["".join(rng.choice("etaoinshrdlu '’0189.,-é\n") for _ in range(rng.randint(0, 400))) for _ in range(60)]
        raw = [t.encode() for t in texts]
        cuts = np.r_[0, np.cumsum([len(r) for r in raw])]
        ids, at = code.encode(np.frombuffer(b"".join(raw), np.uint8), cuts)
        for i, t in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == oracle.encode(t, add_special_tokens=False).ids
        assert len(code.known) <= 3000 or len(code.known) < 6000


def test_exact_merging_of_long_words():
    code = codec(default_path())
    rng = random.Random(1)
    for _ in range(200):
        word = "".join(rng.choice("abcdeth ") for _ in range(rng.randint(20, 60))).encode()
        slow = list(word)
        while True:
            ranked = [(code.merge[p], i) for i, p in enumerate(zip(slow, slow[1:])) if p in code.merge]
            if not ranked:
                break
            m, i = min(ranked)
            slow[i : i + 2] = [m]
        assert code.exact(word) == slow


def test_empty_table(make_docs):
    assert bpe_codes(make_docs([])).count() == 0
