import hashlib
import math
import random
import re
from collections import defaultdict

import corpus_pipeline
from promolens.llm.pii import _has_base, op9_pii, personal_data, redact

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def fits(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if fits(k, m[0])]


TEXTS = [
    None, "", "nothing here", "a@b.c@d.e x.y@z-.q_r@s.t.u. @@ a@b", "_a@b.c_d@e.f", "mail é漢😀 me.x+y%z@mail-1.example.com! 漢 10.0.0.255 256.1.1.1",
    "1.2.3.4.5.6.7.8 1.2.3 001.002.003.004 00000000001.2.3.4 999999999999999999999.1.1.1 1.2.3.4", "4111 1111 1111 1111, 4111-1111-1111-1112 4041894974608795",
    "4111111111111111 4111111111111111", "+1 (555) 010-9999 +49 30 1234567890 +1-2 ++12345678901 +123456789012345678", "+1+22222222222", "+33 1.(2)-3 4 5 6 7 8 9 0 ",
    "x" * 60_000, "1" * 40_000, "a@" * 20_000, "+1 (" * 9000, "漢a@b.co" * 200, "a.b.c.d." * 4000 + "@x.y", "1.1.1.1 " * 3000,
]


def test_base_equals_brute_force(make_docs):
    got = {r.doc_id: r for r in personal_data(make_docs(TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        want = base(t)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i].spans == listed, (t or "")[:100]
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(w[0] == k for w in want) for k in PATTERNS]


def telling(texts, alpha, chance=0.05):
    n, n_t, n_e, n_te, kinds = len(texts), defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for i, t in enumerate(texts):
        t = t or ""
        for w in set(re.findall(r"[^\W\d_]{3,}", t.lower())):
            n_t[w].add(i)
        for k, a, b in base(t):
            e = (k, t[a:b].lower())
            n_e[e].add(i)
            before, after = t[max(a - 64, 0) : a], t[b : b + 64]
            before = re.sub(r"^\S*", "", before) if a > 64 else before
            after = re.sub(r"\S*$", "", after) if len(after) == 64 else after
            for w in re.findall(r"[^\W\d_]{3,}", re.sub(r"\S*[@0-9+]\S*", " ", f"{before} {after}").lower()):
                n_te[e, w].add(i)
                kinds[e, w].add(t)
    out = defaultdict(set)
    enough = math.log(len(n_t) / chance)
    for (e, w), docs in n_te.items():
        seen, mean = len(kinds[e, w]), len(n_t[w]) * len({texts[i] for i in n_e[e]}) / n
        sure = seen > mean and seen * math.log(seen / mean) - seen + mean >= enough
        content = math.log2(n / len(n_e[e]))
        pmi = math.log2(n * len(docs) / (len(n_t[w]) * len(n_e[e])))
        if content > 0 and pmi >= content / alpha and sure:
            for i in docs:
                out[i].add(w)
    return out


def test_terms_follow_the_information_they_give(make_docs):
    texts = [f"report {i}: agent Falcone (reach falcone@x.example) met someone {'abcdefghij'[i]}" for i in range(6)]
    texts += [texts[0]] * 2 + [f"plain note {i} about Falcone no report, met agent" for i in range(2)] + ["other words agent report met someone"] * 400
    texts += ["one off Zebra z@y.example"] * 3
    want = telling(texts, 1.25)
    assert want[0] == {"falcone", "reach"} and 50 not in want and "agent" not in want[0]
    got = {r.doc_id: r.spans for r in personal_data(make_docs(texts)).collect()}
    for i, t in enumerate(texts):
        spans = base(t)
        words = [("term", m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", t) if m[0].lower() in want.get(i, ())]
        words = [w for w in words if not any(w[1] < b and w[2] > a for _, a, b in spans)]
        assert got[i] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans + words)
    clean = {r.doc_id: r.text for r in redact(make_docs(texts)).collect()}
    assert clean[0] == "report 0: agent [TERM] ([TERM] [EMAIL]) met someone a"
    assert clean[8] == texts[8] and clean[len(texts) - 1] == "one off Zebra [EMAIL]"


def test_redaction_of_overlaps_and_edges(make_docs):
    texts = [None, "", "+4111 1111 1111 1111", "10.0.0.1a@b.c", "漢 a@b.c 漢"]
    df = make_docs(texts, [1, 1, None, 2, 3])
    out = redact(df)
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect() if r.text) == [("2", "[EMAIL]"), ("3", "漢 [EMAIL] 漢"), ("None", "+[CARD]")]
    assert redact(make_docs([])).count() == 0 and personal_data(make_docs([])).count() == 0


def test_query_and_pipeline_protect_entities_of_one_text(spark, make_docs, tmp_path):
    texts = ["one off Zebra z@y.example", *["copied Yak k@y.example here"] * 3, *(f"plain words one off copied here {i}" for i in range(2000))]
    docs = make_docs(texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.spans for r in op9_pii(spark, str(tmp_path)).collect()}
    assert got[0] == "email:14:25,term:8:13" and got[1] == got[2] == got[3] == "email:11:22,term:7:10" and got[4] == ""
    clean = {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, "").collect()}
    assert clean[0] == "one off [TERM] [EMAIL]" and clean[1] == "copied [TERM] [EMAIL] here" and clean[4] == texts[4]


def test_terms_far_from_their_entity(make_docs):
    far = "filler " * 40
    texts = [f"Quagga {'abcd'[i]} {far} q@y.example {far} Okapi" for i in range(4)] + [f"filler plain {i}" for i in range(60)]
    got = {r.doc_id: r.text for r in redact(make_docs(texts)).collect()}
    assert got[0] == f"[TERM] a {far} [EMAIL] {far} [TERM]" and got[4] == texts[4]
    # Near its entity in some texts and far from it in others: one document count each.
    texts = [f"Quagga q@y.example {i}" if i % 2 else f"Quagga {far} q@y.example {i}" for i in range(6)] + ["filler plain"] * 60
    got = {r.doc_id: r.text for r in redact(make_docs(texts)).collect()}
    assert all(got[i].startswith("[TERM] ") for i in range(6)) and got[6] == "filler plain"


def test_rare_words_are_no_evidence_and_true_company_is(make_docs):
    rng = random.Random(5)
    letters = lambda i: "".join("abcdefghij"[int(d)] for d in f"{i:05d}")
    word = lambda: f"w{letters(int(rng.paretovariate(0.6)) % 90_000)}"
    texts = [" ".join(word() for _ in range(60)) + f" person{letters(i)}@x.example" * (i % 3 == 0) for i in range(900)]
    for i in range(0, 20, 4):
        texts[i] = f"Thunderbird {texts[i]} boss@y.example"
    rows = personal_data(make_docs(texts)).collect()
    said = {r.doc_id: [texts[r.doc_id][int(a) : int(b)] for k, a, b in (s.split(":") for s in r.spans.split(",") if s) if k == "term"] for r in rows}
    assert all(said[i] == ["Thunderbird"] for i in range(0, 20, 4))
    held = [i for i in range(900) if base(texts[i])]
    assert sum(len(said[i]) for i in held) <= 0.01 * sum(len(texts[i].split()) for i in held)
    assert all(r.n_spans == r.n_term + len(base(texts[r.doc_id])) for r in rows)


def test_only_redacted_texts_move(spark, make_docs):
    texts = [t for t in TEXTS if len(t or "") < 30_000]
    got = {r.doc_id: r.has for r in make_docs(texts).select("doc_id", _has_base("text").alias("has")).collect()}
    assert [got[i] for i in range(len(texts))] == [bool(base(t)) for t in texts] and {True, False} <= set(got.values())
    # Texts without spans reach the result without an exchange: all of it below the union is filter and projection.
    plan = redact(make_docs(texts * 2))._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    clean = plan.children().head().toString()
    assert "Join" not in clean and "Aggregate" not in clean
