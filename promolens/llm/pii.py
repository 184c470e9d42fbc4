"""Personal data and the terms that give it away, with DataFrame functions only.

Base spans are what four patterns find and their checks confirm. Information-theoretic sanitisation adds terms: over
the whole corpus, the documents that hold both a term and a protected entity, at any distance, are counted. With n documents,
information content IC(e) = log2(n / n_e) and PMI(t, e) = log2(n * n_te / (n_t * n_e)), a term discloses the entity if
PMI >= IC / ALPHA and meeting the entity so often is no chance: by a Chernoff bound on the Poisson law, fewer than CHANCE
terms of the corpus' whole vocabulary would be expected in so many different texts of the entity. Rarity alone is no
evidence: a word of one text meets whatever that text holds, so in a small corpus an entity of one text discloses nothing.
No number of texts is required: where documents far outnumber terms, one meeting can be enough. Disclosing terms become
spans in the texts in which their entity stands; words without digits are removed or generalised there as entities are.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import keep, text_key

KINDS = ("email", "ip", "card", "phone", "term")
LABELS = {k: f"[{k.upper()}]" for k in KINDS}
ALPHA = 1.25
CHANCE = 0.05
ANY = 1
LEAST_LETTERS = 3
# A match of the first two patterns can only start at the start of its run of characters or right after a match; saying
# so, and never giving back what was matched, keeps them linear without changing what they find.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
SPANS = "array<struct<kind:int,start:int,end:int,value:string>>"
CHUNK = 64


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column) -> Column:
    """Sums of the values before each place, in near linear time: by chunks, then within the chunk."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def chunk_sums(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / CHUNK).cast("int")), lambda c: total(F.slice(v, c * CHUNK + 1, CHUNK)))

    def before_chunks(sums: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda c: total(F.slice(sums, F.lit(1), c)))

    def places(v: Column, before: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(v) - 1),
            lambda i: F.element_at(before, F.floor(i / CHUNK).cast("int") + 1) + total(F.slice(v, F.floor(i / CHUNK).cast("int") * CHUNK + 1, i % CHUNK)),
        )

    return _let(values, lambda v: _let(chunk_sums(v), lambda sums: _let(before_chunks(sums), lambda before: places(v, before))))


def _fits(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        short = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(short(p)) <= 3) & (F.coalesce(F.when(F.length(short(p)) <= 3, short(p).try_cast("int")), F.lit(0)) <= 255))
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(9, 15)


def _located(df: DataFrame, name: str, pattern: str, hint: Column) -> DataFrame:
    """Add ``name``: structs (start, value) of all matches in code points, from the parts between the matches."""
    none = F.lit(None).cast("array<string>")
    df = df.withColumn("_hits", F.when(hint, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_rest", F.when(F.size("_hits") > 0, F.split("text", pattern, -1)).otherwise(none))
    # A match starts after all earlier matches and the parts up to it.
    parts = F.transform("_rest", lambda x: F.length(x))
    sizes = F.transform("_hits", lambda x: F.length(x))
    steps = F.zip_with(F.slice(parts, F.lit(1), F.size("_hits")), F.concat(F.array(F.lit(0)), F.slice(sizes, F.lit(1), F.size("_hits") - 1)), lambda a, b: a + b)
    starts = _let(steps, lambda v: F.zip_with(_running(v), v, lambda a, b: a + b))
    found = F.zip_with(starts, F.col("_hits"), lambda a, b: F.struct(a.alias("start"), b.alias("value")))
    return df.withColumn(name, F.when(F.size("_rest") > 0, found)).drop("_hits", "_rest")


def _hint(kind: str, text: Column) -> Column:
    return text.rlike("[0-9]") if HINTS[kind] is None else F.contains(text, F.lit(HINTS[kind]))


def _has_base(column: str) -> Column:
    """Whether ``base_spans`` finds anything in a text; nothing is located for that."""
    text = F.coalesce(F.col(column), F.lit(""))

    def found(kind: str, pattern: str) -> Column:
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return _hint(kind, text) & F.coalesce(F.exists(hits, lambda m: _fits(kind, m)), F.lit(False))

    return functools.reduce(lambda a, b: a | b, (found(k, p) for k, p in PATTERNS.items()))


def _checked(kind: str):
    return lambda z: _fits(kind, z["value"])


def _spans(found: Column, number: int) -> Column:
    return F.transform(
        found,
        lambda z: F.struct(
            F.lit(number).alias("kind"), z["start"].alias("start"), (z["start"] + F.length(z["value"])).alias("end"), z["value"].alias("value")
        ),
    )


def base_spans(df: DataFrame) -> DataFrame:
    """Add ``base``: confirmed matches (kind, start, end, value), by kind as listed, then start; ``df`` has ``text``."""
    names = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        df = _located(df, f"_{kind}", pattern, _hint(kind, F.col("text")))
        made = _spans(F.filter(f"_{kind}", _checked(kind)), number)
        df = df.withColumn(f"_{kind}", F.coalesce(made, F.array().cast(SPANS)))
        names.append(f"_{kind}")
    return df.withColumn("base", F.concat(*names)).drop(*names)


def _words(text: Column) -> Column:
    """Different lower-case words of letters of a text."""
    return F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), lambda w: F.length(w) >= LEAST_LETTERS)


def _evidence(seen: Column, expected: Column) -> Column:
    """Least -ln P(X >= seen) for a Poisson X of mean ``expected``; rises with ``seen`` above the mean, 0 up to it."""
    return F.when(seen > expected, seen * F.ln(seen / expected) - seen + expected).otherwise(F.lit(0.0))


def disclosing_terms(docs: DataFrame, found: DataFrame, alpha: float, support: int, chance: float) -> DataFrame:
    """(key, term): the terms of each text that disclose one of its entities. ``found`` has the texts with spans (key,
    copies, entities, words).

    Entities of the same texts have equal counts with every term and are counted as one. Copies of a text count in n, n_t,
    n_e and n_te, but as one text where chance is judged.
    """
    n = F.lit(float(max(docs.count(), 1)))
    each = found.select("key", "copies", F.explode("entities").alias("name"))
    same = each.groupBy("name").agg(
        F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"), F.sum("copies").alias("n_e"), F.count("*").alias("places")
    )
    entity = F.struct("x", "y", "n_e").alias("entity")
    content = F.log2(n / F.col("n_e")).alias("content")
    held = each.join(same, "name").select("key", "copies", entity, "n_e", "places", content).filter("content > 0").distinct()
    held = keep(held, "entities")
    terms = docs.select(F.explode(_words(F.coalesce("text", F.lit("")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    terms = keep(terms, "vocabulary")
    enough = F.ln(F.lit(max(terms.count(), 1) / chance))
    expected = F.col("n_t") * F.col("places") / n
    # PMI is at most log2(n / n_t), and a term meets an entity in no more texts than hold either: what cannot reach both
    # bounds is not paired. The margin covers rounding.
    most = F.log2(n / F.col("n_t")) + 1e-9
    least = held.groupBy("key").agg(F.min("content").alias("least"), F.min("places").alias("fewest"), F.max("places").alias("most_places"))
    bound = F.least("n_t", "most_places")
    likely = bound * F.ln(bound / (F.col("n_t") * F.col("fewest") / n)) + 1e-9 >= enough
    rare = found.select("key", F.explode("words").alias("term")).join(least, "key").join(terms, "term")
    rare = rare.filter((most >= F.col("least") / alpha) & likely).select("key", "term", "n_t")
    can = _evidence(F.least("n_t", "places"), expected) + 1e-9 >= enough
    near = keep(held.join(rare, "key").filter((most >= F.col("content") / alpha) & can), "near")
    pairs = near.groupBy("entity", "n_e", "places", "content", "term", "n_t").agg(F.sum("copies").alias("n_te"), F.count("*").alias("texts"))
    pmi = F.log2(n * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    sure = _evidence(F.col("texts"), expected) >= enough
    telling = pairs.filter((F.col("texts") >= support) & (pmi >= F.col("content") / alpha) & sure).select("entity", "term")
    return near.join(telling, ["entity", "term"], "left_semi").select("key", "term").distinct()


def _found_spans(docs: DataFrame, alpha: float, support: int, chance: float) -> tuple[DataFrame, DataFrame]:
    """The different texts with personal data (key, text, base, ...) and their spans (key, spans), those of disclosing terms
    after the base spans."""
    text = docs.select(F.coalesce("text", F.lit("")).alias("text"), text_key().alias("key"))
    based = base_spans(text)
    entities = F.array_distinct(F.transform("base", lambda s: F.concat_ws(":", s["kind"].cast("string"), F.lower(s["value"]))))
    each = based.select("key", "base", entities.alias("entities"), F.when(F.size("base") > 0, _words(F.col("text"))).alias("words"), F.when(F.size("base") > 0, F.col("text")).alias("text"))
    # Filtered after the aggregation: a filter before it would be pushed down and look for the spans a second time.
    each = each.groupBy("key").agg(*(F.first(c).alias(c) for c in ("base", "entities", "words", "text")), F.count("*").alias("copies"))
    found = keep(each.filter(F.size("base") > 0), "personal")
    terms = keep(disclosing_terms(docs, found, alpha, support, chance), "terms")
    held = found.select("key", "text").join(terms.select("key").distinct(), "key", "left_semi")
    held = _located(held, "word", r"\p{L}+", F.lit(True)).select("key", F.explode("word").alias("w"))
    hit = held.withColumn("term", F.lower("w.value")).join(terms, ["key", "term"], "left_semi")
    span = F.struct(F.lit(4).alias("kind"), F.col("w.start").alias("start"), (F.col("w.start") + F.length("w.value")).alias("end"), F.col("w.value").alias("value"))
    termed = hit.groupBy("key").agg(F.array_sort(F.collect_list(span)).alias("more"))
    none = F.array().cast(SPANS)
    # A term inside a base span needs no span of its own.
    outside = F.filter(F.coalesce("more", none), lambda w: ~F.exists("base", lambda b: (w["start"] < b["end"]) & (w["end"] > b["start"])))
    return found, keep(found.select("key", "base").join(termed, "key", "left").select("key", F.concat("base", outside).alias("spans")), "spans")


def spans_by_text(docs: DataFrame, alpha: float = ALPHA, support: int = ANY, chance: float = CHANCE) -> DataFrame:
    """(key, spans) of every text with personal data: base spans and, after them, those of disclosing terms."""
    return _found_spans(docs, alpha, support, chance)[1]


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, alpha: float = ALPHA, support: int = ANY, chance: float = CHANCE) -> DataFrame:
    """Returns per input row doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term, n_spans.

    ``support`` is the least number of different texts of an entity and a term, ``chance`` the number of terms that may meet
    an entity by chance. A null text counts as empty and has no spans; an empty list of spans hashes as the empty string; rows with equal
    texts are equal in all but doc_id; a null doc_id stays null. Other columns are not read.
    """
    spans = spans_by_text(docs, alpha, support, chance)
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("key")).join(spans, "key", "left")
    rows = rows.withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))
    count = lambda number: F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")
    return rows.select(
        "doc_id",
        *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])),
        F.sha2(_listed(F.filter("spans", lambda s: s["kind"] < 4)).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        count(4).alias("n_term"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def redact(docs: DataFrame, alpha: float = ALPHA, support: int = ANY, chance: float = CHANCE) -> DataFrame:
    """``docs`` with every span replaced by the label of its kind; where spans overlap, the label of the
    first one stays, of the longest if they start together.

    Texts without spans, nulls included, stay as they are, and so do all other columns.
    """
    found, spans = _found_spans(docs, alpha, support, chance)
    texts = found.select("key", "text").join(spans.withColumnRenamed("spans", "_spans"), "key")
    ordered = F.array_sort(F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    labels = F.array(*(F.lit(LABELS[k]) for k in KINDS))

    def step(acc: Column, s: Column) -> Column:
        new = F.concat(F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.element_at(labels, s["kind"] + 1))
        return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], -s["back"]).alias("at"), acc["parts"].alias("parts"))).otherwise(
            F.struct((-s["back"]).alias("at"), F.concat(acc["parts"], F.array(new)).alias("parts"))
        )

    finish = lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    # Whether a text has spans shows in the text itself: terms are told only beside base spans. So only redacted texts move.
    cleaned = texts.select(F.col("key").alias("_key"), F.aggregate(ordered, state, step, finish).alias("_clean"))
    redacted = docs.withColumn("_key", text_key()).drop("text").join(cleaned, "_key").withColumnRenamed("_clean", "text")
    return docs.filter(~_has_base("text")).unionByName(redacted.select(*docs.columns))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
