"""A toxicity classifier that does not lean on who is spoken of: counterfactual regularisation.

A text is a set of features: its words, the beginnings of its words, and which of these occur more than once. Spark counts
in how many labelled texts of each class a feature occurs; those whose counts differ beyond chance (likelihood ratio) are
the model's features. Each labelled text that names a group of people also gives counterfactuals, the same text with its
identity terms swapped: for the neutral term of their group and for their neighbours in the list. Logistic regression then
minimises

    mean log loss + FAIRNESS * mean (score change between a text and its counterfactual) ** 2 + RIDGE * |weights| ** 2

over the labelled rows, the score change being taken in the log odds. So a term that is frequent in toxic texts only
because those speak of its group gains no weight, and neutral mentions score like any neutral text. Rows with equal
features are one row with a number. Each step of the optimiser (L-BFGS) is one pass over these rows, summed by Spark; the
driver holds a few vectors of at most ``FEATURES`` numbers.

At most about ``ROWS`` labelled rows are learnt from, chosen by a hash of their id; fewer are all learnt from. Everything
else, scoring above all, covers every row and the whole of its text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import BASE, SYMBOLS, U64, WORD_BASE, Block, blocks, keep, mix, ranges_hash, words_of
from promolens.llm.passes import FOLD, ragged_values, summed

#: Groups of identity terms. The first term of a group is its neutral one.
IDENTITY = (
    ("people", "women", "men", "muslims", "christians", "jews", "hindus", "atheists", "immigrants", "refugees", "gays", "lesbians"),
    ("person", "woman", "man", "muslim", "christian", "jew", "hindu", "atheist", "immigrant", "refugee", "lesbian", "homosexual"),
    ("local", "black", "white", "asian", "african", "american", "european", "mexican", "arab", "jewish", "islamic", "catholic"),
    ("usual", "gay", "straight", "bisexual", "transgender", "queer", "disabled", "deaf", "blind", "elderly", "young", "old"),
)
#: Beginnings of words, in bytes.
STEMS = tuple(range(3, 11))
#: Features of the model at most; the least telling ones go first.
FEATURES = 1 << 13
#: Labelled rows to learn from, and tasks that a pass over them takes.
ROWS, TASKS = 50_000, 8
#: Least likelihood ratio, and least number of labelled texts, of a feature.
TELLING, SUPPORT = 20.0, 4
FAIRNESS, RIDGE = 1.0, 2e-5
STEPS = 60
THRESHOLD = 0.7


@dataclass(frozen=True)
class Bags:
    """Features of a block's texts: feature[i] is in text[i]; the same feature comes once per text."""

    text: np.ndarray
    feature: np.ndarray


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Per word its features: the word itself and its beginnings; 0 where the word is not longer than the beginning."""
    n, symbols = ends - starts, SYMBOLS[data]
    out = [hashes]
    for size in STEMS:
        long = np.flatnonzero(n > size)
        column = np.zeros(len(n), U64)
        column[long] = mix(ranges_hash(symbols, starts[long], starts[long] + size, WORD_BASE) + U64(size * int(BASE) % 2**64))
        out.append(column)
    return np.stack(out, 1)


def _numbered(part: Block, extra: bytes = b"") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block by number: text and number of each word, the features of each number, the numbers of ``extra``."""
    data = np.concatenate([FOLD[part.data], np.frombuffer(extra, np.uint8)])
    cuts = np.r_[part.cuts, len(data)] if extra else part.cuts
    w = words_of(data, cuts)
    distinct, first, number = np.unique(w.hashes, return_index=True, return_inverse=True)
    features = word_features(data, w.starts[first], w.ends[first], distinct)
    own = int(w.cuts[len(part)])
    text = np.searchsorted(w.cuts[: len(part) + 1], np.arange(own), "right") - 1
    return text, number[:own], features, number[own:]


def bags(text: np.ndarray, number: np.ndarray, features: np.ndarray, chosen: np.ndarray | None = None) -> Bags:
    """Features of texts given by their words; with ``chosen`` (sorted), only those, as places in it."""
    words = max(len(features), 1)
    pair, tf = np.unique(text * words + number, return_counts=True)
    names, index = np.unique(features, return_inverse=True)
    index, width = index.reshape(features.shape), max(len(names), 1)
    once, twice = names, mix(names ^ BASE)
    if chosen is not None:  # a feature and its mark of repetition may be chosen one without the other
        once, twice = _places(once, chosen), _places(twice, chosen)
    useful = names != 0 if chosen is None else (names != 0) & ((once >= 0) | (twice >= 0))
    row, column = np.nonzero(useful[index][pair % words])
    key, at = np.unique(pair[row] // words * width + index[pair[row] % words, column], return_inverse=True)
    total = np.bincount(at, tf[row], len(key))
    owner, name, more = key // width, key % width, total > 1
    found = Bags(np.r_[owner, owner[more]], np.r_[once[name], twice[name[more]]])
    if chosen is None:
        return found
    real = found.feature >= 0
    return Bags(found.text[real], found.feature[real])


def _places(values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Where values stand in a sorted array; -1 for those that do not."""
    if not len(chosen):
        return np.full(values.shape, -1, np.int64)
    at = np.minimum(np.searchsorted(chosen, values), len(chosen) - 1)
    return np.where(chosen[at] == values, at, -1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, clean): texts of each class with a feature, block by block."""
    for part in blocks(batches):
        text, number, features, _ = _numbered(part)
        found = bags(text, number, features)
        toxic = part.column("y").to_numpy()[found.text]
        names, at = np.unique(found.feature, return_inverse=True)
        ones = np.bincount(at, toxic, len(names)).astype(np.int64)
        yield pa.record_batch([pa.array(names.astype(np.int64)), pa.array(ones), pa.array(np.bincount(at, minlength=len(names)) - ones)], names=["feature", "toxic", "clean"])


def likelihood_ratio(toxic: Column, clean: Column, all_toxic: int, all_clean: int) -> Column:
    """G2 of a feature's presence against the class."""
    total, have = float(all_toxic + all_clean), toxic + clean

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    rest = F.lit(total) - have
    return 2 * (
        part(toxic, have * all_toxic / total)
        + part(clean, have * all_clean / total)
        + part(F.lit(all_toxic) - toxic, rest * all_toxic / total)
        + part(F.lit(all_clean) - clean, rest * all_clean / total)
    )


def swaps(groups: tuple[tuple[str, ...], ...], numbers: np.ndarray) -> list[dict[int, int]]:
    """Maps of word numbers: to the neutral term, to the next and to the previous term of the group."""
    maps: list[dict[int, int]] = [{}, {}, {}]
    at = 0
    for group in groups:
        own = numbers[at : at + len(group)].tolist()
        at += len(group)
        for i, n in enumerate(own):
            maps[0][n] = own[0]
            maps[1][n] = own[(i + 1) % len(own)]
            maps[2][n] = own[i - 1]
    return maps


def _packed(bag: Bags, texts: np.ndarray) -> list[bytes]:
    """Per text its features, ascending, as 32-bit numbers."""
    order = np.lexsort((bag.feature, bag.text))
    owner, values = bag.text[order], bag.feature[order].astype(np.int32)
    starts, ends = np.searchsorted(owner, texts), np.searchsorted(owner, texts, "right")
    return [values[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]


def _design(chosen: np.ndarray, groups: tuple[tuple[str, ...], ...]):
    """Rows of the fit: of a labelled text (y, its features, none), of a counterfactual (-1, before, after)."""
    extra = b" " + " ".join(t for g in groups for t in g).encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            text, number, features, terms = _numbered(part, extra)
            every = np.arange(len(part))
            plain = _packed(bags(text, number, features, chosen), every)
            y, before, after = part.column("y").to_numpy().astype(np.int32).tolist(), list(plain), [b""] * len(part)
            named = np.unique(text[np.isin(number, terms)])
            held = np.isin(text, named)
            for change in swaps(groups, terms):
                to = np.arange(len(features))
                to[list(change)] = list(change.values())
                swapped = _packed(bags(text[held], to[number[held]], features, chosen), named)
                for i, s in zip(named.tolist(), swapped):
                    y.append(-1)
                    before.append(plain[i])
                    after.append(s)
            yield pa.record_batch([pa.array(y, pa.int32()), pa.array(before, pa.binary()), pa.array(after, pa.binary())], names=["y", "before", "after"])

    return run


def _gradient(weights: np.ndarray, size: int, penalty: float):
    """Sums over the rows of the fit: log loss and ``penalty`` times squared changes, then the gradient (features,
    constant)."""

    def side(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, cuts = ragged_values(column, np.int32)
        total = np.r_[0.0, np.cumsum(weights[at])]
        return at, np.repeat(np.arange(len(column)), np.diff(cuts)), total[cuts[1:]] - total[cuts[:-1]]

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        value, slope = 0.0, np.zeros(size + 1)
        for batch in batches:
            y, n = batch.column(0).to_numpy(), batch.column(3).to_numpy().astype(float)
            at, row, before = side(batch.column(1))
            to, to_row, after = side(batch.column(2))
            real, sign = y >= 0, np.where(y == 1, 1.0, -1.0)
            z = sign * (before + weights[size])
            change = before - after
            value += (n * np.where(real, np.logaddexp(0, -z), penalty * change**2)).sum()
            pull = np.where(real, -sign / (1 + np.exp(np.clip(z, -500, 500))), 2 * penalty * change) * n
            slope[:size] += np.bincount(at, pull[row], size) - np.bincount(to, pull[to_row], size)
            slope[size] += pull[real].sum()
        return np.r_[value, slope]

    return part


def minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int, held: int = 8) -> np.ndarray:
    """L-BFGS with halving of the step; ends where the gradient is small or no step helps."""
    x, (f, g) = start, value(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.linalg.norm(g) <= 1e-6 * max(1.0, np.linalg.norm(x)):
            break
        q, parts = g.copy(), []
        for s, y in reversed(moves):
            a = (s @ q) / (s @ y)
            parts.append(a)
            q -= a * y
        if moves:
            s, y = moves[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(moves, reversed(parts)):
            q += (a - (y @ q) / (s @ y)) * s
        step, slope = 1.0, g @ q
        for _ in range(20):
            ahead = x - step * q
            f_new, g_new = value(ahead)
            if f_new <= f - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = ahead - x, g_new - g
        if s @ y > 1e-12 * (y @ y):
            moves = (moves + [(s, y)])[-held:]
        x, f, g = ahead, f_new, g_new
    return x


@dataclass(frozen=True)
class Model:
    """Chosen features (sorted hashes), their weights and the constant."""

    features: np.ndarray
    weights: np.ndarray
    constant: float

    def scores(self, part: Block) -> np.ndarray:
        text, number, features, _ = _numbered(part)
        found = bags(text, number, features, self.features)
        z = self.constant + np.bincount(found.text, self.weights[found.feature], len(part))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(
    labelled: DataFrame,
    groups: tuple[tuple[str, ...], ...] = IDENTITY,
    fairness: float = FAIRNESS,
    ridge: float = RIDGE,
    features: int = FEATURES,
    steps: int = STEPS,
) -> Model:
    """The model of ``labelled`` (text, y): y is 1 for toxic and 0 for clean rows; other rows do not count.

    A null text counts as empty. Repeated rows count as often as they come. With rows of one class only, or none, the
    model knows no feature and gives every text the same score: the class's share, and 0 without rows.
    """
    rows = keep(labelled.filter("y in (0, 1)").select(F.coalesce("text", F.lit("")).alias("text"), F.col("y").cast("int").alias("y")), "labelled")
    of = rows.agg(F.count_if(F.col("y") == 1).alias("toxic"), F.count_if(F.col("y") == 0).alias("clean")).first()
    toxic, clean = of["toxic"], of["clean"]
    if not toxic or not clean:
        return Model(np.zeros(0, U64), np.zeros(0), 500.0 if toxic else -500.0)
    counts = rows.mapInArrow(_counts, "feature long, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    told = counts.filter(F.col("toxic") + F.col("clean") >= SUPPORT).withColumn("told", likelihood_ratio(F.col("toxic"), F.col("clean"), toxic, clean))
    best = told.filter(F.col("told") >= TELLING).orderBy(F.desc("told"), "feature").limit(features).select("feature").toArrow()
    chosen = np.sort(best.column("feature").to_numpy().astype(np.int64).view(U64))
    fit = rows.mapInArrow(_design(chosen, groups), "y int, before binary, after binary").groupBy("y", "before", "after").agg(F.count("*").alias("n"))
    fit = keep(fit.select("y", "before", "after", "n").repartition(TASKS), "design")
    size, total = len(chosen), toxic + clean
    swapped = fit.filter("y < 0").agg(F.sum("n")).first()[0] or 0

    penalty = fairness * total / swapped if swapped else 0.0

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        found = summed(fit, size + 2, _gradient(x, size, penalty)) / total
        slope = found[1:].copy()
        slope[:size] += 2 * ridge * x[:size]
        return found[0] + ridge * (x[:size] @ x[:size]), slope

    start = np.r_[np.zeros(size), np.log(toxic / clean)]
    x = minimise(value, start, steps)
    return Model(chosen, x[:size], float(x[size]))


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (with text) with a column ``toxicity``, the model's probability that the text is toxic.

    The whole text counts; a null text is an empty one. All columns stay; a column of that name is replaced.
    """
    docs = docs.drop("toxicity")
    safe = docs.withColumn("_text", F.coalesce("text", F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, column="_text"):
            kept = part.batch.select([c for c in part.batch.schema.names if c != "_text"])
            yield pa.record_batch([*kept.columns, pa.array(model.scores(part))], names=[*kept.schema.names, "toxicity"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return safe.mapInArrow(run, f"{schema}, toxicity double")


def held_out(column: str = "doc_id") -> Column:
    """Rows that no label may be learnt from; a row without id is learnt from like the others."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def chosen_labels(labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """(doc_id, y): at most about ``rows`` labels that may be learnt from, by the hash of their id."""
    known = labels.filter("toxic in (0, 1)").filter(F.col("doc_id").isNotNull() & ~held_out())
    known = keep(known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("y")), "known")
    share = max(1.0, known.count() / rows)
    return known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) / share))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """Returns per row of ``docs`` (doc_id, text) doc_id, held_out, score, predicted, learnt from ``labels`` (doc_id, toxic).

    Labels of held-out ids are not read. Of several labels of one id the largest counts; null and other values than 0 and
    1, and labels without id, do not. About ``rows`` labels at most are learnt from. Rows with equal texts have equal
    scores. Neither ids nor other columns enter a score.
    """
    # The chosen labels are bounded by ``rows``, so they may go to every task; the texts need not move.
    chosen = F.broadcast(chosen_labels(labels, rows))
    labelled = docs.filter(~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id").select("text", "y")
    scored = toxicity_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(labelled))
    score = F.col("toxicity").alias("score")
    return scored.select("doc_id", held_out().alias("held_out"), score, (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
