"""Ranked lexical search by a dual tree over items and documents.

Scores are sums over an item's terms of a weight times what the term adds in the document, all whole and not negative, so
the score of a pair is at most the sum of the coordinates' maxima over any groups that hold the two. Documents and items
are grouped into trees whose nodes hold those maxima. A pair of nodes is opened only if its bound reaches the weakest k-th
score among the items of the node; a pair of leaves *is* a score. So the result is exact.

Items come in blocks of a bounded vocabulary, which is what every task receives; each block costs one pass over the texts
(terms of the block's items in each document, written once) and one over what that pass wrote. The k-th scores of a small
hashed part of the documents start the search; they are lower bounds of the final ones and change no result. Tasks
return their best documents per item, and Spark ranks these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promolens.llm.common import BASE, SYMBOLS, U64, WORD_BASE, blocks, give_back, keep, mix, ragged, ranges_hash, words_of
from promolens.llm.passes import FOLD, ragged_values

TOP = 10
#: Distinct terms of the items of one block, summed over the items.
BLOCK_TERMS = 1 << 20
#: Documents and items below one node of their trees.
DOC_FAN, ITEM_FAN = 16, 8
#: Entries of one tree of documents.
PIECE = 1 << 21
#: Documents, about, that give the starting k-th scores.
SEED_DOCS = 20_000
UNIT = 1_000_000_000

BAGS = "item long, first binary, second binary, counts binary"
VECTORS = "doc_id long, n long, terms binary, tf binary"
HITS = "item long, doc_id long, score long"
RANKED = f"{HITS}, rank int"


def _second(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Another hash of byte ranges, so that two terms count as one only if 128 bits agree."""
    return mix(ranges_hash(mix(SYMBOLS[data] * BASE), starts, ends, WORD_BASE) + (ends - starts).astype(U64) * BASE)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of each item, as two hashes, with their numbers of occurrences."""
    for part in blocks(batches):
        data = FOLD[part.data]
        w = words_of(data, part.cuts)
        second, out = _second(data, w.starts, w.ends), []
        for a, b in zip(w.cuts[:-1].tolist(), w.cuts[1:].tolist()):
            first, at, counts = np.unique(w.hashes[a:b], return_index=True, return_counts=True)
            out.append((first.tobytes(), second[a:b][at].tobytes(), counts.astype(np.int64).tobytes()))
        columns = [pa.array([o[i] for o in out], pa.binary()) for i in range(3)]
        yield pa.record_batch([part.column("item"), *columns], names=["item", "first", "second", "counts"])


@dataclass
class Level:
    """Sparse rows of one level of a tree: the terms of row i are terms[cuts[i]:cuts[i + 1]]."""

    cuts: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.cuts) - 1

    def dot(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        counts = self.cuts[rows + 1] - self.cuts[rows]
        at = ragged(self.cuts[rows], counts)
        total = np.r_[0, np.cumsum(self.values[at] * dense[self.terms[at]])]
        ends = np.cumsum(counts)
        return total[ends] - total[ends - counts]


def raised(level: Level, fan: int, width: int) -> Level:
    """The level above: the maxima over ``fan`` neighbouring rows."""
    node = np.repeat(np.arange(len(level)) // fan, np.diff(level.cuts))
    key = node * width + level.terms
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    values = np.maximum.reduceat(level.values[order], first) if len(first) else level.values[:0]
    nodes = -(-len(level) // fan)
    return Level(np.searchsorted(key[first], np.arange(nodes + 1) * width), key[first] % width, values)


def tree(leaves: Level, fan: int, width: int) -> list[Level]:
    """Levels from the leaves up to a single node."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(raised(levels[-1], fan, width))
    return levels


def row_peaks(level: Level) -> np.ndarray:
    """Per row the term of its largest value; -1 for rows without terms."""
    counts = np.diff(level.cuts)
    out = np.full(len(counts), -1, np.int64)
    some = np.flatnonzero(counts)
    if len(some):
        row = np.repeat(np.arange(len(counts)), counts)
        order = np.lexsort((level.terms, -level.values, row))
        out[some] = level.terms[order][level.cuts[:-1][some]]
    return out


def reordered(level: Level, order: np.ndarray) -> Level:
    counts = np.diff(level.cuts)[order]
    at = ragged(level.cuts[:-1][order], counts)
    return Level(np.r_[0, np.cumsum(counts)], level.terms[at], level.values[at])


class Best:
    """The k best documents of every item so far, and the k-th score of each: what a document must reach."""

    def __init__(self, items: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.scores = [np.zeros(0, np.int64) for _ in range(items)]
        self.docs = [np.zeros(0, np.int64) for _ in range(items)]
        self.known = [np.zeros(0, bool) for _ in range(items)]

    def offer(self, item: int, scores: np.ndarray, docs: np.ndarray, known: np.ndarray) -> None:
        scores, docs, known = np.r_[self.scores[item], scores], np.r_[self.docs[item], docs], np.r_[self.known[item], known]
        order = np.lexsort((docs, ~known, -scores))[: self.k]
        self.scores[item], self.docs[item], self.known[item] = scores[order], docs[order], known[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], scores[order[-1]])


@dataclass
class Index:
    """One block of items: the tree over their weighted counts, in the order of its leaves."""

    items: np.ndarray
    levels: list[Level]
    width: int

    def span(self, level: int, node: int) -> tuple[int, int]:
        size = ITEM_FAN**level
        return node * size, min((node + 1) * size, len(self.items))


def search(index: Index, docs: list[Level], ids: np.ndarray, known: np.ndarray, best: Best) -> None:
    """Offer ``best`` every document of a tree that may be among the best of an item."""
    dense = np.zeros(index.width, np.int64)

    def visit(high: int, node: int, level: int, rows: np.ndarray) -> None:
        side = index.levels[high]
        a, b = side.cuts[node], side.cuts[node + 1]
        dense[side.terms[a:b]] = side.values[a:b]
        bound = docs[level].dot(rows, dense)
        dense[side.terms[a:b]] = 0
        first, last = index.span(high, node)
        alive = bound >= max(1, int(best.least[first:last].min()))
        rows, bound = rows[alive], bound[alive]
        if not len(rows):
            return
        if not high and not level:
            best.offer(node, bound, ids[rows], known[rows])
        elif high and high >= level:
            for child in range(node * ITEM_FAN, min((node + 1) * ITEM_FAN, len(index.levels[high - 1]))):
                visit(high - 1, child, level, rows)
        else:
            # The most promising nodes first, in growing portions, so that the k-th scores rise early.
            order = np.argsort(-bound, kind="stable")
            rows, bound, at, size = rows[order], bound[order], 0, 8
            while at < len(rows):
                stop = at + int(np.searchsorted(-bound[at : at + size], -max(1, int(best.least[first:last].min())), "right"))
                if stop == at:
                    return
                start = rows[at:stop] * DOC_FAN
                counts = np.minimum(start + DOC_FAN, len(docs[level - 1])) - start
                visit(high, node, level - 1, ragged(start, counts))
                at, size = stop, size * 4

    visit(len(index.levels) - 1, 0, len(docs) - 1, np.zeros(1, np.int64))


def _vectors(vocabulary):
    """Per document its number of terms, and the block's terms in it with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = vocabulary.value
        width = max(len(first), 1)
        for part in blocks(batches):
            data = FOLD[part.data]
            w = words_of(data, part.cuts)
            n = np.diff(w.cuts)
            at = np.minimum(np.searchsorted(first, w.hashes), len(first) - 1)
            hit = np.flatnonzero(first[at] == w.hashes)
            hit = hit[_second(data, w.starts[hit], w.ends[hit]) == second[at[hit]]]
            doc = np.searchsorted(w.cuts, hit, "right") - 1
            key, tf = np.unique(doc * width + at[hit], return_counts=True)
            cuts = np.searchsorted(key, np.arange(len(n) + 1) * width).tolist()
            terms, tf = (key % width).astype(np.int32), tf.astype(np.int32)
            packed = [pa.array([v[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for v in (terms, tf)]
            yield pa.record_batch([part.column("doc_id"), pa.array(n.astype(np.int64)), *packed], names=["doc_id", "n", "terms", "tf"])

    return run


def _frequencies(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += np.bincount(ragged_values(batch.column(0), np.int32)[0], minlength=width)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["term", "df"])

    return run


def length_factor(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """m of a document of n terms: 25 + (75 n N) div L; beyond 64 bits the product is taken in whole numbers of any size."""
    if 75 * int(n.max(initial=0)) * docs < 2**63:
        return 25 + 75 * n * docs // terms
    return np.array([25 + 75 * int(v) * docs // terms for v in n], np.int64)


def _hits(shared, docs: int, terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, least = shared.value
        best = Best(len(index.items), k, least)
        try:
            for batch in batches:
                term, cuts = ragged_values(batch.column(2), np.int32)
                tf, _ = ragged_values(batch.column(3), np.int32)
                n = batch.column(1).to_numpy()
                known = np.asarray(batch.column(0).is_valid())
                ids = batch.column(0).fill_null(0).to_numpy()
                m, tf = np.repeat(length_factor(n, docs, terms), np.diff(cuts)), tf.astype(np.int64)
                level = Level(cuts, term.astype(np.int64), UNIT * tf // (1000 * tf + 8 * m))
                at = 0
                while at < len(n):
                    stop = max(at + 1, int(np.searchsorted(cuts, cuts[at] + PIECE, "right")) - 1)
                    rows = np.arange(at, min(stop, len(n)))
                    # Documents whose most frequent terms agree, by length, are neighbours: texts of one language and kind.
                    part = reordered(level, rows)
                    order = np.lexsort((n[rows], row_peaks(part)))
                    search(index, tree(reordered(part, order), DOC_FAN, index.width), ids[rows][order], known[rows][order], best)
                    at = rows[-1] + 1
            counts = [len(s) for s in best.scores]
            if sum(counts):
                docs_found, valid = np.concatenate(best.docs), np.concatenate(best.known)
                yield pa.record_batch(
                    [pa.array(np.repeat(index.items, counts)), pa.array(docs_found, mask=~valid), pa.array(np.concatenate(best.scores))],
                    names=["item", "doc_id", "score"],
                )
        finally:
            give_back()

    return run


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _item_index(items: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray) -> Index:
    cuts = np.r_[0, np.cumsum([len(t) for t, _ in bags], dtype=np.int64)]
    terms = np.concatenate([t for t, _ in bags]) if len(bags) else np.zeros(0, np.int64)
    values = np.concatenate([c for _, c in bags]) * weights[terms]
    # Light terms are the frequent ones: items of one language share their lightest, and are neighbours.
    light = row_peaks(Level(cuts, terms, -weights[terms]))
    heavy = row_peaks(Level(cuts, terms, values))
    order = np.lexsort((heavy, light))
    leaves = reordered(Level(cuts, terms, values), order)
    return Index(items[order], tree(leaves, ITEM_FAN, len(weights)), len(weights))


def _block_hits(docs: DataFrame, rows: pa.Table, k: int) -> DataFrame:
    """(item, doc_id, score) of the best documents of one block of items."""
    spark = docs.sparkSession
    none = spark.createDataFrame([], RANKED)
    held = [ragged_values(rows.column(c).combine_chunks(), t) for c, t in (("first", U64), ("second", U64), ("counts", np.int64))]
    hashes, cuts = held[0]
    first, at, place = np.unique(hashes, return_index=True, return_inverse=True)
    if not len(first):
        return none
    words = spark.sparkContext.broadcast((first, held[1][0][at]))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    vectors = keep(text.mapInArrow(_vectors(words), VECTORS), "vectors")
    known = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = known["docs"], known["terms"] or 0
    if not n_terms:
        return none
    df = vectors.select("terms").mapInArrow(_frequencies(len(first)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    found = df.select("term", weight.alias("w")).toArrow()
    weights = np.zeros(len(first), np.int64)
    weights[found.column("term").to_numpy()] = found.column("w").to_numpy()
    bags = [(place[a:b], held[2][0][a:b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
    index = _item_index(rows.column("item").to_numpy(), bags, weights)
    least = np.zeros(len(index.items), np.int64)
    share = n_docs // SEED_DOCS
    if share > 1:
        some = vectors.filter(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(share)) == 0)
        seed = spark.sparkContext.broadcast((index, least))
        start = _ranked(some.mapInArrow(_hits(seed, n_docs, n_terms, k), HITS), k).filter(F.col("rank") == k).select("item", "score").toArrow()
        place = {item: i for i, item in enumerate(index.items.tolist())}
        for item, score in zip(start.column("item").to_pylist(), start.column("score").to_pylist()):
            least[place[item]] = score
    shared = spark.sparkContext.broadcast((index, least))
    return keep(_ranked(vectors.mapInArrow(_hits(shared, n_docs, n_terms, k), HITS), k), "hits")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Returns per row of ``items`` (item_id, text) its ``k`` best rows of ``docs`` (doc_id, text) with a score above 0:
    item_id, rank (from 1), doc_id, score. Equal scores rank by doc_id, rows without doc_id last.

    Terms are maximal runs of ASCII letters and digits and of non-ASCII characters, A-Z lowered. A null or empty text has
    none: such a document is in no result and not counted, such an item has no result. A score sums, over the item's terms
    with repeats, w * (10**9 tf div (1000 tf + 8 m)), w = floor(1000 ln((2 N + 2) / (2 df + 1))), m = 25 + (75 n N) div L.
    Repeated documents rank side by side, each repeated item row has its own result, and an item_id may be null. Other
    columns are not read. Without items, or documents with terms, there is no row.
    """
    named = keep(items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.coalesce("text", F.lit("")).alias("text")), "items")
    bags = keep(named.select("item", "text").mapInArrow(_bags, BAGS), "bags")
    total = bags.agg(F.sum(F.octet_length("first"))).first()[0] or 0
    n_blocks = max(1, -(-(total // 8) // block_terms))
    found = None
    for block in range(n_blocks):
        rows = bags.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).orderBy("item").toArrow()
        hits = _block_hits(docs, rows, k)
        found = hits if found is None else found.unionByName(hits)
    return named.select("item", "item_id").join(found, "item").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH d AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), i AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), lengths AS (
    SELECT doc_id, count(*)::BIGINT AS n FROM d GROUP BY doc_id
), totals AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths
), tf AS (
    SELECT doc_id, term, count(*)::BIGINT AS tf FROM d GROUP BY ALL
), w AS (
    SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term, docs
), bag AS (
    SELECT item_id, term, count(*)::BIGINT AS c FROM i GROUP BY ALL
), scored AS (
    SELECT item_id, doc_id,
           sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
    FROM bag JOIN w USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), totals GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scored WHERE score > 0
)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= 10
"""
