"""Similarity join of documents on word shingles, by an R-tree over count vectors.

A text becomes its set of shingles. Equal sets are one set. Sets meet in four steps, each without loss:

0. Candidates. Two linked sets share at least num / den of the elements of either, so a set of which fewer shingles occur
   in other texts is linked with none. Which do is counted by ``rounds`` over short names: a name that two shingles share
   by chance only lets a set pass.
1. Clusters. The shingles of a set are hashed into more parts than two linked sets can differ in, so linked sets have a
   part in common (see ``Parts``). Which parts occur twice is counted by ``rounds``; sets with a common part make a
   cluster, a superset of the groups looked for.
2. R-tree. Each set is a point of ``DIMENSIONS`` counts: its shingles by another hash. Points are sorted by cluster, size
   and counts over all tasks and cut into tiles, the leaves' parents; a tile has the maxima of its counts. The overlap of
   any two sets of two tiles is at most the sum of the smaller maxima, so most pairs of tiles of a large cluster go.
   In the remaining pairs of tiles, leaves of a few points are bounded in the same way, then single points. A set without
   a surviving partner is linked with none.
3. The shingles of the others are fetched, and those of surviving pairs are compared, unless links have joined the two
   already. Only links that join what was apart leave a task; components follow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promolens.llm import rounds
from promolens.llm.common import BASE, U64, WORD_BASE, Block, blocks, bucket_bits, keep, mix, ranges_hash, text_key, total_bytes, words_of
from promolens.llm.graph import Forest, components
from promolens.session import discard

DIMENSIONS = 128
TILE_ROWS = 1024
TILE_BYTES = 8 << 20
LEAF = 16
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SETS = "key binary, digest long, digest2 long, n_shingles long, counts binary"


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; linked if intersection / union >= num / den."""

    words: int = 4
    num: int = 85
    den: int = 100

    def linked(self, both: int, a: int, b: int) -> bool:
        return self.den * both >= self.num * (a + b - both)

    def enough(self, both, total):
        """Is an intersection of at most ``both`` enough for sets with ``total`` elements together?"""
        return (self.num + self.den) * both >= self.num * total


class Parts:
    """Size classes and numbers of parts of a rule.

    A size class reaches from its smallest size to that size times den / num, so a linked larger set is in the same class
    or the next. Two linked sets of sizes up to ``most`` differ in at most (den - num) / (den + num) * 2 * most elements.
    With one part more than that, some part has no difference in it. It may be empty in both; so there are ``spare``
    more parts, and a set with more empty parts than that names its empty parts as well.
    """

    def __init__(self, rule: Rule):
        self.rule = rule
        self.least = [1]
        while self.least[-1] < 1 << 40:
            self.least.append(self.least[-1] * rule.den // rule.num + 1)
        self.bounds = np.array(self.least)

    def class_of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, sizes, "right") - 1

    def shape(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts and spare parts of classes."""
        most = self.bounds[classes + 1] - 1
        differ = (self.rule.den - self.rule.num) * 2 * most // (self.rule.den + self.rule.num)
        spare = 1 + differ // 64
        return differ + 1 + spare, spare


def shingle_sets(data: np.ndarray, cuts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes, ascending within each text, and their cuts by text."""
    w = words_of(LOWER[data], cuts)
    counts = np.diff(w.cuts)
    n = np.where(counts == 0, 0, np.maximum(counts - words + 1, 1))
    at = np.r_[0, np.cumsum(n)]
    start = np.arange(at[-1]) - np.repeat(at[:-1] - w.cuts[:-1], n)
    length = np.repeat(np.minimum(counts, words), n)
    hashes = mix(ranges_hash(w.hashes, start, start + length, WORD_BASE) + length.astype(U64) * BASE)
    text = np.repeat(np.arange(len(cuts) - 1), n)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])][: len(hashes)]
    return hashes[new], np.r_[0, np.cumsum(np.bincount(text[new], minlength=len(cuts) - 1))]


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.r_[U64(0), np.cumsum(values, dtype=U64)]
    return total[cuts[1:]] - total[cuts[:-1]]


def _digests(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            sets, cuts = shingle_sets(part.data, part.cuts, rule.words)
            n = np.diff(cuts)
            first = mix(_sums(mix(sets.copy()), cuts) + n.astype(U64)).astype(np.int64)
            second = mix(_sums(mix(sets * BASE), cuts) + n.astype(U64) * BASE).astype(np.int64)
            group = (mix(sets * WORD_BASE) % U64(DIMENSIONS)).astype(np.int64)
            counts = np.bincount(np.repeat(np.arange(len(n)), n) * DIMENSIONS + group, minlength=len(n) * DIMENSIONS).reshape(len(n), -1)
            points = pa.array([c.tobytes() for c in counts.astype(">i4")], pa.binary())
            yield pa.record_batch([part.column("key"), pa.array(first), pa.array(second), pa.array(n), points], names=["key", "digest", "digest2", "n_shingles", "counts"])

    return run


def part_names(sets: np.ndarray, cuts: np.ndarray, parts: Parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the parts of each text's set for its class and the next one: text, name; cuts of the places by text.

    A name is a hash of the part's elements, its number and its class, so sums of hashes do: no order is needed.
    """
    n = np.diff(cuts)
    some = np.maximum(n, 1)
    names, sizes = [], []
    for ahead in (0, 1):
        kind = parts.class_of(some) + ahead
        count, spare = parts.shape(kind)
        count = np.where(n > 0, count, 0)
        first = np.cumsum(count) - count
        text = np.repeat(np.arange(len(n)), n)
        mixed = mix(sets ^ U64(0xA5A5A5A5A5A5A5A5))
        slot = first[text] + ((mixed >> U64(32)) * count[text].astype(U64) >> U64(32)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        total = int(count.sum())
        held = np.bincount(slot, minlength=total)
        ends = np.cumsum(held)
        sums = _sums(mix(mixed[order] * BASE), np.r_[0, ends])
        owner = np.repeat(np.arange(len(n)), count)
        inner = np.arange(total) - first[owner]
        name = mix(sums + inner.astype(U64) * BASE + kind[owner].astype(U64) * WORD_BASE)
        bare = np.bincount(owner, held == 0, len(n)) if total else np.zeros(len(n))
        keep_ = (held > 0) | (bare > spare)[owner]
        names.append((owner[keep_], name[keep_]))
        sizes.append(np.bincount(owner[keep_], minlength=len(n)))
    text = np.concatenate([t for t, _ in names])
    order = np.argsort(text, kind="stable")
    return text[order], np.concatenate([v for _, v in names])[order], np.r_[0, np.cumsum(sizes[0] + sizes[1])]


def _sets_again(rule: Rule, parts: Parts):
    """(uid, part) rows of the marked parts of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            sets, cuts = shingle_sets(part.data, part.cuts, rule.words)
            _, names, at = part_names(sets, cuts, parts)
            flags = [np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(part.column("marks").to_pylist(), np.diff(at).tolist())]
            hit = np.concatenate(flags).astype(bool)
            uid = np.repeat(part.column("uid").to_numpy(), np.diff(at))
            yield pa.record_batch([pa.array(uid[hit]), pa.array(names[hit].astype(np.int64))], names=["uid", "part"])

    return run


def candidates(text: DataFrame, rule: Rule) -> DataFrame:
    """Keys of the texts (key, text) that may be linked with another set: num / den of their shingles or more occur in
    another row. Copies count as other rows, so they pass."""
    items = total_bytes(text) // 6

    def make(part: Block) -> rounds.Cut:
        shingles, cuts = shingle_sets(part.data, part.cuts, rule.words)
        return rounds.Cut(part.column("key").to_pylist(), np.diff(cuts), [rounds.Family(shingles, np.arange(len(shingles)))])

    def enough(states: np.ndarray) -> bytes | None:
        return b"" if rule.den * int((states > 0).sum()) >= rule.num * len(states) else None

    return rounds.marks(text, make, enough, bucket_bits(items), compared=items.bit_length() + 4).select("key")


def _shingles(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            sets, cuts = shingle_sets(part.data, part.cuts, rule.words)
            at = cuts.tolist()
            yield pa.record_batch([part.column("uid"), pa.array([sets[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())], names=["uid", "shingles"])

    return run


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the partition and the cost of the points before each one among those of its cluster and partition."""
    part, cluster, before = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        befores = []
        for c, cost in zip(batch.column(1).to_pylist(), batch.column(4).to_pylist()):
            before = before if c == cluster else 0
            cluster = c
            befores.append(before)
            before += cost
        columns = [pa.array([part] * len(befores), pa.int64()), pa.array(befores, pa.int64())]
        yield pa.record_batch([*columns, *batch.columns], names=["part", "before", *batch.schema.names])


def tiles_of(points: DataFrame, tile_rows: int) -> DataFrame:
    """``points`` (uid, cluster, n, counts) with the name of their tile: a run of sorted points of one cluster, about
    ``tile_rows`` points or TILE_BYTES of shingles. The sort goes over all tasks; where a cluster spans partitions, the
    costs of the partitions before are added, so the number of tiles does not depend on the number of partitions."""
    tasks = max(points.sparkSession.sparkContext.defaultParallelism, points.count() // 50_000 + 1)
    priced = points.withColumn("cost", F.greatest(F.col("n") * 8, F.lit(TILE_BYTES // tile_rows)))
    ranged = priced.repartitionByRange(tasks, "cluster", "n", "counts", "uid").sortWithinPartitions("cluster", "n", "counts", "uid")
    ddl = "part long, before long, uid long, cluster long, n long, counts binary, cost long"
    ranked = keep(ranged.select("uid", "cluster", "n", "counts", "cost").mapInArrow(_ranked, ddl), "ranked")
    upto = Window.partitionBy("cluster").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = ranked.groupBy("cluster", "part").agg(F.sum("cost").alias("cost"))
    runs = runs.select("cluster", "part", F.coalesce(F.sum("cost").over(upto), F.lit(0)).alias("earlier"))
    joined = ranked.join(runs, ["cluster", "part"])
    number = F.floor((F.col("before") + F.col("earlier")) / TILE_BYTES)
    return joined.select(F.xxhash64("cluster", number).alias("tile"), "uid", "cluster", "n", "counts")


def _counts(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">i4").reshape(-1, DIMENSIONS).astype(np.int64)


def _edges_of_tiles(group: pa.Table) -> pa.Table:
    counts = _counts(group.column("counts").combine_chunks())
    n = group.column("n").to_numpy()
    return pa.table(
        [group.column("tile").combine_chunks()[:1], group.column("cluster").combine_chunks()[:1], pa.array([counts.max(0).astype(">i4").tobytes()], pa.binary()), pa.array([n.min()]), pa.array([n.max()])],
        names=["tile", "cluster", "top", "least", "most"],
    )


def _near_tiles(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bound = np.minimum(_counts(batch.column(2)), _counts(batch.column(3))).sum(1)
                yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(rule.enough(bound, batch.column(4).to_numpy())))

    return run


def _near_points(group: pa.Table, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group, sorted by n, that the bounds of leaves and points leave over; of different tiles if the
    group holds two."""
    n, tile = group.column("n").to_numpy(), group.column("tile").to_numpy()
    counts = _counts(group.column("counts").combine_chunks())
    alone = len(np.unique(tile)) == 1
    leaves = np.arange(0, len(n), LEAF)
    tops = np.maximum.reduceat(counts, leaves, axis=0)
    small, large = n[leaves], n[np.minimum(leaves + LEAF, len(n)) - 1]
    for x in range(len(leaves)):
        bound = np.minimum(tops[x], tops[x:]).sum(1)
        near = rule.enough(bound, small[x] + small[x:]) & (rule.num * small[x:] <= rule.den * large[x])
        i = np.arange(leaves[x], min(leaves[x] + LEAF, len(n)))
        for y in (x + np.flatnonzero(near)).tolist():
            j = np.arange(leaves[y], min(leaves[y] + LEAF, len(n)))
            both = np.minimum(counts[i][:, None], counts[j][None]).sum(2)
            fits = rule.enough(both, n[i][:, None] + n[j][None]) & (i[:, None] < j[None])
            p, q = np.nonzero(fits if alone else fits & (tile[i][:, None] != tile[j][None]))
            if len(p):
                yield i[p], j[q]


def _sorted(group: pa.Table) -> pa.Table:
    return group.sort_by([("n", "ascending"), ("uid", "ascending")])


def _alive(rule: Rule):
    """Points with a surviving partner."""

    def run(group: pa.Table) -> pa.Table:
        group = _sorted(group)
        alive = np.zeros(group.num_rows, bool)
        for i, j in _near_points(group, rule):
            alive[i] = alive[j] = True
        return pa.table([pa.array(group.column("uid").to_numpy()[alive])], names=["uid"])

    return run


def _linked(rule: Rule):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        group = _sorted(group)
        uid, n = group.column("uid").to_numpy(), group.column("n").to_numpy()
        sets = [np.frombuffer(s, U64) for s in group.column("shingles").to_pylist()]
        forest, out = Forest(len(uid)), []
        for i, j in _near_points(group, rule):
            for a, b in zip(i.tolist(), j.tolist()):
                if forest.find(a) != forest.find(b):
                    common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if rule.linked(common, int(n[a]), int(n[b])):
                        forest.join(a, b)
                        out.append((uid[a], uid[b]))
        return pa.table([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], schema=schema)

    return run


def shingle_groups(docs: DataFrame, rule: Rule = Rule(), tile_rows: int = TILE_ROWS) -> DataFrame:
    """(key, uid, n_shingles, root): per text the smallest doc_id with its set, the set's size, and its group's root uid.

    ``uid`` and ``root`` are doc_ids; texts whose rows all lack one are left out, as are texts without words.
    """
    parts = Parts(rule)
    text = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), text_key().alias("key"))
    digests = keep(text.select("key", "text").mapInArrow(_digests(rule), SETS).dropDuplicates(["key"]), "digests")
    ids = text.filter(F.col("doc_id").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    known = digests.drop("counts").filter("n_shingles > 0").join(ids, "key")
    best = known.groupBy("digest", "digest2", "n_shingles").agg(F.min(F.struct("doc_id", "key")).alias("best"))
    sets = keep(best.select("digest", "digest2", "n_shingles", F.col("best.doc_id").alias("uid"), F.col("best.key").alias("key")), "sets")

    def make(part: Block) -> rounds.Cut:
        shingles, cuts = shingle_sets(part.data, part.cuts, rule.words)
        _, names, at = part_names(shingles, cuts, parts)
        return rounds.Cut(part.column("key").to_pylist(), np.diff(at), [rounds.Family(names, np.arange(len(names)))])

    # One text stands for each set.
    able = sets.join(candidates(text.select("key", "text"), rule), "key").select("key", "uid")
    one = keep(text.select("key", "text").join(able, "key").dropDuplicates(["key"]), "candidates", release=True)
    marked = rounds.marks(one.select("key", "text"), make, lambda s: np.packbits(s > 0).tobytes(), bucket_bits(total_bytes(one) // 14))
    named = keep(one.join(marked, "key").select("uid", "marks", "text").mapInArrow(_sets_again(rule, parts), "uid long, part long").distinct(), "parts", release=True)
    shared = keep(named.groupBy("part").agg(F.min("uid").alias("first"), F.count("*").alias("n")).filter("n > 1").select("part", "first"), "shared")
    star = named.join(shared, "part").filter("uid <> first").select(F.col("uid").alias("a"), F.col("first").alias("b"))
    clusters = components(star).select(F.col("id").alias("uid"), F.col("component").alias("cluster"))
    member = sets.join(clusters, "uid").select("key", "uid", "cluster", F.col("n_shingles").alias("n"))
    points = keep(member.join(digests.select("key", "counts"), "key").select("uid", "cluster", "n", "counts"), "points", release=True)
    tiled = keep(tiles_of(points, tile_rows), "tiles", release=True)
    tiles = keep(tiled.groupBy("tile").applyInArrow(_edges_of_tiles, "tile long, cluster long, top binary, least long, most long"), "tops")
    a, b = tiles.alias("a"), tiles.alias("b")
    fits = (F.col("a.cluster") == F.col("b.cluster")) & (F.col("a.tile") <= F.col("b.tile"))
    fits = fits & (rule.num * F.greatest("a.least", "b.least") <= rule.den * F.least("a.most", "b.most"))
    pairs = a.join(b, fits).select(F.col("a.tile").alias("a"), F.col("b.tile").alias("b"), F.col("a.top").alias("x"), F.col("b.top").alias("y"), (F.col("a.least") + F.col("b.least")).alias("total"))
    pairs = keep(pairs.mapInArrow(_near_tiles(rule), "a long, b long"), "near")
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
    near = sides.join(tiled, "tile").drop("cluster")
    alive = keep(near.groupBy("a", "b").applyInArrow(_alive(rule), "uid long").distinct(), "alive")
    shingles = keep(one.join(alive, "uid").select("uid", "text").mapInArrow(_shingles(rule), "uid long, shingles binary"), "shingles", release=True)
    links = near.join(shingles, "uid").groupBy("a", "b").applyInArrow(_linked(rule), "a long, b long")
    found = components(links).select(F.col("id").alias("uid"), F.col("component").alias("root"))
    rooted = sets.join(found, "uid", "left").select("digest", "digest2", "n_shingles", "uid", F.coalesce("root", "uid").alias("root"))
    out = keep(digests.drop("counts").join(rooted, ["digest", "digest2", "n_shingles"]).select("key", "uid", "n_shingles", "root"), "rooted")
    discard(digests, sets, one, named, shared, points, tiled, tiles, pairs, alive, shingles)
    return out


def ngram_jaccard(docs: DataFrame, rule: Rule = Rule(), tile_rows: int = TILE_ROWS) -> DataFrame:
    """Returns per input row doc_id, n_shingles, component_id for documents linked under ``rule``.

    Words are maximal runs without ASCII white space, A-Z lowered; a text with fewer words than a shingle is one shingle;
    without words, or null, it has none and is linked with nothing, not even its equals. Rows with equal sets are linked.
    A row without doc_id belongs to the group of its text, if a row with a doc_id has that text, and has no id to give it.
    Other columns are not read.
    """
    groups = shingle_groups(docs, rule, tile_rows)
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("key")).join(groups, "key", "left")
    sizes = rows.select("doc_id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))
    return sizes


def representatives(docs: DataFrame, rule: Rule) -> DataFrame:
    """``docs`` without those of a group of linked documents but the one with the smallest doc_id; all columns stay.

    Of several rows with that doc_id and one text, all stay. Documents without words or doc_id stay.
    """
    groups = shingle_groups(docs, rule).select(F.col("key").alias("_key"), F.col("root").alias("_root"))
    joined = docs.withColumn("_text", text_key()).join(groups, F.col("_text") == F.col("_key"), "left")
    stays = F.col("_root").isNull() | F.col("doc_id").isNull() | (F.col("doc_id") == F.col("_root"))
    return joined.filter(stays).select(*docs.columns)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), sh AS (
    SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS s FROM w, unnest(range(1, greatest(len(ws) - 2, 2))) AS t(i)
    WHERE len(ws) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * both_ >= 85 * (x.n + y.n - both_)
), reach AS (
    SELECT doc_id AS id, doc_id AS root FROM documents
    UNION
    SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.id
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id
FROM documents d JOIN reach ON reach.id = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id GROUP BY d.doc_id
"""
