"""Near-duplicate embeddings by lattice hashing.

In each of several tables two random projections to 8 dimensions are decoded to points of the E8 lattice; a vector is
filed under the pair of its nearest points and, to probe the neighbouring cells, under the pairs with the next nearest
ones. Vectors that share a cell and a label are compared exactly. Tasks give only links that join what was apart; these
make the components, and within a component all vectors are compared in blocks, so the numbers of links are exact there.

Equal vectors are one vector with a number of copies. Cells and components of any size are compared by pairs of blocks
of at most ``BLOCK`` vectors, each pair a group of its own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import U64, keep, mix
from promolens.llm.graph import Forest, components

THRESHOLD = 0.98
TABLES = 8
SCALE = 2.0
BLOCK = 1024
SEED = 11


def projections(size: int, tables: int, scale: float, seed: int = SEED) -> np.ndarray:
    """tables x 2 random maps to 8 dimensions that keep lengths on average, with random shifts appended as a row."""
    rng = np.random.Generator(np.random.PCG64(seed))
    maps = rng.standard_normal((tables, 2, size, 8)) * scale / math.sqrt(8)
    return np.concatenate([maps, rng.random((tables, 2, 1, 8))], 2)


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of an even sum: round, and move the worst coordinate if the sum is odd."""
    y = np.rint(x)
    odd = np.flatnonzero(y.sum(1).astype(np.int64) & 1)
    gap = x[odd] - y[odd]
    worst = np.abs(gap).argmax(1)
    y[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1, -1)
    return y


def nearest_e8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest points of E8, and of its other half (whole coordinates against halves): the first neighbour to probe."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    closer = (((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None]
    return np.where(closer, whole, half), np.where(closer, half, whole)


def cells(vectors: np.ndarray, maps: np.ndarray) -> np.ndarray:
    """64-bit cell names per vector: tables x 4, of the nearest points and of the probes."""
    out = np.zeros((len(vectors), len(maps) * 4), U64)
    salt = np.random.Generator(np.random.PCG64(SEED + 1)).integers(1, 2**62, 16, dtype=np.int64).astype(U64) * U64(2) + U64(1)
    for t, pair in enumerate(maps):
        names = []
        for half in (0, 1):
            points = nearest_e8(vectors @ pair[half, :-1] + pair[half, -1])
            names.append([mix(((2 * p).astype(np.int64).astype(U64) * salt[8 * half : 8 * half + 8]).sum(1, dtype=U64)) for p in points])
        for i in (0, 1):
            for j in (0, 1):
                out[:, 4 * t + 2 * i + j] = mix(names[0][i] + names[1][j] * salt[0] + salt[1:2] * U64(t + 1))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _unit(vectors: DataFrame) -> DataFrame:
    """Different vectors that can be linked: uid (a copy's smallest id), label, copies, vec (unit doubles as bytes)."""
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    usable = usable & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    usable = usable & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    # Adding zero makes the two zeros one.
    rows = vectors.select(F.col("vec_id").cast("long"), "label", F.transform("embedding", lambda x: x.cast("double") + 0.0).alias("e"), usable.alias("ok"))
    rows = rows.filter(F.coalesce("ok", F.lit(False)))
    return rows.groupBy("label", "e").agg(F.min("vec_id").alias("uid"), F.count("*").alias("copies"))


def _normalised(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        made = []
        for e in batch.column(3):
            v = e.values.to_numpy(zero_copy_only=False)
            v = v / np.abs(v).max()
            made.append((v / np.sqrt(v @ v)).tobytes())
        yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(made, pa.binary())], names=["uid", "label", "copies", "vec"])


def _filed(tables: int, scale: float):
    def run(batches):
        for batch in batches:
            held = batch.column(1).to_pylist()
            sizes = np.array([len(v) for v in held])
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                names = cells(np.frombuffer(b"".join(held[i] for i in rows), np.float64).reshape(len(rows), -1), projections(size // 8, tables, scale))
                ids = np.repeat(batch.column(0).to_numpy()[rows], names.shape[1])
                yield pa.record_batch([pa.array(ids), pa.array(names.reshape(-1).astype(np.int64))], names=["uid", "cell"])

    return run


def block_pairs(rows: DataFrame, group: list[str], salt: Column, block: int) -> DataFrame:
    """Send each row to the pairs of blocks of its group that hold it: adds pair_a, pair_b, side and n_group.

    The number of blocks of a group follows its size; groups of one row are left out, as is the block alone with itself
    on the second side.
    """
    sizes = keep(rows.groupBy(*group).agg(F.count("*").alias("n_group")).filter("n_group > 1"), "groups")
    number = F.ceil(F.col("n_group") / block).cast("int")
    mine = rows.join(sizes, group).withColumn("n_blocks", number).withColumn("mine", F.pmod(salt, F.col("n_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    sent = mine.select("*", other)
    return sent.select(
        *rows.columns, F.least("mine", "other").alias("pair_a"), F.greatest("mine", "other").alias("pair_b"), (F.col("mine") > F.col("other")).alias("side")
    )


def _compare(table: pa.Table):
    """Rows and columns of a group of block pairs: two sides, or one side against itself."""
    vec = _matrix(table.column("vec").combine_chunks()) if table.num_rows else np.zeros((0, 1))
    side = table.column("side").to_numpy(zero_copy_only=False).astype(bool)
    alone = table.column("pair_a")[0].as_py() == table.column("pair_b")[0].as_py()
    a = np.flatnonzero(~side)
    return vec, a, a if alone else np.flatnonzero(side), alone


def _links(threshold: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        vec, left, right, alone = _compare(table)
        ids = table.column("uid").to_numpy()
        forest, out = Forest(len(ids)), []
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            i, j = np.nonzero(vec[some] @ vec[right].T >= threshold)
            for x, y in zip(some[i].tolist(), right[j].tolist()):
                if x != y and forest.join(x, y):
                    out.append((ids[x], ids[y]))
        return pa.table([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], schema=schema)

    return run


def _degrees(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        vec, left, right, alone = _compare(table)
        copies = table.column("copies").to_numpy()
        n = np.zeros(len(copies), np.int64)
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            hit = vec[some] @ vec[right].T >= threshold
            if alone:
                hit[np.arange(len(some)), np.arange(at, at + len(some))] = False
            else:
                n[right] += hit.T.astype(np.int64) @ copies[some]
            n[some] += hit.astype(np.int64) @ copies[right]
        return pa.table([table.column("uid").combine_chunks(), pa.array(n)], names=["uid", "n"])

    return run


def embedding_near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, scale: float = SCALE, block: int = BLOCK
) -> DataFrame:
    """Returns per input row vec_id, n_links, component_id, kept, for ``vectors`` (vec_id, embedding, label).

    Rows with equal labels link if the cosine of their embeddings, in doubles, is at least ``threshold``. A null label, a
    null, empty or zero embedding and one with null or non-finite components link with nothing; so do vectors of
    different lengths and rows without vec_id. Equal rows link with each other. Other columns are not read. A link is
    found if lattice cells connect its ends, directly or over other links; see the README for the measured recall.
    """
    unit = keep(_unit(vectors), "distinct")
    slim = keep(unit.select("uid", "label", "copies", "e").mapInArrow(_normalised, f"uid long, label {dict(unit.dtypes)['label']}, copies long, vec binary"), "unit")
    filed = slim.select("uid", "vec").mapInArrow(_filed(tables, scale), "uid long, cell long").distinct()
    named = filed.join(slim.select("uid", "label", F.length("vec").alias("size")), "uid")
    named = named.select("uid", F.xxhash64("cell", "label", "size").alias("cell"))
    dealt = block_pairs(named, ["cell"], F.xxhash64("uid"), block)
    dealt = dealt.join(slim.select("uid", "vec"), "uid")
    links = dealt.groupBy("cell", "pair_a", "pair_b").applyInArrow(_links(threshold), "a long, b long")
    found = components(links).withColumnRenamed("id", "uid")
    members = slim.select("uid", "copies", "vec").join(found, "uid")
    dealt = block_pairs(members, ["component"], F.xxhash64("uid"), block)
    degrees = dealt.groupBy("component", "pair_a", "pair_b").applyInArrow(_degrees(threshold), "uid long, n long")
    degrees = degrees.groupBy("uid").agg(F.sum("n").alias("n"))
    known = unit.join(degrees, "uid", "left").join(found, "uid", "left")
    known = keep(known.select("label", "e", "uid", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "uid").alias("c")), "known")
    key = F.xxhash64("label", "e")
    rows = vectors.select(F.col("vec_id").cast("long"), "label", F.transform("embedding", lambda x: x.cast("double") + 0.0).alias("e")).withColumn("h", key)
    known = known.withColumn("h", key)
    same = (rows["h"] == known["h"]) & (rows["label"] == known["label"]) & (rows["e"] == known["e"]) & rows["vec_id"].isNotNull()
    out = rows.join(known, same, "left")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("c", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def op5_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP5_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
), good AS (
    SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
    SELECT vec_id AS id, vec_id AS root FROM embeddings
    UNION
    SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.id
), least AS (
    SELECT id, min(root) AS root FROM reach GROUP BY id
)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE link.a = e.vec_id) AS n_links, least.root AS component_id,
       least.root = e.vec_id AS kept
FROM embeddings e JOIN least ON least.id = e.vec_id
"""
