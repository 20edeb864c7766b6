"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

For each length of vectors a rotation of the principal components is learned on a bounded sample (SAMPLE vectors, by a
hash of the vector) so that signs lose least; every vector then has a code of up to 64 bits. A table keys vectors by some
bits of their code: runs that cover it, under one order of the bits after another. A key has enough bits for the number
of vectors (their binary logarithm and SPARE more, so that chance neighbours stay few a vector however many there are).
The number of tables and the Hamming radius are fitted too: partners at exactly the threshold's angle, the hardest case,
are made of the sample's vectors, tables are added until all but MISS of these meet in one, and the radius is what all
but BEYOND lie within.

Retrieval moves codes alone: members of a bucket are compared by Hamming distance, and only those with another one in the
radius go on. Their original vectors are then compared by cosine in double precision; only pairs at or over the
threshold link.

Equal vectors are one node with a weight. A bucket of any size is dealt to blocks, and each pair of blocks is one bounded
group in a task. A pair counts only in the first table where both keys agree, which the codes tell, so nothing has to be
made distinct: tasks give out each node's number of links and a forest of links between nodes. A length that has no more
vectors than FEW is one bucket of one table, compared in full.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import drop_stored, stored, table
from .graph import components

SAMPLE, ROUNDS, FEW = 4096, 50, 512
BITS, LEAST_KEY, MOST_KEY, SPARE = 64, 12, 32, 2
MISS, BEYOND, MOST_TABLES = 0.03, 0.003, 256
COSINE = 0.95
BLOCK = 512


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1. Scaled by their largest component first, for squares of finite numbers may not be finite."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def fit_rotation(x: np.ndarray, bits: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimension x bits) of iterative quantisation: principal components, then the rotation that
    alternates between signs and the orthogonal Procrustes solution."""
    mean = x.mean(axis=0)
    _, vectors = np.linalg.eigh(np.cov((x - mean).T).reshape(x.shape[1], x.shape[1]) if len(x) > 1 else np.eye(x.shape[1]))
    base = vectors[:, ::-1][:, :bits]
    v = (x - mean) @ base
    rotation = np.linalg.qr(np.random.Generator(np.random.Philox(key=3)).standard_normal((bits, bits)))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(v.T @ np.where(v @ rotation >= 0, 1.0, -1.0))
        rotation = u @ w
    return mean, base @ rotation


def packed(mask: np.ndarray) -> np.uint64:
    return np.bitwise_or.reduce(np.uint64(1) << mask.astype(np.uint64))


@dataclass
class Codes:
    """What vectors of one length are coded and looked up by."""

    mean: np.ndarray
    projection: np.ndarray
    packs: list[np.uint64]  # the bits of each table's key
    radius: int

    def code(self, v: np.ndarray) -> np.ndarray:
        bits = self.projection.shape[1]
        return (((v - self.mean) @ self.projection >= 0).astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def partners(x: np.ndarray, cosine: float) -> np.ndarray:
    """For each row a vector at this cosine from it, in a random direction."""
    side = np.random.Generator(np.random.Philox(key=5)).standard_normal(x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    norm = np.linalg.norm(side, axis=1, keepdims=True)
    return cosine * x + math.sqrt(1 - cosine * cosine) * side / np.where(norm > 0, norm, 1)


def fit_codes(x: np.ndarray, count: int, cosine: float) -> Codes:
    """Rotation, tables and radius for `count` vectors of which x (of length 1 each) is a sample."""
    bits = min(BITS, x.shape[1])
    mean, projection = fit_rotation(x, bits)
    out = Codes(mean, projection, [], bits)
    differ = out.code(x) ^ out.code(partners(x, cosine))
    far = np.sort(np.bitwise_count(differ).astype(int))
    out.radius = int(far[min(len(far) - 1, math.ceil((1 - BEYOND) * len(far)))])
    width = max(1, min(MOST_KEY, bits // 2, max(LEAST_KEY, math.ceil(math.log2(count)) + SPARE)))
    missed, order = np.ones(len(x), dtype=bool), 0
    while missed.mean() > MISS and len(out.packs) < MOST_TABLES:
        line = np.arange(bits) if order == 0 else np.random.Generator(np.random.Philox(key=[11, order])).permutation(bits)
        order += 1
        for k in range(bits // width):
            pack = packed(line[k * width : (k + 1) * width])
            out.packs.append(pack)
            missed &= (differ & pack) != 0
    return out


def fresh(differ: np.ndarray, packs: list[np.uint64], t: int) -> np.ndarray:
    """True where two codes that differ so agree in no table before t."""
    ok = np.ones(len(differ), dtype=bool)
    for k in range(t):
        ok &= (differ & packs[k]) != 0
    return ok


def near_codes(blocks: np.ndarray, codes: np.ndarray, t: int, same: bool, how: Codes) -> np.ndarray:
    """Of one group: which members have another within the radius that they do not meet in an earlier table.

    same: the group is one block; else only pairs of different blocks are this group's.
    """
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= how.radius
    np.fill_diagonal(near, False)
    if not same:
        near &= blocks[:, None] != blocks[None, :]
    i, j = np.nonzero(np.triu(near))
    ok = fresh(codes[i] ^ codes[j], how.packs, t)
    hit = np.zeros(len(codes), dtype=bool)
    hit[i[ok]] = hit[j[ok]] = True
    return hit


def links_of(blocks: np.ndarray, weights: np.ndarray, codes: np.ndarray, x: np.ndarray, t: int, same: bool, packs: list[np.uint64], cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Of one group: each member's weight of links, and a forest of links as places (i, j)."""
    sums = np.zeros(len(x), dtype=np.int64)
    near = (x @ x.T) >= cosine
    np.fill_diagonal(near, False)
    if not same:
        near &= blocks[:, None] != blocks[None, :]
    i, j = np.nonzero(np.triu(near))
    if t and len(i):
        ok = fresh(codes[i] ^ codes[j], packs, t)
        i, j = i[ok], j[ok]
    np.add.at(sums, i, weights[j])
    np.add.at(sums, j, weights[i])
    parent = list(range(len(x)))

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    forest = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            forest.append((a, b))
    return sums, forest


def by_group(batches: Iterator[pa.RecordBatch], keys: int, run: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """run on tables of whole groups, equal in the first `keys` integer columns, of rows that come sorted by them."""
    kept: pa.Table | None = None
    for batch in batches:
        got = pa.Table.from_batches([batch])
        got = got if kept is None else pa.concat_tables([kept, got])
        if not len(got):
            continue
        other = np.zeros(len(got), dtype=bool)
        for c in range(keys):
            v = got.column(c).to_numpy()
            other |= v != v[-1]
        last = np.flatnonzero(other)
        cut = int(last[-1]) + 1 if len(last) else 0  # the last group may go on in the next batch
        if cut:
            yield run(got.slice(0, cut))
        kept = got.slice(cut)
    if kept is not None and len(kept):
        yield run(kept)


def bounds(columns: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of rows that are equal in all columns, of two rows at least."""
    n = len(columns[0])
    cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns], axis=0)) + 1
    for begin, end in zip(np.concatenate(([0], cuts)).tolist(), np.concatenate((cuts, [n])).tolist(), strict=True):
        if end - begin > 1:
            yield begin, end


def dealt(rows: DataFrame, columns: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Rows (size, t, key, node, ...) of buckets with two members or more, each to the pairs (i, j) of its bucket's blocks
    that its own, `mine`, is in; and the stored table of buckets."""
    counts = stored(rows.groupBy("size", "t", "key").agg(F.count("*").alias("members")).filter("members > 1"), name)
    out = rows.join(counts, ["size", "t", "key"]).withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn("mine", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("mine")).alias("i"), F.greatest(k, F.col("mine")).alias("j")))
    out = out.withColumn("to", F.explode(pair)).select("size", "t", "key", F.col("to.i").alias("i"), F.col("to.j").alias("j"), "node", "mine", *columns)
    by = ["size", "t", "key", "i", "j"]
    return out.repartition(*by).sortWithinPartitions(*by), counts


def embedding_nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (vec_id, k1, k2: a 128-bit hash of a sound vector) and nodes (node, k1, k2, vec_id, weight, size, embedding), both stored."""
    cells = F.col("embedding").cast("array<double>")
    sound = F.coalesce((F.size("embedding") > 0) & F.forall(cells, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(cells, lambda c: c != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    keyed = vectors.select("vec_id", "embedding", F.when(sound, F.xxhash64("embedding")).alias("k1"), F.when(sound, F.xxhash64(F.lit(1), F.col("embedding"))).alias("k2"))
    rows = stored(keyed.select("vec_id", "k1", "k2"), "embedding-rows")
    classes = keyed.filter("k1 is not null").groupBy("k1", "k2").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"), F.first("embedding").alias("embedding"))
    nodes = classes.select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "vec_id", "weight", F.size("embedding").alias("size"), "embedding")
    return rows, stored(nodes, "embedding-nodes")


def fitted(nodes: DataFrame, cosine: float) -> dict[int, Codes]:
    """Codes of each length that more than FEW vectors have. To the driver come one row a length and one sample at a time."""
    out = {}
    for r in nodes.groupBy("size").count().filter(F.col("count") > FEW).collect():
        share = min(1.0, 2 * SAMPLE / r["count"])
        some = nodes.filter((F.col("size") == r["size"]) & (F.pmod("k1", F.lit(1 << 30)) <= int(share * (1 << 30))))
        sample = some.orderBy("k1", "k2").limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
        x = sample.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, r["size"])
        out[r["size"]] = fit_codes(unit(x), r["count"], cosine)
    return out


def embedding_links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of vectors (vec_id of an integer type, embedding).

    Vectors that are null, empty or zero, or that hold a null or a component that is not finite, link with nothing, and
    neither do vectors of different lengths. Rows of one id are one vector each; a row without id has no component,
    counts no links and is kept. Other columns are left out. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    id_kind = vectors.schema["vec_id"].dataType.simpleString()
    rows, nodes = embedding_nodes(vectors.select("vec_id", "embedding"))
    shared = spark.sparkContext.broadcast(fitted(nodes, cosine))  # a matrix of length x 64 a length

    @K.lean
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["size", "t", "key", "node", "code"]
        for batch in batches:
            size = batch.column(1).to_numpy()
            for own in np.unique(size).tolist():
                part = batch.filter(pa.array(size == own))
                how, n = shared.value.get(own), part.num_rows
                column = lambda v, kind: pa.array(np.full(n, v, dtype=kind))  # noqa: B023, E731
                if how is None:
                    yield pa.RecordBatch.from_arrays([column(own, np.int32), column(0, np.int32), column(0, np.int64), part.column(0), column(0, np.int64)], names=names)
                    continue
                code = how.code(unit(part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, own)))
                for t, p in enumerate(how.packs):
                    yield pa.RecordBatch.from_arrays([column(own, np.int32), column(t, np.int32), pa.array((code & p).view(np.int64)), part.column(0), pa.array(code.view(np.int64))], names=names)

    keyed = nodes.select("node", "size", "embedding").mapInArrow(keys, "size int, t int, key long, node long, code long")
    met, buckets = dealt(keyed, ["code"], "embedding-buckets")

    @K.lean
    def retrieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run(part: pa.Table) -> pa.RecordBatch:
            size, t, key, i, j, _, mine, code = (part.column(c).to_numpy() for c in range(8))
            hit = np.zeros(len(part), dtype=bool)
            for begin, end in bounds([size, t, key, i, j]):
                how, s = shared.value.get(int(size[begin])), slice(begin, end)
                hit[s] = True if how is None else near_codes(mine[s], code[s].view(np.uint64), int(t[begin]), bool(i[begin] == j[begin]), how)
            keep = pa.array(hit)
            return pa.RecordBatch.from_arrays([part.column(c).combine_chunks().filter(keep) for c in (0, 1, 2, 5, 7)], names=["size", "t", "key", "node", "code"])

        return by_group(batches, 5, run)

    close = stored(met.mapInArrow(retrieve, "size int, t int, key long, node long, code long").distinct(), "embedding-close")
    drop_stored(buckets)
    full = close.join(nodes.select("node", "weight", "embedding"), "node")
    met, buckets = dealt(full, ["weight", "code", "embedding"], "embedding-buckets")

    @K.lean
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run(part: pa.Table) -> pa.RecordBatch:
            size, t, key, i, j, ids, mine, weights, codes = (part.column(c).to_numpy() for c in range(9))
            lists = part.column(9).combine_chunks()
            a_, b_, w_ = [], [], []
            for begin, end in bounds([size, t, key, i, j]):
                how, s = shared.value.get(int(size[begin])), slice(begin, end)
                x = unit(lists.slice(begin, end - begin).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(end - begin, int(size[begin])))
                sums, forest = links_of(mine[s], weights[s], codes[s].view(np.uint64), x, int(t[begin]), bool(i[begin] == j[begin]), how.packs if how else [], cosine)
                hit = np.flatnonzero(sums)
                f = np.array(forest, dtype=np.int64).reshape(-1, 2)
                a_ += [ids[s][hit], ids[s][f[:, 0]]]
                b_ += [ids[s][hit], ids[s][f[:, 1]]]
                w_ += [sums[hit], np.zeros(len(f), dtype=np.int64)]
            cat = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64))
            return pa.RecordBatch.from_arrays([cat(a_), cat(b_), cat(w_)], names=["a", "b", "w"])

        return by_group(batches, 5, run)

    found = stored(met.mapInArrow(compare, "a long, b long, w long"), "embedding-links")
    drop_stored(buckets, close)
    sums = found.filter("w > 0").groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("links"))
    # a component's label is a node; its id is the smallest of its nodes' ids
    labels = nodes.select("node", "vec_id").join(components(found.filter("w = 0").select("a", "b")), "node")
    lowest = labels.groupBy("component").agg(F.min("vec_id").alias("lowest"))
    labels = labels.join(lowest, "component").select("node", "lowest")
    info = nodes.select("k1", "k2", "node", "weight", "vec_id").join(sums, "node", "left").join(labels, "node", "left")
    info = info.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("lowest", "vec_id").alias("lowest"))
    out = rows.join(info, ["k1", "k2"], "left").withColumn("component_id", F.coalesce("lowest", "vec_id").cast(id_kind))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings; see embedding_links for nulls, repeated ids, lengths and empty tables."""
    return embedding_links(table(spark, sf_dir, "embeddings"))


#: The same by all pairs.
OP6_SQL = """
with recursive v as (
  select vec_id, cast(embedding as double[]) as x from embeddings where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or isnan(c) or isinf(c))) = 0
), u as (select vec_id, x, list_dot_product(x, x) as n from v where list_dot_product(x, x) > 0
), l as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id where list_dot_product(a.x, b.x) / sqrt(a.n * b.n) >= 0.95
), r as (select vec_id as node, vec_id as seen from embeddings union select r.node, l.b from r join l on l.a = r.seen
), c as (select node, min(seen) as component_id from r group by node), k as (select a, count(*) as n from l group by a)
select vec_id, coalesce(k.n, 0) as n_links, component_id, vec_id = component_id as kept from embeddings left join k on k.a = vec_id join c on c.node = vec_id
"""
