"""Mixing sources to target weights by blocks of fixed length.

Each source's words, document behind document, are cut into blocks of `block_words`. Of its blocks a source gives a
quota of slots in the mix, its target over its size. Every output shard draws how many slots of each source it has;
slot r of a source is block perm(r mod n) in epoch r div n, perm being a pseudorandom permutation of the source's n
blocks for that epoch, and slots meet blocks in an equi-join on (source, block).

The draws are multinomial over shards given the sources' quotas: a shard's counts come from binomial splits down a
binary tree over all shards, each node seeded by its own range, so any task can make any shard's draw and its ranks
without the others', quotas come out exactly, and no block is used more often than quota over blocks, rounded up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import kernels as K
from .common import numbered, small_batches, stored, table, unused

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS, SHARD_SLOTS, SEED = 64, 4096, 20240
#: Buckets of a source's running sums: so many, or more where a bucket would have more than BUCKET_ROWS rows.
BUCKETS, BUCKET_ROWS = 1024, 1 << 16
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: Sources up to this many are broadcast to the documents; beyond, they are joined by a shuffle.
BROADCAST_SOURCES = 10_000


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Each source's target, in the order of the given (source, size) list, which is by code point with null last.

    Weights repeat along the list and share `share` of all sizes; a target stops at `most` times its source's size,
    and what is over goes to the others by weight, until none is above.
    """
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    left, open_, out = share * sum(s for _, s in sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(w[i] for i in open_)
        full = [i for i in open_ if left * w[i] / total > most * sizes[i][1]]
        if not full:
            for i in open_:
                out[i] = left * w[i] / total
            break
        for i in full:
            out[i] = most * sizes[i][1]
        open_ -= set(full)
        left -= sum(out[i] for i in full)
    return out


def permute(i: np.ndarray, n: int, key: int, rounds: int = 4) -> np.ndarray:
    """A keyed permutation of 0..n-1 at the places i: a Feistel network over the next even number of bits, walked
    along its cycle until the value lies below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = K.mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(K.WORD_BASE) ^ np.uint64(key & (2**64 - 1)))
    out = i.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (K.mix(right + k) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def draw(shard: int, shards: int, quotas: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """How many slots of each source this shard has, and each source's first rank in it."""
    a, b, have, first = 0, shards, quotas.astype(np.int64), np.zeros(len(quotas), dtype=np.int64)
    while b - a > 1:
        mid = (a + b) // 2
        left = np.random.Generator(np.random.Philox(key=[seed, a * 0x9E3779B1 + b])).binomial(have, (mid - a) / (b - a))
        if shard < mid:
            b, have = mid, left
        else:
            a, first, have = mid, first + left, have - left
    return have, first


def source_plan(base: DataFrame, block_words: int = BLOCK_WORDS) -> list[dict]:
    """One dict a source: sid, source, size, target, blocks, quota. Gathers one row a source, never rows of documents."""
    sums = [(r["source"], int(r["size"])) for r in base.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    sums.sort(key=lambda r: (r[0] is None, r[0] or ""))
    out = []
    for sid, ((source, size), target) in enumerate(zip(sums, targets(sums), strict=True)):
        blocks = -(-size // block_words)
        quota = min(round(target / size * blocks), int(MOST) * blocks) if size else 0
        out.append({"sid": sid, "source": source, "source_size": size, "target": target, "blocks": blocks, "quota": quota})
    return out


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, spans) of the mix of docs (rid, doc_id, source, size, content), rid naming a row, content its text.

    documents: rid, doc_id, size, source_size, target. spans: shard, slot, sid, block, epoch, rid, w0, w1: the words
    w0 to w1 (not included) of row rid stand in this slot of this output shard. Null or empty texts have no words and
    are in no slot; repeated rows are rows of their own; with no rows both are empty. Documents stand in their source
    by a hash of their id (of their content, where that is null), those of one id by content, so the mix does not hang on
    where rows are stored; only rows of one id and one text follow rid, and for the mix they are alike. Running sums go
    bucket by bucket, with more buckets for more rows, and one source of any size is dealt over all tasks.
    """
    spark = docs.sparkSession
    plan = source_plan(docs, block_words)
    buckets = max(BUCKETS, -(-docs.count() // BUCKET_ROWS))
    schema = "sid int, source string, source_size long, target double, blocks long, quota long"
    sources = spark.createDataFrame([tuple(p.values()) for p in plan], schema)
    if len(plan) <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    named = docs.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).withColumn("bucket", F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), "content"))), F.lit(buckets)))
    documents = named.select("rid", "doc_id", "size", "source_size", "target")

    in_bucket = named.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_bucket = in_bucket.select(F.col("sid").alias("sid_"), F.col("bucket").alias("bucket_"), ahead.alias("ahead"))
    inner = F.coalesce(F.sum("size").over(Window.partitionBy("sid", "bucket").orderBy("doc_id", "content", "rid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = named.filter("size > 0").withColumn("inner", inner)
    placed = placed.join(in_bucket, (F.col("sid") == F.col("sid_")) & (F.col("bucket") == F.col("bucket_"))).withColumn("at", F.col("ahead") + F.col("inner"))
    first, last = F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words)
    blocks = placed.select("sid", "rid", "size", "at", F.explode(F.sequence(first, last)).alias("block")).select(
        "sid", "block", "rid",
        F.greatest(F.col("block") * block_words - F.col("at"), F.lit(0)).alias("w0"),
        F.least((F.col("block") + 1) * block_words - F.col("at"), F.col("size")).alias("w1"),
    )

    quotas = np.array([p["quota"] for p in plan], dtype=np.int64)
    counts = np.array([p["blocks"] for p in plan], dtype=np.int64)
    shards = max(1, -(-int(quotas.sum()) // shard_slots))

    @K.lean
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                have, first_rank = draw(shard, shards, quotas, seed)
                sids, index, epochs = [], [], []
                for s in np.flatnonzero(have).tolist():
                    ranks = first_rank[s] + np.arange(have[s])
                    epoch = ranks // counts[s]
                    at = ranks % counts[s]
                    for e in np.unique(epoch).tolist():
                        own = at[epoch == e]
                        index.append(permute(own, int(counts[s]), seed * 1_000_003 + s * 8191 + e))
                        epochs.append(np.full(len(own), e, dtype=np.int64))
                        sids.append(np.full(len(own), s, dtype=np.int32))
                if not sids:
                    continue
                sid, block, epoch = np.concatenate(sids), np.concatenate(index), np.concatenate(epochs)
                order = np.random.Generator(np.random.Philox(key=[seed + 1, shard])).permutation(len(sid))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sid), shard, dtype=np.int64)), pa.array(order), pa.array(sid), pa.array(block), pa.array(epoch)], names=["shard", "slot", "sid", "block", "epoch"])

    drawn = spark.range(shards).mapInArrow(slots, "shard long, slot long, sid int, block long, epoch long")
    # the planner takes the slots' size from the few shards, and would broadcast them all
    return documents, drawn.hint("merge").join(blocks, ["sid", "block"]).select("shard", "slot", "sid", "block", "epoch", "rid", "w0", "w1")


def sized(docs: DataFrame, rid: Column | None = None) -> DataFrame:
    """rid, doc_id, source, size (words) and content (a hash of the text) of each row, written once: rids stay the same in
    all that follows."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rid = F.monotonically_increasing_id() if rid is None else rid
    return stored(docs.select(rid.alias("rid"), "doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), F.xxhash64("text").alias("content")), "mix-sizes")


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with their columns: text is the words the mix takes, epoch behind epoch, in their order.

    A document that the mix takes once and whole keeps its text; of one taken in part each run of neighbouring words
    keeps its text, runs joined by a line feed; one not taken at all goes, so null and empty texts go. n_chars, where
    there is one, follows. Rows stand for themselves whatever their ids; an empty table stays empty.
    """
    spark = docs.sparkSession
    small_batches(spark)
    names = docs.columns
    row, taken = unused(docs, "row_number", "spans")
    own = numbered(docs, row)
    base = sized(own, F.col(row))
    _, spans = mix(base)
    runs = spans.groupBy(F.col("rid").alias(row)).agg(F.sort_array(F.collect_list(F.struct("epoch", "w0", "w1"))).alias(taken))
    both = own.join(runs, row).select(*names, taken)

    @K.lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            texts, spans_ = [], batch.column(len(names)).to_pylist()
            for i, j, words in K.word_runs(batch.column(at), K.SPACED, False):
                data = words.data
                size = np.diff(K.utf8(batch.column(at).slice(i, j - i))[1])
                begin = np.concatenate(([0], np.cumsum(size)))
                for d in range(i, j):
                    first, count = words.first[d - i], words.first[d - i + 1] - words.first[d - i]
                    merged: list[list[int]] = []
                    for s in spans_[d]:
                        if merged and merged[-1][0] == s["epoch"] and merged[-1][2] == s["w0"]:
                            merged[-1][2] = s["w1"]
                        else:
                            merged.append([s["epoch"], s["w0"], s["w1"]])
                    parts = [
                        data[begin[d - i] : begin[d - i + 1]].tobytes() if (a, b) == (0, count) else data[words.starts[first + a] : words.ends[first + b - 1]].tobytes()
                        for _, a, b in merged
                    ]
                    texts.append(b"\n".join(parts).decode())
            columns = [batch.column(k) for k in range(len(names))]
            columns[at] = pa.array(texts, pa.string())
            if "n_chars" in names:
                k = names.index("n_chars")
                columns[k] = pa.array([len(t) for t in texts], columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return both.mapInArrow(cut, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of all documents takes of each; see mix for null sources, null and empty texts, and repeated rows."""
    documents, spans = mix(sized(table(spark, sf_dir, "documents")))
    taken = spans.groupBy("rid").agg(F.sum(F.col("w1") - F.col("w0")).alias("taken"))
    return documents.join(taken, "rid", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
