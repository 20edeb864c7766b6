"""Benchmark decontamination by winnowing.

From each run of `w` neighbouring k-grams the one of least hash is a fingerprint, on both sides; a span of
w + k - 1 words that a document shares with an item therefore shares a fingerprint, at the same place of the span.
With k = 5 and w = 9 that is every window of 13 words. Fingerprints meet in an equi-join and each hit is extended
word by word to both sides. An item shorter than a window is one window itself, so for each such length that the
benchmark has, documents' n-grams of that length are looked up in full.

Only documents' fingerprints that a fixed-size bitmap of the benchmark's hashes lets through leave the scan. The
bitmap's size does not depend on the benchmark; as it fills, more rows go to the join, and none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .common import small_batches, stored, table, unused

WINDOW, GRAM = 13, 5
REACH = WINDOW - GRAM
BITS = 23

_HIT = pa.struct([("hash", pa.int64()), ("at", pa.int64()), ("gram", pa.string()), ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])


def fingerprints(words: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """Places (among all words) and hashes of the fingerprints of every document of the run."""
    grams = K.grams(words.hashes(), GRAM)
    windows = len(words) - WINDOW + 1
    if windows <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at = np.unique(K.window_argmin(grams, REACH + 1)[K.inside(words.first, WINDOW, windows)])
    return at, grams[at]


def short_grams(words: K.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all n-grams inside a document; hashes of different n differ."""
    grams = K.grams(words.hashes(), n)
    at = np.flatnonzero(K.inside(words.first, n, len(grams)))
    return at, K.mix(grams[at] ^ K.mix(np.array([n], dtype=np.uint64)))


def _hit(words: K.Words, doc: int, at: int, h: int, n: int) -> dict:
    first, last = int(words.first[doc]), int(words.first[doc + 1])
    reach = REACH if n == 0 else 0
    size = n or GRAM
    return {
        "hash": h - (1 << 64) if h >= 1 << 63 else h,
        "at": at - first,
        "gram": words.text(at, at + size).decode(),
        "before": [words.text(k, k + 1).decode() for k in range(at - 1, max(first, at - reach) - 1, -1)],
        "after": [words.text(k, k + 1).decode() for k in range(at + size, min(last, at + size + reach))],
    }


def benchmark_index(benchmark: DataFrame) -> DataFrame:
    """item_id (text), n_words of a short item (0 for others), hash, at, gram, before, after of each fingerprint."""

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, hits = [], [], []
            names = batch.column(0).to_pylist()
            for i, _, words in K.word_runs(batch.column(1), K.ALNUM, True):
                owner = words.owner()
                found = [(0, *x) for x in zip(*fingerprints(words), strict=True)]
                counts = words.counts()
                for n in np.unique(counts[(counts > 0) & (counts < WINDOW)]).tolist():
                    at, h = short_grams(words, n)
                    whole = counts[owner[at]] == n
                    found += [(n, *x) for x in zip(at[whole], h[whole], strict=True)]
                for n, at, h in found:
                    doc = int(owner[at])
                    ids.append(names[i + doc])
                    sizes.append(n)
                    hits.append(_hit(words, doc, int(at), int(h), n))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sizes, pa.int32()), *pa.array(hits, _HIT).flatten()], names=["item_id", "short", "hash", "at", "gram", "before", "after"])

    return benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).filter("item_id is not null").mapInArrow(run, "item_id string, short int, hash long, at long, gram string, before array<string>, after array<string>")


def bitmap(index: DataFrame, bits: int = BITS) -> np.ndarray:
    """2**bits bits, set at the top bits of the index's hashes; at most 2**bits / 8 bytes come to the driver."""
    slot = F.shiftrightunsigned("hash", 64 - bits) + 1
    rows = index.select(slot.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("m")).collect()
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["m"]), dtype=np.uint8)
        begin = (r["b"] - 1) * 4096
        out[begin : begin + len(part)] = part[: len(out) - begin]
    return out


def scan(docs: DataFrame, bits: np.ndarray, short: list[int], keep: list[str], names: list[str]) -> DataFrame:
    """The kept columns, n_words, and the hits (fingerprints that the bitmap lets through) of each document, under these names."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # 2**BITS / 8 bytes whatever the benchmark
    shift = np.uint64(64 - (len(bits) * 8).bit_length() + 1)

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = np.unpackbits(shared.value, bitorder="little").view(bool)
        for batch in batches:
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            hits: list[list[dict] | None] = [None] * batch.num_rows
            for i, j, words in K.word_runs(batch.column(len(keep)), K.ALNUM, True):
                counts[i:j] = words.counts()
                owner = None
                for n in (0, *short):
                    at, h = short_grams(words, n) if n else fingerprints(words)
                    ok = table_[h >> shift]
                    if ok.any():
                        owner = words.owner() if owner is None else owner
                        for p, x in zip(at[ok].tolist(), h[ok].tolist(), strict=True):
                            d = int(owner[p])
                            if hits[i + d] is None:
                                hits[i + d] = []
                            hits[i + d].append(_hit(words, d, p, x, n))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), pa.array(counts), pa.array(hits, pa.list_(_HIT))], names=[*keep, *names])

    (text,) = unused(docs, "whole_text")
    kept = docs.select(*keep, F.col("text").cast("string").alias(text))
    hit = T._parse_datatype_string("n_words long, hits array<struct<hash: long, at: long, gram: string, before: array<string>, after: array<string>>>")
    return kept.mapInArrow(run, T.StructType([*docs.select(*keep).schema, *[T.StructField(n, f.dataType) for n, f in zip(names, hit, strict=True)]]))


def _common(a: str, b: str) -> Column:
    """How many leading words two arrays have in common."""
    same = f"zip_with({a}, {b}, (x, y) -> x is not null and y is not null and x = y)"
    return F.expr(f"if(array_position({same}, false) = 0, size({same}), cast(array_position({same}, false) - 1 as int))")


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns of each row with n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit: words inside any occurrence of an item's window; n_items: items with such a window; contaminated: n_hit > 0
    and 20 n_hit >= n_words. Null and empty texts have no words and no hits; items without words or id never hit;
    repeated items count once by id; every row of docs stands for itself, whatever its id; columns of any name may be
    kept; an empty table on either side is allowed.
    """
    small_batches(docs.sparkSession)
    index = stored(benchmark_index(benchmark), "decontaminate-index")
    short = sorted(r[0] for r in index.filter("short > 0").select("short").distinct().collect())  # lengths below a window
    row, words, hits = unused(docs, "row_number", "n_words", "hits")
    rows = stored(scan(docs.withColumn(row, F.monotonically_increasing_id()), bitmap(index), short, [*keep, row], [words, hits]), "decontaminate-scan")
    d = rows.filter(F.col(hits).isNotNull()).select(F.col(row).alias("rid"), F.explode(hits).alias("d"))
    d = d.select("rid", *[F.col(f"d.{x}").alias(f"d_{x}") for x in ("hash", "at", "gram", "before", "after")])
    both = d.join(index, (F.col("d_hash") == F.col("hash")) & (F.col("d_gram") == F.col("gram")))
    both = both.withColumn("l", _common("d_before", "before")).withColumn("r", _common("d_after", "after"))
    size = F.when(F.col("short") > 0, F.col("short")).otherwise(F.lit(GRAM))
    spans = both.filter((F.col("short") > 0) | (F.col("l") + F.col("r") >= REACH)).select(
        "rid", "item_id", F.struct((F.col("d_at") - F.col("l")).alias("a"), (F.col("d_at") + size + F.col("r")).alias("b")).alias("span")
    )
    covered = F.expr("aggregate(sort_array(spans), named_struct('n', 0L, 'e', 0L), (s, x) -> named_struct('n', s.n + greatest(0L, x.b - greatest(x.a, s.e)), 'e', greatest(s.e, x.b)), s -> s.n)")
    found = spans.groupBy("rid").agg(F.collect_set("span").alias("spans"), F.sort_array(F.collect_set("item_id")).alias("items"))
    found = found.select(F.struct(covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items")).alias("found"), F.col("rid"))
    # one struct on each side, so that no name of a kept column can clash
    left = rows.select(F.struct(*keep).alias("kept") if keep else F.struct(F.col(row)).alias("kept"), F.col(words).alias("n_words"), F.col(row).alias("rid"))
    out = left.join(found, "rid", "left")
    n_hit = F.coalesce("found.n_hit", F.lit(0))
    return out.select(
        *[F.col("kept")[c].alias(c) for c in keep], "n_words", n_hit.alias("n_hit"), F.coalesce("found.n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce("found.items", F.lit("")), 256).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of all documents by all benchmark items; see contamination for nulls, repeats and empty tables."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


#: The same by plain string windows.
OP4_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), iw as (
  select item_id, least(len(w), 13) as n, array_to_string(w[p : p + least(len(w), 13) - 1], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as p from i where len(w) > 0)
), n as (select distinct n from iw
), dw as (
  select doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') as s
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p from d, n where len(w) >= n)
), hits as (select doc_id, item_id, dw.n, p from dw join iw on dw.n = iw.n and dw.s = iw.s
), words as (select doc_id, count(distinct x) as n_hit from (select doc_id, unnest(range(p, p + n)) as x from hits) group by 1
), items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item_id from hits) group by 1
)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words on d.doc_id = words.doc_id left join items on d.doc_id = items.doc_id
"""
