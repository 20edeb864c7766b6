"""Substring deduplication with a log-structured fingerprint index.

A fingerprint is the least of the 26 hashes of 25-word runs inside a window of 50 words; equal windows have equal
fingerprints, and a document has about one for every 13 words. The index is a list of immutable runs, each a table of
(hash, lo, hi), the smallest and largest id of the documents with that hash, bucketed and sorted by hash: a hash that a
third of all documents have is one row. A new batch becomes a run and is merge-joined with each run before it, bucket by
bucket, with no shuffle; when there are more than `FANOUT` runs they are compacted into one.

Hashes that two documents have are verified on whole windows: the documents with such a fingerprint are read again, and
of their 50-word windows under these fingerprints, told apart by two hashes of 96 bits together, every one but that of the
smallest id is a repeat. Least ids are found before the shuffle, so that a passage which many documents have is not one
task's. An index that outlives a call also keeps the texts and fingerprints that it has taken in, for the
windows of later rows are held against theirs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import cleaned, drop_path, drop_stored, new_path, small_batches, stored, table

WINDOW, GRAM = 50, 25
REACH = WINDOW - GRAM + 1
FANOUT = 2
BATCHES = 4
BITS = 26


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def other_hashes(words: K.Words, at: np.ndarray) -> np.ndarray:
    """A second, independent hash of the windows that begin at these words."""
    return K.grams(words.hashes(K.OTHER_BASE), WINDOW)[at] if len(at) else np.zeros(0, dtype=np.uint64)


def windows(words: K.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of every window inside a document, its fingerprint, its hash."""
    h = words.hashes()
    n = len(h) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.uint64)
        return np.zeros(0, dtype=np.int64), none, none
    at = np.flatnonzero(K.inside(words.first, WINDOW, n))
    grams = K.grams(h, GRAM)
    return at, grams[K.window_argmin(grams, REACH)[at]], K.grams(h, WINDOW)[at]


def per_document(values: np.ndarray, owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct values, document behind document, and how many each has."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[keep], np.bincount(owner[keep], minlength=docs)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, whole_sha256 (all words joined by one space) and the distinct fingerprints of each row."""

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in K.word_runs(batch.column(1), K.SPACED, False):
                at, prints, _ = windows(words)
                found, counts = per_document(prints, words.owner()[at], j - i)
                data, off = K.utf8(batch.column(1).slice(i, j - i))
                off = off.tolist()
                sha = [hashlib.sha256(b" ".join(data[a:b].tobytes().split())).hexdigest() for a, b in zip(off[:-1], off[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(words.counts()), pa.array(sha), K.nested(signed(found), counts)], names=["doc_id", "n_words", "whole_sha256", "prints"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, n_words long, whole_sha256 string, prints array<long>")


class FingerprintIndex:
    """Sorted immutable runs of (hash, lo, hi), and the texts and fingerprints of earlier calls, in the shared folder.

    Rows without an id are never taken in. An empty batch makes an empty run. `buckets` stays as it is for the index's
    life, so that all runs are cut alike; `close` deletes everything.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark, self.runs, self.texts, self.prints = spark, [], [], []
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write_run(self, rows: DataFrame) -> str:
        """Write (hash, lo, hi), distinct hashes, as a run; the name of its table."""
        name = f"fingerprint_run_{uuid.uuid4().hex}"
        writer = rows.select("hash", "lo", "hi").write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash")
        with cleaned(self.spark):
            writer.option("path", new_path(self.spark, name)).saveAsTable(name)
        return name

    def add(self, fresh: DataFrame) -> DataFrame:
        """Take a batch (hash, doc_id) in; a stored table of the hashes that it shares with another document, old or new."""
        run = self.write_run(fresh.groupBy("hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")))
        new = self.spark.table(run)
        shared = new.filter("lo < hi").select("hash")
        for name in self.runs:
            old = self.spark.table(name).toDF("hash", "old_lo", "old_hi")
            both = new.join(old.hint("merge"), "hash").filter(F.least("lo", "old_lo") < F.greatest("hi", "old_hi"))
            shared = shared.unionByName(both.select("hash"))
        shared = stored(shared, "fingerprint-shared")
        self.runs.append(run)
        if len(self.runs) > FANOUT:
            self.compact()
        return shared

    def compact(self) -> None:
        """Merge all runs into one."""
        every = reduce(lambda a, b: a.unionByName(b), [self.spark.table(name) for name in self.runs])
        old, self.runs = self.runs, [self.write_run(every.groupBy("hash").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))]
        drop_runs(self.spark, old)

    def keep(self, docs: DataFrame, rows: DataFrame) -> None:
        """Take the texts and fingerprints of rows with an id in, for later calls; more than FANOUT tables become one."""
        self.texts.append(stored(docs.filter("doc_id is not null and text is not null"), "fingerprint-texts"))
        self.prints.append(stored(rows.filter("doc_id is not null").select("doc_id", "prints"), "fingerprint-prints"))
        for kept in (self.texts, self.prints):
            if len(kept) > FANOUT:
                merged = stored(reduce(lambda a, b: a.unionByName(b), kept), "fingerprint-kept")
                drop_stored(*kept)
                kept[:] = [merged]

    def close(self) -> None:
        drop_runs(self.spark, self.runs)
        drop_stored(*self.texts, *self.prints)
        self.runs, self.texts, self.prints = [], [], []


def drop_runs(spark: SparkSession, names: list[str]) -> None:
    """Drop the tables of runs and delete their files."""
    for name in names:
        files = spark.table(name).inputFiles()
        spark.sql(f"drop table {name}")
        if files:
            drop_path(spark, files[0].rsplit("/", 1)[0])


def id_bitmap(ids: DataFrame, bits: int = BITS) -> np.ndarray:
    """2**bits bits, set at hashes of the ids; 2**bits / 8 bytes (8 MB) at most, whatever the number of ids."""
    v = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits)) + 1).alias("v")
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    with cleaned(ids.sparkSession):
        for r in ids.select(v).groupBy(F.bitmap_bucket_number("v").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("m")).toLocalIterator():
            out[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(bytes(r["m"]), dtype=np.uint8)
    return out


def maybe(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """Rows of docs whose id the bitmap has: all that are wanted and, as it fills, some more."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    n = len(bits) * 8

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(0).to_numpy()
            keep = (shared.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep.astype(bool))) for c in batch.columns[1:]], names=batch.schema.names[1:])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).alias("slot"), "doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string")


def candidate_windows(docs: DataFrame) -> DataFrame:
    """(w, x, doc_id): distinct hashes, of 64 and 32 bits, of each document's windows whose fingerprint is among its `prints`."""

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in K.word_runs(batch.column(1), K.SPACED, False):
                at, prints, hashes = windows(words)
                owner = words.owner()[at]
                lists = batch.column(2).slice(i, j - i)
                wanted = np.asarray(lists.flatten().to_numpy(), dtype=np.int64).view(np.uint64)
                salt = K.mix(np.arange(1, j - i + 1, dtype=np.uint64))
                wanted = wanted ^ salt[np.repeat(np.arange(j - i), np.diff(lists.offsets.to_numpy()))]
                ok = np.isin(prints ^ salt[owner], wanted)
                at, hashes, owner = at[ok], hashes[ok], owner[ok]
                order = np.lexsort((hashes, owner))
                at, hashes, owner = at[order], hashes[order], owner[order]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                x = pa.array((other_hashes(words, at[new]) >> np.uint64(32)).astype(np.uint32).view(np.int32))
                yield pa.RecordBatch.from_arrays([signed(hashes[new]), x, batch.column(0).slice(i, j - i).take(pa.array(owner[new]))], names=["w", "x", "doc_id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "prints").mapInArrow(run, f"w long, x int, doc_id {kind}")


def repeats(rows: DataFrame) -> DataFrame:
    """(w, doc_id) of those of (w, x, doc_id) whose window also has a smaller doc_id."""
    lows = rows.groupBy("w", "x").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").drop("hi")
    return rows.join(lows, ["w", "x"]).filter("doc_id > lo").select("w", "doc_id")


def repeats_of_old(rows: DataFrame, old: DataFrame) -> DataFrame:
    """(w, doc_id) of those of (w, x, doc_id) whose window another doc_id has in old."""
    seen = old.groupBy("w", "x").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    return rows.join(seen, ["w", "x"]).filter("lo <> doc_id or hi <> doc_id").select("w", "doc_id")


def flagged_by(prints: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc_id, prints): documents of (doc_id, prints) with those of their fingerprints that are shared, stored."""
    met = prints.select("doc_id", F.explode("prints").alias("hash")).join(shared, "hash")
    return stored(met.groupBy("doc_id").agg(F.collect_set("hash").alias("prints")), "substring-flagged")


def cut(docs: DataFrame, with_text: bool) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept, the text) of documents with their repeated windows `ws`."""

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in K.word_runs(batch.column(1), K.SPACED, False):
                at, _, hashes = windows(words)
                owner = words.owner()
                lists = batch.column(2).slice(i, j - i)
                salt = K.mix(np.arange(1, j - i + 1, dtype=np.uint64))
                bad = np.asarray(lists.flatten().to_numpy(), dtype=np.int64).view(np.uint64) ^ salt[np.repeat(np.arange(j - i), np.diff(lists.offsets.to_numpy()))]
                hit = at[np.isin(hashes ^ salt[owner[at]], bad)]
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + WINDOW, -1)
                gone = np.cumsum(cover[:-1]) > 0
                removed = np.bincount(owner[gone], minlength=j - i)
                kept = []
                starts, ends, raw = words.starts, words.ends, words.data.tobytes()
                for d in range(j - i):
                    own = np.flatnonzero(~gone[words.first[d] : words.first[d + 1]]) + words.first[d]
                    kept.append(b" ".join([raw[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]))
                columns = [batch.column(0).slice(i, j - i), pa.array(words.counts()), pa.array(removed.astype(np.int64)), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                yield pa.RecordBatch.from_arrays(columns + [pa.array([k.decode() for k in kept])] * with_text, names=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "ws").mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)


def dedup_substrings(docs: DataFrame, batches: int = BATCHES, index: FingerprintIndex | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row of docs (doc_id of an integer type, text).

    A word goes when a window of 50 words over it, taken from the input, also starts in a document of a smaller id.
    Null and empty texts have no words; documents shorter than a window keep all; a row without id neither loses words
    nor makes others lose them; rows of one id are judged against smaller ids only, never against each other.

    With an index, rows of its earlier calls stand before those of this one whatever their ids: a word also goes when a
    window over it starts in such a row of another id. Only rows of docs are given out; the index then has them too.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = stored(scan(docs), "substring-scan")
    known = rows.filter("doc_id is not null").select("doc_id", "prints")
    prints = known.select("doc_id", F.explode("prints").alias("hash"))
    own = index is None
    index = index or FingerprintIndex(spark)
    found = [index.add(prints.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == b)) for b in range(batches)]
    shared = stored(reduce(lambda a, b: a.unionByName(b), found).distinct(), "substring-shared")
    drop_stored(*found)
    flagged = flagged_by(known, shared)
    again = stored(maybe(docs, id_bitmap(flagged)).join(flagged, "doc_id"), "substring-again")
    twice = stored(candidate_windows(again), "substring-windows")
    repeated = repeats(twice)
    if index.texts:
        earlier = flagged_by(reduce(lambda a, b: a.unionByName(b), index.prints), shared)
        old = candidate_windows(maybe(reduce(lambda a, b: a.unionByName(b), index.texts), id_bitmap(earlier)).join(earlier, "doc_id"))
        repeated = repeated.unionByName(repeats_of_old(twice, old)).distinct()
    bad = stored(repeated.groupBy("doc_id").agg(F.collect_list("w").alias("ws")), "substring-repeats")
    drop_stored(flagged, shared, twice)
    if own:
        index.close()
    else:
        index.keep(docs, rows)
    changed = cut(again.drop("prints").join(bad, "doc_id"), False)
    same = rows.join(bad.select("doc_id"), "doc_id", "left_anti").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("whole_sha256").alias("kept_sha256"))
    return same.unionByName(changed)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 50-word windows of all documents, taken into an index in BATCHES batches; see dedup_substrings for edges."""
    return dedup_substrings(table(spark, sf_dir, "documents"))


#: The same by plain windows of text.
OP7_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), win as (
  select doc_id, p, hash(array_to_string(w[p : p + 49], ' ')) as s from (select doc_id, w, unnest(range(1, len(w) - 48)) as p from d where len(w) >= 50)
), low as (select s, min(doc_id) as lo from win group by s
), gone as (select doc_id, unnest(range(p, p + 50)) as x from (select doc_id, p from win join low on win.s = low.s where doc_id > lo)
), g as (select doc_id, count(distinct x) as n, list(distinct x) as xs from gone group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: xs is null or not list_contains(xs, i)), ' ')) as kept_sha256
from d left join g on d.doc_id = g.doc_id
"""
