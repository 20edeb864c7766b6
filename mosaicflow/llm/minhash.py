"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct word shingles, each a 64-bit hash; its sketch is the k smallest. Documents with equal
sets form one node. Values kept in sketches make inverted lists. With sketches of k, two sets of similarity 0.8 share
0.8 k values give or take sqrt(0.16 k), so at least SHARED k of them; ordered from rare to frequent, such sketches then
have m values in common among the first (1 - SHARED) k + m of each, and only those are indexed: what many documents
share is never a list's key unless a document consists of it.

The pairs are worked off in two exact rounds. Lists of up to HOT members give their pairs; two sketches that must share
COMMON indexed values are a pair only when they meet in so many lists. Each node is first tested against its neighbour
with the most common sketch, and each member of a longer list against that list's centre, on the full sets, which are
at hand, so that no estimate loses a link. Then come pairs that are still between components; in longer lists every member
outside the list's largest component meets all members of other components, block by block, on full sets, inside tasks
of bounded size which give out links only between components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import drop_stored, small_batches, stored, table
from .graph import components
from .substring import id_bitmap, maybe, per_document, signed

SKETCH, SHARED = 64, 0.578
SHINGLE, PERCENT = 5, 80
BLOCK = 512
#: Two nodes share at least so many indexed values (fewer where sketches are short); longer lists are hot.
COMMON, HOT = 4, 64


def shingle_sets(words: K.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct shingles, sorted, document behind document, and how many each has.

    A document of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    h, owner, counts = words.hashes(), words.owner(), words.counts()
    values, owners = [], []
    for n in range(1, size + 1):
        if n < size and not (counts == n).any():
            continue
        grams = K.grams(h, n)
        at = np.flatnonzero(K.inside(words.first, n, len(grams)))
        if n < size:
            at = at[counts[owner[at]] == n]
        values.append(K.mix(grams[at] ^ K.mix(np.array([n], dtype=np.uint64))))
        owners.append(owner[at])
    return per_document(np.concatenate(values), np.concatenate(owners), len(counts))


def scan(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n (set size), k1, k2 (a 128-bit hash of the set) and the sketch of each row."""

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in K.word_runs(batch.column(1), K.SPACED, True):
                values, counts = shingle_sets(words, size)
                first = np.concatenate(([0], np.cumsum(counts)))
                keys = []
                for salt in (0x51, 0x7A3):
                    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(K.mix(values ^ np.uint64(salt)), dtype=np.uint64)))
                    keys.append(signed(sums[first[1:]] - sums[first[:-1]]))
                kept = np.minimum(counts, SKETCH)
                at = np.arange(kept.sum()) + np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(kept)[:-1])), kept)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(counts.astype(np.int64)), *keys, K.nested(signed(values[at]), kept)], names=["doc_id", "n", "k1", "k2", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, k1 long, k2 long, sketch array<long>")


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """node, set: the sorted hashes of each row's shingles as bytes."""

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words in K.word_runs(batch.column(1), K.SPACED, True):
                values, counts = shingle_sets(words, size)
                ends = np.concatenate(([0], np.cumsum(counts) * 8)).astype(np.int64)
                sets = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), sets], names=["node", "set"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"node {kind}, set binary")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 |x & y| >= percent |x | y|, exactly."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of nodes those that are links."""

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                keep.append(bool(len(x) and len(y)) and similar(x, y, percent))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    x = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, f"a {kind}, b {kind}")


def block_links(sets: list[np.ndarray], minor: np.ndarray, comp: np.ndarray, own: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (i, j) of members in different components, one of them minor and one of the group's own size; a forest of
    them: none closes a ring."""
    left = np.flatnonzero(minor)
    sizes = np.array([len(s) for s in sets])
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.repeat(np.arange(len(sets)), sizes)
    often = np.bincount(at, minlength=len(values)) > 1
    number = np.cumsum(often) - 1
    at, member = number[at[often[at]]], member[often[at]]
    both = np.zeros((len(left), len(sets)), dtype=np.float32)
    order = np.argsort(at, kind="stable")
    at, member = at[order], member[order]
    step = 4096
    for begin in range(0, int(often.sum()), step):
        a, b = np.searchsorted(at, [begin, begin + step])
        dense = np.zeros((len(sets), step), dtype=np.float32)
        dense[member[a:b], at[a:b] - begin] = 1
        both += dense[left] @ dense.T
    union = sizes[left][:, None] + sizes[None, :] - both
    ok = (100 * both.astype(np.float64) >= percent * union) & (comp[left][:, None] != comp[None, :]) & (own[left][:, None] | own[None, :])
    parent: dict[object, object] = {}

    def root(c):  # noqa: ANN001, ANN202
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(ok), strict=True):
        x, y = root(comp[left[i]]), root(comp[j])
        if x != y:
            parent[x] = y
            out.append((int(left[i]), int(j)))
    return out


def residual_links(lists: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components inside lists (v, node, n).

    A list falls into groups of like set sizes: sets that link lie in one size class or in neighbouring ones, so each
    member goes to its own class and to the next. A group's members outside its largest component are dealt to blocks by
    a hash, and so are the others; each pair of blocks that has a minor one is one task's group. Blocks have about BLOCK
    members whatever the list's size.
    """
    size_class = F.floor(F.log("n") / (1.001 * math.log(100 / percent))).cast("int")  # a little wide, for logarithms are rounded
    rows = lists.join(labels, "node", "left").withColumn("c", size_class).withColumn("g", F.explode(F.array(F.col("c"), F.col("c") + 1)))
    rows = rows.select("v", "g", "node", F.coalesce("component", "node").alias("comp"), (F.col("c") == F.col("g")).alias("own"))
    per = rows.groupBy("v", "g", "comp").agg(F.count("*").alias("k")).groupBy("v", "g").agg(F.max_by("comp", F.struct("k", "comp")).alias("major"), F.max("k").alias("big"), F.sum("k").alias("all"))
    rows = rows.join(per.filter("big < all"), ["v", "g"]).withColumn("minor", F.col("comp") != F.col("major"))
    bm, bg = F.ceil((F.col("all") - F.col("big")) / BLOCK).cast("int"), F.ceil(F.col("big") / BLOCK).cast("int")
    rows = rows.withColumn("bm", bm).withColumn("bg", bg).withColumn("h", F.xxhash64("node", F.lit(5)))
    mine = F.pmod(F.col("h"), F.when(F.col("minor"), F.col("bm")).otherwise(F.col("bg"))).cast("int")
    # a block pair is (minor block i, minor block j >= i) or (minor block i, -1 - other block)
    minor_to = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("bm") - 1), lambda k: F.struct(F.least(k, F.col("mine")).alias("i"), F.greatest(k, F.col("mine")).alias("j"))),
        F.transform(F.sequence(F.lit(0), F.col("bg") - 1), lambda k: F.struct(F.col("mine").alias("i"), (-1 - k).alias("j"))),
    )
    other_to = F.transform(F.sequence(F.lit(0), F.col("bm") - 1), lambda k: F.struct(k.alias("i"), (-1 - F.col("mine")).alias("j")))
    dealt = rows.withColumn("mine", mine).withColumn("to", F.explode(F.when(F.col("minor"), minor_to).otherwise(other_to)))
    dealt = dealt.select("v", "g", F.col("to.i").alias("i"), F.col("to.j").alias("j"), "node", "comp", "minor", "own").join(sets, "node")

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def links() -> list[tuple[object, object]]:
            if len(group) < 2:
                return []
            found = block_links([np.frombuffer(g[4], dtype=np.uint64) for g in group], np.array([g[2] for g in group]), np.array([g[1] for g in group]), np.array([g[3] for g in group]), percent)
            return [(group[x][0], group[y][0]) for x, y in found]

        def out(found: list[tuple[object, object]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], kind_), pa.array([f[1] for f in found], kind_)], names=["a", "b"])

        for batch in batches:
            found = []
            kind_ = batch.schema.field("node").type
            for v, g, i, j, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (v, g, i, j) != key:
                    found += links()
                    key, group = (v, g, i, j), []
                group.append(rest)
            yield out(found)
        if group:
            yield out(links())

    kind = lists.schema["node"].dataType.simpleString()
    return dealt.repartition("v", "g", "i", "j").sortWithinPartitions("v", "g", "i", "j").select("v", "g", "i", "j", "node", "comp", "minor", "own", "set").mapInArrow(run, f"a {kind}, b {kind}")


def prefix(t: Column, m: Column) -> Column:
    """How many of a sketch's t values, rarest first, are indexed, for m of them to be in common."""
    return t - F.floor(t * SHARED) + m


def inverted_lists(known: DataFrame, classes: DataFrame) -> DataFrame:
    """(v, node, n, score, m, members, centre) of the indexed values that more than one node has.

    score: how common the node's sketch is on the whole; m: of how many lists two such nodes must share at least;
    centre: the list's member of the highest score.
    """
    reps = known.join(classes.select("k1", "k2", F.col("node").alias("doc_id")), ["k1", "k2", "doc_id"], "left_semi").dropDuplicates(["doc_id", "k1", "k2"])
    reps = stored(reps.select(F.col("doc_id").alias("node"), "n", "sketch"), "minhash-nodes")
    entries = reps.select("node", F.explode("sketch").alias("v")).repartition("v")  # dealt once, for the counts and the join
    often = entries.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1")
    common = entries.join(often, "v").groupBy("node").agg(F.collect_list(F.struct("df", "v")).alias("vs"))
    common = common.join(reps.select("node", "n", F.size("sketch").alias("t")), "node")
    m = F.greatest(F.lit(1), F.least(F.lit(COMMON), F.floor(F.col("t") * SHARED)))
    left = prefix(F.col("t"), F.col("m")) - (F.col("t") - F.size("vs"))  # values of one node are the rarest and come first
    indexed = common.withColumn("m", m).withColumn("score", F.expr("aggregate(vs, 0L, (s, x) -> s + x.df)") / F.col("t")).withColumn("left", left.cast("int")).filter("left > 0")
    lists = indexed.select("node", "n", "score", "m", F.explode(F.slice(F.sort_array("vs"), F.lit(1), F.col("left"))).alias("x")).select("node", "n", "score", "m", F.col("x.v").alias("v"))
    lists = stored(lists, "minhash-lists")
    sizes = lists.groupBy("v").agg(F.max(F.struct("score", "node", "n")).alias("top"), F.count("*").alias("members")).filter("members > 1")
    placed = stored(lists.join(sizes.select("v", "members", F.col("top.node").alias("c"), F.col("top.n").alias("cn")), "v"), "minhash-placed")
    drop_stored(reps, lists)
    return placed


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of docs (doc_id of an integer type, text).

    Rows link when 100 |A & B| >= percent |A | B| of their sets of lower-cased (A-Z) word shingles; component_id is the
    smallest id that links lead to, kept marks that document. Rows with equal sets link; null or empty texts link with
    nothing; rows of one id are one document; a row without id links with nothing, has no component, and is kept.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = stored(scan(docs, shingle), "minhash-scan")
    known = rows.filter("doc_id is not null and n > 0")
    classes = known.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("node"))
    members = stored(known.select("doc_id", "k1", "k2", "n").join(classes, ["k1", "k2", "n"]).select("doc_id", "node").distinct(), "minhash-members")
    placed = inverted_lists(known, classes)

    def fits(a: str, b: str) -> Column:
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    short = placed.filter(F.col("members") <= HOT)
    # long lists of one centre are one list: near copies have tens of lists in common, and mostly one centre
    long = stored(placed.filter(F.col("members") > HOT).select("node", "n", "c", "cn").distinct(), "minhash-long")
    x = short.select("v", F.col("node").alias("a"), F.col("n").alias("an"), F.col("m").alias("am"), F.col("score").alias("ascore"))
    y = short.select("v", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("m").alias("bm"), F.col("score").alias("bscore"))
    met = x.join(y, "v").filter((F.col("a") < F.col("b")) & fits("an", "bn"))
    met = met.groupBy("a", "b").agg(F.count("*").alias("lists"), F.first("am").alias("am"), F.first("bm").alias("bm"), F.first("ascore").alias("ascore"), F.first("bscore").alias("bscore"))
    met = stored(met.filter(F.col("lists") >= F.least("am", "bm")).select("a", "b", "ascore", "bscore"), "minhash-pairs")
    # first each node with its neighbour of the highest score, and each member of a long list with the list's centre
    each = met.select(F.col("a").alias("node"), F.struct(F.col("bscore").alias("s"), F.col("b").alias("o")).alias("x")).union(met.select("b", F.struct(F.col("ascore").alias("s"), F.col("a").alias("o"))))
    best = each.groupBy("node").agg(F.max("x").alias("x")).select("node", F.col("x.o").alias("o"))
    starred = long.filter((F.col("node") != F.col("c")) & fits("n", "cn")).select("node", F.col("c").alias("o"))
    pairs = best.union(starred).select(F.least("node", "o").alias("a"), F.greatest("node", "o").alias("b")).distinct()
    wanted = met.select(F.col("a").alias("doc_id")).union(met.select("b")).union(long.select("node")).distinct()
    wanted = stored(wanted, "minhash-wanted")
    sets = stored(full_sets(maybe(docs, id_bitmap(wanted)).join(wanted, "doc_id", "left_semi"), shingle), "minhash-sets")
    links = stored(verified(pairs, sets, percent), "minhash-links")
    # then what is left between components: pairs of short lists one by one, long lists block by block
    labels = components(links)
    a, b = labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    rest = met.select("a", "b").join(a, "a", "left").join(b, "b", "left").filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    tested = rest.join(pairs, ["a", "b"], "left_anti")
    more = stored(verified(tested, sets, percent).unionByName(residual_links(long.select(F.col("c").alias("v"), "node", "n"), labels, sets, percent)), "minhash-more")
    same = members.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    labels = components(links.unionByName(more).unionByName(same))
    drop_stored(members, placed, long, met, wanted, sets, links, more)  # rows and labels make the result
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents by 2-word shingles; see near_duplicates for nulls, ties and repeats."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


#: The same by all pairs of documents with a shingle in common.
OP8_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), s as (
  select distinct doc_id, unnest(case when len(w) >= 2 then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end) as g from w
), n as (select doc_id, count(*) as n from s group by doc_id
), p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)
), e as (select a, b from l union select b, a from l
), r as (select doc_id as node, doc_id as seen from documents union select r.node, e.b from r join e on e.a = r.seen
), c as (select node, min(seen) as component_id from r group by node)
select d.doc_id, coalesce(n.n, 0) as n_shingles, component_id, d.doc_id = component_id as kept from documents d left join n on d.doc_id = n.doc_id join c on c.node = d.doc_id
"""
