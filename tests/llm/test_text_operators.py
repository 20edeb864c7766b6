"""The text operators against brute force, on small tables with every edge case."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from mosaicflow.llm import decontaminate, lines, minhash, mixing, substring

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, hash string, rid string, v string"


def corpus(seed=3, n=60):
    """Documents with copies, near copies, shared passages, nulls, empty and long texts, ties."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(300)]
    words = lambda k: [r.choice(vocabulary) for _ in range(k)]
    passage, base = words(70), words(120)
    texts = [None, "", " \t\n ", "one", "One", "two words", "日本 語", "a\x0bb"]
    for k in range(n):
        kind = k % 8
        if kind == 0:
            texts.append(" ".join(words(r.randint(1, 200))))
        elif kind == 1:
            copy = list(base)
            for _ in range(r.randint(0, 9)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts.append(" ".join(copy))
        elif kind == 2:
            texts.append(" ".join(words(20) + passage + words(20)))
        elif kind == 3:
            texts.append("\n".join([" ".join(words(8)), " ".join(passage[:9]), " ".join(passage[:9])[:-1], "", " ".join(passage[:9]) + "x"]))
        elif kind == 4:
            texts.append(texts[-1])
        elif kind == 5:
            texts.append("is onhe. " * r.randint(1, 90))
        elif kind == 6:
            texts.append(" ".join(words(3)))
        else:
            texts.append(" ".join(words(3000)) if k == 7 else " ".join(x.upper() for x in passage))
    ids = list(range(len(texts)))
    r.shuffle(ids)
    return [(i, t, "en", r.choice(["a", "b", None]), 1, "x", "y", "z", "w") for i, t in zip(ids, texts, strict=True)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def connected(ids, pairs):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_minhash_against_all_pairs(docs, rows, size):
    sets = {}
    for doc, text, *_ in rows:
        w = SPACED.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    ids = sorted(sets)
    pairs = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = connected(ids, pairs)
    got = {r.doc_id: r for r in minhash.near_duplicates(docs, shingle=size).collect()}
    assert {i: (got[i].n_shingles, got[i].component_id, got[i].kept) for i in ids} == {i: (len(sets[i]), want[i], want[i] == i) for i in ids}


def test_minhash_long_lists_go_by_blocks(docs, rows, monkeypatch):
    want = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, shingle=2).collect()}
    monkeypatch.setattr(minhash, "HOT", 1)
    monkeypatch.setattr(minhash, "BLOCK", 3)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, shingle=2).collect()} == want


def test_minhash_verifies_on_full_sets(spark):
    """Two sets of similarity 0.8 exactly, whose sketches share only 36 of 64 values."""
    import numpy as np

    # the 64 least of the union: 36 in both, 28 in y only; behind them what makes the similarity up
    only, both = list(range(28)) + list(range(1000, 1172)), list(range(28, 64)) + list(range(2000, 2764))
    x, y = np.array(sorted(both), dtype=np.uint64), np.array(sorted(both + only), dtype=np.uint64)
    sets = spark.createDataFrame([(1, x.tobytes()), (2, y.tobytes()), (3, y[:-1].tobytes()), (4, x[1:].tobytes())], "node long, set binary")
    pairs = spark.createDataFrame([(1, 2), (4, 3)], "a long, b long")
    assert [tuple(r) for r in minhash.verified(pairs, sets, 80).collect()] == [(1, 2)]


def test_minhash_repeated_ids_and_nulls(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "x y z"), (2, "x y z"), (None, "x y z"), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df, shingle=2).collect() if r.doc_id is not None)
    assert got == [(False, 1, 1, True), (False, 1, 1, True), (False, 2, 1, False), (False, 3, 3, True)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_substring_against_all_windows(docs, rows):
    words = {d: SPACED.findall(t or "") for d, t, *_ in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 49):
            first.setdefault(tuple(words[d][i : i + 50]), d)
    for batches in (1, 4):
        got = {r.doc_id: r for r in substring.dedup_substrings(docs, batches=batches).collect()}
        assert sorted(got) == sorted(words)
        for d, w in words.items():
            gone = {k for i in range(len(w) - 49) if first[tuple(w[i : i + 50])] < d for k in range(i, i + 50)}
            kept = " ".join(x for k, x in enumerate(w) if k not in gone)
            assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()), d
    assert any(r.n_removed for r in got.values())


def test_substring_without_rows_or_ids(spark):
    text = " ".join(str(i) for i in range(60))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (4, text), (7, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in substring.dedup_substrings(df).collect())
    assert got == [(0, 0), (4, 0), (5, 60), (5, 60), (7, 0)]
    assert substring.dedup_substrings(df.limit(0)).count() == 0


def test_substring_against_rows_of_earlier_calls(spark, rows):
    passage = " ".join(f"p{i}" for i in range(55))
    old, new = [x[:2] for x in rows[: len(rows) // 2]], [x[:2] for x in rows[len(rows) // 2 :]]
    calls = [[*old, (900, f"a b {passage} c")], [*new, (-1, f"{passage} d"), (900, f"e {passage}"), (None, passage), (901, None)], [(-2, passage), (902, "f g")]]
    index, earlier, lost = substring.FingerprintIndex(spark), defaultdict(set), 0
    for call in calls:
        got = {r.doc_id: r for r in substring.dedup_substrings(spark.createDataFrame(call, "doc_id long, text string").repartition(3), index=index).collect()}
        assert len(got) == len(call)
        words = {d: SPACED.findall(t or "") for d, t in call}
        here = defaultdict(set)
        for d, w in words.items():
            for i in range(len(w) - 49 if d is not None else 0):
                here[tuple(w[i : i + 50])].add(d)
        for d, w in words.items():
            again = lambda x: d is not None and (bool(earlier[x] - {d}) or min(here[x]) < d)  # noqa: B023, E731
            gone = {k for i in range(len(w) - 49) if again(tuple(w[i : i + 50])) for k in range(i, i + 50)}
            kept = " ".join(x for k, x in enumerate(w) if k not in gone)
            assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()), d
        for x, ids in here.items():
            earlier[x] |= ids
        lost = {d: r.n_removed for d, r in got.items()}
    assert lost == {-2: 55, 902: 0}
    assert 0 < len(index.runs) <= substring.FANOUT
    index.close()


def test_substring_query_compacts_its_runs(spark, docs, monkeypatch):
    done = []
    real = substring.FingerprintIndex.compact
    monkeypatch.setattr(substring.FingerprintIndex, "compact", lambda self: (done.append(len(self.runs)), real(self)))
    substring.dedup_substrings(docs)
    assert done == [substring.FANOUT + 1]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("fingerprint_run")]


def test_runs_are_joined_without_a_shuffle(spark):
    index = substring.FingerprintIndex(spark)
    runs = [spark.table(index.write_run(spark.range(1000).selectExpr("id * 7 as hash", "id as lo", "id as hi"))) for _ in range(2)]
    both = runs[0].join(runs[1].toDF("hash", "a", "b").hint("merge"), "hash")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_decontamination_against_all_windows(spark, docs, rows):
    texts = [t for _, t, *_ in rows if t]
    long = [" ".join(ALNUM.findall(t.translate(LOWER))[5:40]) for t in texts[8:30]]
    items = [(i, t) for i, t in enumerate([*long, "one", "two words", "", None, "is onhe is onhe is", "ONE"])] + [(3, "one"), (None, "one")]
    benchmark = spark.createDataFrame([(str(i) if i is not None else None, t) for i, t in items], "item_id string, text string")
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        n = min(len(w), 13)
        for p in range(len(w) - n + 1 if n else 0):
            if i is not None:
                windows[tuple(w[p : p + n])].add(str(i))
    sizes = {len(w) for w in windows}
    got = {r.doc_id: r for r in decontaminate.contamination(docs, benchmark, ["doc_id"]).collect()}
    for d, t, *_ in rows:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    found |= windows[tuple(w[p : p + n])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want = (len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w))
        assert (got[d].n_words, got[d].n_hit, got[d].n_items, got[d].items_sha256, got[d].contaminated) == want, d
    assert decontaminate.contamination(docs.limit(0), benchmark, ["doc_id"]).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs, benchmark.limit(0), ["doc_id"]).collect())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


BLANKS = " \t\x0b\f\r"


@pytest.mark.parametrize("hot", [64, 1])
def test_lines_against_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(lines, "HOT", hot)
    r = random.Random(5)
    base = ["".join(r.choice("abé ") for _ in range(r.randint(1, 24))) for _ in range(24)]
    texts = [None, "", "\n\n", "\t\t", "\r", "short", "shorx\nshort", "x" * 1000 + "y", "x" * 1000]
    for _ in range(25):
        own = []
        for _ in range(r.randint(1, 6)):
            line = r.choice(base)
            p = r.randrange(len(line))
            own.append(r.choice([line, line[:p] + line[p + 1 :], line[:p] + "z" + line[p:], line[:p] + "ñ" + line[p + 1 :], line[:p] + line[p:p + 1] + line[p:], line[:p] + line[p + 1 :] + "q"]))
        texts.append("\n".join(own))
    docs = spark.createDataFrame([(len(texts) - i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, h1 string").repartition(3)
    first, count = {}, 0
    for d, t in sorted((len(texts) - i, t) for i, t in enumerate(texts)):
        for n, line in enumerate(t.split("\n") if t is not None else []):
            if line.strip(BLANKS):
                first.setdefault(line, (d, n))
    near = defaultdict(list)
    for a in first:
        for b in first:
            if a != b and abs(len(a) - len(b)) <= 1 and distance(a, b) <= 1:
                near[a].append(first[b])
    got = {r.doc_id: r for r in lines.line_report(docs).collect()}
    for i, t in enumerate(texts):
        d, own = len(texts) - i, t.split("\n") if t is not None else []
        gone = [n for n, x in enumerate(own) if x.strip(BLANKS) and (first[x] != (d, n) or any(o < first[x] for o in near[x]))]
        links = sum(len(near[x]) for n, x in enumerate(own) if x.strip(BLANKS) and first[x] == (d, n))
        assert (got[d].n_lines, got[d].n_removed, got[d].n_links, got[d].removed_lines) == (len(own), len(gone), links, ",".join(map(str, gone))), d
        count += len(gone)
    assert count
    kept = {r.doc_id: r.text for r in lines.drop_lines(docs).collect()}
    for i, t in enumerate(texts):
        gone = {int(x) for x in got[len(texts) - i].removed_lines.split(",") if x}
        assert kept[len(texts) - i] == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone))
    assert lines.line_report(docs.limit(0)).count() == 0


def test_lines_of_any_length(spark):
    own = ["Contact us", "Contact us.", "Read more", "Read more>", "a", "b", "ab", "é", "abc", "acb", " a", "   ", "the same line 1", "the same line 2", "1234567890123456", "xyzw", "xyw", "yzw"]
    docs = spark.createDataFrame([(0, "\n".join(own))], "doc_id long, text string")
    near = {a: [b for b in own if a != b and b.strip(" ") and distance(a, b) <= 1] if a.strip(" ") else [] for a in own}
    gone = [n for n, a in enumerate(own) if any(own.index(b) < n for b in near[a])]
    got = lines.line_report(docs).first()
    assert (got.n_lines, got.n_removed, got.n_links, got.removed_lines) == (len(own), len(gone), sum(map(len, near.values())), ",".join(map(str, gone)))


def test_numbered_lines_are_counted_without_their_pairs(spark):
    """300 lines that differ in one place of four: each key has them all, so they go by groups."""
    own = [f"the page with the number {n:03d} of this book" for n in range(300)]
    got = lines.line_report(spark.createDataFrame([(n, x) for n, x in enumerate(own)], "doc_id int, text string")).collect()
    near = lambda n: sum(sum(a != b for a, b in zip(f"{n:03d}", f"{m:03d}", strict=True)) == 1 for m in range(300))
    assert {r.doc_id: r.n_links for r in got} == {n: near(n) for n in range(300)}


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_banded_bit_parallel_distance(spark, threshold):
    r = random.Random(threshold)
    word = lambda: "".join(r.choice("ab😀") for _ in range(r.randint(1, 9)))
    pairs = [(word(), word()) for _ in range(400)]
    df = spark.createDataFrame(pairs, "x string, y string")
    for q in df.withColumn("ok", lines.within("x", "y", threshold)).collect():
        assert q.ok == (distance(q.x, q.y) <= threshold), (q.x, q.y)


def test_lines_of_rows_without_ids_or_with_repeated_ones(spark):
    rows_ = [(None, "one line\ntwo"), (None, "one line"), (3, "two\nthree lines"), (3, "three lines"), (1, "two")]
    docs = spark.createDataFrame([(*x, "c", "d") for x in rows_], "doc_id long, text string, rid string, gone string")
    kept = lines.drop_lines(docs)
    assert kept.columns == docs.columns
    texts = sorted(x for r in kept.collect() for x in r.text.split("\n") if x)
    assert texts == ["one line", "three lines", "two"]
    assert kept.count() == len(rows_) and lines.drop_lines(docs.limit(0)).count() == 0


def test_mixing(spark, docs, rows):
    sizes = {d: len(SPACED.findall(t or "")) for d, t, *_ in rows}
    out = mixing.mix(mixing.sized(docs), block_words=8, shard_slots=50)
    spans = out[1].collect()
    words = defaultdict(int)
    by_block = defaultdict(int)
    for s in spans:
        assert 0 <= s.w0 < s.w1
        words[s.rid] += s.w1 - s.w0
        by_block[(s.sid, s.block, s.epoch)] += 1
    info = {r.rid: r for r in out[0].collect()}
    per = defaultdict(lambda: [0, 0.0])
    for rid, r in info.items():
        assert r.size == sizes[r.doc_id] and words[rid] <= 2 * r.size
        per[r.source_size][0] += words[rid]
        per[r.source_size][1] = r.target
    assert sum(t for _, t in per.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(abs(n - t) <= 12 for n, t in per.values())
    again = mixing.mix(mixing.sized(docs), block_words=8, shard_slots=50)[1].collect()
    key = lambda s: (s.shard, s.slot, s.rid, s.w0)
    assert sorted(map(key, spans)) == sorted(map(key, again))
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(SPACED.findall(r.text)) for r in mixed.collect()) == pytest.approx(1.5 * sum(sizes.values()), abs=200)
    assert mixing.mix(mixing.sized(docs.limit(0)))[0].count() == 0


def test_mixing_targets_reshare_what_is_over():
    got = mixing.targets([("a", 10), ("b", 100), (None, 100)])
    assert got == pytest.approx([20, 295 / 3, 2 * 295 / 3])
    assert mixing.targets([]) == [] and mixing.targets([("a", 0)]) == [0]


def test_permutation_is_one():
    import numpy as np

    for n in (1, 2, 3, 10, 257, 1000):
        assert sorted(mixing.permute(np.arange(n), n, 9).tolist()) == list(range(n))
