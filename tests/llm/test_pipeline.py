"""The mix's query and each stage of the pipeline against brute force, on small tables with every edge case."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from mosaicflow.llm import kernels, language, mixing
from mosaicflow.llm.tokens import load_tokenizer

public = pytest.importorskip("public_tokenizers")
pipeline = pytest.importorskip("corpus_pipeline")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_number string, rid string, told_score string, spans string"


def rows_of(seed=2):
    r = random.Random(seed)
    en, fr = "the of and to in is that it was for on are".split(), "le la et les des est que une pour dans sur pas".split()
    out = [(None, None), (None, ""), (1, "123 !"), (1, None), (2, "x" * 5000)]
    base = [r.choice(en) + str(k % 7) for k in range(60)]
    for k in range(60):
        lang = ("en", "fr")[k % 2]
        words = [r.choice((en, fr)[k % 2]) + r.choice(["", "s", "x"]) for _ in range(r.randint(1, 120))]
        if k % 6 == 0:
            words = list(base)
            words[r.randrange(60)] = r.choice(en)
        if k % 10 == 3:
            words += "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()
        out.append((r.choice([k, k, 5, None]), " ".join(words)))
    return [(d, t, ("fr" if k % 2 else "en"), r.choice(["a", "b", None]), len(t or ""), f"r{k}", "rid", "s", "sp") for k, (d, t) in enumerate(out)]


@pytest.fixture(scope="module")
def rows():
    return rows_of()


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    items = [("a", "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), ("b", None), ("c", "123")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def names(df):
    """Rows by the mark that each has in a column of a clashing name."""
    return sorted(r.row_number for r in df.collect())


def test_language_stage(spark, docs, rows, sf):
    got = pipeline.language_id(spark, docs, sf)
    assert got.columns == docs.columns
    model = language.fit(language.train_rows(docs))
    want = []
    for x in rows:
        if x[1] and any(c.isalpha() for c in x[1]):
            grams = [x[1][i : i + n] for n in (1, 2, 3) for i in range(len(x[1]) - n + 1)]
            places = [int(b) for g in grams for b in next(language.gram_buckets([g]))[2][-1:]]
            score = language.softmax(model.weights[places].astype(np.float64).mean(axis=0) + model.bias).max()
            want += [x[5]] * bool(score >= pipeline.LEAST_SCORE)
    assert names(got) == sorted(want)
    assert got.select("told_score").distinct().collect()[0][0] == "s"


def test_minhash_stage(spark, docs, rows, sf):
    got = pipeline.minhash_dedup(spark, docs, sf)
    assert got.columns == docs.columns
    sets = []
    for x in rows:
        w = SPACED.findall((x[1] or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    kept = {r.row_number: r.doc_id for r in got.collect()}
    members = defaultdict(list)
    for k, g in enumerate(group):
        members[g].append(rows[k])
    assert len(kept) == len(members)
    for own in members.values():
        (one,) = [x for x in own if x[5] in kept]
        assert one[0] == min((x[0] for x in own if x[0] is not None), default=None)


def test_decontamination_stage(spark, docs, rows, sf):
    got = pipeline.decontaminate(spark, docs, sf)
    assert got.columns == docs.columns
    items = [ALNUM.findall(t.translate(LOWER)) for t in ("Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron", "123")]
    windows = {tuple(w[p : p + min(13, len(w))]) for w in items for p in range(max(1, len(w) - 12))}
    want = []
    for x in rows:
        w = ALNUM.findall((x[1] or "").translate(LOWER))
        hit = {k for s in windows for p in range(len(w) - len(s) + 1) if tuple(w[p : p + len(s)]) == s for k in range(p, p + len(s))}
        want += [x[5]] * (not hit or 20 * len(hit) < len(w))
    assert names(got) == sorted(want) and len(want) < len(rows)


def test_decontamination_stage_goes_by_rows(spark, sf):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    df = spark.createDataFrame([(None, passage), (1, passage), (2, "hello world"), (2, passage), (None, "clean")], "doc_id long, text string")
    assert sorted(r.text for r in pipeline.decontaminate(spark, df, sf).collect()) == ["clean", "hello world"]


def test_mix_stage(spark, docs, rows, sf):
    got = pipeline.mix_sources(spark, docs, sf)
    assert got.columns == docs.columns
    texts = {x[5]: x[1] for x in rows}
    sizes = {x[5]: len(SPACED.findall(x[1] or "")) for x in rows}
    taken = defaultdict(int)
    for r in got.collect():
        words = SPACED.findall(r.text)
        taken[r.source] += len(words)
        assert len(words) <= 2 * sizes[r.row_number] and set(words) <= set(SPACED.findall(texts[r.row_number])) and r.n_chars == len(r.text)
    per = sorted({x[3] for x in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(sizes[x[5]] for x in rows if x[3] == s) for s in per}
    for s, target in zip(per, mixing.targets([(s, size[s]) for s in per]), strict=True):
        assert abs(taken[s] - target) <= mixing.BLOCK_WORDS


def test_token_stage(spark, docs, rows, sf):
    got = pipeline.token_ids(spark, docs, sf).collect()
    tokenizer = load_tokenizer(public.path("word_bpe_49k.json"))
    ids = [(x[0], tokenizer.encode(x[1] or "", add_special_tokens=False).ids + [2]) for x in rows]
    key = lambda d, n, crc: (d is not None, d or 0, n, crc)
    assert sorted(key(r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted(key(d, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for d, x in ids)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stage_on_an_empty_table(spark, docs, sf, name):
    out = dict(pipeline.STAGES)[name](spark, docs.limit(0), sf)
    assert out.count() == 0 and (name == pipeline.STAGES[-1][0] or out.columns == docs.columns)


def test_run_is_the_stages_one_after_another(spark, tmp_path):
    rows = [x[:5] for x in rows_of(4) if x[0] is not None]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("a", rows[9][1])], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted(map(tuple, pipeline.run(spark, str(tmp_path)).select(docs.columns).collect())) == sorted(map(tuple, docs.collect()))


def test_mixing_query_against_plain_loops(spark, tmp_path):
    """Places of words, blocks and slots by plain loops; only the keyed permutation and the shards' draw are the operator's."""
    r = random.Random(6)
    rows = [(i, " ".join(["w"] * r.choice([0, 1, 5, 90, 700])), r.choice(["b", "a", None, "é"])) for i in r.sample(range(10_000), 300)] + [(20_001, None, "a")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x for x in mixing.op9_mixing(spark, str(tmp_path)).collect()}
    size = {d: len(SPACED.findall(t or "")) for d, t, _ in rows}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[d] for d, _, x in rows if x == s) for s in sources}
    weight, left, goal = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}, 1.5 * sum(total.values()), {}
    while True:
        rest = [s for s in sources if s not in goal]
        over = [s for s in rest if left * weight[s] / sum(weight[x] for x in rest) > 2 * total[s]]
        if not over:
            goal |= {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
            break
        goal |= {s: 2.0 * total[s] for s in over}
        left -= sum(goal[s] for s in over)

    def spark_hash(text, seed=42):
        return xxhash.xxh64(text.encode(), seed=seed).intdigest()

    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    owners = {}
    for s in sources:
        own = sorted((signed(spark_hash(str(d))) % mixing.BUCKETS, d) for d, _, x in rows if x == s)
        owners[s] = [d for _, d in own for _ in range(size[d])]
    blocks = [-(-total[s] // 64) for s in sources]
    quotas = [min(round(goal[s] / total[s] * b), 2 * b) if total[s] else 0 for s, b in zip(sources, blocks, strict=True)]
    taken = defaultdict(int)
    shards = max(1, -(-sum(quotas) // mixing.SHARD_SLOTS))
    for shard in range(shards):
        have, first = mixing.draw(shard, shards, np.array(quotas), mixing.SEED)
        for k, s in enumerate(sources):
            for rank in range(first[k], first[k] + have[k]):
                epoch, at = divmod(int(rank), blocks[k])
                block = int(mixing.permute(np.array([at]), blocks[k], mixing.SEED * 1_000_003 + k * 8191 + epoch)[0])
                for d in owners[s][64 * block : 64 * block + 64]:
                    taken[d] += 1
    for d, _, s in rows:
        x = got[d]
        assert (x.size, x.source_size, x.taken) == (size[d], total[s], taken[d]) and x.target == pytest.approx(goal[s])
        assert x.taken <= 2 * x.size
    for s in sources:
        assert abs(sum(got[d].taken for d, _, x in rows if x == s) - goal[s]) <= 64


def test_mixing_rows_without_ids_or_with_repeated_ones(spark):
    rows = [(None, "a b c", "x")] * 5 + [(3, "d e", "x"), (3, "f", "y"), (None, None, None)]
    docs = spark.createDataFrame([(*x, "r", "b") for x in rows], "doc_id long, text string, source string, rid__ string, spans__ string")
    documents, spans = mixing.mix(mixing.sized(docs))
    assert documents.count() == len(rows)
    assert sum(s.w1 - s.w0 for s in spans.collect()) > 0
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and all(r.text for r in mixed.collect())


def test_mixing_does_not_hang_on_where_rows_are_stored(spark, tmp_path):
    r = random.Random(8)
    rows = [(r.choice([None, 5, k, k]), " ".join(f"w{r.randrange(50)}" for _ in range(r.choice([1, 30, 200]))), r.choice(["a", "b", None])) for k in range(60)]
    rows += rows[:5]
    out = []
    for k in range(3):
        r.shuffle(rows)
        spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(k + 1).write.parquet(f"{tmp_path}/{k}")
        mixed = mixing.mix_documents(spark.read.parquet(f"{tmp_path}/{k}")).collect()
        out.append(sorted(map(tuple, mixed), key=str))
    assert out[0] == out[1] == out[2]


def test_kernels_use_two_independent_hashes():
    words = kernels.Words(np.frombuffer(b"ab ba ab", dtype=np.uint8), np.array([0, 8]), kernels.SPACED, False)
    one, two = words.hashes(), words.hashes(kernels.OTHER_BASE)
    assert one[0] == one[2] != one[1] and two[0] == two[2] != two[1] and (one != two).all()


def test_kernels_hash_words_alike_wherever_they_stand(monkeypatch):
    text = b" ".join([b"ab", b"c" * 40, b"ab", b"dd", b"c" * 40] * 9)
    of = lambda: kernels.Words(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]), kernels.SPACED, False).hashes()
    whole = of()
    monkeypatch.setattr(kernels, "SLICE_BYTES", 50)
    assert (of() == whole).all() and len(set(whole.tolist())) == 3
