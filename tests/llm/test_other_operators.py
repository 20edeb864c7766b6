"""Tokens, languages, archives, embeddings and the pipeline: exact round trips, held-out accuracy, brute force."""

import base64
import hashlib
import json
import random
import zlib

import numpy as np
import pytest

from mosaicflow.llm import embeddings, language, tokens, warc
from mosaicflow.llm.common import new_path
from mosaicflow.llm.token_output import read_tokens, token_digest, write_tokens
from tests.conftest import SF

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

ALPHABET = ["a", "B", "theastou", "'s", "'ll", " ", "  ", "\n", "\t", "é", "É", "́", "İ", "Σ", "日本", "\r\n", "\x1c", "\x85", " ", " ", "ß", "😀", "1", "!", ",", "?", "<|endoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "\x01", "<|startoftext|>"]


def texts(n=120, seed=1):
    r = random.Random(seed)
    return [None, "", " ", "x" * 40_000 + " y", "ab cd " * 9000] + ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 80))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_text_s_ids(name):
    encoder = tokens.PieceEncoder(public.path(name), most=300)
    data = [(t or "").encode() for t in texts(600)]
    offsets = np.cumsum([0, *map(len, data)])
    ids, counts = encoder.encode(np.frombuffer(b"".join(data), dtype=np.uint8), offsets)
    want = [encoder.tokenizer.encode(d.decode(), add_special_tokens=False).ids for d in data]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_cut_at_marks_give_the_text_s_ids(name):
    r = random.Random(3)
    some = [chr(c) for c in range(1, 256)] + ["'s", "'ll", "\u0301", "\u0338", "é", "日", "ａ", "İ"] + list("abcdefghéüßñ .,'") * 6
    data = ["".join(r.choice(some) for _ in range(r.randint(1, 60))) for _ in range(3000)]
    encoder, raw = tokens.PieceEncoder(public.path(name)), [t.encode() for t in data]
    ids, counts = encoder.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)]))
    want = [e.ids for e in encoder.tokenizer.encode_batch_fast(data, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]


def pieces_encoded(encoder, monkeypatch):
    """The pieces that the library gets from here on."""
    got, fresh = [], encoder.fresh
    monkeypatch.setattr(encoder, "fresh", lambda pieces: (got.extend(pieces), fresh(pieces))[1])
    return got


def test_a_word_is_encoded_once_whatever_marks_and_white_space_are_beside_it(monkeypatch):
    encoder = tokens.PieceEncoder(public.path("word_bpe_49k.json"))
    got = pieces_encoded(encoder, monkeypatch)
    data = " Été.\nété,\tété***\rété)\x0bété/ok été%%%\x0cété été-ok".encode()
    encoder.encode(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    assert [p for p in got if "té" in p] == [" Été", " été"] and " " not in "".join(p[1:] for p in got)


def test_kept_pieces_follow_what_comes_often(monkeypatch):
    encoder = tokens.PieceEncoder(public.path("word_bpe_49k.json"), most=8)
    got = pieces_encoded(encoder, monkeypatch)
    for k in range(40):
        data = f" often{'' if k else ' first' * 9} once{chr(97 + k % 26)}{chr(97 + k // 26)} other{chr(97 + k % 26)}{k // 26}".encode()
        encoder.encode(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
        assert len(encoder.known) == len(encoder.lens) == len(encoder.starts) == len(encoder.used) <= 8
        if k == 0:
            got.clear()
            encoder.encode(data := np.frombuffer(b" a b c d e f g h i j", dtype=np.uint8), np.array([0, len(data)]))
    assert got.count(" often") <= 1


def test_overlapping_chunks_give_the_text_s_ids():
    r = random.Random(4)
    tokenizer = tokens.load_tokenizer(public.path("byte_bpe_50k.json"))
    cases = ["".join(r.choice(ALPHABET) for _ in range(r.randint(100, 900))) for _ in range(150)] + ["x" * 2000, " " * 2000, "<|endoftext|>" * 200, "ab " * 900 + "x" * 900]
    for t in cases:
        assert tokens.encode_huge(tokenizer, t, 200, 70) == tokenizer.encode(t, add_special_tokens=False).ids


def test_token_counts_and_output(spark):
    rows = [(i * 7 % 1000, t, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    tokenizer = tokens.load_tokenizer(public.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in tokens.token_counts(docs, public.path("byte_bpe_50k.json")).collect()}
    for d, t, _ in rows:
        n = len(tokenizer.encode(t or "").ids)
        assert (got[d].n_bytes, got[d].n_tokens, got[d].over_limit) == (len((t or "").encode()), n, n > 1024)
    words = tokens.load_tokenizer(public.path("word_bpe_49k.json"))
    path = write_tokens(docs, new_path(spark, "tokens-test"), public.path("word_bpe_49k.json"))
    stored = {r.doc_id: r.tokens for r in read_tokens(spark, path).collect()}
    digest = {r.doc_id: r for r in token_digest(spark, path).collect()}
    start = 0
    for d, t, _ in sorted(rows):
        ids = words.encode(t or "", add_special_tokens=False).ids + [2]
        assert stored[d] == ids
        assert (digest[d].start, digest[d].n_tokens, digest[d].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert tokens.token_counts(docs.limit(0), public.path("byte_bpe_50k.json")).count() == 0
    assert token_digest(spark, write_tokens(docs.limit(0), new_path(spark, "tokens-none"), public.path("word_bpe_49k.json"))).count() == 0


def test_token_output_of_rows_of_one_id_does_not_hang_on_their_layout(spark):
    rows = [(i % 3 or None, None if i == 7 else "word " * (i % 41)) for i in range(200)]
    words = tokens.load_tokenizer(public.path("word_bpe_49k.json"))
    want, start = [], 0
    for d, t in sorted(rows, key=lambda x: (x[0] or 0, x[1] is not None, x[1])):
        ids = words.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((start, d, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    for parts, own in ((1, rows), (7, rows[::-1])):
        docs = spark.createDataFrame(own, "doc_id long, text string").repartition(parts)
        path = write_tokens(docs, new_path(spark, "tokens-ties"), public.path("word_bpe_49k.json"))
        assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_digest(spark, path).collect()) == want


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in language.op2_language(spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [d for d, r in got.items() if r.held_out]
    assert {d for d in got if zlib.crc32(str(d).encode()) % 4 == 2} == set(held)
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_edges(spark):
    rows = [(1, "the cat", "en"), (1, "the cat", "en"), (3, "le chat", "fr"), (4, None, "fr"), (5, "123 !", "en"), (6, "", None), (None, "the", "en"), (8, "a" * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.predict(docs, language.fit(language.train_rows(docs)), ["doc_id"]).collect()
    assert sorted(r.lang_pred for r in got if r.doc_id in (4, 5, 6)) == ["und"] * 3
    assert all(r.lang_pred in ("en", "fr") for r in got if r.doc_id not in (4, 5, 6))
    none = language.fit(language.train_rows(docs.limit(0)))
    assert none is None and {r.lang_pred for r in language.predict(docs, none, ["doc_id"]).collect()} == {"und"}


@pytest.mark.parametrize(("lines_", "roll"), [(1000, 1 << 30), (2, 300)])
def test_archives(spark, monkeypatch, lines_, roll):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines_)
    monkeypatch.setattr(warc, "ROLL_BYTES", roll)
    rows = [(5, "http://www.b.example/x?y=1", "same"), (3, "https://b.example/x?y=1", "same"), (9, None, None), (2, "http://a.example/ñ z", ""), (7, "::bad[", "é" * 500_000), (3, "http://c.example", "same"), (None, "http://d.example", "same"), (4, "http://b.example/x?y=1", "x"), (4, "http://b.example/x?y=1", "x"), (None, None, None)]
    pages = spark.createDataFrame([(*x, "k", "s") for x in rows], "page_id long, url string, html string, key string, sha string").repartition(2)
    folder = new_path(spark, "warc-test")
    captures = warc.write_archives(pages, folder)
    directory = warc.write_index(captures, folder)
    got = [(r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_records(warc.look_up(pages.select("url", "page_id"), directory, folder), folder).collect()]
    want = []
    for page, _, html in rows:
        p = (html or "").encode()
        first = min((x[0] for x in rows if (x[2] or "") == (html or "") and x[0] is not None), default=None)
        same = page is None or page == first
        want.append((page or 0, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if same else "revisit", None if same else first))
    assert sorted(got, key=str) == sorted(want, key=str)
    if roll < 1000:
        assert captures.select("file").distinct().count() > 4
    index = warc.CaptureIndex.of(directory, folder)
    assert sorted(c["page_id"] for c in index.find("https://b.example/x?y=1")) == [3, 4, 4, 5]
    assert index.read(index.find("http://a.example/ñ z")[0])["page_id"] == 2
    assert index.find("http://nowhere.example") == []
    assert warc.url_key("http://www.Blog.example.com:80/a?b#c") == "com,example,blog)/a?b"
    empty = new_path(spark, "warc-none")
    none = warc.write_index(warc.write_archives(pages.limit(0), empty), empty)
    assert warc.read_records(warc.look_up(pages.select("url", "page_id"), none, empty), empty).count() == 0
    assert warc.read_records(warc.look_up(pages.select("url", "page_id").limit(0), directory, folder), folder).count() == 0


def test_a_look_up_reads_one_block_of_many(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 10)
    pages = spark.range(2000).selectExpr("id as page_id", "concat('http://h', lpad(id, 5, '0'), '.example/') as url", "cast(id as string) as html")
    folder = new_path(spark, "warc-many")
    index = warc.CaptureIndex.of(warc.write_index(warc.write_archives(pages, folder), folder), folder)
    assert [c["page_id"] for c in index.find("http://h01234.example/")] == [1234]
    assert index.reads <= 2 * 3  # a footer, a directory and a block; at a file's edge those of its neighbour


def vectors():
    r = np.random.default_rng(2)
    base = r.standard_normal((12, 64))
    rows = [(i, (base[i % 12] + 0.12 * r.standard_normal(64)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(5)] + [(300 + i, r.standard_normal(64).astype(np.float32).tolist()) for i in range(60)]
    return rows + [(400, None), (401, []), (402, [0.0] * 64), (403, [None] + [1.0] * 63), (404, [float("nan")] + [1.0] * 63), (405, [1.0, 2.0]), (406, [float("inf")] * 64)]


@pytest.mark.parametrize(("block", "few"), [(512, 512), (4, 20), (512, 20)])
def test_embeddings_against_all_pairs(spark, monkeypatch, block, few):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "FEW", few)
    rows = vectors()
    got = {r.vec_id: r for r in embeddings.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)).collect()}
    good = [(i, v) for i, v in rows if i < 400]
    x = np.array([v for _, v in good], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i, _ in good])
    assert links.sum() >= 0.98 * near.sum() and (links <= near.sum(axis=1)).all()
    labels = np.arange(len(good))
    for _ in range(20):
        labels = np.array([min([labels[k], *labels[near[k]]]) for k in range(len(good))])
    assert [got[i].component_id for i, _ in good] == [good[k][0] for k in labels]
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in rows if i >= 400)
    assert embeddings.embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embeddings_of_any_length_scale_and_id(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.01e200]), (3, [1e-200, 1e-200]), (4, [1e-200, 1.01e-200]), (5, [1.0, 0.0, 0.0]), (6, [1.0, 0.01, 0.0]), (7, [0.0, 1.0, 0.0])]
    rows += [(8, [0.0, 0.0, 1.0, 0.0]), (8, [0.0, 0.0, 1.0, 0.0]), (8, [1.0, 0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0]), (9, [1.0, 0.0, 0.0, 0.01])]
    df = spark.createDataFrame([(*x, "n", 1, "c") for x in rows], "vec_id long, embedding array<double>, node string, size int, code string")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embeddings.embedding_links(df).collect())
    assert got == [(0, 0, 0, True), (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 3, 1, False), (5, 1, 5, True), (6, 1, 5, False), (7, 0, 7, True), (8, 1, 8, True), (8, 1, 8, True), (8, 1, 8, True), (9, 1, 8, False)]


def test_hamming_retrieval_prunes_chance_neighbours(spark):
    """Vectors that have nothing to do with each other: hardly any goes on to the comparison of vectors."""
    r = np.random.default_rng(3)
    x = embeddings.unit(r.standard_normal((3000, 64)))
    how = embeddings.fit_codes(x, len(x), 0.95)
    codes = how.code(x)
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= how.radius
    assert near.sum() - len(x) < 0.02 * len(x)
    differ = codes ^ how.code(embeddings.partners(x, 0.95))
    met = (np.bitwise_count(differ) <= how.radius) & np.any([(differ & p) == 0 for p in how.packs], axis=0)
    assert met.mean() >= 0.95


def test_language_against_plain_loops(spark):
    """Features, the leader's weights and the temperature, once more with dictionaries and a fine grid."""
    import math

    words = {"en": ["the cat sat", "a dog and the cat", "this is the end"], "fr": ["le chat est la", "un chien et le chat", "c'est la fin"], "de": ["der hund und die katze", "das ist das ende"]}
    texts_ = [(t + " " + u, k) for k, (lang, own) in enumerate(sorted(words.items())) for t in own for u in own]
    labels = np.array([k for _, k in texts_])

    def bucket(gram):
        k = len(gram) - 1
        h = (97 * len(gram) + 1) % 2**32
        for p, c in enumerate(gram):
            h = ((h ^ ord(c)) * int(language._MULTIPLIERS[k + p])) % 2**32
            h ^= h >> 15
        return h >> 16

    feats = []
    for t, _ in texts_:
        grams = [t[i : i + n].lower() for n in (1, 2, 3) for i in range(len(t) - n + 1)]
        f = {}
        for g in grams:
            f[bucket(g)] = f.get(bucket(g), 0.0) + 1.0 / len(grams)
        feats.append(f)
    for f, (at, share) in zip(feats, language.shares([t for t, _ in texts_]), strict=True):
        assert dict(zip(at.tolist(), share.tolist(), strict=True)) == pytest.approx(f)
    rows = [(np.array(sorted(f)), np.array([f[b] * 20 for b in sorted(f)])) for f in feats]
    got, bias = language.fit_ftrl(rows, labels, 3)
    z, n, last = {}, {}, language.BUCKETS

    def weight(key):
        if abs(z.get(key, 0.0)) <= language.L1:
            return 0.0
        return -(z[key] - math.copysign(language.L1, z[key])) / ((language.BETA + math.sqrt(n[key])) / language.ALPHA + language.L2)

    order = np.arange(len(rows))
    for epoch in range(language.EPOCHS):
        np.random.Generator(np.random.Philox(key=[7, epoch])).shuffle(order)
        for k in order.tolist():
            x = {**{b: v * 20 for b, v in feats[k].items()}, last: 1.0}
            w = {(b, c): weight((b, c)) for b in x for c in range(3)}
            logits = [sum(x[b] * w[b, c] for b in x) for c in range(3)]
            top = max(logits)
            total = sum(math.exp(v - top) for v in logits)
            for c in range(3):
                miss = math.exp(logits[c] - top) / total - (labels[k] == c)
                for b in x:
                    g, have = x[b] * miss, n.get((b, c), 0.0)
                    z[b, c] = z.get((b, c), 0.0) + g - (math.sqrt(have + g * g) - math.sqrt(have)) / language.ALPHA * w[b, c]
                    n[b, c] = have + g * g
    for b in {b for f in feats for b in f} | {last}:
        for c in range(3):
            assert (bias[c] if b == last else got[b, c]) == pytest.approx(weight((b, c)), abs=1e-9)
    assert (got == 0).mean() > 0.9
    logits = np.array([x @ got[at] + bias for at, x in rows])
    wrong = np.where(np.arange(len(labels)) % 5 == 0, (labels + 1) % 3, labels)  # so that the best factor is a finite one
    loss = lambda f: -np.log(language.softmax(logits * f)[np.arange(len(wrong)), wrong] + 1e-12).mean()
    best = min(np.exp(np.linspace(-3, 3, 6001)), key=loss)
    assert language.fit_temperature(logits, wrong) == pytest.approx(best, rel=2e-3)
    assert language.fit_temperature(logits[:0], wrong[:0]) == 1.0


def test_language_sample_is_bounded_and_the_same_again(spark):
    rows = [(7, f"the {i}", "en") for i in range(40)] + [(i, f"le {i}", "fr") for i in range(40)] + [(99, "das", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one = language.fit(docs, per_language=10)
    two = language.fit(docs.repartition(7), per_language=10)
    assert one.languages == ["de", "en", "fr"] and np.array_equal(one.weights, two.weights) and np.array_equal(one.bias, two.bias)


def test_language_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "the cat", "en", "x", None)], "doc_id long, text string, whole_text string, letter string, score string")
    got = language.predict(docs, language.fit(docs.select("doc_id", "text", docs.whole_text.alias("lang"))), ["doc_id", "whole_text", "letter", "score"], prefix="p_")
    assert got.columns == ["doc_id", "whole_text", "letter", "score", "p_lang_pred", "p_score"]
    assert got.first().letter == "x"


def test_rows_without_ids_or_with_repeated_ones(spark):
    rows = [(None, "two words"), (None, "some more words here"), (4, "again"), (4, "and again"), (1, None)]
    docs = spark.createDataFrame([(*x, "t") for x in rows], "doc_id long, text string, tokens string")
    path = public.path("word_bpe_49k.json")
    words = tokens.load_tokenizer(path)
    want = sorted((d or 0, len(words.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in rows)
    got = token_digest(spark, write_tokens(docs, new_path(spark, "tokens-ids"), path)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id or 0 for r in sorted(got, key=lambda r: r.start)] == sorted(d or 0 for d, _ in rows)
    counted = tokens.token_counts(docs, public.path("byte_bpe_50k.json")).collect()
    assert sorted((r.doc_id or 0, r.n_bytes) for r in counted) == sorted((d or 0, len(t or "")) for d, t in rows)
