"""Encoding, packing, token counts, classifier and the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from basketlens.llm import encoding, op03_jaccard, op04_token_counts as o4, op08_packing as o8, op09_classifier as o9, textbytes as tb

from .conftest import CLASHING, EDGE_ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["Ünḯ é Å x y z <|endoftext|>abc it's  İstanbul ΣΑΣ. 中文12 \x85a b ́start", "", "  ", "a\x1cb\x1db",
        "Ünḯ, é!a Å... it's don't!'s a,b:c (x) …!a I̊.a A̧b a|b|> l'été x2,y 3.5a Don'T a-́b", "ĀB ā ā Ä.Ö!ß?", "<|ENDOFTEXT|> A.b", "K Å ﬁ!x"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("together", [True, False])
def test_encoding_equals_the_library(tokenizer, together, monkeypatch):
    rng = random.Random(4)
    chars = "abZé É'|.,!?<>中\n\t 12ß́️😀σΣ"
    texts = HARD + ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    monkeypatch.setattr(encoding, "KEEP_WORDS", 50)  # forgets again and again
    for group in ([texts] if together else [[t] for t in texts]):
        for i, j, ids, at in encoding.encoded_blocks(pa.array(group), PATH):
            for k in range(i, j):
                assert ids[at[k - i]:at[k - i + 1]].tolist() == ids_of(tokenizer, group[k])


def test_packing_is_a_partition_of_each_document(make_docs, tokenizer):
    rows = EDGE_ROWS + [(50 + i, "w " * n) for i, n in enumerate((2047, 2048, 2046, 5000))]
    got = o8.pieces(make_docs(rows, CLASHING), PATH, digest=False).collect()
    want = sorted((str(d), ids_of(tokenizer, t) + [1]) for d, t in rows)
    assert len({r.sequence_id for r in got}) == len(got)
    docs = {}
    for r in sorted(got, key=lambda r: r.sequence_id):  # pieces of a row follow each other
        assert r.length == len(r.ids) == r.bucket and r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0
        docs.setdefault(str(r.doc_id), []).append(r)
    found = []
    for d, parts in docs.items():
        while parts:
            whole, at = [], 0
            while at < parts[0].doc_tokens if not whole else len(whole) < total:
                r = parts.pop(0)
                total = r.doc_tokens
                assert r.start == len(whole)
                whole += r.ids
                at = total
            found.append((d, whole))
    assert sorted(found) == want
    crcs = o8.pieces(make_docs(rows), PATH, digest=True).collect()
    assert sorted((str(r.doc_id), r.start, r.ids_crc32) for r in crcs) == sorted(
        (str(r.doc_id), r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got)


def test_buckets_hold_equal_lengths(shipped, make_docs, tmp_dir):
    packed = o8.pieces(make_docs(EDGE_ROWS), PATH)
    o8.write_buckets(packed, f"{tmp_dir}/b", 2)
    back = shipped.read.parquet(f"{tmp_dir}/b")
    assert back.where("bucket <> size(ids)").count() == 0 and back.count() == packed.count()
    with pytest.raises(ValueError):
        o8.pieces(packed, PATH, max_tokens=1000)


def test_histogram_answers_every_limit(make_docs, tokenizer):
    rng = random.Random(1)
    rows = EDGE_ROWS + [(100 + i, "tok " * rng.choice([0, 1, 5, 1023, 1024, 1025, 3000])) for i in range(40)]
    lengths = sorted(len(ids_of(tokenizer, t)) for _, t in rows)
    counts = o4.histogram(make_docs(rows, CLASHING), PATH).cache()
    for r in counts.collect():
        n = r.n_tokens
        assert (r.n_docs, r.docs_to, r.tokens_to) == (lengths.count(n), sum(x <= n for x in lengths), sum(x for x in lengths if x <= n))
        assert (r.docs_longer, r.tokens_longer) == (sum(x > n for x in lengths), sum(x for x in lengths if x > n))
        assert (r.truncated_tokens, r.total_docs, r.total_tokens) == (sum(min(x, n) for x in lengths), len(lengths), sum(lengths))
    for r in o4.totals_at(counts, [0, 7, 1024, 10 ** 6]).collect():
        assert r.truncated_tokens == sum(min(x, r.context_limit) for x in lengths)
        assert (r.docs_longer, r.total_docs) == (sum(x > r.context_limit for x in lengths), len(lengths))
    for r in o4.quantiles(counts, [0.0, 0.25, 0.5, 0.99, 1.0]).collect():
        assert r.n_tokens == lengths[max(1, int(np.ceil(r.probability * len(lengths)))) - 1]


def test_empty_tables(make_docs):
    none = make_docs([(1, "x")]).where("doc_id < 0")
    assert o8.pieces(none, PATH).count() == 0 and o4.histogram(none, PATH).count() == 0


# --- classifier ---------------------------------------------------------------------------------

def plain_probability(net, text):
    """The network window by window."""
    data = np.concatenate([np.zeros(4, np.uint8), np.frombuffer(text, np.uint8)])
    blocks = -(-len(data) // o9.PAD)
    data = np.concatenate([data, np.zeros(blocks * o9.PAD + 4 - len(data), np.uint8)])
    filters = np.concatenate([net.first, net.second])
    out = [np.maximum(net.embed[data[4 * w:4 * w + 8]].ravel() @ filters + net.bias, 0) for w in range(blocks * o9.POOL)]
    chunks, first = [], 0
    while True:
        chunks.append(np.max(out[first * 16:min(first + 4, blocks) * 16], axis=0))
        if first + 4 >= blocks:
            break
        first += 3
    feats = np.concatenate([np.max(chunks, axis=0), np.mean(chunks, axis=0)])
    return 1 / (1 + np.exp(-(feats @ net.out + net.out_bias[0])))


def test_scores_match_a_plain_network():
    net = o9.Network.fresh(3)
    rng = random.Random(0)
    texts = [b"", b"a", b"abc", b"x" * 60, b"y" * 61] + [bytes(rng.randrange(256) for _ in range(n)) for n in (63, 64, 300, 1000, 5000)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = o9.probability(net, np.frombuffer(b"".join(texts), np.uint8), bounds)
    assert np.allclose(got, [plain_probability(net, t) for t in texts], atol=1e-5)


def test_gradient_matches_differences():
    net = o9.Network.fresh(5, width=3, filters=4)
    for k in o9.Network.NAMES:
        setattr(net, k, getattr(net, k).astype(np.float64))
    text = np.frombuffer(b"some text with ### marks, long enough for several chunks. " * 9, np.uint8)
    grad = {k: np.zeros(getattr(net, k).shape) for k in o9.Network.NAMES}
    o9._gradient(net, text, 1.0, 1.0, grad)
    rng = np.random.default_rng(0)
    empty = lambda: {k: np.zeros(getattr(net, k).shape) for k in o9.Network.NAMES}
    for k in o9.Network.NAMES:
        values = getattr(net, k).reshape(-1)
        for at in rng.integers(0, len(values), 5):
            if k == "embed":
                at = int(text[at % len(text)]) * 3 + at % 3
            keep, step = values[at], 1e-4
            values[at] = keep + step
            up = o9._gradient(net, text, 1.0, 1.0, empty())
            values[at] = keep - step
            down = o9._gradient(net, text, 1.0, 1.0, empty())
            values[at] = keep
            assert abs((up - down) / (2 * step) - grad[k].reshape(-1)[at]) < 2e-3


def test_held_out_accuracy(shipped):
    sf = "/root/testdata/sf0.01"
    docs, labels = (shipped.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = o9.quality_scores(docs, labels)
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    out = [r for r in rows if r.held_out]
    assert len(out) > 40 and np.mean([r.predicted == r.quality for r in out]) > 0.9


def test_classifier_edges(shipped, make_docs):
    labels = shipped.createDataFrame([(4, 1, 0), (6, 0, 0), (None, 1, 0), (9, None, 0), (777, 1, 1), (7, 5, 0)], "doc_id long, quality int, toxic int")
    rows = EDGE_ROWS
    got = o9.quality_scores(make_docs(rows), labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    by_text = {}
    docs = make_docs(rows, CLASHING)
    scored = o9.score(docs, o9.Network.fresh(1))
    for r in scored.select(F.col("text"), F.col("n_chars")).collect():
        by_text.setdefault(r.text, r)
    assert scored.columns[:len(docs.columns)] == docs.columns and scored.count() == len(rows)
    assert o9.quality_scores(docs.where("doc_id < 0"), labels).count() == 0
    none = o9.quality_scores(make_docs(rows), labels.where("doc_id < 0"))
    assert {r.score for r in none.collect()} == {0.5}


def test_sample_is_bounded(shipped, make_docs):
    docs = make_docs([(i, f"text {i} " * 10) for i in range(300)])
    labels = shipped.createDataFrame([(i, i % 3 != 0, 0) for i in range(300)], "doc_id long, quality boolean, toxic int").withColumn("quality", F.col("quality").cast("int"))
    texts, y, w = o9.training_sample(docs, labels, 40, 1 << 20)
    assert len(texts) == 80 and sum(y) == 40
    assert all(zlib.crc32(t.split()[1]) % 5 for t in texts)
    assert abs(np.sum(w * y) / np.sum(w) - 2 / 3) < 0.1
    assert sum(map(len, o9.training_sample(docs, labels, 300, 6000)[0])) <= 6000


# --- pipeline -----------------------------------------------------------------------------------

def test_pipeline_stages_match_plain_versions(shipped, tokenizer):
    """Each stage on its own predecessor's rows, at the smallest scale."""
    from .test_jaccard_and_units import brute_components, brute_whole_lines
    from .test_rules_and_suffixes import brute_hits
    sf = "/root/testdata/sf0.001"
    docs = shipped.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in shipped.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    from basketlens.session import materialize
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(shipped, kept[-1], sf), name))
    assert all(k.columns == docs.columns for k in kept[:-1])
    rows = [sorted(tuple(r) for r in k.select("doc_id", "text").collect()) for k in kept[:-1]]
    assert 0 < len(rows[1]) <= len(rows[0])
    assert [d for d, _ in rows[2]] == sorted(d for d, _, c in brute_components(rows[1], 5, 80) if d == c)
    cut = [(d, t) for d, t, _, gone in brute_whole_lines(rows[2], 8) if not gone or t.strip(" \t\n\r\x0b\x0c")]
    assert rows[3] == sorted(cut)
    # a cheap test first: only documents with a rare word of an item can hold its window
    assert rows[4] == [r for r in rows[3] if not brute_hits(r[1], bench)[4]]
    whole = {d: ids_of(tokenizer, t) + [1] for d, t in rows[4]}
    for d, group in kept[5].groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "ids")))).collect():
        assert [x for piece in group for x in piece["ids"]] == whole.pop(d)
    assert not whole


def test_long_labelled_texts_train_both_labels(shipped, make_docs):
    docs = make_docs([(i, ("good words " if i % 2 else "bad spam ") * 20_000) for i in range(50)])
    labels = shipped.createDataFrame([(i, i % 2, 0) for i in range(50)] + [(1, 0, 0)], "doc_id long, quality int, toxic int")
    texts, y, w = o9.training_sample(docs, labels, 1500, 8 << 20)
    assert 0 < y.sum() < len(y) and all(len(t) > 150_000 for t in texts) and sum(map(len, texts)) <= 8 << 20
    with pytest.raises(ValueError, match="label"):
        o9.training_sample(docs, labels, 1500, 1 << 17)
    with pytest.warns(UserWarning, match="both kinds"):
        net = o9.train(docs, labels.where("quality = 1"))
    assert set(r.score for r in o9.score(docs, net).collect()) == {0.5}
