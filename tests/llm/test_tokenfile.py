import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillwise.llm import tokenfile as tf
from tillwise.sources import scratch

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.001"
ODD = [
    "a ́b", "x\x1cy z", "É ÉTÉ ǅ İI", " x y", "<|endoftext|>  <|startoftext|>x", "ΑΣ ΑΣ. don't I'll 12 34५", "", " ", "\u2028ﬁ Ⅷ​\u0085q",
    "한국어 中文 é ́", "THE. e. ,. . x's' 's can't!", "x" * 300 + " y", "a\u00a0b\u2003c", "#", "##", "it's'", "A%%% b### c!!",
    "ŒUVRE Straße, ÇA été! ªº İstanbul ıI ß.ß", "ǄÜ ȘŢ ɐ ɏ ŉ ſ K Å", "é. e\u0301. 'é' -é- ë’s", "\u00ad a\u00adb",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_word_by_word_is_text_by_text(tokenizer):
    encoder = tf.WordEncoder(PATH, full=40)
    for _ in range(2):
        for text, packed in ((t, encoder.text(t.encode())) for t in ODD):
            assert np.frombuffer(packed, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_grammars_expand_to_the_ids(seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, [2, 3, 5, 40, 1, 3][seed], 4000)
    last = rng.random(4000) < 0.02
    last[-1] = True
    sequence, ends, left, right = tf.compress(ids, last)
    assert len(sequence) < len(ids) and np.array_equal(tf.expand(sequence, left, right), ids)
    starts, stops = np.append(0, np.flatnonzero(last)[:-1] + 1), np.flatnonzero(last) + 1
    inner = np.append(0, np.flatnonzero(ends)[:-1] + 1), np.flatnonzero(ends) + 1
    for a, b, c, d in zip(starts, stops, *inner):
        assert np.array_equal(tf.expand(sequence[c:d], left, right), ids[a:b])
    sizes = tf.expansions(left, right)
    for i, n in enumerate(sizes):
        assert len(tf.expand(np.array([tf.NONTERMINAL + i]), left, right)) == n


def test_later_rounds_count_new_symbols_only(monkeypatch):
    """A pair seen too rarely is not counted again in every round, and the grammar is Re-Pair's all the same."""
    rng = np.random.default_rng(5)
    ids = np.where(rng.random(60_000) < 0.3, rng.integers(0, 8, 60_000), rng.integers(100, 60_000, 60_000))
    last = rng.random(60_000) < 0.02
    last[-1] = True
    sizes, frequent = [], tf._frequent
    monkeypatch.setattr(tf, "_frequent", lambda pair, least: sizes.append(len(pair)) or frequent(pair, least))
    sequence, ends, left, right = tf.compress(ids, last)
    assert len(sizes) > 2 and max(sizes[1:]) < len(ids) / 2
    expands = tf.expansions(left, right)
    assert np.array_equal(tf.decode(sequence.astype(np.int64), left, right, expands), ids)
    inner = np.flatnonzero(~ends[:-1])
    counts = np.unique(sequence[inner].astype(np.int64) << 32 | sequence[inner + 1].astype(np.int64), return_counts=True)[1]
    assert counts.max() < 8


@pytest.mark.parametrize("seed", range(4))
def test_frequent_pairs_are_counted_exactly(monkeypatch, seed):
    monkeypatch.setattr(tf, "HASH_BITS", 3)  # many pairs a hash
    pair = np.random.default_rng(seed).integers(0, [1, 9, 300, 5000][seed], 2000).astype(np.uint64) << np.uint64(32)
    group, pairs, times = tf._frequent(pair, 8)
    known, counts = np.unique(pair, return_counts=True)
    assert dict(zip(pairs.tolist(), times.tolist())) == {p: n for p, n in zip(known.tolist(), counts.tolist()) if n >= 8}
    assert all(pairs[g] == p if g >= 0 else p not in set(pairs) for p, g in zip(pair, group.tolist()))


def want(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_tokens", [300, 1 << 19])
def test_index_and_random_access(spark, tokenizer, shard_tokens):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    path = scratch.new_path(spark, "tokens")
    tf.write(docs, path, PATH, 2, shard_tokens)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    expected = want(rows, tokenizer)
    assert sorted(map(tuple, tf.read_index(spark, path).collect())) == expected
    shards = spark.read.parquet(path).collect()
    assert (len(shards) > 10) == (shard_tokens == 300)
    texts = dict(rows)
    for shard in shards:
        for place in range(0, len(shard.doc_ids), 7):
            ids = tf.read_document(shard.asDict(), place)
            assert ids.tolist() == [*tokenizer.encode(texts[shard.doc_ids[place]], add_special_tokens=False).ids, 2]


def test_messy_rows(spark, messy, none, tokenizer):
    path = scratch.new_path(spark, "tokens")
    tf.write(messy, path, PATH, 2, 100)
    rows = sorted(((r.doc_id, r.text) for r in messy.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = sorted(map(tuple, tf.read_index(spark, path).collect()), key=lambda r: r[1])
    assert got == want(rows, tokenizer)
    path = scratch.new_path(spark, "tokens")
    tf.write(none, path, PATH, 2)
    assert tf.read_index(spark, path).count() == 0


def test_no_pair_is_left_that_occurs_often(tokenizer):
    rng = np.random.default_rng(3)
    phrases = [rng.integers(0, 500, rng.integers(2, 60)) for _ in range(40)]
    ids = np.concatenate([phrases[i] for i in rng.integers(0, 40, 3000)])
    last = np.zeros(len(ids), bool)
    last[::997], last[-1] = True, True
    sequence, ends, left, right = tf.compress(ids, last)
    inside = ~ends[:-1]
    pairs = [tuple(p) for p in zip(sequence[:-1][inside].tolist(), sequence[1:][inside].tolist())]
    times = {}
    for i, p in enumerate(pairs):  # those that overlap themselves count once in a run
        times[p] = times.get(p, 0) + 1
    assert max(n for p, n in times.items() if p[0] != p[1]) < 8
    assert np.array_equal(tf.expand(sequence, left, right), ids) and len(sequence) + 2 * len(left) < len(ids) / 8


def test_token_ranges(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    path = scratch.new_path(spark, "tokens")
    tf.write(docs, path, PATH, 2)
    shard = spark.read.parquet(path).first().asDict()
    for place in range(0, len(shard["doc_ids"]), 5):
        ids = tf.read_document(shard, place).tolist()
        for start, stop in ((0, 1), (0, len(ids)), (len(ids) // 3, len(ids) // 2), (len(ids) - 1, len(ids) + 9), (5, 5), (-3, 2)):
            assert tf.read_tokens(shard, place, start, stop).tolist() == ids[max(start, 0) : stop]


def test_other_tokenizers_get_whole_texts(tokenizer):
    other = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = tf.WordEncoder(other), Tokenizer.from_file(other)
    assert tf.WordEncoder(PATH).by_words and not encoder.by_words
    for text in ["Hello World, two  spaces", *ODD]:
        assert np.frombuffer(encoder.text(text.encode()), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_counting_pairs_takes_little_memory():
    """A shard's pairs are looked up a block at a time, beside one sorted copy."""
    import tracemalloc

    pair = np.random.default_rng(0).zipf(1.3, 1 << 20).astype(np.uint64) % np.uint64(1 << 40)
    tracemalloc.start()
    group, pairs, times = tf._frequent(pair, 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(pairs) > 1000 and np.array_equal(pairs[group[group >= 0]], pair[group >= 0])
    assert peak < 40 * len(pair)


def test_the_pipeline_remembers_fewer_words(monkeypatch, spark, messy, tokenizer):
    """Its other stages leave memory with the same executor; the rows do not depend on what is remembered."""
    import corpus_pipeline

    asked, write = [], tf.write
    monkeypatch.setattr(tf, "write", lambda *a, **k: asked.append(k["remembered"]) or write(*a, **k))
    got = corpus_pipeline.tokens(spark, messy, SF_DIR).collect()
    assert asked == [corpus_pipeline.REMEMBERED] and asked[0] <= 100_000
    rows = sorted(((r.doc_id, r.text) for r in messy.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want(rows, tokenizer)
