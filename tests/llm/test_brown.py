import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import brown
from tillwise.llm.texts import fold

SMALL = brown.Settings(classes=6, clustered=20, endings=8, held=50, sweeps=4)
SF_DIR = "/root/testdata/sf0.001"


def run(docs, settings=brown.Settings()):
    held = fold(F.col("doc_id"), 10) == 0
    return brown.score(docs, ~held, held, settings).collect()


def tokens(text):
    return [*(text or "").encode().lower().split(), brown.END]


@pytest.mark.parametrize("settings", [SMALL, brown.Settings()])
def test_base_scores(spark, settings):
    import zlib

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in rows}
    counts = collections.Counter(t for r in rows if not held[r.doc_id] for t in tokens(r.text))
    total, distinct = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in run(docs, settings)}
    assert len(got) == len(rows)
    for r in rows:
        cut, g = tokens(r.text), got[r.doc_id]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in cut)
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (held[r.doc_id], len(cut), sum(counts[t] > 0 for t in cut), total)
        assert g.base_score == pytest.approx(base, rel=1e-9)
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def brute_model(texts, settings):
    """Classes and probabilities from plain counts, with the classes the exchange gives for the same pair table."""
    counts = collections.Counter(t for text in texts for t in tokens(text))
    words = sorted((w for w in counts if w and len(w) <= settings.longest), key=lambda w: (-counts[w], w))
    steps = collections.Counter(int(math.floor(math.log2(counts[w]) * 16)) for w in words)
    reached, lowest = 0, None
    for step in sorted(steps, reverse=True):
        reached += steps[step]
        if reached > settings.held:
            break
        lowest = step
    held = [w for w in words if lowest is not None and math.floor(math.log2(counts[w]) * 16) >= lowest]
    place = {w: i for i, w in enumerate(held[: settings.clustered])}
    end = settings.symbols - 1
    symbol = lambda w: end if w == brown.END else place.get(w, settings.ending(w))
    pairs = np.zeros((settings.symbols, settings.symbols))
    for text in texts:
        row = [end, *map(symbol, tokens(text))]
        for a, b in zip(row, row[1:]):
            pairs[a, b] += 1
    return counts, symbol, pairs


def test_scores_are_class_steps_and_emissions(make):
    texts = ["the cat sat on the mat", "the dog sat on the rug.", "a cat, a dog and a rug", "Cats sit; dogs sat! THE end", ""] * 3
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = make(rows, extra=True)
    got = {r.doc_id: r for r in brown.score(docs, F.lit(True), F.lit(False), SMALL).collect()}
    counts, symbol, pairs = brute_model(texts, SMALL)
    of = brown.exchange(pairs, SMALL)
    assert of[-1] == 0 and (of[:-1] > 0).all()
    n, v = np.zeros(SMALL.classes), np.zeros(SMALL.classes)
    for w, c in counts.items():
        if w:
            n[of[symbol(w)]] += c
            v[of[symbol(w)]] += 1
    model = brown.fit(pairs, of, (n, v), SMALL)
    used = sorted(set(of))
    assert np.allclose((10**model.step)[:, used].sum(1), 1)
    for i, text in rows:
        total, last = 0.0, 0
        for t in tokens(text):
            c = of[symbol(t)]
            total += model.step[last, c] + (math.log10((counts[t] + 0.1) / (n[c] + 0.1 * (v[c] + 1))) if t else 0)
            last = c
        assert got[i].score == pytest.approx(total, rel=1e-9)


def likelihood(pairs, of, classes):
    member = np.eye(classes)[of]
    table = member.T @ pairs @ member
    gain = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return gain(table) - gain(table.sum(0)) - gain(table.sum(1))


def test_exchange_climbs_to_a_local_best():
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 5, SMALL.symbols)
    pairs = rng.poisson(np.where((kinds[:, None] + 1) % 5 == kinds, 6.0, 0.2)).astype(float)
    settings = brown.Settings(classes=6, clustered=20, endings=8, sweeps=50)
    start = brown.exchange(pairs, brown.Settings(classes=6, clustered=20, endings=8, sweeps=0))
    of = brown.exchange(pairs, settings)
    best = likelihood(pairs, of, 6)
    assert best > likelihood(pairs, start, 6)
    for s in range(SMALL.symbols - 1):
        for c in range(1, 6):
            other = of.copy()
            other[s] = c
            assert likelihood(pairs, other, 6) <= best + 1e-6


def test_messy_rows(messy, none):
    got = run(messy)
    assert len(got) == 12 and {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert run(none) == []
    untaught = brown.score(messy, F.lit(False), F.lit(True), SMALL).collect()
    assert {r.train_tokens for r in untaught} == {0} and {r.n_known for r in untaught} == {0}
    assert all(math.isfinite(r.score) for r in untaught)


def test_every_repeated_word_is_clustered_until_none_moves(spark, monkeypatch):
    """Held and other words alike: alone, no word seen twice does better in another class."""
    found = {}
    rounds = brown.exchange_rounds

    def kept(pairs, of, end, settings):
        found["start"], found["end"] = of, end
        found["of"], found["table"] = rounds(pairs, of, end, settings)
        return found["of"], found["table"]

    monkeypatch.setattr(brown, "exchange_rounds", kept)
    settings = brown.Settings(classes=6, clustered=20, endings=8, held=50)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("doc_id < 40")
    brown.score(docs, F.lit(True), F.lit(False), settings).collect()
    texts = [tokens(r.text) for r in docs.collect()]
    counts = collections.Counter(w for t in texts for w in t)
    rare = sorted(settings.key(w) for w, c in counts.items() if w and c > 1)
    held = found["end"] - settings.endings
    keys = sorted(set(rare))
    assert len(found["of"]) == len(keys) + settings.endings + 1 and 20 < held <= 50 < len(keys)
    ordered = sorted((w for w, c in counts.items() if w and c > 1), key=lambda w: (-counts[w], w))[:held]
    place = {settings.key(w): i for i, w in enumerate(ordered)}
    place |= {k: found["end"] + 1 + i for i, k in enumerate(k for k in keys if k not in place)}
    symbol = lambda w: found["end"] if w == brown.END else place.get(settings.key(w), held + settings.key(w) % 8)
    pairs = np.zeros((len(found["of"]),) * 2)
    for text in texts:
        row = [found["end"], *map(symbol, text)]
        for a, b in zip(row, row[1:]):
            pairs[a, b] += 1
    member = np.eye(6)[found["of"]]
    assert np.array_equal(member.T @ pairs @ member, found["table"])
    best = likelihood(pairs, found["of"], 6)
    assert best > likelihood(pairs, found["start"], 6)
    for s in np.random.default_rng(1).permutation(len(found["of"]))[:150]:
        for c in range(1, 6) if s != found["end"] else ():
            other = found["of"].copy()
            other[s] = c
            assert likelihood(pairs, other, 6) <= best + 1e-5


def test_texts_are_coded_once(spark, messy, monkeypatch):
    """Pairs and scores start from the written symbols, not from the texts."""
    coded, rows = [], []
    code, stage = brown.code_texts, brown.scratch.stage
    monkeypatch.setattr(brown, "code_texts", lambda *a: coded.append(a) or code(*a))
    monkeypatch.setattr(brown.scratch, "stage", lambda df, name: rows.append((name, stage(df, name))) or rows[-1][1])
    brown.score(messy, F.lit(True), F.lit(False), SMALL).collect()
    assert len(coded) == 1
    texts, words, _ = coded[0]
    coder = brown.Coder(*words.value[:3])
    wanted = sorted((r.doc_id or 0, bytes(r.text or b"").lower().split()) for r in texts.collect())
    got = sorted((r.doc_id or 0, np.frombuffer(r.symbols, "<i4").tolist(), r.n_tokens, r.held, r.rest) for r in dict(rows)["coded"].collect())
    assert len(got) == len(wanted)
    by_words = sorted((d, coder.symbols(c, coder.places(c)).tolist(), len(c) + 1, len(c) - sum(w not in coder.place for w in c), [w for w in c if w not in coder.place]) for d, c in wanted)
    assert by_words == [(d, s, n, h, [bytes(w) for w in r]) for d, s, n, h, r in got]


def test_keys_are_the_key_of_each_word():
    words = [b"a", b"running!!", b"\xc3\xa9t\xc3\xa9,", b"...", b"x" * 300]
    assert brown.Settings().keys(words).tolist() == [brown.Settings().key(w) for w in words]
    assert brown.Settings().keys([]).tolist() == []
