import random

import comparing
import numpy as np
import pytest

from tillwise.llm import lshforest, registry, sql
from tillwise.llm.lshforest import Forest

SF_DIR = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def brute(rows):
    """Smallest doc_id that links reach, every text against every other."""
    sets = {}
    for doc_id, text, *_ in rows:
        sets.setdefault(shingles(text), []).append(doc_id)
    worded = [s for s in sets if s]
    label = list(range(len(worded)))
    for i, a in enumerate(worded):
        for j in range(i):
            b = worded[j]
            if label[i] != label[j] and 100 * len(a & b) >= 85 * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    groups = {}
    for s, x in zip(worded, label):
        groups.setdefault(x, []).extend(sets[s])
    least = {x: min((i for i in ids if i is not None), default=None) for x, ids in groups.items()}
    out = [(i, len(s), least[x]) for s, x in zip(worded, label) for i in sets[s]]
    out += [(i, 0, i) for i in sets.get(frozenset(), [])]
    return sorted(((i, n, c, i == c) for i, n, c in out), key=str)


def got(docs, how=Forest()):
    return sorted((tuple(r) for r in lshforest.near_duplicates(docs, how).collect()), key=str)


def varied(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**9)}"
    return " ".join(out)


def made_up(rng, originals=12, variants=9):
    rows, passage = [], [f"shared{i}" for i in range(60)]
    for _ in range(originals):
        words = [rng.choice("abcdefgh") + str(rng.randrange(3000)) for _ in range(rng.choice([4, 30, 120, 400]))]
        if rng.random() < 0.5:
            words += passage
        rows += [" ".join(words), " ".join(words).upper()]
        rows += [varied(rng, words, rng.choice([1, 1, 2, 4, len(words) // 30 + 1])) for _ in range(variants)]
    rng.shuffle(rows)
    return list(zip(rng.sample(range(10**6), len(rows)), rows))


@pytest.mark.parametrize("region", [6, 40, 1024])
def test_same_as_comparing_all(make, region):
    rows = made_up(random.Random(region))
    assert got(make(rows), Forest(region=region)) == brute(rows)


def test_variants_that_only_their_original_joins(make):
    """Hardly two of the variants are similar enough, and they are many times a region."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, varied(rng, words, 2)) for i in range(1, 600)] + [(1000, " ".join(words))]
    want = brute(rows)
    assert sum(c == 1 for _, _, c, _ in want) > 500
    assert got(make(rows), Forest(region=64)) == want


def test_messy_rows(make, messy, none):
    from conftest import MESSY

    want = {(i, n, c, i == c) for i, n, c, _ in brute(MESSY)}
    found = got(messy)
    assert set(found) == want and len(found) == len(MESSY)
    assert got(none) == [] and got(make([(1, None), (2, ""), (2, "")])) == [(1, 0, 1, True), (2, 0, 2, True), (2, 0, 2, True)]


def test_estimates_of_sketches():
    rng = np.random.default_rng(0)
    for similarity in (0.3, 0.6, 0.85):
        both = rng.integers(0, 1 << 63, 400, np.uint64)
        only = int(400 * (1 - similarity) / similarity / 2)
        a, b = (np.concatenate([both, rng.integers(0, 1 << 63, only, np.uint64)]) for _ in range(2))
        x, y = (lshforest.minima(s, 256) >> np.uint64(63) for s in (a, b))
        assert abs((2 * (x == y).mean() - 1) - similarity) < 0.2
        first = lshforest.minima(a, 256) == lshforest.minima(b, 256)
        assert abs(first.mean() - similarity) < 0.12


def test_confirmed_joins_all_similar_sets():
    rng = np.random.default_rng(2)
    base = np.arange(200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(200) > 0.06], rng.integers(10**6, 10**9, 6).astype(np.uint64)])) for _ in range(60)]
    sketch = np.stack([np.packbits((lshforest.minima(s, 256) >> np.uint64(63)).astype(bool)).view("<u8") for s in sets])
    links = lshforest.confirmed(sets, sketch, 256, 85)
    assert len(links) < 60 and all(lshforest.similar(sets[i], sets[j], 85) for i, j in links)
    label = list(range(60))
    for i in range(60):
        for j in range(60):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                label = [label[i] if x == label[j] else x for x in label]
    found = list(range(60))
    for i, j in links:
        found = [found[i] if x == found[j] else x for x in found]
    assert len(set(zip(label, found))) == len(set(label)) == len(set(found))


def test_same_as_sql(spark):
    duck = comparing.connect(SF_DIR)
    mine = registry.op12_lsh_forest(spark, SF_DIR).toPandas()
    assert comparing.differences(mine, duck.execute(sql.NEAR_DUPLICATES).df()) == []
