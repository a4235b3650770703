import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillwise.llm import simhash
from tillwise.llm.components import connected_components

SF_DIR = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fingerprints, radius):
    """Label of each distinct value: the smallest it reaches."""
    values, label = sorted(set(fingerprints)), {}
    for v in values:
        label[v] = v
    for _ in values:
        changed = False
        for i, a in enumerate(values):
            for b in values[i + 1 :]:
                if (a ^ b).bit_count() <= radius and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
        if not changed:
            break
    return label


def test_same_as_comparing_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    label = brute_components(fps.values(), 4)
    first = {}
    for i, fp in fps.items():
        first[label[fp]] = min(i, first.get(label[fp], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{fp:016x}", first[label[fp]]) for i, fp in fps.items()}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(first.values())


def neighbours(rng, n):
    """Values in clusters, chains of near values and values far from any other."""
    out = [rng.getrandbits(64) for _ in range(n // 3)]
    centre = rng.getrandbits(64)
    out += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(n // 3)]
    for _ in range(n // 3):
        out.append(out[-1] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("tree_size", [7, 4096])
@pytest.mark.parametrize("radius", [0, 3, 4])
def test_links_reach_what_all_pairs_reach(spark, tree_size, radius):
    rng = random.Random(radius)
    values = neighbours(rng, 240)
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fp long"), radius, tree_size)
    rows = links.collect()
    assert all((int(r.u) ^ int(r.v)).bit_count() > 0 for r in rows)
    reached = {r.node: r.label for r in connected_components(links).collect()}
    groups = {}
    for v, (s,) in zip(values, signed):
        groups.setdefault(reached.get(s, s), set()).add(v)
    want = {}
    for v, label in brute_components(values, radius).items():
        want.setdefault(label, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("distinct", [10, 10**6, 10**9])
def test_masks_keep_near_values_together(distinct):
    rng = random.Random(1)
    masks = [m & (1 << 64) - 1 for m in simhash.shard_masks(distinct, 4)]
    for _ in range(300):
        value = rng.getrandbits(64)
        other = value ^ sum(1 << b for b in rng.sample(range(64), 4))
        assert any(value & m == other & m for m in masks)


def test_components_of_paths_and_stars(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (100, 101), (300, 200)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(rows, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 300: 200}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_messy_rows(messy, none):
    got = simhash.near_duplicates(messy).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 12 and {by[i].fingerprint for i in (1, 2, 3)} == {"0" * 16} and {by[i].component_id for i in (1, 2, 3)} == {1}
    assert by[6].component_id == 5 and by[None].component_id is None and all(by[r.doc_id].fingerprint == r.fingerprint for r in got)
    kept = [r.doc_id for r in simhash.keep_one(messy).collect()]
    assert sorted(kept, key=str) == sorted([1, 4, None, 5, 7, 8, 9, 10], key=str)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_long_text():
    text = " ".join(f"w{i % 5003}" for i in range(80_000))
    assert simhash.fingerprint(text.encode(), 4) & (1 << 64) - 1 == brute_fingerprint(text)


def test_callers_columns_stay(make):
    docs = make([(1, "a b c d e"), (2, "a b c d e"), (3, "x y z w v")])
    for name in ("kept_hash", "kept_id", "text_hash", "c0"):
        docs = docs.withColumn(name, F.concat(F.lit(name), "doc_id"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.kept_hash, r.kept_id, r.text_hash, r.c0) for r in kept.collect()) == [
        (i, f"kept_hash{i}", f"kept_id{i}", f"text_hash{i}", f"c0{i}") for i in (1, 3)
    ]


def test_one_fingerprint_in_most_rows(spark, make):
    """The rows of a heavy fingerprint and component are spread, none is lost."""
    rows = [(i, "same words in many rows" if i % 10 else f"text number {i} alone") for i in range(3000)]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(make(rows)).collect()}
    assert len(got) == 3000 and {got[i] for i in range(3000) if i % 10} == {1}
