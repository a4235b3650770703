import random

import pytest

from tillwise.llm import decontaminate as d


def distance_in(pattern, text):
    """(least edit distance to a part of the text, where the first such part ends), by the full table."""
    row = list(range(len(pattern) + 1))
    best = (row[-1], 0)
    for end, c in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, (row[-1], end))
    return best


@pytest.mark.parametrize("seed", range(30))
def test_bit_parallel_distance(seed):
    rng = random.Random(seed)
    pattern = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 70)))
    text = "".join(rng.choice("ab ") for _ in range(rng.randint(0, 200)))
    want = distance_in(pattern, text)
    assert d.nearest(pattern, text, len(pattern)) == want
    assert (d.nearest(pattern, text, 3) is not None) == (want[0] <= 3)


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + "q" + text[at:], text[:at] + "z" + text[at + 1 :]])
    return text


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.mark.parametrize("block_chars", [100, 4_000_000])
def test_same_as_comparing_everything(make, spark, block_chars):
    rng = random.Random(5)
    items = [(i, words(rng, rng.randint(10, 25))) for i in range(6)] + [(6, "too short"), (7, None), (None, words(rng, 12))]
    rows = []
    for i in range(60):
        text = words(rng, 30)
        if i % 2:
            item = items[rng.choice([0, 1, 2, 3, 4, 5, 8])][1]
            text += " " + edited(rng, item, rng.randint(0, 12)).upper() + ", " + words(rng, 5)
        rows.append((i, text))
    rows += [(100, None), (101, ""), (rows[1][0], rows[1][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(d.matches(make(rows, extra=True), benchmark, block_chars=block_chars).collect(), key=str)
    want = []
    for doc_id, text in rows:
        for item_id, item in items:
            item, plain = d.plain(item), d.plain(text)
            if len(item) >= 50 and (near := distance_in(item, plain))[0] <= int(len(item) * 0.05):
                want.append((doc_id, item_id, *near))
    assert len(want) > 8 and sorted(map(tuple, got), key=str) == sorted(want, key=str)
    dirty = {w[0] for w in want}
    clean = d.keep_clean(make(rows, extra=True), benchmark, block_chars=block_chars)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r[0] for r in rows if r[0] not in dirty)


def test_messy_rows(messy, none, make, spark):
    benchmark = spark.createDataFrame([(1, "word1 word2 " * 20)], "item_id long, text string")
    assert d.matches(messy, benchmark).count() == 0
    clean = d.keep_clean(messy, benchmark)
    assert clean.columns == messy.columns and clean.count() == 12
    long = make([(1, "filler " * 50_000 + "word1 word2 " * 20 + " filler" * 50_000)])
    assert d.matches(long, benchmark).collect()[0].distance == 0
    assert d.matches(none, benchmark).count() == 0
    empty = benchmark.filter("false")
    assert d.matches(messy, empty).count() == 0 and d.keep_clean(messy, empty).count() == 12
