import random
import re
from itertools import permutations

import comparing
import pytest

from tillwise.llm import interplay, registry, sql, texts

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, labels):
    """Every order applied to every document, one filter after the other."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    texts = [(i, r[1] or "", r[3] if len(r) > 3 else None) for i, r in ((r[0], r) for r in rows)]

    def fails(i, text):
        words = WORD.findall(text)
        return {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and any(t == text and j is not None and j < i for j, t, _ in texts),
        }

    docs = [(i, part or "", fails(i, text)) for i, text, part in texts]
    out = {}
    for part in {p for _, p, _ in docs}:
        removed_in_all = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            here = [(i, f) for i, p, f in docs if p == part]
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in here if f[letter]]
                failing = [f for _, p, f in docs if p == part and f[letter]]
                here = [(i, f) for i, f in here if not f[letter]]
                removed_in_all[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(here), len(gone), len(failing) - len(gone), sum(sum(f.values()) == 1 for f in failing),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_in_all[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def got(docs, labels):
    rows = interplay.audit(docs, labels).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(found) == len(rows)
    return found


def label_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def made_up(rng):
    words = [f"w{i}" for i in range(400)]
    pool = []
    for _ in range(25):
        text = " ".join(rng.choices(words[: rng.choice([5, 400])], k=rng.choice([3, 150, 199, 200, 201, 420])))
        pool.append(rng.choice(["", "# ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 2, "É € ", "| X"]) + text)
    return [(i, rng.choice([*pool, None, ""]), None, rng.choice(["a", "b", "", None])) for i in rng.sample(range(10**6), 150)]


@pytest.mark.parametrize("seed", range(2))
def test_same_as_applying_every_order(spark, make, seed):
    rng = random.Random(seed)
    rows = made_up(rng)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, *_ in rng.sample(rows, 90)] + [(rows[0][0], 1, 1), (None, 1, 1), (-5, 1, 1)]
    assert got(make(rows, extra=True), label_table(spark, labels)) == brute(rows, labels)


def test_messy_rows(spark, make, messy, none):
    from conftest import MESSY

    found = got(messy, label_table(spark, [(5, 1, 0)]))
    assert found == brute(MESSY, [(5, 1, 0)])
    assert got(none, label_table(spark, [])) == {}


def test_intervals_are_the_ranks_of_the_orders():
    orders = list(permutations(range(5)))
    for length in range(6):
        for prefix in permutations(range(5), length):
            start, end = interplay.rank_interval(prefix, 5)
            assert [i for i, o in enumerate(orders) if o[:length] == prefix] == list(range(start, end))


def test_every_order_removes_a_mask_once():
    ends = interplay.removal_ends(4)
    for mask in range(1, 16):
        steps = [0] * 24
        for m, step, rank, sign in ends:
            if m == mask:
                for r in range(rank, 24):
                    steps[r] += sign * step
        first = [next(s for s, f in enumerate(o, 1) if mask >> f & 1) for o in permutations(range(4))]
        assert steps == first


def test_words_of_long_texts():
    text = ("ab cd " * 400_000 + "x" * 3_000_000 + " end").encode()
    assert sum(map(len, texts.word_pieces(text))) == 800_002
    assert interplay.failures(text) == 2


def test_same_as_sql(spark):
    duck = comparing.connect(SF_DIR)
    mine = registry.op11_interplay(spark, SF_DIR).toPandas()
    assert comparing.differences(mine, duck.execute(sql.INTERPLAY).df()) == []
