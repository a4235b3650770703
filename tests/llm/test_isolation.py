import math
import re

import numpy as np
import pytest

from tillwise.llm import isolation

SF_DIR = "/root/testdata/sf0.01"


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, run in enumerate(runs) if runs.count(run) > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(covered),
    )


TEXTS = [
    None, "", " \n\t", "one", "a b c d e a b c d e", "a a a a a a a", "x\nx\n \n \nx ", "Été #*$ %&|<> 中文", "a b c d e f a b c d e g b c d e f",
    "line\nother\nline\n\nother", "a\x0bb\x0cc\x1cd\x85e", " ".join("abcd"[i * i % 4] for i in range(90)),
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert isolation.measure(text.encode() if text is not None else None)[:5] == brute_counts(text)


def brute_path(forest, tree, point):
    at, level = 0, 0
    while forest.child[tree, at] != at:
        at = forest.child[tree, at] + (point[forest.feature[tree, at]] >= forest.cut[tree, at])
        level += 1
    return forest.path[tree, at], level


def test_scores_are_mean_path_lengths():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(500, 3)), rng.normal(8, 1, (5, 3))])
    forest = isolation.grow(points, 40, 64, 3)
    got = forest.score(points)
    for i in (0, 7, 500, 504):
        paths = [brute_path(forest, t, points[i]) for t in range(40)]
        assert all(level <= path <= level + 7 for path, level in paths)
        assert got[i] == pytest.approx(2 ** (-np.mean([p for p, _ in paths]) / isolation.average_path(64)))
    assert got[500:].min() > np.quantile(got[:500], 0.97)
    assert isolation.average_path(256) == pytest.approx(2 * (math.log(255) + 0.5772156649) - 2 * 255 / 256)


def test_threshold_keeps_good_rows():
    histogram = [(800, 1, 990), (1100, 1, 8), (1300, 1, 2), (1200, 0, 50), (900, 0, 5)]
    assert isolation.threshold(histogram, 0.005) == 1150 / 2000
    assert isolation.threshold(histogram, 1.0) == 850 / 2000
    assert isolation.threshold([(5, 1, 10)], 0.1) == isolation.threshold([], 0.1) == 2.0


def test_separates_labelled_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    got = isolation.judge(docs, labels).join(labels, "doc_id").filter("not base_failed").toPandas()
    assert (~got.kept)[got.quality == 0].mean() > 0.9 and got.kept[got.quality == 1].mean() > 0.98


def test_whole_query_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in isolation.judge(docs, labels).collect()}
    again = {r.doc_id: r for r in isolation.judge(docs.repartition(5), labels.repartition(3)).collect()}
    assert got == again
    for r in docs.limit(150).collect():
        want = brute_counts(r.text)
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (g.kept and g.base_failed)


def test_messy_rows(messy, none, spark):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (9, None, 0), (None, 1, 1), (8, 1, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    got = isolation.judge(messy, labels).collect()
    assert len(got) == 12 and all(r.base_failed and not r.kept for r in got if r.doc_id in (1, 2, 3, 4))
    assert isolation.judge(none, labels).count() == 0
    alone = isolation.judge(messy, labels.filter("false")).collect()
    assert all(r.kept != r.base_failed for r in alone)
    assert got[0].asDict().keys() == alone[0].asDict().keys()
