import random

import comparing
import duckdb
import pytest

from tillwise.llm import linededup, sql

SF_DIR = "/root/testdata/sf0.001"


def brute(docs):
    """Texts without lines under a window of three that stood at an earlier (doc_id, line)."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if not "".join(window).strip(" \t\n\x0b\x0c\r"):
                continue
            if window in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(window)
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_same_as_brute_force(make, seed):
    rng = random.Random(seed)
    rows = [(i, "\n".join(rng.choice(["", "a", "b", "c", " "]) for _ in range(rng.randint(1, 12)))) for i in range(60)]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in linededup.remove_repeated(make(rows, extra=True)).collect()}
    assert got == brute(rows)


def test_some_copy_of_every_line_survives(make):
    rows = [(i, "\n".join(f"line {(i * 3 + k) % 11}" for k in range(7))) for i in range(30)]
    got = linededup.remove_repeated(make(rows)).collect()
    assert {x for _, t in rows for x in t.split("\n")} == {x for r in got for x in r.text.split("\n") if x}


def test_same_as_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    mine = linededup.remove_repeated(spark.read.parquet(f"{SF_DIR}/documents.parquet")).toPandas()
    assert comparing.differences(mine, connection.execute(sql.LINE_DEDUP).df()) == []


def test_messy_rows(messy, none):
    got = linededup.remove_repeated(messy).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 12 and by[1].text is None and by[1].n_lines == 0 and by[2].text == "" and by[2].n_lines == 1
    assert by[9].text == "a\nb\nc\nd\n\n\n\n" and by[9].n_removed == 4
    assert linededup.remove_repeated(none).count() == 0


def test_one_window_in_most_places(make):
    """The places of a heavy window are spread; every one but the first goes."""
    rows = [(i, f"a\nb\nc\nown {i}\nd{i}\ne{i}" if i % 10 else f"x{i}\ny{i}\nz{i}") for i in range(3000)]
    got = {r.doc_id: r for r in linededup.remove_repeated(make(rows)).collect()}
    assert len(got) == 3000
    assert all(got[i].n_removed == (3 if i % 10 and i != 1 else 0) for i in got)
