"""Each stage of the pipeline against a plain version of it, on the stage before."""

import collections
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from tillwise.llm import decontaminate, langid, sql
from tillwise.sources import scratch

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    """The documents and what each stage made of them."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    extra = spark.createDataFrame(
        [(10_000, None, "en", "src0", 0), (10_001, "", None, None, 0), (10_002, "### 12 !!", "en", "src1", 9), (10_003, "Qx " * 3, None, None, 9)], docs.schema
    )
    docs = docs.unionByName(extra)
    out.append(scratch.stage(docs, "raw"))
    for _, stage in corpus_pipeline.STAGES:
        out.append(scratch.stage(stage(spark, out[-1], SF_DIR), "stage"))
    return out


def by_id(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(tables):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "benchmark", "mix", "tokens"]
    assert all(t.schema == tables[0].schema for t in tables[:5])


def test_language(tables):
    rows = tables[0].collect()
    sums = collections.defaultdict(lambda: np.zeros(1024))
    for r in rows:
        if r.lang and r.text and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            sums[r.lang] += langid.bundle([r.text], 7, 1024)[0]
    protos = [v / np.linalg.norm(v) for v in sums.values()]
    kept = set()
    for r in rows:
        if r.text and any(map(str.isalpha, r.text)):
            vector = langid.bundle([r.text], 7, 1024)[0].astype(float)
            best = max(float(p @ vector) for p in protos) / np.linalg.norm(vector)
            if len(r.text) < 30 or best >= 0.15:
                kept.add(r.doc_id)
    assert set(by_id(tables[1])) == kept and {10_000, 10_001, 10_002}.isdisjoint(kept) and 10_003 in kept


def test_near_duplicates(tables):
    fps = {i: brute_fingerprint(t) for i, t in by_id(tables[1]).items()}
    label, first = brute_components(fps.values(), 4), {}
    for i, fp in fps.items():
        first[label[fp]] = min(i, first.get(label[fp], i))
    assert sorted(by_id(tables[2])) == sorted(first.values()) and tables[2].count() == len(first)


def test_benchmark(tables, spark):
    items = [decontaminate.plain(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    items = [i for i in items if len(i) >= 50]
    kept = {
        i for i, t in by_id(tables[2]).items()
        if not any(decontaminate.nearest(item, decontaminate.plain(t), int(len(item) * 0.05)) for item in items)
    }
    assert set(by_id(tables[3])) == kept and len(kept) < tables[2].count()


def test_mix(tables):
    connection = duckdb.connect()
    connection.register("documents", tables[3].toPandas())
    want = {r[0]: r[4] for r in connection.execute(sql.MIXING).fetchall() if r[4]}
    got, texts = collections.Counter(), by_id(tables[3])
    for r in tables[4].collect():
        got[r.doc_id] += len((r.text or "").encode().split())
        assert set(r.text.encode().split()) <= set(texts[r.doc_id].encode().split())
    assert got == want


def test_tokens(tables):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, []
    for doc_id, text in sorted((r.doc_id, r.text) for r in tables[4].collect()):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, tables[5].collect())) == sorted(want)


def test_run_applies_the_stages(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert out.agg(F.sum("n_tokens"), F.max(F.col("start") + F.col("n_tokens"))).first()[0] > 0


def test_empty_documents(spark, none):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch.stage(stage(spark, docs, SF_DIR), "stage")
    assert docs.count() == 0
