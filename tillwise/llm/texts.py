"""What the text operators share: words, hash folds, passes over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space; ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a text whose words are cut out together; bounds memory, not results.
PIECE = 1 << 20


def fold(key: Column, folds: int) -> Column:
    """The fold of a row: crc32 of its key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, a list for every ``size`` bytes or so; a longer word stays whole."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        yield text[at:end].split()
        at = end


def shingle_hashes(text: bytes, width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words, joined by spaces, a piece of the text at a time.

    Letters A to Z count as small ones. Fewer words are one run; without a word there is none.
    """
    import xxhash

    hash_of, before, some = xxhash.xxh64_intdigest, [], False
    for words in word_pieces(text):
        words = before + [w.lower() for w in words]
        before = words[max(0, len(words) - width + 1) :]
        if len(words) >= width:
            some = True
            joined = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            runs = zip([0, *ends], ends[width - 1 :])
            yield np.fromiter((hash_of(joined[a : b - 1], seed) for a, b in runs), np.uint64, len(words) - width + 1)
    if before and not some:
        yield np.array([hash_of(b" ".join(before), seed)], np.uint64)


#: A key is heavy if it has over 1 / HEAVY of all rows; so at most this many keys are.
HEAVY = 1000


def spread_join(rows: DataFrame, values: DataFrame, key: str | list[str], n: str, total: int) -> DataFrame:
    """Inner join of many rows with one row of values per key, without a key's rows meeting in one task.

    ``values`` has the number of ``rows`` of each key as ``n``, and ``total`` is
    the number of all rows. Values of the at most ``HEAVY`` keys with more than
    their share of the rows are broadcast; the other keys are shuffled.
    """
    heavy = F.col(n) > total / HEAVY
    few = values.filter(heavy).collect()
    if not few:
        return rows.join(values, key)
    held = rows.sparkSession.createDataFrame(few, values.schema)
    keys = held.select(*([key] if isinstance(key, str) else key))
    light = rows.join(F.broadcast(keys), key, "left_anti").join(values.filter(~heavy), key)
    return rows.join(F.broadcast(held), key).unionByName(light)


def map_rows(
    df: DataFrame, rows: Callable[[dict[str, list]], Iterator[tuple]], schema: str, flush: int = 50_000
) -> DataFrame:
    """Run ``rows`` over batches of columns (as lists) and gather the tuples it yields."""
    target = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for batch in batches:
            columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
            held: list[tuple] = []
            for row in rows(columns):
                held.append(row)
                if len(held) >= flush:
                    yield _batch(held, arrow)
                    held = []
            if held:
                yield _batch(held, arrow)

    return df.mapInArrow(run, target)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind.type) for values, kind in zip(columns, schema, strict=True)], schema=schema
    )
