"""Mixing sources to target weights in equal-token blocks; DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.texts import WORD
from tillwise.sources import scratch

#: The most often that any document is taken.
EPOCHS = 3
#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Shards of a source are apportioned in groups of so many.
GROUP = 1024


@dataclass(frozen=True)
class Mix:
    """Sizes in words. Small corpora use smaller blocks, so that there are ``least_blocks`` of them."""

    block_words: int = 64
    least_blocks: int = 1 << 16
    shard_words: int = 1 << 14
    seed: str = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Words to take from each source.

    ``sizes`` has source and source_size, one row per source. Sources in code
    point order, null last, weigh 5, 2, 1 and so on, and share the sum of all
    sizes by weight; a target stops at EPOCHS times its source's size and the
    excess goes to the others. Adds rank, weight and target.

    In ascending order of (limit / weight), a share per weight is worked out at
    every source as if all before it had stopped; it rises up to the first
    source that does not stop and falls after it, so the greatest is the right one.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = sizes.withColumn("rank", rank).withColumn("weight", F.get(weights, (F.col("rank") - 1) % len(WEIGHTS)))
    limit = F.col("source_size") * EPOCHS
    filling = Window.orderBy(limit / F.col("weight"), "rank")
    stopped = F.sum(limit).over(filling) - limit
    following = F.sum("weight").over(Window.partitionBy()) - F.sum("weight").over(filling) + F.col("weight")
    everything = F.sum("source_size").over(Window.partitionBy())
    shares = ranked.withColumn("share", (everything - stopped) / following)
    share = F.max("share").over(Window.partitionBy())
    return shares.withColumn("target", F.least(limit.cast("double"), share * F.col("weight"))).drop("share")


def apportion(parts: DataFrame, within: list[str], key: list[str], weight: str, seats: str, out: str) -> DataFrame:
    """Whole numbers of seats by highest quotients (Sainte-Lague).

    In each group of the columns ``within``, the column ``seats`` (the same in
    all its rows) goes to the highest quotients weight / (2 j + 1), j = 0, 1, ...;
    equal ones go by ``key``. Adds ``out``.

    A seat number differs from the exact share by at most half the share's part
    of the group's rows, and a seat. So only quotients about the exact share
    compete, a few for each row, whatever the number of seats.
    """
    group = Window.partitionBy(*within)
    share = F.coalesce(F.try_divide(weight, F.sum(weight).over(group)), F.lit(0.0))
    exact = F.floor(share * F.col(seats))
    slack = F.ceil(share * F.count(F.lit(1)).over(group)) + 1
    near = parts.withColumns({"sure": F.greatest(F.lit(0), exact - slack), "most": exact + slack})
    near = near.withColumn("open", F.col(seats) - F.sum("sure").over(group))
    rivals = near.withColumn("j", F.explode(F.sequence("sure", "most")))
    quotient = F.col(weight) / (2 * F.col("j") + 1)
    place = F.row_number().over(group.orderBy(quotient.desc(), *key, "j"))
    won = rivals.withColumn("won", (place <= F.col("open")).cast("long"))
    kept = parts.columns
    return won.groupBy(*kept).agg((F.first("sure") + F.sum("won")).alias(out))


def _digest(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("")) if isinstance(p, str) else p for p in parts]))


def plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """What the mix takes of every document.

    Returns doc_id, row_hash (of all its columns), size, source_size, target
    (its source's), taken, copies (whole texts among them) and parts: the
    (start, words) pieces taken besides, in order. Null and wordless texts have
    size 0 and give nothing; rows without a source are a source of their own;
    repeated rows are taken separately. An empty table gives no rows.

    Documents of a source fall into shards by a seeded hash; the shards' words
    in seeded order are cut into blocks of equal size. Blocks are apportioned to
    sources by their targets, on to groups of shards and to shards by their
    words. A shard's quota goes in whole passes first, then in blocks in seeded
    order, the last one cut off. Everything follows from the rows and the seed.
    """
    sized = scratch.stage(
        docs.select("doc_id", "source", F.xxhash64(*[docs[c] for c in docs.columns]).alias("row_hash"), word_count(docs["text"]).alias("size")),
        "mix-sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes)
    everything = F.sum("source_size").over(Window.partitionBy())
    block = F.greatest(F.lit(1), F.least(F.lit(mix.block_words), F.floor(everything / mix.least_blocks))).cast("long")
    targets = targets.withColumn("block", block).withColumn("blocks", F.round(everything / block).cast("long"))
    quotas = apportion(targets, [], ["rank"], "target", "blocks", "quota")
    quotas = quotas.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / mix.shard_words)))
    quotas = scratch.stage(quotas.drop("weight", "blocks"), "mix-sources")

    of_source = sized["source"].eqNullSafe(quotas["source"])
    order = _digest(F.lit(mix.seed), "doc_id")
    dealt = sized.join(quotas.drop("quota"), of_source).drop("source").withColumn("order", order)
    shard = F.conv(F.substring("order", 1, 8), 16, 10).cast("long") % F.col("shards")
    dealt = dealt.withColumn("shard", shard).drop("shards")
    words = dealt.groupBy("rank", "shard").agg(F.sum("size").alias("words")).withColumn("part", F.floor(F.col("shard") / GROUP))
    parts = words.groupBy("rank", "part").agg(F.sum("words").alias("words")).join(quotas.select("rank", "block", "quota"), "rank")
    parts = apportion(parts, ["rank"], ["part"], "words", "quota", "part_quota").drop("words", "quota")
    shards = apportion(words.join(parts, ["rank", "part"]), ["rank", "part"], ["shard"], "words", "part_quota", "shard_quota")
    budget = F.least(F.col("shard_quota") * F.col("block"), F.col("words") * EPOCHS)
    shards = shards.filter("words > 0").withColumn("budget", budget).withColumn("copies", F.floor(F.col("budget") / F.col("words")))
    shards = shards.withColumn("rest", F.col("budget") - F.col("copies") * F.col("words"))
    shards = scratch.stage(shards.select("rank", "shard", "words", "copies", "rest", "block"), "mix-shards")

    numbered = shards.filter("rest > 0").withColumn("k", F.explode(F.expr("sequence(0, (words - 1) div block)")))
    length = F.least("block", F.col("words") - F.col("k") * F.col("block"))
    drawn = Window.partitionBy("rank", "shard").orderBy(_digest(F.lit(mix.seed), "rank", "shard", "k"))
    open_words = F.col("rest") - (F.sum(length).over(drawn) - length)
    chosen = numbered.select("rank", "shard", "k", F.least(length, open_words).alias("chosen")).filter("chosen > 0")

    row = Window.partitionBy("rank", "shard").orderBy("order", "doc_id", "row_hash", "size")
    placed = dealt.withColumns({"place": F.row_number().over(row), "start": F.sum("size").over(row) - F.col("size")}).drop("order")
    placed = placed.join(shards.select("rank", "shard", "copies"), ["rank", "shard"], "left")
    covers = F.expr("if(size > 0, sequence(start div block, (start + size - 1) div block), array())")
    # without the hint the planner takes the blocks for as few as the shards they come from, and broadcasts them
    cut = placed.withColumn("k", F.explode_outer(covers)).join(chosen.hint("merge"), ["rank", "shard", "k"], "left")
    opens = F.greatest("start", F.col("k") * F.col("block"))
    ends = F.least(F.col("start") + F.col("size"), F.col("k") * F.col("block") + F.col("chosen"))
    piece = F.when(F.col("chosen").isNotNull() & (ends > opens), F.struct((opens - F.col("start")).alias("start"), (ends - opens).alias("words")))
    cut = cut.withColumn("piece", piece)
    kept = ["doc_id", "row_hash", "size", "source_size", "target", F.coalesce("copies", F.lit(0)).cast("long").alias("copies")]
    gathered = cut.groupBy("rank", "shard", "place", *kept).agg(F.sort_array(F.collect_list("piece")).alias("parts"))
    extra = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    taken = (F.col("size") * F.col("copies") + extra).alias("taken")
    return gathered.select("doc_id", "row_hash", "size", "source_size", "target", taken, "copies", "parts")


def take(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mixed rows, all columns kept: each text as often as it is taken whole, then the pieces taken besides.

    Pieces of a text come in one row, in order, with the white space that follows their words.
    """
    twin = Window.partitionBy("doc_id", "row_hash").orderBy(F.lit(1))
    planned = plan(docs, mix).filter("taken > 0").select("doc_id", "row_hash", "copies", "parts")
    planned = planned.withColumn("twin", F.row_number().over(Window.partitionBy("doc_id", "row_hash").orderBy("copies", "parts")))
    planned = planned.select(*[F.col(c).alias(f"mix_{c}") for c in planned.columns])
    own = [f"own_{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[docs[c].alias(o) for c, o in zip(docs.columns, own)], docs["doc_id"], F.xxhash64(*[docs[c] for c in docs.columns]).alias("row_hash"))
    rows = rows.withColumn("twin", F.row_number().over(twin))
    same = (
        rows["doc_id"].eqNullSafe(planned["mix_doc_id"])
        & (rows["row_hash"] == planned["mix_row_hash"])
        & (rows["twin"] == planned["mix_twin"])
    )
    text = own[docs.columns.index("text")]
    spaced = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), F.lit(1))
    pieces = F.flatten(F.transform("mix_parts", lambda p: F.slice("spaced", p["start"].cast("int") + 1, p["words"].cast("int"))))
    whole = F.array_repeat(F.col(text), F.col("mix_copies").cast("int"))
    some = F.when(F.size("mix_parts") > 0, F.array(F.array_join(pieces, ""))).otherwise(F.array().cast("array<string>"))
    joined = rows.join(planned, same).withColumn("spaced", F.when(F.size("mix_parts") > 0, spaced))
    out = joined.withColumn(text, F.explode(F.concat(whole, some)))
    return out.select(*own).toDF(*docs.columns)
