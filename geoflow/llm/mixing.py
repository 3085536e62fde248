"""Mixing sources to target weights, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

WEIGHTS = (5.0, 2.0, 1.0)
LIMIT = 3.0
BLOCK_WORDS = 64
SHARD_SLOTS = 1024
#: Documents of a source are put in order within so many groups, so that no source is sorted in one task.
GROUPS = 4096
#: Names the draw; another one gives another mix.
SEED = 1
WORD = r"[^\x20\x09-\x0D]+"


def _sum_before(value: str, *by: str, order: str) -> Column:
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """Rows (rank, source, source_size, target) of rows (source, size), sources by code point, null last.

    A target is the smaller of `limit` times the source's size and its weight times one common level, which is the level at
    which all targets add up to all sizes. In the order of size over weight, sources up to some place stop at their limit;
    the level follows from what they leave to the others. The windows run over one row for each source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    sources = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(order) - 1)
        .withColumn("weight", F.element_at(listed, (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * F.lit(limit))
    )
    fill = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    below = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(below), F.lit(0.0))) / F.sum("weight").over(rest)
    return (
        sources.withColumn("level", level)
        # the level rises with every source that stops at its limit and falls again after the first that doesn't
        .withColumn("target", F.least(F.col("most"), F.max("level").over(everything) * F.col("weight")))
        .select("rank", "source", "source_size", "target")
    )


def _hashed(*parts: Column) -> Column:
    """32 bits of a hash of the parts; SQL has the same."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("bigint")


def _numbers(chunk: int, last: str) -> tuple[Column, Column]:
    """0 to last - 1, generated in two steps so that one row's numbers are dealt out over many tasks."""
    return F.explode(F.expr(f"sequence(0L, ({last} - 1) div {chunk})")), F.explode(F.expr(f"sequence(chunk * {chunk}, least({last}, (chunk + 1) * {chunk}) - 1)"))


def packed_blocks(sized: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (rank, block, doc_id, start, size, words and more): which words of each source's blocks a document fills.

    sized: rows (rank, doc_id, size) and any others. The words of a source are put one document after the other, by a hash of the doc_id and
    then the doc_id, and cut into blocks. Places are sums over groups of documents first and within a group second.
    """
    grouped = sized.where("size > 0").withColumn(
        "grp", F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10).cast("bigint") % GROUPS
    )
    totals = grouped.groupBy("rank", "grp").agg(F.sum("size").alias("n")).withColumn("base", _sum_before("n", "rank", order="grp"))
    within = Window.partitionBy("rank", "grp").orderBy(F.col("doc_id").isNull(), "doc_id", "size")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        grouped.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(totals.select("rank", "grp", "base"), ["rank", "grp"])
        .withColumn("start", F.col("base") + F.col("inner"))
    )
    ends = F.expr("start + size")
    first, last = F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")
    more = [c for c in sized.columns if c not in ("rank", "doc_id", "size")]
    return placed.select("rank", "doc_id", "start", "size", *more, F.explode(F.sequence(first, last)).alias("block")).select(
        "rank", "block", "doc_id", "start", "size", *more,
        (F.least(ends, (F.col("block") + 1) * block_words) - F.greatest(F.col("start"), F.col("block") * block_words)).alias("words"),
    )


def permuted_blocks(targets: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """Rows (rank, block, index): each source's blocks in a pseudorandom order, the index being a block's place in it.

    The order is that of a keyed hash, then of the block. Places are counted over groups of blocks first and within a group
    second, so that no source is ordered in one task.
    """
    outer, inner = _numbers(SHARD_SLOTS, "blocks")
    counted = targets.select("rank", F.ceil(F.col("source_size") / block_words).cast("bigint").alias("blocks")).where("blocks > 0")
    blocks = counted.withColumn("chunk", outer).repartition("rank", "chunk").withColumn("block", inner)
    keyed = blocks.select("rank", "block", _hashed(F.lit(seed), F.col("rank"), F.col("block")).alias("key")).withColumn("grp", F.expr(f"key div {(1 << 32) // GROUPS}"))
    before = keyed.groupBy("rank", "grp").agg(F.count("*").alias("n")).withColumn("base", _sum_before("n", "rank", order="grp"))
    within = F.row_number().over(Window.partitionBy("rank", "grp").orderBy("key", "block"))
    # the blocks come out of one row for each source; see drawn_slots
    placed = keyed.withColumn("inner", within).hint("merge").join(before.select("rank", "grp", "base").hint("merge"), ["rank", "grp"])
    return placed.select("rank", "block", (F.col("base") + F.col("inner") - 1).alias("index"))


def source_slots(targets: DataFrame, order: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (rank, blocks, slots, shards_slots) of sources with a target: how many blocks the mix takes of each.

    The slots go through a source's blocks in their order, again and again, and end where the words taken are nearest to the
    target; only the last block of a source may be smaller than others, so its place in the order decides which number that
    is. A source with a target has a slot at least. shards_slots: the slots of all sources.
    """
    blocks = F.ceil(F.col("source_size") / block_words).cast("bigint")
    ends = targets.where("target > 0").withColumn("blocks", blocks)
    last = order.select("rank", F.col("block").alias("last_block"), F.col("index").alias("last_index"))
    met = ends.join(last.hint("merge"), (ends.rank == last.rank) & (F.col("last_block") == F.col("blocks") - 1)).drop(last.rank)
    short = F.col("blocks") * block_words - F.col("source_size")
    turns = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - turns * F.col("source_size")
    # without the last block among those of the last turn, and with it
    fewer, more = F.round(rest / block_words), F.round((rest + short) / block_words)
    partly = F.when(fewer <= F.col("last_index"), fewer).otherwise(F.greatest(F.col("last_index") + 1, more))
    slots = F.least(F.greatest(turns * F.col("blocks") + partly, F.lit(1)), F.floor(F.lit(LIMIT) * F.col("blocks"))).cast("bigint")
    return met.select("rank", "blocks", slots.alias("slots")).withColumn("shards_slots", F.sum("slots").over(Window.partitionBy()))


def drawn_slots(slots: DataFrame, order: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """Rows (rank, block, shard, slot): the blocks that the mix takes and where it puts them.

    Every slot of a source draws its output shard, all shards being equally likely, so the counts of a source in the shards are a
    multinomial draw of its slots, and a shard's counts of sources one under the condition that each source's slots come out
    exactly. There are as many shards as make `shard_slots` slots each on average. The n-th slot of a source, counted modulo its blocks, takes the
    block with that index in the source's own order. Slots stand in their shard by another hash.
    slots: rows of source_slots; order: rows of permuted_blocks.
    """
    outer, inner = _numbers(SHARD_SLOTS, "slots")
    draws = slots.withColumn("chunk", outer).repartition("rank", "chunk").withColumn("draw", inner)
    shards = F.ceil(F.col("shards_slots") / shard_slots).cast("bigint")
    drawn = draws.select("rank", "draw", F.expr("draw % blocks").alias("index"), (_hashed(F.lit(seed), F.lit("shard"), F.col("rank"), F.col("draw")) % shards).alias("shard"))
    place = Window.partitionBy("shard").orderBy(_hashed(F.lit(seed), F.lit("slot"), F.col("rank"), F.col("draw")), "rank", "draw")
    return (
        drawn.withColumn("slot", F.row_number().over(place) - 1)
        # the slots come out of one row for each source, so their estimated size would make them a broadcast at any scale
        .hint("merge").join(order.hint("merge"), ["rank", "index"])
        .select("rank", "block", "shard", "slot")
    )


def shard_counts(drawn: DataFrame) -> DataFrame:
    """Rows (shard, rank, slots): the multinomial counts of the sources in every output shard."""
    return drawn.groupBy("shard", "rank").agg(F.count("*").alias("slots"))


def sized_documents(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Written rows (rank, doc_id, size) and (rank, source, source_size, target)."""
    counted = scratch.keep(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        )
    )
    return counted, scratch.keep(source_targets(counted))


def _drawn_blocks(targets: DataFrame, scratch: Scratch, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """Rows (rank, block, times, first_shard) of the blocks that were drawn."""
    order = scratch.keep(permuted_blocks(targets, block_words, seed))
    slots = scratch.keep(source_slots(targets, order, block_words))
    drawn = drawn_slots(slots, order, shard_slots, seed)
    return drawn.groupBy("rank", "block").agg(F.count("*").alias("times"), F.min("shard").alias("first_shard"))


def mixed_sources(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken, first_shard), one for each row of docs.

    docs: columns doc_id, text, source; others are not read. size counts words, null text has none and is never taken. Sources
    by code point, a null source last, weigh 5, 2, 1 and so on; targets share all words and stop at three times the source's
    size. taken counts the document's words in the blocks that were drawn, repeats included; first_shard is the first output
    shard that has some of them, null if none has. Repeated rows are documents of
    their own. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    counted, targets = sized_documents(docs, scratch)
    sized = scratch.keep(counted.join(targets, counted.source.eqNullSafe(targets.source)).select("rank", "doc_id", "size"))
    drawn = _drawn_blocks(targets, scratch, block_words, shard_slots, seed)
    taken = (
        packed_blocks(sized, block_words)
        .join(drawn.hint("merge"), ["rank", "block"], "left")
        .groupBy("rank", "start", "doc_id", "size")
        .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"), F.min("first_shard").alias("first_shard"))
    )
    empty = sized.where("size = 0").select("rank", F.lit(-1).cast("bigint").alias("start"), "doc_id", "size", F.lit(0).cast("bigint").alias("taken"), F.lit(None).cast("bigint").alias("first_shard"))
    return (
        taken.select("rank", "start", "doc_id", "size", "taken", "first_shard")
        .union(empty)
        .join(targets, "rank")
        .select("doc_id", "size", "source_size", "target", "taken", "first_shard")
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix itself: documents with the columns of docs, each as often as its blocks were drawn at most.

    docs: columns doc_id, text, source, n_chars and any others. The k-th copy of a document has the words of those of its
    blocks that were drawn k times or more, joined by spaces; a copy that has all words is the unchanged text. n_chars follows
    the text. Documents without words and those whose blocks were never drawn don't come out, so null and empty texts don't;
    repeated rows are documents of their own. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mixture")
    rows = scratch.keep(docs.withColumn("mix_row", F.monotonically_increasing_id()))
    counted = scratch.keep(rows.select("mix_row", "source", F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("size")).where("size > 0"))
    targets = scratch.keep(source_targets(counted))
    sized = counted.join(targets, counted.source.eqNullSafe(targets.source)).select("rank", F.col("mix_row").alias("doc_id"), "size")
    drawn = _drawn_blocks(targets, scratch, block_words, SHARD_SLOTS, seed).select("rank", "block", F.col("times").cast("int").alias("times"))
    first = F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0)).cast("int").alias("first")
    taken = (
        packed_blocks(sized, block_words)
        .join(drawn.hint("merge"), ["rank", "block"], "left")
        .select("doc_id", F.struct(first, F.col("words").cast("int").alias("words"), F.coalesce("times", F.lit(0)).alias("times")).alias("b"))
        .groupBy(F.col("doc_id").alias("mix_row"))
        .agg(F.array_sort(F.collect_list("b")).alias("mix_blocks"), F.min("b.times").alias("mix_least"), F.max("b.times").alias("mix_most"))
        .where("mix_most > 0")
    )
    words = F.regexp_extract_all("text", F.lit(WORD), 0)
    some = F.expr("flatten(transform(filter(mix_blocks, b -> b.times >= mix_copy), b -> slice(mix_words, b.first + 1, b.words)))")
    # words are cut below the generator, once a document: above it the optimizer would move the cutting into the loop over blocks
    cut = rows.join(taken, "mix_row").withColumn("mix_words", F.when(F.col("mix_least") < F.col("mix_most"), words))
    copies = cut.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_most"))))
    mixed = copies.withColumn("text", F.when(F.col("mix_least") >= F.col("mix_copy"), F.col("text")).otherwise(F.array_join(some, " ")))
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)
