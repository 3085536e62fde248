"""Exact deduplication by deterministic block naming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

BLOCK_CHARS = 4096
#: Fixed value: the pattern of white space that counts as one space.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def route(block: Column, attempt: int) -> Column:
    """128 bits that lead a block to its name; another attempt gives other bits."""
    return F.struct(F.xxhash64(F.lit(2 * attempt), block).alias("h1"), F.xxhash64(F.lit(2 * attempt + 1), block).alias("h2"))


def _named(values: DataFrame) -> DataFrame:
    """Different rows, sorted within their partition and numbered: equal values have one name, different ones never share it."""
    return values.distinct().sortWithinPartitions(*values.columns).withColumn("name", F.monotonically_increasing_id())


def document_names(
    docs: DataFrame, scratch: Scratch, block_chars: int = BLOCK_CHARS, routed: Callable[[Column, int], Column] = route
) -> DataFrame:
    """Rows (row, doc_id, sha256, round, name): texts are equal, after normalising white space, exactly if (round, name) are.

    Texts are cut into blocks; the different blocks are sorted and numbered. Then the names of neighbouring blocks are taken
    in pairs, the different pairs sorted and numbered again, until a document has one name left. The name of round r stands
    for one sequence of up to 2^r blocks and no other, so no hash decides which documents are equal: hashes only lead blocks
    back to their names, and are drawn anew if two different blocks share one.
    """
    text = normalised(F.col("text"))
    cut = F.regexp_extract_all("t", F.lit(f"(?s).{{1,{block_chars}}}"), 0)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("t"))
    blocks = F.when(F.length("t") == 0, F.array(F.lit(""))).otherwise(cut)
    attempt = 0
    while True:
        names = scratch.keep(
            _named(texts.select(F.explode(blocks).alias("block"))).select("name", routed(F.col("block"), attempt).alias("hash"))
        )
        if names.groupBy("hash").count().where("count > 1").isEmpty():
            break
        scratch.drop(names)
        attempt += 1
    rows = scratch.keep(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.unhex(F.sha2("t", 256)).alias("sha256"),
            F.transform(blocks, lambda b: routed(b, attempt)).alias("hashes"),
        )
    )
    level = scratch.keep(
        rows.select("row", F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "hash"))
        .join(names, "hash")
        .select("row", "n", "pos", "name")
    )
    scratch.drop(names)
    done, turn = [], 0
    while True:
        done.append(level.where("n = 1").select("row", F.lit(turn).alias("round"), "name"))
        pairs = (
            level.where("n > 1")
            .groupBy("row", F.shiftright("pos", 1).alias("pos"))
            .agg(
                F.first("n").alias("n"),
                F.max(F.expr("if(pos % 2 = 0, name, null)")).alias("a"),
                F.coalesce(F.max(F.expr("if(pos % 2 = 1, name, null)")), F.lit(-1).cast("bigint")).alias("b"),
            )
        )
        pairs = scratch.keep(pairs)
        if pairs.isEmpty():
            break
        named = scratch.keep(_named(pairs.select("a", "b")))
        level = scratch.keep(pairs.join(named, ["a", "b"]).select("row", F.expr("shiftright(n + 1, 1)").alias("n"), "pos", "name"))
        scratch.drop(pairs, named)
        turn += 1
    names = done[0]
    for x in done[1:]:
        names = names.union(x)
    return rows.select("row", "doc_id", "sha256").join(names, "row")


def exact_duplicates(
    docs: DataFrame, block_chars: int = BLOCK_CHARS, routed: Callable[[Column, int], Column] = route
) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one for each row of docs.

    docs: columns doc_id, text; others are not read. Null counts as the empty text. Of equal texts the row with the smallest
    doc_id stays, a null doc_id last; of repeated rows with that doc_id one is kept. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    named = scratch.keep(document_names(docs, scratch, block_chars, routed))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")
    groups = scratch.keep(named.groupBy("round", "name").agg(first, F.count("*").alias("group_size")))
    return named.join(groups, ["round", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )
