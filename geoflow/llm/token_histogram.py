"""Token counts of a corpus as an exact histogram of document lengths."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .wordbytes import slices

#: Fixed value: how texts are split before byte pairs are merged, for vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: the characters that the pattern takes for white space.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Longer runs of white space are encoded by themselves: the pattern would go back through them character by character.
LONG_RUN = 10_000
#: Lengths whose sums are taken together first.
SPAN = 1024
_ENCODINGS: dict[int, object] = {}


def _encoding(ranks: bytes):
    """The encoder of a vocabulary, made once in each Python process, and one that takes a whole text for one piece."""
    key = hash(ranks)
    if key not in _ENCODINGS:
        import tiktoken

        merges = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}
        _ENCODINGS[key] = tuple(tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=merges, special_tokens={}) for name, pattern in (("corpus", PATTERN), ("piece", r"[\s\S]+")))
    return _ENCODINGS[key]


def pieces(text: str, long_run: int = LONG_RUN) -> Iterator[tuple[bool, str]]:
    """Parts of a text that can be encoded one by one, and whether each is one piece of white space.

    Of a run of white space the pattern takes all but the last character as a piece, and that character goes with what
    follows; at the end of the text the whole run is one piece. No piece reaches over such a place.
    """
    at = 0
    for run in re.finditer(f"[{WHITE}]{{{long_run},}}", text):
        yield False, text[at : run.start()]
        at = run.end() - (run.end() < len(text))
        yield True, text[run.start() : at]
    yield False, text[at:]


def count_tokens(text: str, encoders: tuple, long_run: int = LONG_RUN) -> int:
    by_pattern, whole = encoders
    return sum(len((whole if white else by_pattern).encode_ordinary(part)) for white, part in pieces(text, long_run))


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Rows (doc_id, n_tokens): tokens of every whole text; null and empty texts have none, repeated rows are counted one by one.

    docs: columns doc_id, text; others are not read. An empty table gives no rows.

    vocabulary: a file of byte-pair ranks (a base64 token and its rank on each line), which the driver reads; its content,
    about a megabyte, goes to the executors.
    """
    with open(vocabulary, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoding(ranks.value)
        for rows, texts in slices(batches):
            counts = [count_tokens(t.decode(), encoders) for t in texts]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_tokens bigint")


def length_histogram(counts: DataFrame) -> DataFrame:
    """Rows (n_tokens, n_docs, docs_up_to, docs_longer, tokens_up_to, tokens_longer, truncated_total, quantile) for every length.

    truncated_total is what is left of all documents if each is cut to n_tokens; quantile is the share of documents that are
    no longer. Sums run over spans of lengths first and within a span second, so no task sees more than one span, or one row
    for each span. counts: rows with n_tokens, others are not read; null counts as 0. No rows give no rows.
    """
    rows = counts.groupBy(F.coalesce("n_tokens", F.lit(0).cast("bigint")).alias("n_tokens")).agg(F.count("*").alias("n_docs"))
    # written once: both kinds of sums read it, and counting the tokens is the costly part
    rows = Scratch(counts.sparkSession, "lengths").keep(rows)
    rows = rows.withColumn("span", F.expr(f"n_tokens div {SPAN}")).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    spans = rows.groupBy("span").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("sum"))
    later = Window.orderBy(F.col("span").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    spans = spans.select(
        "span",
        F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("sum").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("docs").over(everything).alias("all_docs"),
        F.sum("sum").over(everything).alias("all_tokens"),
    )
    longer = Window.partitionBy("span").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    suffix = (
        rows.withColumn("docs_here", F.coalesce(F.sum("n_docs").over(longer), F.lit(0)))
        .withColumn("tokens_here", F.coalesce(F.sum("tokens").over(longer), F.lit(0)))
        .join(spans, "span")
        .withColumn("docs_longer", F.col("docs_here") + F.col("docs_after"))
        .withColumn("tokens_longer", F.col("tokens_here") + F.col("tokens_after"))
    )
    return suffix.select(
        "n_tokens", "n_docs",
        (F.col("all_docs") - F.col("docs_longer")).alias("docs_up_to"),
        "docs_longer",
        (F.col("all_tokens") - F.col("tokens_longer")).alias("tokens_up_to"),
        "tokens_longer",
        (F.col("all_tokens") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_longer")) / F.col("all_docs")).alias("quantile"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Rows (context, truncated_total, docs_cut) for any context limits, which need not be lengths that occur."""
    sums = []
    for i, x in enumerate(limits):
        sums.append(F.coalesce(F.sum(F.least("n_tokens", F.lit(int(x)).cast("bigint")) * F.col("n_docs")), F.lit(0)).alias(f"t{i}"))
        sums.append(F.coalesce(F.sum(F.when(F.col("n_tokens") > int(x), F.col("n_docs"))), F.lit(0)).alias(f"c{i}"))
    rows = [
        F.struct(F.lit(int(x)).cast("bigint").alias("context"), F.col(f"t{i}").alias("truncated_total"), F.col(f"c{i}").alias("docs_cut"))
        for i, x in enumerate(limits)
    ]
    return histogram.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def length_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """Rows (share, n_tokens): the smallest length that this share of all documents doesn't exceed."""
    picks = [F.min(F.when(F.col("quantile") >= F.lit(float(s)), F.col("n_tokens"))).alias(f"q{i}") for i, s in enumerate(shares)]
    pairs = [F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, s in enumerate(shares)]
    return histogram.agg(*picks).select(F.explode(F.array(*pairs)).alias("p")).select("p.share", "p.n_tokens")
