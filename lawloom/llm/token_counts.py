"""Exact histogram of encoded lengths with suffix sums.

The histogram (one row a length) is all that later questions need: totals,
quantiles and totals under truncation come from sums over the lengths above.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.encode import encoder, text_blocks
from lawloom.llm.scratch import stored

BLOCK = 1024


def token_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens) of every whole text; null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            for part in text_blocks(b):
                got = enc.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array([len(x) // enc.width for x in got], pa.int64())], names=["doc_id", "n_tokens"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row for each length that occurs, with what a context limit of that length means.

    n_tokens, n_docs, tokens (of those documents), docs_at_least and tokens_at_least (suffix sums),
    truncated_total (ids that remain when every document is cut at n_tokens), docs_cut (longer ones)
    and quantile (share of documents no longer). Suffix sums go by blocks of 1024 lengths, then inside
    each block, so no task sees more than a block's lengths or the list of blocks.
    An empty table gives no rows.
    """
    hist = lengths.where("n_tokens is not null").groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    hist = stored(hist, "lengths")  # read twice below; without it every text would be encoded twice
    hist = hist.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("block", F.expr(f"n_tokens div {BLOCK}"))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_above"), F.sum("d").over(everything).alias("all_docs"), F.sum("t").over(everything).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = hist.join(blocks, "block").select(
        "n_tokens", "n_docs", "tokens", "all_docs", "all_tokens",
        (F.sum("n_docs").over(inside) + F.col("d_above")).alias("docs_at_least"),
        (F.sum("tokens").over(inside) + F.col("t_above")).alias("tokens_at_least"),
    )
    above = F.col("docs_at_least") - F.col("n_docs")
    return out.select(
        "n_tokens", "n_docs", "tokens", "docs_at_least", "tokens_at_least",
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
        above.alias("docs_cut"),
        ((F.col("all_docs") - above) / F.col("all_docs")).alias("quantile"),
    )


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, truncated_total, docs_cut) for any context limits, from the histogram alone."""
    ask = hist.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit long")
    per = [F.sum(F.least(F.col("n_tokens"), F.lit(int(x))) * F.col("n_docs")).alias(f"t{i}") for i, x in enumerate(limits)]
    cut = [F.sum(F.when(F.col("n_tokens") > x, F.col("n_docs")).otherwise(0)).alias(f"c{i}") for i, x in enumerate(limits)]
    row = hist.agg(*per, *cut)
    pick = F.array(*[F.struct(F.lit(int(x)).cast("long").alias("context_limit"), F.coalesce(F.col(f"t{i}"), F.lit(0)).alias("truncated_total"), F.coalesce(F.col(f"c{i}"), F.lit(0)).alias("docs_cut")) for i, x in enumerate(limits)])
    return ask.join(row.select(F.inline(pick)), "context_limit")


def length_quantile(hist: DataFrame, q: float) -> DataFrame:
    """The least length that at least a share ``q`` of the documents does not exceed."""
    return hist.where(F.col("quantile") >= q - 1e-12).agg(F.min("n_tokens").alias("n_tokens"))
