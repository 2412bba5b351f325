"""Token counts: the exact histogram of encoded lengths, and what its suffix sums answer for every context limit.

Every document is encoded whole. Lengths are counted where the texts are read, so what is shuffled is a few counts per
task, and a length that a third of all documents have is one row per batch of rows. The histogram has as many rows as
there are different lengths. Running sums go over blocks of lengths, then over the blocks' sums.

Defined results: a null text counts as empty, an empty text has no tokens; repeated rows count each; no documents give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from predia.llm.common import settle
from predia.llm.vocabulary import SPECIAL, encoder, shared_ranks

BLOCK = 4096


def histogram(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """n_tokens, n_docs: how many documents have each encoded length."""
    shared = shared_ranks(docs.sparkSession, vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, special = encoder(shared.value), set(SPECIAL)
        for batch in batches:
            lengths = [len(encode.encode_to_numpy(t.as_py() or "", allowed_special=special)) for t in batch["text"]]
            sizes, counts = np.unique(np.array(lengths, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(counts.astype(np.int64))], ["n_tokens", "n"])

    return (docs.select("text").mapInArrow(counted, "n_tokens long, n long")
            .groupBy("n_tokens").agg(F.sum("n").alias("n_docs")))


def length_table(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per length, with the sums of all lengths from it on and up to it.

    n_tokens, n_docs; docs_from and tokens_from: documents of at least this length and their tokens; docs_to: documents
    of at most this length; tokens_within: what is left of all tokens if every document is cut at this length.
    """
    counts = settle(histogram(docs, vocabulary).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
                    .withColumn("block", F.floor(F.col("n_tokens") / BLOCK)), "lengths")
    blocks = counts.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    after = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
                          F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"))
    total = counts.agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("tokens")).first()
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    docs_from = F.sum("n_docs").over(inside) + F.col("docs_after")
    tokens_from = F.sum("tokens").over(inside) + F.col("tokens_after")
    return (counts.join(after, "block").withColumn("docs_from", docs_from).withColumn("tokens_from", tokens_from)
            .select("n_tokens", "n_docs", "docs_from", "tokens_from",
                    (F.lit(total["docs"]) - F.col("docs_from") + F.col("n_docs")).alias("docs_to"),
                    (F.lit(total["tokens"]) - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from"))
                    .alias("tokens_within")))


def within_limits(lengths: DataFrame, limits: list[int]) -> DataFrame:
    """Documents that fit, and tokens that are left, for any context limits: context, docs_to, tokens_within.

    The first length from a limit on has all documents that the limit cuts, so each limit reads one row.
    """
    total = lengths.agg(F.coalesce(F.max("docs_to"), F.lit(0)).alias("docs"),
                        F.coalesce(F.max("tokens_within"), F.lit(0)).alias("tokens")).first()
    asked = lengths.sparkSession.createDataFrame([(int(x),) for x in sorted(set(limits))], "context long")
    limit = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context")
    reached = (lengths.select("n_tokens", "n_docs", "docs_from", "tokens_from", limit).where("n_tokens >= context")
               .groupBy("context").agg(F.min(F.struct("n_tokens", "n_docs", "docs_from", "tokens_from")).alias("first")))
    fits = F.when(F.col("first.n_tokens") == F.col("context"), F.col("first.n_docs")).otherwise(0)
    return asked.join(reached, "context", "left").select(
        "context", (F.lit(total["docs"]) - F.coalesce(F.col("first.docs_from") - fits, F.lit(0))).alias("docs_to"),
        (F.lit(total["tokens"]) - F.coalesce(F.col("first.tokens_from") - F.col("context") * F.col("first.docs_from"),
                                             F.lit(0))).alias("tokens_within"))


def quantiles(lengths: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least a share of the documents does not exceed: share, n_tokens."""
    total = lengths.agg(F.max("docs_to")).first()[0] or 0
    picked = [F.min(F.when(F.col("docs_to") >= share * total, F.col("n_tokens"))).alias(f"q{i}")
              for i, share in enumerate(shares)]
    row = lengths.agg(*picked).first()
    return lengths.sparkSession.createDataFrame([(float(s), row[i]) for i, s in enumerate(shares)],
                                                "share double, n_tokens long")
