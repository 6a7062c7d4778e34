"""Operator 8 - token counts from an exact length histogram.

Documents are aggregated by encoded length; the histogram is tiny next to the
corpus, and its suffix sums answer totals, quantiles and truncated totals for
every context limit exactly.  Between two occurring lengths a < L < b the
truncated total is linear: ``truncated_tokens(a) + (L - a) * docs_longer(a)``.

Running sums are taken within blocks of ``BLOCK`` consecutive lengths plus the
totals of the blocks, so no task holds all lengths.

Defined results: a null or empty text has length 0 and is counted; a table
without rows has an empty histogram; repeated rows count each time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm import bpe

BLOCK = 1024


def token_lengths(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, the encoded length of each whole text."""
    return bpe.encode(docs, tokenizer_path, text_col, ids_col=None)


def length_histogram(lengths: DataFrame, by: tuple[str, ...] = (), length_col: str = "n_tokens") -> DataFrame:
    """One row per occurring length (and per group of ``by``): ``length``, ``n_docs``."""
    return lengths.groupBy(*by, F.coalesce(F.col(length_col), F.lit(0)).cast("long").alias("length")).agg(F.count("*").alias("n_docs"))


def context_totals(histogram: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The histogram with what each length answers when it is taken as the context limit.

    ``docs_at_most``, ``share_at_most`` (for quantiles), ``docs_longer``,
    ``tokens_at_most``, ``tokens_longer`` (whole texts) and
    ``truncated_tokens``: all tokens left when each text is cut to the limit.
    """
    block = F.floor(F.col("length") / BLOCK).alias("block")
    h = histogram.withColumn("block", block).withColumn("tokens", F.col("length") * F.col("n_docs"))
    blocks = h.groupBy(*by, "block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    before = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    blocks = blocks.select(
        *by,
        "block",
        F.coalesce(F.sum("b_docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("b_tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("b_docs").over(whole).alias("all_docs"),
        F.sum("b_tokens").over(whole).alias("all_tokens"),
    )
    same = F.lit(True)
    right = blocks
    for c in (*by, "block"):
        right = right.withColumnRenamed(c, f"__{c}")
        same = same & h[c].eqNullSafe(F.col(f"__{c}"))
    w = Window.partitionBy(*by, "block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    docs_at_most = F.col("docs_before") + F.sum("n_docs").over(w)
    tokens_at_most = F.col("tokens_before") + F.sum("tokens").over(w)
    out = h.join(right, same).withColumn("docs_at_most", docs_at_most).withColumn("tokens_at_most", tokens_at_most)
    return out.select(
        *by,
        "length",
        "n_docs",
        "docs_at_most",
        (F.col("docs_at_most") / F.col("all_docs")).alias("share_at_most"),
        (F.col("all_docs") - F.col("docs_at_most")).alias("docs_longer"),
        "tokens_at_most",
        (F.col("all_tokens") - F.col("tokens_at_most")).alias("tokens_longer"),
        (F.col("tokens_at_most") + F.col("length") * (F.col("all_docs") - F.col("docs_at_most"))).alias("truncated_tokens"),
    )


def limit_report(histogram: DataFrame, limits: list[int], by: tuple[str, ...] = ()) -> DataFrame:
    """Totals for given context limits: one row per limit with ``n_docs``, ``docs_cut`` and ``tokens``."""
    limit = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("limit")
    return (
        histogram.select("*", limit)
        .groupBy(*by, "limit")
        .agg(
            F.sum("n_docs").alias("n_docs"),
            F.sum(F.when(F.col("length") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_cut"),
            F.sum(F.least("length", "limit") * F.col("n_docs")).alias("tokens"),
        )
    )


def quantiles(totals: DataFrame, shares: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """For each share, the smallest length that at least this share of the documents does not exceed."""
    share = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    return (
        totals.select(*by, "length", "share_at_most", share)
        .filter(F.col("share_at_most") >= F.col("share"))
        .groupBy(*by, "share")
        .agg(F.min("length").alias("length"))
    )
