"""Exact token-length histogram: documents by encoded length; suffix sums answer every context limit.

Defined results: null text counts as an empty document of length 0; an empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .common import cut

SPAN = 1024


def lengths(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """One row per document: n_tokens."""

    def run(batches):
        enc = encoder(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(enc.counts(t.as_py() for t in b.column("t")), pa.int64())], ["n_tokens"])

    return docs.select(F.col(text_col).alias("t")).mapInArrow(run, "n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """For each distinct length: n_docs; docs and tokens of that length or more; tokens of shorter documents;
    truncated_total, all tokens left when every document is cut at this length; and at_most, the share of documents no longer.

    The suffix sums take two levels, so no task sees all lengths: totals of spans of lengths, then sums inside a span.
    """
    # written once: both levels read it, and the corpus is encoded a single time
    counts = cut(counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs")).withColumn("span", F.floor(F.col("n_tokens") / SPAN)))
    spans = counts.groupBy("span").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    over = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = spans.select("span", F.coalesce(F.sum("d").over(over), F.lit(0)).alias("d_over"), F.coalesce(F.sum("t").over(over), F.lit(0)).alias("t_over"), F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"))
    inside = Window.partitionBy("span").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = counts.join(spans, "span").withColumns({"docs_at_least": F.col("d_over") + F.sum("n_docs").over(inside), "tokens_at_least": F.col("t_over") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside)})
    return out.select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", (F.col("t_all") - F.col("tokens_at_least")).alias("tokens_below"), (F.col("t_all") - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("n_tokens")).alias("truncated_total"), ((F.col("d_all") - F.col("docs_at_least") + F.col("n_docs")) / F.col("d_all")).alias("at_most"))


def truncated_total(hist: DataFrame, limit: int) -> int:
    """Tokens left when documents are cut at any ``limit``: shorter documents whole, the others at the limit."""
    got = hist.agg(F.sum(F.col("n_docs") * F.least("n_tokens", F.lit(limit))).alias("n")).first()["n"]
    return int(got or 0)


def quantile(hist: DataFrame, q: float) -> int | None:
    """The least length that at least the share ``q`` of documents do not exceed."""
    return hist.where(F.col("at_most") >= q).agg(F.min("n_tokens").alias("n")).first()["n"]
