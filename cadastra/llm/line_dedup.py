"""Line dedup by site-relative frequency: lines that stand on more than a share of a host's pages are boilerplate.

A page counts a line once. Blank lines are never boilerplate, and a line has to stand on ``least`` pages at least.
Only hashes of lines (128 bits) are shuffled, with map-side counts. A host's boilerplate is short by its nature: shares
of one host add up to its mean number of lines, so there are at most that number over the ratio; the list goes to the
pages by broadcast while its counted size is small, and by a join on the host and a salt beyond that.

Defined results: null text stays null with no lines; a null host is a host; repeated rows are separate pages; a page of
boilerplate alone becomes the empty text; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, spread_join

#: A line of one page repeats nothing, so two pages are the least.
RATIO, LEAST = 0.1, 2


def line_key(line: Column) -> Column:
    """128 bits of a line without its outer white space."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """(host, keys): the boilerplate lines of each host that has any."""
    distinct = F.array_distinct(F.filter(F.transform(F.split(text_col, "\n", -1), lambda x: F.trim(x)), lambda x: x != ""))
    lines = pages.select(F.col(host_col).alias("host"), F.explode(F.transform(distinct, line_key)).alias("k"))
    counts = lines.groupBy("host", "k.a", "k.b").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    totals = pages.groupBy(F.col(host_col).alias("host_of")).agg(F.count("*").alias("pages"))
    bad = counts.join(totals, F.col("host").eqNullSafe(F.col("host_of"))).where(F.col("n") / F.col("pages") > ratio)
    return bad.groupBy("host").agg(F.collect_list(F.struct("a", "b")).alias("keys"))


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """(page, text, n_lines, n_dropped): each row whole, as the struct ``page``, and its text without the boilerplate lines."""
    bad = cut(boilerplate(pages, ratio, least, host_col, text_col))
    size = bad.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0)).alias("n")).first()["n"]
    # a null host becomes a key of its own, so that the join is on plain equality
    key = lambda c: F.struct(c.isNull().alias("none"), F.coalesce(c, F.lit("")).alias("host")).alias("host_key")
    rows = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("page"), key(F.col(host_col).cast("string")))
    rows = rows.withColumn("of", F.xxhash64("page"))
    both = spread_join(rows, bad.select(key(F.col("host").cast("string")), "keys"), ["host_key"], size, ["of"], "left")
    text = F.col("page")[text_col]
    kept = F.filter("lines", lambda x: (F.trim(x) == "") | ~F.array_contains("keys", line_key(x)))
    out = both.select("page", "keys", F.split(text, "\n", -1).alias("lines")).select("page", "lines", F.when(F.col("keys").isNull(), F.col("lines")).otherwise(kept).alias("kept"))
    count = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("long")
    return out.select("page", F.array_join("kept", "\n").alias("text"), count("lines").alias("n_lines"), (count("lines") - count("kept")).alias("n_dropped"))


def cleaned(pages: DataFrame, ratio: float = RATIO, least: int = LEAST, host_col: str = "source", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The pages, same columns, without boilerplate lines; a column of character counts is kept true."""
    out = drop_boilerplate(pages, ratio, least, host_col, text_col)
    new = {text_col: F.col("text"), chars_col: F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("page")[chars_col]) if chars_col in pages.columns else None}
    return out.select(*[(new[c].cast(pages.schema[c].dataType) if new.get(c) is not None else F.col("page")[c]).alias(c) for c in pages.columns])
