"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark decontamination, BPE round trip.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents. ``run`` writes each stage's
rows to the shared folder as Parquet and hands the reread table to the next; what a stage has stored on its way is then
deleted, and a stage's rows once the next one's are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadastra.llm import bpe, decontaminate, language_id, line_dedup, simhash
from cadastra.llm.common import Cut, scratch, table
from cadastra.llm.queries import vocabulary


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or for which no language speaks, go; a missing language is filled in."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def lines_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.cleaned(docs)


def near_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, a similarity of 0.8 or more; the document with the least id of each group stays."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, vocabulary())


STAGES = [("language_id", identified), ("line_dedup", lines_deduped), ("simhash_near_dedup", near_deduped), ("decontamination", decontaminated), ("bpe", encoded)]

#: SQL can state neither the learned languages, nor the components, nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        with scratch():
            written = Cut(stage(spark, docs, sf_dir), kept=True)
        if held is not None:
            held.drop()
        docs, held = written.df, written
    return STAGES[-1][1](spark, docs, sf_dir)
