"""Helpers shared by the training-data operators: table access and lineage cuts in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset in local mode (tests on one machine), a new temporary folder that is then set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_scratch: list[list[Cut]] = []


@contextmanager
def scratch():
    """Deletes at its end the tables that were cut inside, except those made to be ``kept``."""
    _scratch.append([])
    try:
        yield
    finally:
        for c in _scratch.pop():
            c.drop()


class Cut:
    """A table written to the shared folder and read back: its lineage ends there, so a lost executor costs no recomputation."""

    def __init__(self, df: DataFrame, kept: bool = False):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/cut-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        if _scratch and not kept:
            _scratch[-1].append(self)

    def drop(self) -> None:
        """Deletes the files, once nothing lazy reads them any more."""
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    return Cut(df).df


#: A side of a join is broadcast up to this many counted rows.
SMALL = 200_000
SALTS = 32
HOT_ROWS, HOT_KEYS = 1000, 100_000


def hot_join(large: DataFrame, small: DataFrame, on: str, total: int) -> DataFrame:
    """An inner join with a table that has one row for each key and, as ``n``, how many rows of ``large`` have it, ``total`` in all. Keys of many rows go by broadcast: no more than ``HOT_KEYS`` have so many. The others are merged, whatever their size seems: it grows with the input, and a broadcast stands in the driver. ``n`` is dropped."""
    least = max(HOT_ROWS, total // HOT_KEYS)
    found = small.where(F.col("n") > least).drop("n")
    if total <= least or found.isEmpty():
        return large.join(small.drop("n").hint("merge"), on)
    hot = F.broadcast(found)
    cool = large.join(hot.select(on), on, "left_anti").join(small.where(F.col("n") <= least).drop("n").hint("merge"), on)
    return large.join(hot, on).unionByName(cool)


def spread_join(large: DataFrame, small: DataFrame, on: list[str], rows: int, by: list[str], how: str = "inner") -> DataFrame:
    """Joins with a table of ``rows`` counted rows, unique or few by key: by broadcast while it is small, beyond that with a salt made of the columns ``by``, so that the rows of a hot key go to ``SALTS`` tasks. A null key meets nothing."""
    if rows <= SMALL:
        return large.join(F.broadcast(small), on, how)
    salted = large.withColumn("__salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)))
    return salted.join(small.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))).hint("merge"), [*on, "__salt"], how).drop("__salt")


def sha256_hex(col) -> "F.Column":
    return F.sha2(F.encode(col, "UTF-8"), 256)
