"""Tables written between stages: plans stay small, and a lost executor costs no recomputation."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the folder in spark.checkpoint.dir and read back; where that is unset in local mode, as in tests, to a new temporary folder."""
    spark = df.sparkSession
    home = spark.conf.get("spark.checkpoint.dir", None)
    if not home:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        home = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", home)
    path = f"{home.rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
