"""Parcel-shaped tables derived from the star-schema tables by arithmetic on keys: all shapes are axis-aligned boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import functions as K
from .operators.slope import box_column

ACRE = 4046.8564224


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shaped(df: DataFrame) -> DataFrame:
    """``geom`` from x0, y0, x1, y1, and its ``box``."""
    K.register(df.sparkSession)
    df = df.withColumn("geom", box_column(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return df.withColumn("box", F.struct(F.col("x0").alias("minx"), F.col("y0").alias("miny"), F.col("x1").alias("maxx"), F.col("y1").alias("maxy"), (w * h).alias("area"), (2 * (w + h)).alias("length"), ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy")))


_PARCEL_EXPRS = """
SELECT c_custkey AS k, concat('P', CAST(c_custkey AS {s})) AS account_id,
  CAST(700 * (c_custkey % 40) AS DOUBLE) AS x0,
  CAST(700 * (c_custkey {div} 40) + 18 + CASE WHEN c_custkey % 17 = 0 THEN 15 ELSE 0 END AS DOUBLE) AS y0,
  CAST(700 * (c_custkey % 40) + CASE WHEN c_custkey % 3 = 0 THEN 700 ELSE 400 + 20 * (c_custkey % 13) END AS DOUBLE) AS x1,
  CAST(700 * (c_custkey {div} 40) + 18 + 150 + 25 * (c_custkey % 15) AS DOUBLE) AS y1,
  CASE c_nationkey % 3 WHEN 0 THEN 'FRED' WHEN 1 THEN 'CARR' ELSE 'WASH' END AS county_code,
  concat('SMITH', CAST(c_custkey % 5 AS {s}), ' JOHN', CASE c_custkey % 8 WHEN 0 THEN ' A & MARY B' WHEN 1 THEN ' ET AL' WHEN 2 THEN ' FARMS L.L.C.' WHEN 3 THEN ' REV TRUST' WHEN 4 THEN ' DEVELOPMENT INC' WHEN 5 THEN ' CHURCH' WHEN 6 THEN ', JR' ELSE '' END) AS owner_name,
  concat(CAST(c_custkey % 97 AS {s}), ' Old Mill Road, P.O. Box ', CAST(c_custkey % 7 AS {s}), ' 21701-', CAST(1000 + c_custkey % 50 AS {s})) AS owner_mailing_address
FROM customer
"""
#: The same words in the two dialects.
PARCELS_SQL = _PARCEL_EXPRS.format(s="VARCHAR", div="//")
ENC_SQL = """
SELECT o_orderkey AS e, substring(o_orderpriority, 1, 1) AS layer, CAST((37 * o_orderkey) % 28000 AS DOUBLE) AS x0,
  CAST((91 * o_orderkey) % 28000 AS DOUBLE) AS y0, CAST((37 * o_orderkey) % 28000 + 50 + o_custkey % 200 AS DOUBLE) AS x1,
  CAST((91 * o_orderkey) % 28000 + 50 + o_orderkey % 150 AS DOUBLE) AS y1 FROM orders
"""
ZONES_SQL = """
SELECT n_nationkey AS z, CASE n_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'RC' ELSE 'R1' END AS code,
  CAST(1200 * n_nationkey AS DOUBLE) AS x0, CAST(0 AS DOUBLE) AS y0, CAST(1200 * (n_nationkey + 1) AS DOUBLE) AS x1, CAST(1000000 AS DOUBLE) AS y1 FROM nation
"""


def _sql(spark: SparkSession, sf_dir: str, text: str, source: str) -> DataFrame:
    return spark.sql(text.replace(f"FROM {source}", "FROM {src}"), src=table(spark, sf_dir, source))


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(_sql(spark, sf_dir, _PARCEL_EXPRS.format(s="STRING", div="div"), "customer"))


def top(spark: SparkSession, sf_dir: str) -> float:
    """The parcels' upper edge, a row above the highest: they reach as far north as there are customers."""
    return 700.0 * (table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0] or 0) // 40 + 1400.0


def encumbrances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(_sql(spark, sf_dir, ENC_SQL, "orders"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(_sql(spark, sf_dir, ZONES_SQL, "nation"))


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One road below each row of parcels."""
    # as an aggregate's result: tests of shapes made from a distinct column would be pushed below it and run for each customer
    row = F.expr("c_custkey div 40")
    rows = table(spark, sf_dir, "customer").groupBy(row.alias("of")).agg(F.max(row).alias("r")).drop("of")
    y = F.col("r") * 700.0
    return shaped(rows.select("r", F.lit(0.0).alias("x0"), y.alias("y0"), F.lit(28000.0).alias("x1"), (y + 18).alias("y1"), F.when(F.col("r") % 4 == 0, "state").otherwise("county").alias("authority"), (F.col("r") % 7 != 6).alias("public")))


ROADS_SQL = """
SELECT r, CAST(0 AS DOUBLE) AS x0, CAST(700 * r AS DOUBLE) AS y0, CAST(28000 AS DOUBLE) AS x1, CAST(700 * r + 18 AS DOUBLE) AS y1,
  CASE WHEN r % 4 = 0 THEN 'state' ELSE 'county' END AS authority, r % 7 <> 6 AS public FROM (SELECT DISTINCT c_custkey // 40 AS r FROM customer)
"""
