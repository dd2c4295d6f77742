"""Skew-safe ordered scans equal plain windows, also when one group holds most rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from thawline.operators.scan import ffill_within, ordinal_within


def skewed(spark):
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 13).cast("string")))
        .alias("g"), F.col("id").alias("o"),
        F.when(F.col("id") % 37 == 0, F.col("id")).alias("v"))
    return df


def test_ordinal_within_matches_row_number(spark):
    df = skewed(spark)
    got = ordinal_within(df, ["g"], ["o"], "n", n_parts=16)
    exp = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert got.select("g", "o", "n").exceptAll(exp.select("g", "o", "n")).count() == 0
    assert got.count() == df.count()


def test_ffill_within_matches_last_ignore_nulls(spark):
    df = skewed(spark)
    got = ffill_within(df, ["g"], ["o"], ["v"], n_parts=16)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("v", F.last("v", ignorenulls=True).over(w))
    assert got.select("g", "o", "v").exceptAll(exp.select("g", "o", "v")).count() == 0
