"""Bucketed global order equals the single-window answer, also with one hot group."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from propensity.functions.order import cumulative_within, row_number_within, score_bucket


def test_row_number_and_lag_match_plain_window(spark):
    rng = random.Random(7)
    rows = [(i, 1 if rng.random() < 0.4 else rng.randrange(2, 50), rng.randrange(0, 400)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g long, d long")
    got = row_number_within(df, ["g"], [F.col("d"), F.col("id")], F.floor(F.col("d") / 37), out="rn",
                            lag_of="d", lag_out="prev")
    w = Window.partitionBy("g").orderBy("d", "id")
    ref = df.select("id", F.row_number().over(w).alias("rn2"), F.lag("d").over(w).alias("prev2"))
    bad = got.join(ref, "id").filter((F.col("rn") != F.col("rn2")) | ~F.col("prev").eqNullSafe(F.col("prev2")))
    assert bad.count() == 0


def test_cumulative_matches_plain_window(spark):
    rng = random.Random(3)
    rows = [("a" if i % 3 else "b", round(rng.random(), 4), rng.randrange(5), rng.randrange(5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, p double, x long, y long").groupBy("g", "p").agg(
        F.sum("x").alias("x"), F.sum("y").alias("y"))
    got = cumulative_within(df, ["g"], "p", score_bucket(F.col("p"), 64), {"cx": "x", "cy": "y"}, descending=True)
    w = Window.partitionBy("g").orderBy(F.col("p").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("g", "p", F.sum("x").over(w).alias("rx"), F.sum("y").over(w).alias("ry"))
    bad = got.join(ref, ["g", "p"]).filter((F.col("cx") != F.col("rx")) | (F.col("cy") != F.col("ry")))
    assert bad.count() == 0 and got.count() == df.count()


def test_day_bucket_hot_customer(spark):
    from propensity.functions.order import day_bucket
    rows = [(i, 7 if i % 3 else i % 50, f"2020-0{1 + i % 3}-1{i % 10}") for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, c long, d string").withColumn("d", F.to_timestamp("d"))
    got = row_number_within(df, ["c"], [F.col("d"), F.col("k")], day_bucket(F.col("d")),
                            out="rn", lag_of="d", lag_out="prev")
    w = Window.partitionBy("c").orderBy("d", "k")
    ref = df.select("k", F.row_number().over(w).alias("rn2"), F.lag("d").over(w).alias("prev2"))
    bad = got.join(ref, "k").filter((F.col("rn") != F.col("rn2")) | ~F.col("prev").eqNullSafe(F.col("prev2")))
    assert bad.count() == 0
