"""Audits on hand-made rows."""

from pyspark.sql import functions as F

from lexispark.operators import audits


def test_truncation(spark):
    df = spark.createDataFrame([(29.5, 30.0), (29.4, 30.0), (40.0, 0.0), (40.0, -1.0), (None, 30.0), (40.0, None)], "d double, cap double")
    assert [r[0] for r in df.select(audits.is_truncated(F.col("d"), F.col("cap"))).collect()] == [True, False, False, False, False, False]


def test_counts(spark):
    df = spark.createDataFrame([("a", "x y", "x y"), ("a", None, None), ("b", "x", "z"), ("b", None, "q")], "term string, old string, new string")
    assert [tuple(r) for r in audits.leak_counts(df, "term", F.col("new") == "z").collect()] == [("b", 2, 1)]
    assert tuple(audits.change_counters(df, F.col("old"), F.col("new"), F.col("new").contains(" "), F.col("new") == "q").first()) == (4, 2, 1, 1)
    assert audits.leak_counts(df.limit(0), "term", F.lit(True)).count() == 0


def test_cheapest_first(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", None), ("d", 0.5)], "name string, price double")
    assert [r["name"] for r in audits.cheapest_first(df, F.col("price"), F.col("name")).orderBy("place").collect()] == ["d", "a", "b", "c"]
