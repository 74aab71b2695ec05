"""Trailing means across midnight."""

from pyspark.sql import functions as F

from tidemark.operators import metrics


def test_means_go_on_over_midnight(spark):
    df = spark.createDataFrame([(86_395,), (86_399,), (86_400,), (86_450,)], "s long").select(F.timestamp_seconds("s").alias("ts"))
    got = {r.second: (r.marks, round(r.mean_10s * 10), round(r.mean_60s * 60)) for r in metrics.rates(df, "ts", F.lit(1)).collect()}
    assert got == {86_395: (1, 1, 1), 86_399: (1, 2, 2), 86_400: (1, 3, 3), 86_450: (1, 1, 4)}


def test_averages_decay_by_the_second(spark):
    import math

    marks = {0: 5, 1: 2, 7: 1, 500: 3, 100_000: 4}
    df = spark.createDataFrame([(s, n) for s, n in marks.items()], "s long, n long").select(F.timestamp_seconds("s").alias("ts"), "n")
    got = {r.second: r for r in metrics.smoothed(df, "ts", F.col("n")).collect()}
    for span in (1, 10, 60):
        average, alpha = None, 1 - math.exp(-1 / span)
        for second in range(1001):
            n = marks.get(second, 0)
            average = n if average is None else average + alpha * (n - average)
            if second in marks:
                assert abs(got[second][f"ewma_{span}s"] - average) < 1e-9
        assert abs(got[100_000][f"ewma_{span}s"] - alpha * 4) < 1e-9
