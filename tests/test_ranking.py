import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from subscope.functions import ranking

PROBABILITIES = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_equal_numpy(spark, seed):
    random.seed(seed)
    # One value holds a third of the rows; the others span negatives, zero and wide magnitudes.
    data = [7] * 300 + [random.choice([random.randint(-50, 50), random.randint(0, 10**9)]) for _ in range(600)]
    df = spark.createDataFrame([(v,) for v in data], "v long")
    got = ranking.percentiles(ranking.histogram(df, "v"), "v", PROBABILITIES).first().asDict()
    for name, p in PROBABILITIES.items():
        assert got[name] == pytest.approx(np.quantile(data, p), rel=1e-12)


def test_percentiles_per_group_with_null_group(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("a", 10), (None, 5), (None, 6), ("b", None)], "g string, v int"
    )
    hist = ranking.histogram(df, "v", ["g"])
    got = {row.g: row.p50 for row in ranking.percentiles(hist, "v", {"p50": 0.5}, ["g"]).collect()}
    assert got == {"a": 2.0, None: 5.5}


def test_running_totals_equal_window(spark):
    random.seed(1)
    data = [(random.choice("ab"), random.random() ** 4, random.randint(0, 1)) for _ in range(500)]
    data += [("a", 0.5, 1)] * 200
    df = spark.createDataFrame(data, "g string, s double, y int")
    hist = ranking.histogram(df, "s", ["g"], pos=F.col("y"))
    for row in ranking.running_totals(hist, "s", ["g"], ["n", "pos"]).collect():
        below = [(g, s, y) for g, s, y in data if g == row.g and s < row.s]
        assert row.n_before == len(below)
        assert row.pos_before == sum(y for _, _, y in below)
        assert row.n_total == sum(g == row.g for g, _, _ in data)


def test_bucket_is_monotone(spark):
    df = spark.range(-5000, 5000).select((F.pow(F.col("id") / 100.0, 3)).alias("v"))
    found = df.select("v", ranking.ordered_bucket(F.col("v")).alias("b")).orderBy("v").collect()
    buckets = [row.b for row in found]
    assert buckets == sorted(buckets)
