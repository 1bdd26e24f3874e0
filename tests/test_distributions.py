import random
from datetime import date

import numpy as np
from table_rows import rows
from pyspark.sql import functions as F

from subscope.operators import distributions, seasonality, validation


def test_bins_by_percent_rank_keep_ties_together(make):
    random.seed(3)
    counts = [random.randint(0, 40) for _ in range(150)] + [1] * 75
    views = make.pageviews(*[{"view_count": v, "page_title": str(i)} for i, v in enumerate(counts)])
    got = {int(row["page_title"]): row for row in rows(distributions.percentile_bins(views))}
    for i, v in enumerate(counts):
        place = sum(c < v for c in counts) * 10 / (len(counts) - 1)
        assert got[i]["bin"] == min(int(place) + 1, 10)
    assert got[len(counts) - 1]["bin_label"] == f"p{(got[224]['bin'] - 1) * 10:02d}-{got[224]['bin'] * 10:02d}"


def test_bins_of_single_row_and_nulls(make):
    views = make.pageviews({"view_count": 3}, {"project": "de", "view_count": None}, {"project": None, "view_count": 2})
    got = {row["project"]: row["bin"] for row in rows(distributions.percentile_bins(views))}
    assert got == {"en": 1, "de": None, None: 1}


def test_robust_stats_and_caps(make):
    counts = [1, 2, 3, 4, 100]
    views = make.pageviews(*[{"view_count": v} for v in counts])
    stats = distributions.robust_stats(views).first()
    assert (stats.p25, stats.median, stats.p75, stats.iqr) == (2.0, 3.0, 4.0, 2.0)
    capped = [row["capped_view_count"] for row in rows(distributions.cap_outliers(views))]
    assert max(capped) == np.quantile(counts, 0.95)
    assert len(capped) == 5


def test_log(make):
    assert distributions.log_transform(make.pageviews({"view_count": 0})).first().log_view_count == 0.0


def series(spark, values, start=date(2024, 1, 1)):
    data = [(date.fromordinal(start.toordinal() + i), v) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(data, "date date, value long")


def test_rolling_average_fills_missing_days(spark):
    got = rows(seasonality.rolling_averages(series(spark, [7, None, 5]), windows=(2,)).orderBy("date"))
    assert [(row["value"], row["avg_2d"]) for row in got] == [(7, 7.0), (0, 3.5), (5, 2.5)]


def test_decomposition_recovers_parts(spark):
    weekly = [0, 1, 2, 3, 2, 1, -9]
    values = [100 + 2 * i + weekly[i % 7] for i in range(35)]
    got = rows(seasonality.seasonal_decomposition(series(spark, values)).orderBy("date"))
    assert [row["trend"] is None for row in got[:4]] == [True, True, True, False]
    assert got[-1]["trend"] is None and got[-4]["trend"] is not None
    inner = got[7:28]
    assert all(abs(row["residual"]) < 0.5 for row in inner)
    assert inner[6]["seasonal"] < inner[3]["seasonal"]


def test_calendar(spark):
    holidays = spark.createDataFrame([(date(2024, 1, 1),)], "date date")
    got = rows(seasonality.calendar_features(series(spark, [1] * 7), holidays).orderBy("date"))
    assert [row["is_holiday"] for row in got] == [True] + [False] * 6
    assert [row["is_weekend"] for row in got] == [False] * 5 + [True] * 2


def test_minmax_of_a_constant_weekday_is_null(spark):
    got = rows(seasonality.seasonal_minmax(series(spark, [5, 1, 1, 1, 1, 1, 1, 9])).orderBy("date"))
    assert got[0]["scaled"] == 0.0 and got[-1]["scaled"] == 1.0 and got[1]["scaled"] is None


def test_validation_finds_each_violation(spark, make):
    views = make.pageviews({"view_count": -1}, {"view_count": 1, "access_method": "fax"}, {"view_count": None})
    behavior = make.behavior(
        {"user_id": "ghost", "duration_seconds": -5, "session_id": "s", "timestamp": "2024-01-02"},
        {"user_id": "ghost", "action_type": "jump", "session_id": "s", "timestamp": "2024-01-01"},
        {"user_id": "u", "session_id": "s", "timestamp": "2024-01-01"},
    ).withColumn("event_id", F.monotonically_increasing_id())
    subs = make.subscriptions(
        {"subscription_start": "2023-05-01", "subscription_end": "2023-04-01"},
        {"user_id": "v", "plan_type": "gold", "payment_method": None},
    )
    got = {
        (row["source"], row["rule"]): row["violations"]
        for row in rows(validation.bronze_validation(views, behavior, subs))
    }
    broken = {key: n for key, n in got.items() if n}
    assert broken == {
        ("pageviews", "view_count not null"): 1,
        ("pageviews", "view_count not negative"): 1,
        ("pageviews", "access_method in domain"): 1,
        ("behavior", "duration_seconds not negative"): 1,
        ("behavior", "action_type in domain"): 1,
        ("behavior", "user has a subscription"): 1,
        ("behavior", "timestamps in order"): 1,
        ("subscriptions", "end not before start"): 1,
        ("subscriptions", "plan_type in domain"): 1,
    }


def test_out_of_order_across_chunks(spark):
    """Brute force over one hot session split into small chunks."""
    random.seed(5)
    times = [random.randint(0, 1000) + 5 * i for i in range(200)]
    data = [("u", "s", i, t) for i, t in enumerate(times)]
    df = spark.createDataFrame(data, "user_id string, session_id string, event_id long, t long").select(
        "user_id", "session_id", "event_id", F.timestamp_seconds("t").alias("timestamp")
    )
    expected = sorted(i for i, t in enumerate(times) if i and t < max(times[:i]))
    got = validation.out_of_order(df, "event_id", chunk=16)
    assert sorted(row.event_id for row in got.collect()) == expected
