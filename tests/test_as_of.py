"""A report as of a day is the same whether or not later rows are there."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from subscope.functions.exprs import recent_rows, snapshot, until
from subscope.operators import dashboards, features, kpis

DAY = "2024-01-16"

EARLY = [
    {"user_id": "a", "timestamp": "2024-01-03T08:00:00", "session_id": "a1"},
    {"user_id": "a", "timestamp": "2024-01-16T23:59:59", "session_id": "a2", "action_type": "page_view"},
    {"user_id": "b", "timestamp": "2024-01-10T00:00:00", "session_id": "b1"},
]
LATE = [
    {"user_id": "a", "timestamp": "2024-01-17T00:00:00", "session_id": "a3"},
    {"user_id": "c", "timestamp": "2024-01-30T00:00:00", "session_id": "c1"},
]
SUBS = [
    {"user_id": "a", "subscription_start": "2023-11-01"},
    {"user_id": "b", "subscription_start": "2023-12-01", "subscription_end": "2024-01-16", "churn_reason": "price"},
    {"user_id": "c", "subscription_start": "2023-12-05"},
]
# The same subscriptions as they look later: one has ended meanwhile, another has begun.
LATER = [
    SUBS[0],
    SUBS[1],
    SUBS[2] | {"subscription_end": "2024-01-20", "churn_reason": "support"},
    {"user_id": "d", "subscription_start": "2024-01-17"},
]


def same(left, right):
    return left.columns == right.columns and sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.mark.parametrize(
    "operator", [features.engagement_features, features.activity_recency, kpis.weekly_engagement_trend]
)
def test_later_actions_change_nothing(make, operator):
    assert same(operator(make.behavior(*EARLY), DAY), operator(make.behavior(*EARLY, *LATE), DAY))


@pytest.mark.parametrize(
    "operator",
    [
        features.subscription_lifecycle,
        dashboards.retention_funnel,
        dashboards.cohort_retention,
        kpis.monthly_churn_trend,
    ],
)
def test_later_subscriptions_change_nothing(make, operator):
    assert same(operator(make.subscriptions(*SUBS), DAY), operator(make.subscriptions(*LATER), DAY))


def test_matrix_of_a_day(make):
    one = features.feature_matrix(make.behavior(*EARLY), make.subscriptions(*SUBS), DAY)
    two = features.feature_matrix(make.behavior(*EARLY, *LATE), make.subscriptions(*LATER), DAY)
    assert same(one, two)


def test_the_day_itself_counts(make):
    assert until(make.behavior(*EARLY, *LATE), DAY).count() == 3
    ended = {r.user_id: r.is_churned for r in snapshot(make.subscriptions(*LATER), DAY).collect()}
    assert ended == {"a": False, "b": True, "c": False}
    assert features.activity_recency(make.behavior(*EARLY), DAY).agg(F.min("days_since_last_session")).head()[0] == 0


def test_partition_columns_are_only_used_where_they_are_the_layers_own(spark):
    row = [(dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10), dt.date(1999, 1, 1), "x")]
    df = spark.createDataFrame(row, "timestamp timestamp_ntz, seen_at timestamp_ntz, month date, event_date string")
    assert recent_rows(df, DAY, 30).count() == 1
    assert recent_rows(df, DAY, 30, "seen_at").count() == 1
    assert recent_rows(df, DAY, 30, "seen_at", ("month", "month")).count() == 0
