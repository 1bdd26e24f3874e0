"""As-of joins and features at many cutoffs against plain loops and single cutoffs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from subscope.operators import dashboards, features, point_in_time

START = datetime(2024, 1, 1)


def events(rng, n, users):
    """User 0 has a third of all rows; some rows lack a user or a time."""
    rows = []
    for i in range(n):
        user = "u0" if rng.random() < 0.33 else rng.choice([*users, None])
        at = None if rng.random() < 0.02 else START + timedelta(hours=rng.randint(0, 60 * 24))
        rows.append((user, at, rng.choice(["a", "b", None]), i))
    return rows


def brute(left, right):
    out = []
    for user, at, _, i in left:
        known = [(t, v is not None, v or "") for u, t, v, _ in right if u is not None and u == user and t is not None and at is not None and t <= at]
        best = max(known, default=None)
        out.append((i, user, best and best[0], best and (best[2] if best[1] else None)))
    return sorted(out, key=lambda r: r[0])


@pytest.mark.parametrize("chunk_hours", [1, 24, 24 * 7, 24 * 1000])
def test_as_of_join_equals_a_loop(spark, chunk_hours):
    rng = random.Random(chunk_hours)
    left, right = events(rng, 300, ["u1", "u2", "gone"]), events(rng, 200, ["u1", "u2", "u3"])
    schema = "user_id string, t timestamp, {} string, {} long"
    lf = spark.createDataFrame(left, schema.format("kind", "i")).repartition(3)
    rf = spark.createDataFrame(right, schema.format("value", "j")).repartition(3)
    found = point_in_time.as_of_join(lf, rf, "user_id", "t", "t", ["value"], chunk_hours * 3600)
    assert sorted((r["i"], r["user_id"], r["matched_time"], r["value"]) for r in found.collect()) == brute(left, right)


def test_as_of_join_of_empty_sides(spark):
    schema = "user_id string, t timestamp, value string"
    none = spark.createDataFrame([], schema)
    one = spark.createDataFrame([("u", START, "v")], schema)
    assert point_in_time.as_of_join(none.select("user_id", "t"), one, "user_id", "t", "t", ["value"]).count() == 0
    left = one.select("user_id", "t")
    row = point_in_time.as_of_join(left, none, "user_id", "t", "t", ["value"]).collect()[0]
    assert (row["matched_time"], row["value"]) == (None, None)


def test_a_hot_user_is_several_tasks(spark):
    """The rows of one user are dealt by user and chunk, so that no task has them all."""
    rows = spark.range(20_000).select(F.lit("hot").alias("user_id"), F.timestamp_seconds(F.col("id") * 3600).alias("t"))
    found = point_in_time.as_of_join(rows, rows.withColumn("v", F.lit("x")), "user_id", "t", "t", ["v"], 86400 * 7)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in text and "_chunk" in text
    sizes = found.groupBy(F.floor(F.unix_seconds("t") / (86400 * 7))).count().agg(F.max("count")).first()[0]
    assert found.where("v IS NULL").count() == 0 and sizes == 168


def test_many_cutoffs_equal_single_ones(spark, make):
    rng, rows = random.Random(4), []
    for i in range(800):
        user = "u0" if rng.random() < 0.33 else f"u{rng.randint(1, 12)}"
        rows.append({
            "user_id": user,
            "timestamp": (START + timedelta(hours=rng.randint(0, 80 * 24))).isoformat(),
            "session_id": rng.choice([None, "s1", "s2", f"{user}-{i % 40}"]),
            "action_type": rng.choice(["login", "feature_use"]),
            "feature_name": rng.choice([None, "reports", "strange"]),
            "duration_seconds": rng.choice([None, 3, 50]),
            "device_type": rng.choice([None, "mobile", "watch"]),
            "location": rng.choice(["US", None, "Mars"]),
        })
    behavior = make.behavior(*rows).cache()
    subs = make.subscriptions(*[
        {"user_id": f"u{i}", "subscription_start": f"2024-0{1 + i % 3}-0{1 + i % 9}", "subscription_end": f"2024-03-{10 + i}" if i % 3 == 0 else None}
        for i in range(15)
    ])
    days = ["2024-01-05", "2024-02-01", "2024-02-02", "2024-03-15", "2023-01-01"]
    cutoffs = spark.createDataFrame([(d,) for d in [*days, days[0], None]], "cutoff string").select(F.to_date("cutoff").alias("cutoff"))
    spread = {name: F.round(name, 6) for name in ("avg_session_duration", "stddev_session_duration")}
    found = point_in_time.features_at_cutoffs(behavior, subs, cutoffs).withColumns(spread).cache()
    total = 0
    for day in days:
        alone = features.cutoff_features(behavior, subs, day).withColumns(spread)
        own = found.where(F.col("cutoff") == day).select(alone.columns)
        assert own.exceptAll(alone).count() == alone.exceptAll(own).count() == 0, day
        total += alone.count()
    assert found.count() == total > 0
    assert point_in_time.features_at_cutoffs(behavior, subs, cutoffs.limit(0)).count() == 0


def test_slices_equal_the_single_reports(make):
    rng = random.Random(5)
    behavior = make.behavior(*[{"user_id": f"u{rng.randint(0, 30)}", "location": rng.choice(["US", "EU", None]), "device_type": "mobile"} for _ in range(300)])
    subs = make.subscriptions(*[{"user_id": f"u{i}", "plan_type": rng.choice(["basic", "pro"]), "is_churned": i % 3 == 0} for i in range(40)])
    engaged = features.engagement_features(behavior)
    found = dashboards.churn_slices(behavior, engaged, subs).cache()
    assert {r["sliced_by"].count(",") for r in found.select("sliced_by").distinct().collect()} == {0, 1}
    plans = {r["plan_type"]: (r["total_subscribers"], r["churned_count"]) for r in found.where("sliced_by = 'plan_type'").collect()}
    expected = {}
    for row in subs.collect():
        n, churned = expected.get(row["plan_type"], (0, 0))
        expected[row["plan_type"]] = (n + 1, churned + row["is_churned"])
    assert plans == expected
    by_place = {r["location"]: r["total_subscribers"] for r in found.where("sliced_by = 'location'").collect()}
    assert sum(by_place.values()) == 40
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Expand") <= 2
