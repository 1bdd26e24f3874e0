"""The refreshed matrix equals one computed from all rows, day after day."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from subscope.operators import daily_refresh, features


def difference(left, right):
    spread = {name: F.round(name, 6) for name in ("avg_session_duration", "stddev_session_duration")}
    left, right = left.select(right.columns).withColumns(spread), right.withColumns(spread)
    return left.exceptAll(right).count() + right.exceptAll(left).count()


@pytest.fixture(scope="module")
def history():
    """Forty days with a gap, sessions over midnight, strange and missing values; user u0 has a third of all rows."""
    rng, rows = random.Random(6), []
    for i in range(1500):
        user = "u0" if rng.random() < 0.33 else f"u{rng.randint(1, 25)}"
        day = rng.choice([d for d in range(40) if not 20 <= d <= 24])
        rows.append({
            "user_id": user,
            "timestamp": f"{date(2024, 1, 1) + timedelta(days=day)}T{rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:00",
            "session_id": rng.choice([None, f"{user}-{day // 2}", f"{user}-{day}", "shared"]),
            "action_type": rng.choice(["login", "page_view", "feature_use", "support_ticket", "odd"]),
            "feature_name": rng.choice([None, "dashboard", "reports", "new feature"]),
            "duration_seconds": rng.choice([None, 0, 5, 100_000]),
            "device_type": rng.choice([None, "mobile", "watch"]),
            "location": rng.choice(["US", "EU", None]),
        })
    return rows


def test_every_refresh_equals_all_rows(spark, make, history, tmp_path):
    behavior = make.behavior(*history).cache()
    subs = make.subscriptions(*[{"user_id": f"u{i}", "subscription_start": "2023-06-01"} for i in range(0, 26, 2)])
    base = str(tmp_path / "state")
    for day in ("2024-01-10", "2024-01-11", "2024-01-12", "2024-01-19", "2024-01-22", "2024-01-26", "2024-02-09", "2024-02-20"):
        daily_refresh.refresh(behavior, base, day)
        found = daily_refresh.refreshed_matrix(spark, base, subs, day)
        assert difference(found, features.feature_matrix(behavior, subs, day)) == 0, day
    # Earlier days are still there, and a repeated refresh changes nothing.
    daily_refresh.refresh(behavior, base, "2024-02-20")
    for day in ("2024-01-12", "2024-02-20"):
        assert difference(daily_refresh.refreshed_matrix(spark, base, subs, day), features.feature_matrix(behavior, subs, day)) == 0


def test_late_rows_need_a_refresh_from_their_day(spark, make, history, tmp_path):
    behavior, subs, base = make.behavior(*history), make.subscriptions({"user_id": "u1"}), str(tmp_path / "state")
    for day in ("2024-01-10", "2024-01-12", "2024-01-14"):
        daily_refresh.refresh(behavior, base, day)
    late = {"user_id": "u9", "timestamp": "2024-01-11T05:00:00", "session_id": "late", "duration_seconds": 7}
    more = make.behavior(*history, late)
    for day in ("2024-01-12", "2024-01-14"):
        daily_refresh.refresh(more, base, day, since="2024-01-10")
        since_then = daily_refresh.refreshed_matrix(spark, base, subs, day)
        assert difference(since_then, features.feature_matrix(more, subs, day)) == 0


def test_a_refresh_reads_new_days_only(spark, make, history, tmp_path):
    base, layer = str(tmp_path / "state"), str(tmp_path / "layer")
    rows = make.behavior(*history).withColumn("event_date", F.to_date("timestamp"))
    rows.write.partitionBy("event_date").parquet(layer)
    daily_refresh.refresh(spark.read.parquet(layer), base, "2024-01-10")
    read = []
    wanted = daily_refresh._day_sums
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(daily_refresh, "_day_sums", lambda df: read.append(df) or wanted(df))
        daily_refresh.refresh(spark.read.parquet(layer), base, "2024-01-12")
    days = {str(row[0]) for row in read[0].select(F.col("_metadata.file_path")).distinct().collect() for row in [row]}
    assert len({path.split("event_date=")[1].split("/")[0] for path in days}) == 2
    text = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "event_date" in text.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_no_rows(spark, make, tmp_path):
    empty, base = make.behavior({}).limit(0), str(tmp_path / "state")
    daily_refresh.refresh(empty, base, "2024-01-10")
    assert daily_refresh._refreshed(spark, base) == []
