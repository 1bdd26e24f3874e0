"""Mergeable distinct counts against plain sets."""

import random
from datetime import datetime, timedelta

import pytest

from subscope.operators import distinct_state, profiles
from subscope.sources import driver_tables as D


@pytest.fixture(scope="module")
def visits(spark):
    """(key, timestamp) with keys far apart, negative ones and none; one key has a third of all rows."""
    rng = random.Random(1)
    keys = [7, 0, -1, 32767, 32768, 32769, 1 << 40, None, *range(100_000, 100_300)]
    rows = [(7 if rng.random() < 0.3 else rng.choice(keys), datetime(2024, 1, 1) + timedelta(hours=rng.randint(0, 24 * 70))) for _ in range(4000)]
    return rows, spark.createDataFrame(rows, "key long, timestamp timestamp").repartition(5)


def expected(rows):
    starts = {
        "day": lambda d: d,
        "week": lambda d: d - timedelta(days=d.weekday()),
        "month": lambda d: d.replace(day=1),
        "total": lambda d: None,
    }
    found = {}
    for key, at in rows:
        for period, start in starts.items():
            own = found.setdefault((period, start(at.date())), [set(), 0])
            own[0] |= {key} - {None}
            own[1] += 1
    return {k: (len(keys), n) for k, (keys, n) in found.items()}


def counted(df):
    return {(r["period"], r["period_start"]): (r["distinct_count"], r["rows"]) for r in df.collect()}


def test_bitmaps_equal_sets(visits):
    rows, df = visits
    assert counted(distinct_state.distinct_by_period(distinct_state.daily_bitmaps(df, "key"))) == expected(rows)


def test_days_are_added_and_replaced(spark, visits, tmp_path):
    rows, df = visits
    path = str(tmp_path / "state")
    cut = datetime(2024, 2, 1)
    broken = [(key, at) for key, at in rows if at < cut and key != 7]
    distinct_state.write_days(distinct_state.daily_bitmaps(df.where("timestamp < '2024-02-01' AND key <> 7"), "key"), path)
    assert counted(distinct_state.distinct_by_period(spark.read.parquet(path)))[("total", None)][1] == len([k for k, _ in broken if k is not None])
    for part in (df.where("timestamp < '2024-02-01'"), df.where("timestamp >= '2024-02-01'"), df.where("timestamp >= '2024-03-01'")):
        distinct_state.write_days(distinct_state.daily_bitmaps(part, "key"), path)
    assert counted(distinct_state.distinct_by_period(spark.read.parquet(path))) == expected(rows)


def test_keys_stay_and_new_ones_follow(spark, tmp_path):
    first = distinct_state.add_keys(spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "v string"), "v")
    first.write.parquet(str(tmp_path / "1"))
    known = spark.read.parquet(str(tmp_path / "1"))
    both = distinct_state.add_keys(spark.createDataFrame([("c",), ("b",), ("d",)], "v string"), "v", known)
    before, after = ({r["v"]: r["key"] for r in df.collect()} for df in (known, both))
    assert set(before) == {"a", "b"} and set(after) == {"a", "b", "c", "d"} and len(set(after.values())) == 4
    assert all(after[v] == key for v, key in before.items())


def test_sketches_stay_within_their_error(spark, visits):
    rng = random.Random(2)
    rows = [(f"v{rng.randint(0, 20_000)}", datetime(2024, 1, 1 + rng.randint(0, 20))) for _ in range(60_000)]
    df = spark.createDataFrame(rows, "v string, timestamp timestamp")
    state = distinct_state.daily_sketches(df, ["v"])
    exact = expected(rows)
    for r in distinct_state.estimates_by_period(state, ["v"]).collect():
        n = exact[r["period"], r["period_start"]]
        assert r["rows"] == n[1] and abs(r["v"] - n[0]) <= 4 * 0.013 * n[0] + 1


def test_empty_states(spark):
    none = spark.createDataFrame([], "key long, timestamp timestamp")
    found = distinct_state.distinct_by_period(distinct_state.daily_bitmaps(none, "key")).collect()
    assert [(r["period"], r["period_start"]) for r in found] == []


def test_profiles_copy_no_rows(spark, sf_dir):
    """Several distinct counts are aggregates of their own: no plan multiplies the rows by the counted columns."""
    views, behavior, subs = D.pageviews(spark, sf_dir), D.behavior(spark, sf_dir), D.subscriptions(spark, sf_dir)
    for df in (
        profiles.pageview_summary(views),
        profiles.summary_long(views),
        profiles.behavior_summary(behavior),
        profiles.source_overview(views, behavior, subs),
        distinct_state.distinct_by_period(distinct_state.daily_bitmaps(behavior.withColumn("key", behavior["user_id"].cast("long")), "key")),
    ):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
