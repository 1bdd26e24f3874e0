"""Plan shape: what is read, shuffled and broadcast."""

import re

from subscope.operators import dashboards, distributions, features, kpis, profiles
from subscope.plans import medallion
from subscope.session import sized_settings
from subscope.sources import driver_tables as D


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_and_rows_are_read(spark, sf_dir):
    text = plan(kpis.daily_active_users(D.behavior(spark, sf_dir)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    text = plan(kpis.weekly_engagement_trend(D.behavior(spark, sf_dir)))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", text)


def test_a_profile_of_several_columns_scans_once(spark, sf_dir):
    views = D.pageviews(spark, sf_dir)
    assert plan(profiles.null_profile(views, ["project", "page_title", "view_count"])).count("FileScan") == 1
    matrix = features.feature_matrix(D.behavior(spark, sf_dir), D.subscriptions(spark, sf_dir))
    assert plan(features.feature_statistics(matrix)).count("events.parquet") == 1


def test_unused_distinct_counts_vanish(spark, sf_dir):
    users = features.engagement_features(D.behavior(spark, sf_dir))
    text = plan(users.select("user_id", "total_actions"))
    assert text.count("FileScan") == 1 and "Join" not in text and "Expand" not in text


def test_shares_reuse_the_shuffle_of_their_counts(spark, sf_dir):
    df = profiles.project_distribution(D.pageviews(spark, sf_dir))
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_group_cut_points_do_not_move_the_rows(spark, sf_dir):
    text = plan(distributions.cap_outliers(D.pageviews(spark, sf_dir)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_user_features_read_the_behaviour_once(spark, sf_dir):
    behavior, subs = D.behavior(spark, sf_dir), D.subscriptions(spark, sf_dir)
    assert plan(features.engagement_features(behavior)).count("events.parquet") == 1
    assert plan(features.feature_matrix(behavior, subs)).count("events.parquet") == 1


def test_user_features_shuffle_rows_only_as_sums(spark, sf_dir):
    text = plan(features.engagement_features(D.behavior(spark, sf_dir)))
    # The sums by visit, then two for the distinct counts on them; the rows themselves are combined first.
    assert text.count("Exchange hashpartitioning") == 3 and "Join" not in text
    assert text.index("Expand") < text.rindex("Exchange hashpartitioning")


def test_recent_reports_skip_directories(spark, sf_dir, tmp_path):
    base = str(tmp_path)
    views, behavior, subs = D.pageviews(spark, sf_dir), D.behavior(spark, sf_dir), D.subscriptions(spark, sf_dir)
    medallion.build_bronze(base, views, behavior, subs)
    stored = spark.read.parquet(f"{base}/{medallion.BEHAVIOR}")
    report = kpis.weekly_engagement_trend(stored, days=7)
    assert "event_date" in re.search(r"PartitionFilters: \[(.*?)\], ", plan(report))[1]
    assert report.collect() == kpis.weekly_engagement_trend(behavior, days=7).collect()
    stored = spark.read.parquet(f"{base}/{medallion.SUBSCRIPTIONS}")
    for job in (dashboards.cohort_retention, kpis.monthly_churn_trend):
        assert "start_month" in re.search(r"PartitionFilters: \[(.*?)\], ", plan(job(stored)))[1]
        assert job(stored).collect() == job(subs).collect()


def test_shuffle_settings_follow_size_and_cores():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert sized_settings(10 * 2**40, 4000)[key] == "81920"
    assert sized_settings(2**40, 1000)[key] == "8192"
    assert sized_settings(2**20, 8)[key] == "16"
