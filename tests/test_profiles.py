from table_rows import rows

from subscope.operators import profiles


def test_null_profile_counts_nulls(make):
    views = make.pageviews({"view_count": 1}, {"view_count": None}, {"view_count": 2, "page_title": None})
    got = {row["column_name"]: row for row in rows(profiles.null_profile(views, ["page_title", "view_count", "project"]))}
    assert got["view_count"]["null_count"] == 1 and got["view_count"]["null_percentage"] == 33.33
    assert got["page_title"]["non_null_count"] == 2
    assert got["project"]["null_percentage"] == 0.0


def test_null_profile_of_an_empty_table(make):
    got = rows(profiles.null_profile(make.pageviews({}).limit(0), ["project"]))
    assert got[0]["total_records"] == 0 and got[0]["null_percentage"] is None


def test_histogram_boundaries_and_order(make):
    counts = [0, 1, 10, 11, 100, 101, 1000, 1001, 10000, 10001, None, -1]
    got = rows(profiles.view_count_histogram(make.pageviews(*[{"view_count": v} for v in counts])))
    assert [(row["view_count_range"], row["page_count"]) for row in got] == [
        ("0", 1), ("1-10", 2), ("11-100", 2), ("101-1K", 2), ("1K-10K", 2), ("10K+", 3)
    ]


def test_stats_of_nulls_only_and_single_value(make):
    none = profiles.view_count_stats(make.pageviews({"view_count": None})).first()
    assert none.total_records is None and none.median_views is None
    one = profiles.view_count_stats(make.pageviews({"view_count": 5})).first()
    assert (one.total_records, one.median_views, one.stddev_views) == (1, 5.0, None)


def test_project_tie_is_ordered_by_name(make):
    views = make.pageviews({"project": "b"}, {"project": "a"}, {"project": "c"}, {"project": "c"})
    got = profiles.project_distribution(views, top=2).collect()
    assert [(row.project, row.percentage) for row in got] == [("c", 50.0), ("a", 25.0)]


def test_feature_share_denominator_counts_unnamed_uses(make):
    use = {"action_type": "feature_use"}
    got = rows(profiles.feature_usage_share(make.behavior(use | {"feature_name": "reports"}, use, {})))
    assert got == [{"feature_name": "reports", "usage_count": 1, "unique_users": 1, "percentage": 50.0}]


def test_unknown_reason_stays_apart_from_a_stored_unknown(make):
    end = {"subscription_end": "2024-01-01"}
    subs = make.subscriptions(end, end | {"churn_reason": "Unknown"}, end | {"churn_reason": "price"}, {})
    got = profiles.churn_reason_breakdown(subs).collect()
    assert sorted((row.churn_reason, row.churn_count) for row in got) == [
        ("Unknown", 1), ("Unknown", 1), ("price", 1)
    ]


def test_length_bands(make):
    subs = make.subscriptions(*[
        {"subscription_start": "2023-01-01", "subscription_end": end}
        for end in ("2023-01-31", "2023-02-01", "2023-03-02", "2023-03-03", "2023-04-01", "2023-04-02")
    ])
    got = {row.subscription_length_range: row.total_subscriptions for row in
           profiles.churn_by_subscription_length(subs).collect()}
    assert got == {"0-30 days": 1, "31-60 days": 2, "61-90 days": 2, "90+ days": 1}


def test_weekday_one_is_sunday(make):
    got = rows(profiles.weekday_distribution(make.pageviews({"file_timestamp": "2024-01-07"})))
    assert got[0]["day_of_week"] == 1
