import pytest
from table_rows import rows

from subscope.operators import dashboards, scoring
from subscope.sources import driver_tables


def engagement(spark, *values):
    return spark.createDataFrame(
        list(values),
        "user_id string, total_actions long, features_adopted long, avg_session_duration double",
    )


def predictions(spark, *values):
    return spark.createDataFrame(list(values), "user_id string, churn_probability double, churn_risk string")


def test_funnel_keeps_empty_stages(make):
    got = rows(dashboards.retention_funnel(make.subscriptions({"subscription_start": "2024-01-01"})))
    assert [row["user_count"] for row in got] == [1, 0, 0, 0]
    assert got[1]["churn_rate"] is None and got[1]["stage_percentage"] == 0.0
    assert got[0]["retention_rate"] == 100.0


@pytest.mark.parametrize("days, stage", [(30, 0), (31, 1), (90, 1), (91, 2), (365, 2), (366, 3)])
def test_funnel_boundaries(make, days, stage):
    from datetime import date, timedelta

    start = (date(2024, 1, 31) - timedelta(days=days)).isoformat()
    got = rows(dashboards.retention_funnel(make.subscriptions({"subscription_start": start})))
    assert [row["user_count"] for row in got].index(1) == stage


def test_cohorts_by_bucket_and_by_day(make):
    subs = make.subscriptions(
        {"subscription_start": "2024-01-02"},
        {"subscription_start": "2024-01-03", "subscription_end": "2024-01-20"},
        {"subscription_start": "2023-08-03"},
    )
    bucket = rows(dashboards.cohort_retention(subs))
    assert [(row["cohort_month"], row["user_count"], row["retention_grade"]) for row in bucket] == [
        ("2024-01", 2, "Critical")
    ]
    day = rows(dashboards.cohort_retention(subs, grain="day"))
    assert sorted(row["retention_rate"] for row in day) == [0.0, 100.0]


def test_segment_share_is_of_all_feature_users(spark, make):
    users = engagement(spark, ("a", 100, 4, 1.0), ("b", 100, 3, 3.0), ("c", 19, 6, None), ("d", 500, 6, 9.0))
    subs = make.subscriptions({"user_id": "a"}, {"user_id": "b", "subscription_end": "2024-01-01"}, {"user_id": "c"})
    got = {row["engagement_level"]: row for row in rows(dashboards.engagement_segments(users, subs))}
    assert list(got) == ["High Engagement", "Medium Engagement", "Minimal Engagement"]
    assert got["High Engagement"]["user_percentage"] == 25.0
    assert got["High Engagement"]["avg_session_duration"] == 1.0
    assert got["Medium Engagement"]["churn_rate"] == 100.0
    adoption = [row["adoption_segment"] for row in rows(dashboards.adoption_segments(users, subs))]
    assert adoption == ["Power User (5+ features)", "Regular User (3-4 features)"]


def test_modal_value_tie_takes_the_smaller(make):
    behavior = make.behavior(
        {"device_type": "tablet"}, {"device_type": "mobile"}, {"device_type": None}, {"device_type": None},
        {"user_id": "v", "device_type": "tablet"}, {"user_id": "v", "device_type": "tablet"},
        {"user_id": "v", "device_type": "desktop"},
    )
    got = {row["user_id"]: row["device_type"] for row in rows(dashboards.modal_value(behavior, "device_type"))}
    assert got == {"u": "mobile", "v": "tablet"}


def test_risk_reports(spark, make):
    scored = predictions(
        spark, ("a", 0.9, "high_risk"), ("b", 0.8, "high_risk"), ("c", 0.4, "medium_risk"), ("x", 0.1, "low_risk")
    )
    subs = make.subscriptions({"user_id": "a", "subscription_end": "2024-01-01"}, {"user_id": "b"}, {"user_id": "c"})
    got = {row["churn_risk"]: row for row in rows(dashboards.risk_distribution(scored, subs))}
    assert got["high_risk"]["predicted_percentage"] == 50.0 and got["high_risk"]["actual_churn_rate"] == 50.0
    assert "low_risk" not in got
    outcomes = {row["prediction_outcome"]: row["percentage"] for row in rows(dashboards.prediction_outcomes(scored, subs))}
    assert outcomes == {"True Positive": 50.0, "False Positive": 50.0}


def test_scorecard_thresholds(spark, make):
    users = engagement(spark, ("a", 1, 3, 1.0), ("b", 1, 2, 1.0))
    scored = predictions(spark, *[(str(i), 0.1, "high_risk" if i < 4 else "low_risk") for i in range(100)])
    subs = make.subscriptions(
        *[{"user_id": str(i), "subscription_end": "2023-06-01" if i < 13 else None} for i in range(100)]
    )
    got = {row["metric"]: row for row in rows(dashboards.kpi_scorecard(subs, scored, users))}
    assert (got["Churn Rate"]["current_value"], got["Churn Rate"]["status"]) == (13.0, "At Risk")
    assert (got["High Risk Users"]["current_value"], got["High Risk Users"]["status"]) == (4.0, "At Risk")
    assert got["Feature Adoption Rate"]["status"] == "At Risk"
    assert got["Early Stage Retention"]["current_value"] is None


def test_risk_tiers_partition_users(spark, sf_dir):
    scored = driver_tables.scores(driver_tables.subscriptions(spark, sf_dir))
    tiers = {row.churn_risk for row in scored.select("churn_risk").distinct().collect()}
    assert tiers <= {"high_risk", "medium_risk", "low_risk"}


def test_queue_and_new_high_risk(spark, make):
    scored = predictions(spark, ("a", 0.9, "high_risk"), ("b", 0.9, "high_risk"), ("c", 0.95, "high_risk"))
    subs = make.subscriptions({"user_id": "a"}, {"user_id": "b"}, {"user_id": "c", "subscription_end": "2024-01-01"})
    assert [row["user_id"] for row in rows(scoring.intervention_queue(scored, subs, k=1))] == ["a"]
    before = predictions(spark, ("a", 0.9, "high_risk"), ("b", 0.4, "medium_risk"))
    assert sorted(row["user_id"] for row in rows(scoring.new_high_risk(before, scored))) == ["b", "c"]
