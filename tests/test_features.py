import pytest
from table_rows import rows

from subscope.operators import features, journeys, profiles

USE = {"action_type": "feature_use"}


def test_matrix_has_39_columns_and_keeps_unmatched_users(make):
    behavior = make.behavior({"user_id": "a"}, {"user_id": "b"} | USE | {"feature_name": "reports"})
    matrix = features.feature_matrix(behavior, make.subscriptions({"user_id": "b"}))
    assert len(matrix.columns) == 39
    got = {row["user_id"]: row for row in rows(matrix)}
    assert got["a"]["reports"] is None and got["a"]["features_adopted"] == 0
    assert got["a"]["is_churned"] is None and got["a"]["subscription_stage"] == "veteran"
    assert got["b"]["reports"] == 1 and got["b"]["dashboard"] == 0


def test_matrix_without_sessions_has_zero_ratio(make):
    got = features.feature_matrix(make.behavior({}), make.subscriptions({})).first()
    assert got.total_sessions == 0 and got.avg_actions_per_session == 0.0


@pytest.mark.parametrize(
    "start, matrix_stage, lifecycle_stage",
    [
        ("2024-01-01", "new", "new"),
        ("2023-12-31", "early", "early"),
        ("2023-11-02", "early", "early"),
        ("2023-11-01", "established", "established"),
        ("2023-01-31", "established", "established"),
        ("2023-01-30", "veteran", "established"),
    ],
)
def test_stage_boundaries(make, start, matrix_stage, lifecycle_stage):
    subs = make.subscriptions({"subscription_start": start})
    assert features.feature_matrix(make.behavior({}), subs).first().subscription_stage == matrix_stage
    assert features.subscription_lifecycle(subs).first().subscription_stage == lifecycle_stage


def test_ended_subscription_uses_its_own_length(make):
    subs = make.subscriptions({"subscription_start": "2023-01-01", "subscription_end": "2023-01-31"})
    got = features.subscription_lifecycle(subs).first()
    assert (got.subscription_length_days, got.days_since_subscription, got.subscription_stage) == (30, 395, "churned")


def test_last_days_count_from_midnight(make):
    behavior = make.behavior({"timestamp": "2024-01-24T00:00:00"}, {"timestamp": "2024-01-23T23:59:59"})
    got = features.engagement_features(behavior).first()
    assert (got.actions_last_7_days, got.actions_last_30_days) == (1, 2)


def test_undeclared_values_are_counted_too(make):
    behavior = make.behavior(
        {"feature_name": "reports", "device_type": "mobile"},
        {"feature_name": "reports", "device_type": "watch"},
        {"feature_name": "new_one", "device_type": "watch"},
        {"feature_name": "new_two", "device_type": None},
        {"user_id": "v", "device_type": "tablet", "location": "EU"},
    )
    got = {row["user_id"]: row for row in rows(features.engagement_features(behavior))}
    assert (got["u"]["features_adopted"], got["u"]["device_types_used"], got["u"]["locations_used"]) == (3, 2, 0)
    assert (got["v"]["features_adopted"], got["v"]["device_types_used"], got["v"]["locations_used"]) == (0, 1, 1)


def test_action_mix_sums_to_whole(make):
    behavior = make.behavior({}, {}, {"action_type": "page_view"}, {"action_type": "support_ticket"})
    got = features.action_mix(behavior).first()
    assert (got.login_percentage, got.page_view_percentage, got.feature_use_percentage) == (50.0, 25.0, 0.0)


def test_pivots_have_fixed_columns(make):
    assert features.action_count_pivot(make.behavior({})).first().support_ticket_count == 0
    assert features.feature_usage_pivot(make.behavior({})).count() == 0
    got = features.feature_usage_pivot(make.behavior(USE, USE | {"feature_name": "api_access"})).first()
    assert (got.api_access, got.dashboard) == (1, 0)


def test_correlation_of_a_constant_is_null(make):
    behavior = make.behavior({"user_id": "a"}, {"user_id": "b"}, {"user_id": "b"}, {"user_id": "c"})
    subs = make.subscriptions({"user_id": "a", "subscription_end": "2024-01-01"}, {"user_id": "b"})
    matrix = features.feature_matrix(behavior, subs)
    got = {row["feature_name"]: row["correlation_with_churn"] for row in rows(features.churn_correlation(matrix))}
    assert got["total_actions"] == -1.0 and got["features_adopted"] is None


def test_summary_and_balance_ignore_null_labels(make):
    matrix = features.feature_matrix(make.behavior({"user_id": "a"}, {"user_id": "b"}), make.subscriptions({"user_id": "b"}))
    assert rows(profiles.class_balance(matrix))[0] == {
        "total_users": 2, "churned_users": 0, "active_users": 1, "churn_rate_percentage": 0.0
    }
    first, second = rows(features.feature_summary(matrix))
    assert first["feature_count"] == 39 and second["status"] == "0.00%"


def test_cutoff_features_see_no_future(make):
    behavior = make.behavior(
        {"timestamp": "2024-01-15"}, {"timestamp": "2024-01-16"}, {"timestamp": "2023-12-16T23:59:59"}
    )
    subs = make.subscriptions(
        {"user_id": "u", "subscription_end": "2024-01-20"},
        {"user_id": "gone", "subscription_end": "2024-01-15"},
        {"user_id": "late", "subscription_start": "2024-01-16"},
        {"user_id": "beyond", "subscription_end": "2024-02-15"},
    )
    got = {row["user_id"]: row for row in rows(features.cutoff_features(behavior, subs, "2024-01-16"))}
    assert set(got) == {"u", "beyond"}
    assert got["u"]["total_actions"] == 1 and got["u"]["churns_in_horizon"]
    assert got["beyond"]["total_actions"] == 0 and not got["beyond"]["churns_in_horizon"]


def test_stratified_sample(spark):
    df = spark.range(4000).selectExpr("cast(id as string) user_id", "id % 4 = 0 as label")
    got = features.stratified_sample(df, "label", {True: 1.0, False: 0.5})
    assert got.where("label").count() == 1000
    assert 1350 < got.where("not label").count() < 1650
    again = features.stratified_sample(df.repartition(7), "label", {True: 1.0, False: 0.5})
    assert got.exceptAll(again).count() == 0


def test_recency(make):
    behavior = make.behavior({"timestamp": "2024-01-17"}, {"timestamp": "2024-01-10"}, {"user_id": "v"})
    got = {row["user_id"]: row for row in rows(features.activity_recency(behavior))}
    assert got["u"]["is_inactive"] and got["u"]["action_trend"] == -1
    assert not got["v"]["is_inactive"] and got["v"]["days_since_last_session"] == 1


def test_journey_order_and_ties(make):
    behavior = make.behavior(
        USE | {"feature_name": "reports", "timestamp": "2024-01-02"},
        USE | {"feature_name": "reports", "timestamp": "2024-01-01"},
        USE | {"feature_name": "analytics", "timestamp": "2024-01-01"},
        USE | {"feature_name": "dashboard", "timestamp": "2024-01-03"},
    )
    got = sorted(rows(journeys.adoption_journey(behavior)), key=lambda row: row["step"])
    assert [row["feature_name"] for row in got] == ["analytics", "reports", "dashboard"]
    assert [row["next_feature"] for row in got] == ["reports", "dashboard", None]


def test_early_adoption_counts_the_first_days_only(make):
    def use(user, feature, day):
        return USE | {"user_id": user, "feature_name": feature, "timestamp": day}

    behavior = make.behavior(
        use("a", "reports", "2024-01-01"), use("a", "dashboard", "2024-01-02"), use("a", "analytics", "2024-01-30"),
        use("b", "reports", "2024-01-01"), use("b", "dashboard", "2024-01-02"), use("b", "analytics", "2024-01-31"),
    )
    subs = make.subscriptions({"user_id": "a"}, {"user_id": "b", "subscription_end": "2024-01-31"})
    got = {row["adopter_group"]: row for row in rows(journeys.early_adoption_effect(behavior, subs))}
    assert got["early adopter"]["churn_rate"] == 0.0 and got["late adopter"]["churn_rate"] == 100.0
    assert got["early adopter"]["rate_vs_late"] == 0.0
