"""Bronze, silver and gold layers, and the dashboard over them.

Every layer is a written table, so later steps read files rather than recompute the steps before.
"""

from pyspark.sql import functions as F

from subscope import settings as S
from subscope.operators import classifiers, dashboards, features, kpis, preprocessing, tuning
from subscope.session import model_root
from subscope.sources.layers import read_layer, write_layer

PAGEVIEWS, BEHAVIOR, SUBSCRIPTIONS = "bronze_pageviews", "bronze_user_behavior", "bronze_subscription_data"
FEATURES, PREDICTIONS = "silver_user_features", "gold_churn_predictions"


def _partitioned(df, timestamp):
    """Add the partition column cut from a timestamp."""
    column, unit = S.PARTITIONS[timestamp]
    return df.withColumn(column, F.to_date(F.date_trunc(unit, timestamp))), column


def build_bronze(base, pageviews, behavior, subs):
    """Days or months rather than instants are the partition keys: one directory per instant would be tiny files."""
    tables = (
        (pageviews, PAGEVIEWS, "file_timestamp", ["project"]),
        (behavior, BEHAVIOR, "timestamp", []),
        (subs, SUBSCRIPTIONS, "subscription_start", []),
    )
    for df, name, timestamp, more in tables:
        dated, column = _partitioned(df, timestamp)
        write_layer(dated, f"{base}/{name}", [column, *more])


def build_silver(spark, base, as_of=S.AS_OF):
    behavior = read_layer(spark, f"{base}/{BEHAVIOR}")
    subs = read_layer(spark, f"{base}/{SUBSCRIPTIONS}")
    matrix = features.feature_matrix(behavior, subs, as_of)
    return write_layer(matrix, f"{base}/{FEATURES}", ["subscription_stage"])


def train(spark, base, **settings):
    """Preprocessing and forest fitted on the training side of the silver table, as one model.

    Without ``settings`` the grid search finds them, or an earlier search on the same rows has stored its forest.
    """
    filled = preprocessing.fill_missing(read_layer(spark, f"{base}/{FEATURES}"))
    known, _ = preprocessing.train_test_split(filled.where(F.col("is_churned").isNotNull()))
    fitted = preprocessing.preprocessing(*preprocessing.feature_types(filled)).fit(known)
    vectors = preprocessing.labelled(fitted.transform(known))
    if settings:
        return classifiers.full_model(fitted, classifiers.train_random_forest(vectors, **settings))
    cores = spark.sparkContext.defaultParallelism
    tuned = tuning.stored_tuned_forest(vectors, model_root(spark), parallelism=cores)
    return classifiers.full_model(fitted, tuned.bestModel)


def build_gold(spark, base, model):
    scored = classifiers.score_users(model, read_layer(spark, f"{base}/{FEATURES}"))
    return write_layer(scored, f"{base}/{PREDICTIONS}", ["churn_risk"])


def dashboard(spark, base, as_of=S.AS_OF):
    """The dashboard tables by name, each evaluated on use."""
    behavior, subs, matrix, scored = (
        read_layer(spark, f"{base}/{name}") for name in (BEHAVIOR, SUBSCRIPTIONS, FEATURES, PREDICTIONS)
    )
    lifecycle = features.subscription_lifecycle(subs, as_of)
    return {
        "executive_kpis": dashboards.executive_kpis(subs, scored),
        "retention_funnel": dashboards.retention_funnel(subs, as_of),
        "cohort_retention": dashboards.cohort_retention(subs, as_of),
        "slice_by_plan": dashboards.slice_by_plan(subs, matrix),
        "slice_by_billing": dashboards.slice_by_billing(lifecycle, matrix),
        "slice_by_payment": dashboards.slice_by_payment(lifecycle),
        "engagement_segments": dashboards.engagement_segments(matrix, subs),
        "adoption_segments": dashboards.adoption_segments(matrix, subs),
        "risk_distribution": dashboards.risk_distribution(scored, subs),
        "prediction_outcomes": dashboards.prediction_outcomes(scored, subs),
        "geographic_churn": dashboards.geographic_churn(behavior, matrix, subs),
        "device_churn": dashboards.device_churn(behavior, matrix, subs),
        "monthly_churn_trend": kpis.monthly_churn_trend(subs, as_of),
        "weekly_engagement_trend": kpis.weekly_engagement_trend(behavior, as_of),
        "risk_by_stage": dashboards.risk_by_stage(scored, subs, as_of),
        "kpi_scorecard": dashboards.kpi_scorecard(subs, scored, matrix, as_of),
        "insight_ratios": dashboards.insight_ratios(behavior, matrix, subs),
    }
