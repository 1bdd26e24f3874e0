"""Times the headline queries: one warm-up run, then one timed run with the result fully consumed.

Written inputs that several queries share are built first and timed as lines of their own, the search over the grid of
forests among them. Other models are fitted within the timed run.
"""

import json
import os
import sys
import time

from checks import queries
from subscope.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "enrich_pageviews",
    "project_distribution",
    "view_count_stats",
    "null_profile",
    "daily_pageview_trend",
    "behavior_summary",
    "source_overview",
    "daily_active_users",
    "session_stats",
    "feature_adoption_histogram",
    "engagement_features",
    "action_mix",
    "feature_matrix",
    "feature_statistics",
    "churn_correlation",
    "preprocess_scaled_features",
    "train_random_forest",
    "train_logistic",
    "kpi_scorecard_2024_01_16",
    "feature_matrix_2024_01_16",
    "insight_ratios",
    "pageview_summary",
    "classification_metrics",
    "ranking_metrics",
    "activity_recency",
    "stream_active_users",
    "executive_kpis",
    "retention_funnel",
    "cohort_retention",
    "slice_by_plan",
    "engagement_segments",
    "risk_distribution",
    "geographic_churn",
    "monthly_churn_trend",
    "weekly_engagement_trend",
    "risk_by_stage",
    "kpi_scorecard",
    "rolling_averages_by_project",
    "seasonal_decomposition",
    "percentile_bins",
    "cap_outliers",
    "segment_auc",
    "bronze_validation",
    "adoption_transitions",
    "stream_daily_actions",
    "tuning_improvement",
    "score_users",
    "users_by_period",
    "features_at_cutoffs",
    "last_use_before_ticket",
    "churn_slices",
]
# Models are fitted again for the timed run; only written inputs are kept from the warm-up.
FITTED = ["preprocessing", "training preprocessing", *queries.TRAINERS]
INPUTS = {
    "line_files": queries._line_files,
    "manifest_file": queries._manifest_file,
    "silver_table": queries._silver,
    "training_table": queries._training_table,
    "tuned_forest": queries._tuned,
}


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "subscope-bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = queries.queries()
    seconds, inputs = {}, {}
    for name, build in INPUTS.items():
        start = time.perf_counter()
        build(spark, SF_DIR)
        inputs[name] = round(time.perf_counter() - start, 3)
    for name in names:
        consume(registry[name](spark, SF_DIR))
        for key in [key for key in queries._written if key[2] in FITTED]:
            del queries._written[key]
        start = time.perf_counter()
        consume(registry[name](spark, SF_DIR))
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps({
            "metric": "headline_queries_total",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "inputs": inputs,
            "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        })
    )


if __name__ == "__main__":
    main()
