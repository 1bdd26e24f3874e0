"""Data-quality and distribution profiles of pageviews, behaviour and subscriptions."""

from pyspark.sql import functions as F

from subscope import settings as S
from subscope.functions import ranking
from subscope.functions.exprs import (
    active_count,
    churn_rate,
    churned_count,
    pct,
    position,
    rounded_avg,
    upper_band,
)
from subscope.functions.reshape import distinct_total, rows_from, with_share


def pageview_summary(pageviews):
    one = pageviews.agg(
        F.count("*").alias("total_records"),
        F.min("file_timestamp").alias("earliest_timestamp"),
        F.max("file_timestamp").alias("latest_timestamp"),
    )
    return one.select(
        "total_records",
        distinct_total(pageviews, "project").alias("unique_projects"),
        distinct_total(pageviews, "page_title").alias("unique_pages"),
        distinct_total(pageviews, "access_method").alias("unique_access_methods"),
        distinct_total(pageviews, "source_file").alias("total_files"),
        "earliest_timestamp",
        "latest_timestamp",
    )


def project_distribution(pageviews, top=10):
    counts = pageviews.groupBy("project").agg(F.count("*").alias("record_count"))
    return (
        with_share(counts, "record_count", "percentage")
        .orderBy(F.desc("record_count"), "project")
        .limit(top)
    )


def view_count_stats(pageviews):
    """Moments and exact percentiles, all from one count per distinct value.

    The mean enters the squared deviations as a scalar, which keeps the deviation stable for any range.
    """
    hist = ranking.histogram(pageviews.select("view_count"), "view_count")
    value, n = F.col("view_count").cast("double"), F.col("n")
    mean = hist.agg(F.sum(value * n) / F.sum(n)).scalar()
    variance = F.try_divide(F.sum(n * F.pow(value - mean, 2)), F.sum(n) - 1)
    basics = hist.agg(
        F.sum("n").alias("total_records"),
        F.min("view_count").alias("min_views"),
        F.max("view_count").alias("max_views"),
        F.round(F.sum(value * n) / F.sum(n), 2).alias("avg_views"),
        F.round(F.sqrt(variance), 2).alias("stddev_views"),
    )
    cuts = ranking.percentiles(
        hist,
        "view_count",
        {
            "p25_views": 0.25,
            "median_views": 0.5,
            "p75_views": 0.75,
            "p95_views": 0.95,
            "p99_views": 0.99,
        },
    )
    whole = basics.withColumn("cuts", cuts.select(F.struct("*").alias("cuts")).scalar())
    return whole.select(F.lit("All Records").alias("category"), *basics.columns, "cuts.*")


def null_profile(df, columns, label="column_name"):
    """Null counts of several columns in one pass, one row per column."""
    counted = df.agg(F.count("*").alias("total"), *[F.count(name).alias(f"filled_{name}") for name in columns])
    total = F.col("total")
    rows = []
    for name in columns:
        filled = F.col(f"filled_{name}")
        rows.append((F.lit(name), total, filled, total - filled, pct(total - filled, total)))
    report = rows_from(
        counted, [label, "total_records", "non_null_count", "null_count", "null_percentage"], rows
    )
    return report.orderBy(label)


def missing_counts(df):
    """Null count of every column."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return rows_from(
        counted, ["column_name", "missing_count"], [(F.lit(name), F.col(name)) for name in df.columns]
    )


def summary_long(pageviews):
    one = pageviews.agg(
        F.count("*").alias("records"), F.min("file_timestamp").alias("first"), F.max("file_timestamp").alias("last")
    ).withColumns({
        "files": distinct_total(pageviews, "source_file"),
        "projects": distinct_total(pageviews, "project"),
        "titles": distinct_total(pageviews, "page_title"),
    })

    def instant(name):
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss")

    rows = [
        (F.lit("Total Records"), F.col("records").cast("string")),
        (F.lit("Total Files Processed"), F.col("files").cast("string")),
        (F.lit("Unique Projects"), F.col("projects").cast("string")),
        (F.lit("Unique Page Titles"), F.col("titles").cast("string")),
        (F.lit("Date Range Start"), instant("first")),
        (F.lit("Date Range End"), instant("last")),
    ]
    return rows_from(one, ["metric", "value"], rows)


def complete_record_ratio(pageviews, columns=("project", "page_title", "view_count", "access_method")):
    complete = F.lit(True)
    for name in columns:
        complete = complete & F.col(name).isNotNull()
    one = pageviews.agg(F.count("*").alias("total"), F.count_if(complete).alias("complete"))
    rows = [
        (F.lit("Records with Complete Data"), F.col("complete"), pct(F.col("complete"), F.col("total"))),
        (F.lit("Total Records"), F.col("total"), F.lit(100.0).cast("double")),
    ]
    return rows_from(one, ["quality_metric", "record_count", "percentage"], rows)


def daily_pageview_trend(pageviews):
    return (
        pageviews.groupBy(F.to_date("file_timestamp").alias("date"))
        .agg(
            F.count("*").alias("total_pageviews"),
            F.countDistinct("page_title").alias("unique_pages"),
            rounded_avg("view_count").alias("avg_views_per_page"),
        )
        .orderBy("date")
    )


def _pageviews_by(pageviews, key, name):
    counts = pageviews.groupBy(key.alias(name)).agg(F.count("*").alias("total_pageviews"))
    return with_share(counts, "total_pageviews", "percentage").orderBy(name)


def hourly_distribution(pageviews):
    return _pageviews_by(pageviews, F.hour("file_timestamp"), "hour_of_day")


def weekday_distribution(pageviews):
    """Day 1 is Sunday."""
    return _pageviews_by(pageviews, F.dayofweek("file_timestamp"), "day_of_week")


def view_count_histogram(pageviews):
    """Decimal magnitude bands; NULL and negative counts fall to the last band."""
    views = F.col("view_count")
    known = F.when(views >= 0, views)
    counts = pageviews.groupBy(upper_band(known, S.VIEW_COUNT_BANDS).alias("view_count_range")).agg(
        F.count("*").alias("page_count")
    )
    labels = [label for _, label in S.VIEW_COUNT_BANDS]
    return with_share(counts, "page_count", "percentage").orderBy(position(F.col("view_count_range"), labels))


def behavior_summary(behavior):
    one = behavior.agg(
        F.count("*").alias("total_records"),
        F.min("timestamp").alias("earliest_timestamp"),
        F.max("timestamp").alias("latest_timestamp"),
        rounded_avg("duration_seconds").alias("avg_duration"),
    )
    return one.select(
        "total_records",
        distinct_total(behavior, "user_id").alias("unique_users"),
        distinct_total(behavior, "session_id").alias("unique_sessions"),
        distinct_total(behavior, "action_type").alias("unique_action_types"),
        "earliest_timestamp",
        "latest_timestamp",
        "avg_duration",
    )


def action_distribution(behavior):
    counts = behavior.groupBy("action_type").agg(F.count("*").alias("record_count"))
    return with_share(counts, "record_count", "percentage").orderBy(F.desc("record_count"), "action_type")


def feature_usage_share(behavior):
    """Uses per named feature; the share is of all feature uses, named or not."""
    uses = (
        behavior.where(F.col("action_type") == "feature_use")
        .groupBy("feature_name")
        .agg(F.count("*").alias("usage_count"), F.countDistinct("user_id").alias("unique_users"))
    )
    return (
        with_share(uses, "usage_count", "percentage")
        .where(F.col("feature_name").isNotNull())
        .orderBy(F.desc("usage_count"), "feature_name")
    )


def subscription_summary(subs):
    return subs.agg(
        F.count("*").alias("total_subscriptions"),
        F.countDistinct("user_id").alias("unique_users"),
        churned_count().alias("churned_users"),
        active_count().alias("active_users"),
        churn_rate().alias("churn_rate_percentage"),
    )


def plan_distribution(subs):
    return (
        subs.groupBy("plan_type")
        .agg(
            F.count("*").alias("subscription_count"),
            churned_count().alias("churned_count"),
            churn_rate().alias("churn_rate"),
        )
        .orderBy(F.desc("subscription_count"), "plan_type")
    )


def churn_reason_breakdown(subs):
    """Groups by the stored reason; only its display turns NULL into 'Unknown'."""
    counts = subs.where("is_churned").groupBy("churn_reason").agg(F.count("*").alias("churn_count"))
    return (
        with_share(counts, "churn_count", "percentage")
        .withColumn("churn_reason", F.coalesce("churn_reason", F.lit("Unknown")))
        .orderBy(F.desc("churn_count"), "churn_reason")
    )


def churn_by_subscription_length(subs):
    days = F.datediff("subscription_end", "subscription_start")
    return (
        subs.where(F.col("subscription_end").isNotNull())
        .groupBy(upper_band(days, S.LENGTH_BANDS).alias("subscription_length_range"))
        .agg(
            F.count("*").alias("total_subscriptions"),
            churned_count().alias("churned_count"),
            churn_rate().alias("churn_rate"),
        )
        .orderBy("subscription_length_range")
    )


def source_overview(pageviews, behavior, subs):
    """One row per source; the two distinct counts are named after the first source's."""

    def row(label, df, second, third):
        return df.agg(F.count("*").alias("record_count")).select(
            F.lit(label).alias("data_source"), "record_count", second.alias("unique_projects"), third.alias("unique_pages")
        )

    def distinct(df, *columns):
        return [distinct_total(df, name) for name in columns]

    return (
        row("Wikimedia Pageviews", pageviews, *distinct(pageviews, "project", "page_title"))
        .unionByName(row("User Behavior", behavior, *distinct(behavior, "user_id", "session_id")))
        .unionByName(row("Subscriptions", subs, *distinct(subs, "user_id"), subs.agg(churned_count()).scalar()))
    )


def class_balance(matrix):
    """Label balance; users without a label count in the total only."""
    return matrix.agg(
        F.count("*").alias("total_users"),
        churned_count().alias("churned_users"),
        active_count().alias("active_users"),
        churn_rate().alias("churn_rate_percentage"),
    )
