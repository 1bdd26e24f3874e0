"""Per-user features from behaviour and subscriptions, and reports over the feature matrix."""

from functools import reduce

from pyspark.sql import functions as F

from subscope import settings as S
from subscope.functions.exprs import (
    active_count,
    age_days,
    as_of_date,
    churned_count,
    hash_below,
    length_days,
    pct,
    pearson,
    recent_rows,
    since,
    snapshot,
    until,
    upper_band,
)
from subscope.functions.reshape import rows_from
from subscope.operators.profiles import null_profile

RECENT_WINDOWS = {"actions_last_7_days": 7, "actions_last_30_days": 30}
MATRIX_WINDOWS = RECENT_WINDOWS | {
    "actions_last_week": 7,
    "actions_last_2_weeks": 14,
    "actions_last_month": 30,
}

# Low-cardinality columns: the name of their distinct count, and their declared values.
DIVERSITY = {
    "feature_name": ("features_adopted", S.FEATURE_NAMES),
    "device_type": ("device_types_used", S.DEVICE_TYPES),
    "location": ("locations_used", S.LOCATIONS),
}
ENGAGEMENT = (
    "total_actions",
    "total_sessions",
    "active_days",
    "features_adopted",
    "feature_usage_count",
    "avg_session_duration",
    "stddev_session_duration",
    "device_types_used",
    "locations_used",
)

# Defaults of the report operators.
STATISTIC_FEATURES = ("total_actions", "features_adopted", "subscription_length_days")
CORRELATION_FEATURES = (
    "total_actions",
    "features_adopted",
    "avg_actions_per_session",
    "support_ticket_ratio",
    "subscription_length_days",
)


def _is_action(name):
    return F.col("action_type") == name


def _bits(column, domain):
    """One bit per declared value seen: a few bytes instead of a set."""
    return F.bit_or(
        reduce(
            lambda bits, entry: bits.when(F.col(column) == entry[1], F.lit(1 << entry[0])),
            enumerate(domain),
            F.when(F.lit(False), F.lit(0)),
        )
        .otherwise(0)
        .cast("long")
    )


def _per_user(behavior, as_of, windows, more=None):
    """Engagement aggregates per user, from one scan of the rows up to ``as_of``.

    The rows are first summed by user, session and day, and by any value outside the declared domains, so that a
    user's, session's or day's many rows are few before they move. The distinct counts, for which Spark copies
    each row once per counted column, run on those sums. Sums of durations and their squares are exact, so the
    deviation does not depend on the order of the rows. ``more`` maps names to further counted conditions.
    """
    counted = {"feature_usage_count": _is_action("feature_use")}
    counted |= {name: since(as_of, days) for name, days in windows.items()} | (more or {})
    duration = F.col("duration_seconds").cast("decimal(10,0)")
    strange = [
        F.when(~F.col(column).isin(domain), F.col(column)).alias(f"_{column}")
        for column, (_, domain) in DIVERSITY.items()
    ]
    visits = (
        until(behavior, as_of)
        .groupBy("user_id", "session_id", F.to_date("timestamp").alias("_day"), *strange)
        .agg(
            F.count("*").alias("total_actions"),
            *[F.count_if(condition).alias(name) for name, condition in counted.items()],
            F.count("duration_seconds").alias("_n"),
            F.sum(duration).alias("_sum"),
            F.sum(duration * duration).alias("_squares"),
            *[_bits(column, domain).alias(f"_{name}") for column, (name, domain) in DIVERSITY.items()],
        )
    )
    n, total, squares = F.sum("_n"), F.sum("_sum"), F.sum("_squares")
    variance = F.try_divide((n * squares - total * total).cast("double"), (n * (n - 1)).cast("double"))
    return visits.groupBy("user_id").agg(
        F.sum("total_actions").alias("total_actions"),
        *[F.sum(name).alias(name) for name in counted],
        F.countDistinct("session_id").alias("total_sessions"),
        F.countDistinct("_day").alias("active_days"),
        F.try_divide(total.cast("double"), n).alias("avg_session_duration"),
        F.sqrt(variance).alias("stddev_session_duration"),
        *[
            (F.bit_count(F.bit_or(f"_{name}")).cast("long") + F.countDistinct(f"_{column}")).alias(name)
            for column, (name, _) in DIVERSITY.items()
        ],
    )


def _action_counts():
    return {f"{name}_count": _is_action(name) for name in S.ACTION_TYPES}


def _feature_counts():
    return {name: _is_action("feature_use") & (F.col("feature_name") == name) for name in S.FEATURE_NAMES}


def _ordered(per_user, windows, *more):
    return per_user.select("user_id", *ENGAGEMENT, *windows, *more)


def engagement_features(behavior, as_of=S.AS_OF, windows=None):
    windows = windows or RECENT_WINDOWS
    return _ordered(_per_user(behavior, as_of, windows), windows)


def action_mix(behavior):
    """Percentage of each user's actions by type. The counts share one pass, so no window is needed."""
    total = F.count("*")
    return behavior.groupBy("user_id").agg(
        *[pct(F.count_if(_is_action(name)), total).alias(f"{name}_percentage") for name in S.ACTION_TYPES]
    )


def subscription_lifecycle(subs, as_of=S.AS_OF):
    age = age_days(as_of)
    return subscription_features(subs, as_of).withColumn(
        "subscription_stage",
        F.when(F.col("subscription_end").isNotNull(), "churned").otherwise(upper_band(age, S.LIFECYCLE_STAGES)),
    )


def action_count_pivot(behavior):
    return behavior.groupBy("user_id").agg(
        *[F.count_if(condition).alias(name) for name, condition in _action_counts().items()]
    )


def feature_usage_pivot(behavior):
    """Users with at least one feature use; the output columns are fixed by the feature list."""
    return (
        behavior.where(_is_action("feature_use"))
        .groupBy("user_id")
        .agg(*[F.count_if(F.col("feature_name") == name).alias(name) for name in S.FEATURE_NAMES])
    )


def subscription_features(subs, as_of=S.AS_OF):
    return snapshot(subs, as_of).select(
        "user_id",
        "plan_type",
        "billing_cycle",
        "payment_method",
        "subscription_start",
        "subscription_end",
        "is_churned",
        "churn_reason",
        age_days(as_of).alias("days_since_subscription"),
        length_days(as_of).alias("subscription_length_days"),
    )


def feature_matrix(behavior, subs, as_of=S.AS_OF):
    """The 39-column matrix of one row per behaviour user.

    Action and feature counts are sums within the engagement aggregate rather than pivots of their own. All
    joins have one row per user on either side. Users without a subscription keep a NULL label and fall to
    the stage without bound. Users without any feature use have NULL rather than 0 uses per feature.
    """
    return finished_matrix(_per_user(behavior, as_of, MATRIX_WINDOWS, _action_counts() | _feature_counts()), subs, as_of)


def finished_matrix(users, subs, as_of):
    """The matrix from one row of sums per user."""
    used = F.col("feature_usage_count") > 0
    per_user = _ordered(
        users.withColumns({name: F.when(used, F.col(name)) for name in S.FEATURE_NAMES}),
        MATRIX_WINDOWS,
        *[f"{name}_count" for name in S.ACTION_TYPES],
        *S.FEATURE_NAMES,
    )
    actions = F.col("total_actions")

    def per(part, whole):
        return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))

    return per_user.join(subscription_features(subs, as_of), "user_id", "left").withColumns({
        "avg_actions_per_session": per(actions, F.col("total_sessions")),
        "avg_actions_per_day": per(actions, F.col("active_days")),
        "feature_usage_ratio": per(F.col("feature_usage_count") * 100, actions),
        "support_ticket_ratio": per(F.col("support_ticket_count") * 100, actions),
        "subscription_stage": upper_band(F.col("subscription_length_days"), S.MATRIX_STAGES),
    })


def feature_statistics(matrix, columns=STATISTIC_FEATURES):
    """Moments and exact percentiles of several columns, one pass.

    The percentile buffer holds distinct values only; counts per user and day lengths have few of them
    (see ``session_stats`` for the bound). Columns of arbitrary doubles belong in ``ranking.percentiles``.
    """
    integral = all(matrix.schema[name].dataType.typeName() in ("integer", "long") for name in columns)
    kind = "long" if integral else "double"
    parts = []
    for name in columns:
        parts += [
            F.round(F.avg(name), 2).alias(f"mean_{name}"),
            F.round(F.stddev(name), 2).alias(f"stddev_{name}"),
            F.min(name).cast(kind).alias(f"min_{name}"),
            F.max(name).cast(kind).alias(f"max_{name}"),
            F.percentile(name, [0.25, 0.5, 0.75, 0.95]).alias(f"cuts_{name}"),
        ]
    one = matrix.agg(F.count("*").alias("total_users"), *parts)
    rows = [
        (
            F.lit(name),
            F.col("total_users"),
            *[F.col(f"{part}_{name}") for part in ("mean", "stddev", "min", "max")],
            *[F.get(f"cuts_{name}", F.lit(i)) for i in range(4)],
        )
        for name in columns
    ]
    names = ["feature_name", "total_users", "mean_value", "stddev_value", "min_value", "max_value"]
    return rows_from(one, names + ["p25_value", "median_value", "p75_value", "p95_value"], rows)


def churn_correlation(matrix, columns=CORRELATION_FEATURES):
    """Pearson correlation of features with the label, strongest first."""
    label = F.col("is_churned").cast("double")
    one = matrix.where(F.col("is_churned").isNotNull()).agg(
        *[F.round(pearson(F.col(name).cast("double"), label), 4).alias(name) for name in columns]
    )
    report = rows_from(
        one, ["feature_name", "correlation_with_churn"], [(F.lit(name), F.col(name)) for name in columns]
    )
    return report.orderBy(F.abs("correlation_with_churn").desc(), "feature_name")


def feature_completeness(matrix, columns=STATISTIC_FEATURES):
    return null_profile(matrix, columns, label="feature_name")


def feature_summary(matrix):
    one = matrix.agg(
        F.count("*").alias("users"),
        churned_count().alias("churned"),
        active_count().alias("active"),
        pct(churned_count(), F.count("*")).alias("rate"),
    )
    width = F.lit(len(matrix.columns)).cast("long")
    rows = [
        (F.lit("Feature Matrix"), F.col("users"), width, F.lit("Ready for modeling")),
        (
            F.lit("Churn Distribution"),
            F.col("churned"),
            F.col("active"),
            F.concat(F.col("rate").cast("decimal(10,2)").cast("string"), F.lit("%")),
        ),
    ]
    return rows_from(one, ["component", "user_count", "feature_count", "status"], rows)


def cutoff_features(
    behavior,
    subs,
    cutoff,
    lookback=S.FEATURE_LOOKBACK_DAYS,
    horizon=S.PREDICTION_HORIZON_DAYS,
):
    """Features known before the cutoff and the label of the days after it, for users active at the cutoff."""
    day = as_of_date(cutoff)
    seen = recent_rows(behavior, cutoff, lookback).where(F.col("timestamp") < day)
    features = engagement_features(seen, cutoff)
    active = subs.where(
        (F.col("subscription_start") < day)
        & (F.col("subscription_end").isNull() | (F.col("subscription_end") >= day))
    ).select(
        "user_id",
        "plan_type",
        "billing_cycle",
        "payment_method",
        age_days(cutoff).alias("days_since_subscription"),
        F.coalesce(
            F.col("is_churned") & (F.col("subscription_end") < F.date_add(day, horizon)), F.lit(False)
        ).alias("churns_in_horizon"),
    )
    counts = [field.name for field in features.schema.fields if field.dataType.typeName() == "long"]
    return active.join(features, "user_id", "left").fillna(0, subset=counts)


def stratified_sample(df, label, fractions, key="user_id", seed=42):
    """Reproducible sample with one fraction per label value; unlisted labels are left out."""
    keep = F.lit(False)
    for value, fraction in fractions.items():
        keep = keep | ((F.col(label) == value) & hash_below(key, seed, fraction))
    return df.where(keep)


def activity_recency(behavior, as_of=S.AS_OF, inactive_after=14):
    """Days since the last action, an inactivity flag, and the change between the last two weeks."""
    behavior = until(behavior, as_of)
    this_week = F.count_if(since(as_of, 7))
    last_two = F.count_if(since(as_of, 14))
    idle = F.datediff(as_of_date(as_of), F.max("timestamp"))
    return behavior.groupBy("user_id").agg(
        idle.alias("days_since_last_session"),
        (idle >= inactive_after).alias("is_inactive"),
        this_week.alias("actions_last_7_days"),
        (last_two - this_week).alias("actions_previous_7_days"),
        (this_week - (last_two - this_week)).alias("action_trend"),
    )
