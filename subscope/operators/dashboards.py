"""Tables behind the business dashboard."""

from itertools import combinations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope import settings as S
from subscope.functions.exprs import (
    active_count,
    age_days,
    churn_rate,
    churned_count,
    lower_band,
    pct,
    position,
    ratio,
    recent_rows,
    rounded_avg,
    rounded_stddev,
    snapshot,
    upper_band,
)
from subscope.functions.reshape import rows_from, with_share


def _labels(bands):
    return [band[-1] for band in bands]


def executive_kpis(subs, predictions):
    """Seven figures in fixed order: one aggregate per table, no scan per figure."""
    totals = subs.agg(
        F.count("*").alias("total"),
        active_count().alias("active"),
        churned_count().alias("churned"),
        churn_rate().alias("rate"),
    )
    tiers = predictions.agg(*[F.count_if(F.col("churn_risk") == tier).alias(tier) for tier in S.RISK_TIERS])
    names = ["metric", "value", "unit"]

    def row(metric, name, unit="Count"):
        return (F.lit(metric), F.col(name).cast("double"), F.lit(unit))

    return rows_from(
        totals,
        names,
        [
            row("Total Subscribers", "total"),
            row("Active Subscribers", "active"),
            row("Churned Subscribers", "churned"),
            row("Overall Churn Rate", "rate", "Percentage"),
        ],
    ).unionByName(
        rows_from(
            tiers,
            names,
            [
                row("High Risk Users", "high_risk"),
                row("Medium Risk Users", "medium_risk"),
                row("Low Risk Users", "low_risk"),
            ],
        )
    )


def retention_funnel(subs, as_of=S.AS_OF):
    """Four age stages, always four rows; an empty stage has NULL rates.

    Conditional counts in one aggregate give the rows, so no stage list has to be joined.
    """
    stage = upper_band(age_days(as_of), S.FUNNEL_STAGES)
    labels = _labels(S.FUNNEL_STAGES)
    staged = snapshot(subs, as_of).select(stage.alias("stage"), "is_churned")
    one = staged.agg(
        F.count("*").alias("everyone"),
        *[F.count_if(F.col("stage") == label).alias(f"users_{i}") for i, label in enumerate(labels)],
        *[
            F.count_if((F.col("stage") == label) & F.col("is_churned")).alias(f"churned_{i}")
            for i, label in enumerate(labels)
        ],
    )
    rows = []
    for i, label in enumerate(labels):
        users, churned = F.col(f"users_{i}"), F.col(f"churned_{i}")
        rows.append((
            F.lit(label),
            users,
            churned,
            pct(churned, users),
            pct(users - churned, users),
            pct(users, F.col("everyone")),
        ))
    names = ["stage", "user_count", "churned_count", "churn_rate", "retention_rate", "stage_percentage"]
    return rows_from(one, names, rows)


def cohort_retention(subs, as_of=S.AS_OF, grain="bucket", days=S.COHORT_WINDOW_DAYS):
    """Start month by survival month. ``grain='day'`` keeps one row per start day, which repeats a month's label."""
    age = age_days(as_of)
    keys = [
        F.date_format("subscription_start", "yyyy-MM").alias("cohort_month"),
        upper_band(age, S.SURVIVAL_MONTHS).alias("survival_month"),
    ]
    if grain == "day":
        keys.append(age.alias("_age"))
    users, churned = F.col("user_count"), F.col("churned_count")
    return (
        recent_rows(snapshot(subs, as_of), as_of, days, "subscription_start")
        .groupBy(*keys)
        .agg(F.count("*").alias("user_count"), churned_count().alias("churned_count"))
        .withColumns({"retention_rate": pct(users - churned, users), "churn_rate": pct(churned, users)})
        .withColumn("retention_grade", lower_band(F.col("retention_rate"), S.RETENTION_GRADES))
        .orderBy("cohort_month", position(F.col("survival_month"), _labels(S.SURVIVAL_MONTHS)))
        .drop("_age")
    )


def slice_by(subs, dimension, averages, features=None):
    """Subscribers, churn and rounded averages per value of one subscription column.

    ``averages`` maps output names to columns of the subscriptions or, if given, of the per-user features.
    """
    rows = subs if features is None else subs.join(_measures(features, averages.values()), "user_id")
    return (
        rows.groupBy(dimension)
        .agg(
            F.count("*").alias("total_subscribers"),
            churned_count().alias("churned_count"),
            churn_rate().alias("churn_rate"),
            *[rounded_avg(column).alias(name) for name, column in averages.items()],
        )
        .orderBy(F.desc("churn_rate"), dimension)
    )


def _measures(features, names):
    """Key and measures only, so that the subscription columns come from one side of the join."""
    behaviour = ("total_actions", "features_adopted", "avg_session_duration")
    return features.select("user_id", *[name for name in dict.fromkeys(names) if name in behaviour])


def slice_by_plan(subs, features):
    averages = {
        "avg_actions_per_user": "total_actions",
        "avg_features_adopted": "features_adopted",
        "avg_session_duration": "avg_session_duration",
    }
    return slice_by(subs, "plan_type", averages, features)


def slice_by_billing(lifecycle, features):
    averages = {
        "avg_subscription_length": "subscription_length_days",
        "avg_actions_per_user": "total_actions",
    }
    return slice_by(lifecycle, "billing_cycle", averages, features)


def slice_by_payment(lifecycle):
    return slice_by(lifecycle, "payment_method", {"avg_subscription_length": "subscription_length_days"})


def _segments(features, subs, segment, name, averages, labels):
    """Users with a subscription per segment; percentages are of all feature users.

    A left join keeps the denominator in the same pass, where a total before the join would scan again.
    """
    labelled = subs.select("user_id", "is_churned", F.lit(True).alias("subscribed"))
    here = F.col("subscribed")
    grouped = (
        features.select("user_id", *dict.fromkeys(averages.values()), segment.alias(name))
        .join(labelled, "user_id", "left")
        .groupBy(name)
        .agg(
            F.count("*").alias("everyone"),
            F.count("subscribed").alias("user_count"),
            *[rounded_avg(F.when(here, F.col(column))).alias(out) for out, column in averages.items()],
            churned_count().alias("churned_count"),
        )
    )
    total = F.sum("everyone").over(W.partitionBy())  # one row per segment label
    users = F.col("user_count")
    return (
        grouped.withColumns({
            "user_percentage": pct(users, total),
            "churn_rate": pct(F.col("churned_count"), users),
        })
        .where(users > 0)
        .select(name, "user_count", "user_percentage", *averages, "churned_count", "churn_rate")
        .orderBy(position(F.col(name), labels))
    )


def engagement_segments(features, subs):
    *levels, (_, _, rest) = S.ENGAGEMENT_LEVELS
    segment = None
    for actions, adopted, label in levels:
        reached = (F.col("total_actions") >= actions) & (F.col("features_adopted") >= adopted)
        segment = F.when(reached, label) if segment is None else segment.when(reached, label)
    averages = {
        "avg_total_actions": "total_actions",
        "avg_features_adopted": "features_adopted",
        "avg_session_duration": "avg_session_duration",
    }
    labels = _labels(S.ENGAGEMENT_LEVELS)
    return _segments(features, subs, segment.otherwise(rest), "engagement_level", averages, labels)


def adoption_segments(features, subs):
    segment = lower_band(F.col("features_adopted"), S.ADOPTION_SEGMENTS)
    averages = {"avg_features_adopted": "features_adopted", "avg_total_actions": "total_actions"}
    return _segments(features, subs, segment, "adoption_segment", averages, _labels(S.ADOPTION_SEGMENTS))


def risk_distribution(predictions, subs):
    """Predicted tier against actual churn; percentages are of all predictions, matched or not."""
    labelled = subs.select("user_id", "is_churned", F.lit(True).alias("subscribed"))
    probability = F.when(F.col("subscribed"), F.col("churn_probability"))
    grouped = (
        predictions.select("user_id", "churn_risk", "churn_probability")
        .join(labelled, "user_id", "left")
        .groupBy("churn_risk")
        .agg(
            F.count("*").alias("everyone"),
            F.count("subscribed").alias("predicted_count"),
            churned_count().alias("actual_churned"),
            rounded_avg(probability, 4).alias("avg_churn_probability"),
            rounded_stddev(probability, 4).alias("stddev_churn_probability"),
        )
    )
    total = F.sum("everyone").over(W.partitionBy())  # one row per tier
    users = F.col("predicted_count")
    return (
        grouped.withColumns({
            "predicted_percentage": pct(users, total),
            "actual_churn_rate": pct(F.col("actual_churned"), users),
        })
        .where(users > 0)
        .drop("everyone")
        .orderBy(position(F.col("churn_risk"), S.RISK_TIERS))
    )


def prediction_outcomes(predictions, subs):
    """Confusion cells of the high and low tiers."""
    outcomes = ["True Positive", "False Positive", "True Negative", "False Negative"]
    high, _, low = S.RISK_TIERS
    tier, churned = F.col("churn_risk"), F.col("is_churned")
    outcome = (
        F.when((tier == high) & churned, outcomes[0])
        .when((tier == high) & ~churned, outcomes[1])
        .when((tier == low) & ~churned, outcomes[2])
        .otherwise(outcomes[3])
    )
    counts = (
        predictions.where(tier.isin(high, low))
        .select("user_id", "churn_risk")
        .join(subs.select("user_id", "is_churned"), "user_id")
        .groupBy(outcome.alias("prediction_outcome"))
        .agg(F.count("*").alias("count"))
    )
    return with_share(counts, "count", "percentage").orderBy(position(F.col("prediction_outcome"), outcomes))


def modal_value(behavior, column):
    """Each user's most frequent non-null value; the smaller value wins a tie.

    Counts per user and value are partial sums, and the choice is a minimum over them: no sort per user.
    """
    counts = behavior.where(F.col(column).isNotNull()).groupBy("user_id", column).agg(F.count("*").alias("n"))
    return counts.groupBy("user_id").agg(F.min(F.struct(-F.col("n"), column))[column].alias(column))


def _churn_by_habit(behavior, features, subs, column, averages):
    users = features.select("user_id", *averages.values()).join(modal_value(behavior, column), "user_id", "left")
    joined = users.join(subs.select("user_id", "is_churned"), "user_id")
    total = F.count("user_id")
    return (
        joined.groupBy(column)
        .agg(
            total.alias("total_users"),
            churned_count().alias("churned_users"),
            pct(churned_count(), total).alias("churn_rate"),
            *[rounded_avg(name).alias(out) for out, name in averages.items()],
        )
        .orderBy(F.desc("churn_rate"), column)
    )


def geographic_churn(behavior, features, subs):
    averages = {"avg_actions_per_user": "total_actions", "avg_features_adopted": "features_adopted"}
    return _churn_by_habit(behavior, features, subs, "location", averages)


def device_churn(behavior, features, subs):
    averages = {"avg_session_duration": "avg_session_duration", "avg_total_actions": "total_actions"}
    return _churn_by_habit(behavior, features, subs, "device_type", averages)


def risk_by_stage(predictions, subs, as_of=S.AS_OF):
    """Tiers within each age stage."""
    stage = upper_band(age_days(as_of), S.AGE_STAGES)
    counts = (
        predictions.select("user_id", "churn_risk", "churn_probability")
        .join(snapshot(subs, as_of).select("user_id", stage.alias("subscription_stage")), "user_id")
        .groupBy("subscription_stage", "churn_risk")
        .agg(
            F.count("*").alias("user_count"),
            rounded_avg("churn_probability", 4).alias("avg_churn_probability"),
        )
    )
    in_stage = F.sum("user_count").over(W.partitionBy("subscription_stage"))  # one row per tier
    return counts.withColumn("stage_percentage", pct(F.col("user_count"), in_stage)).orderBy(
        position(F.col("subscription_stage"), _labels(S.AGE_STAGES)),
        position(F.col("churn_risk"), S.RISK_TIERS),
    )


def kpi_scorecard(subs, predictions, features, as_of=S.AS_OF):
    """Four figures against fixed benchmarks."""

    def figure(aggregate, metric, value, judged):
        benchmark, off, risky, name = S.BENCHMARKS[metric]
        worse = (lambda bound: judged > bound) if off > risky else (lambda bound: judged < bound)
        status = F.when(worse(off), name).when(worse(risky), "At Risk").otherwise("On Target")
        return aggregate.select(
            F.lit(metric).alias("metric"),
            value.cast("double").alias("current_value"),
            F.lit(benchmark).alias("benchmark"),
            status.alias("status"),
        )

    is_early = age_days(as_of) <= 90
    known = snapshot(subs, as_of).agg(
        churn_rate().alias("rate"),
        F.count_if(is_early).alias("users"),
        F.count_if(is_early & ~F.coalesce("is_churned", F.lit(False))).alias("kept"),
    )
    high = predictions.agg(
        F.count_if(F.col("churn_risk") == S.RISK_TIERS[0]).alias("users"), F.count("*").alias("everyone")
    )
    adoption = features.agg(F.avg("features_adopted").alias("mean"))
    share = F.try_divide(F.col("users") * 100.0, F.col("everyone"))
    kept = F.try_divide(F.col("kept") * 100.0, F.col("users"))
    return (
        figure(known, "Churn Rate", F.col("rate"), F.col("rate"))
        .unionByName(figure(high, "High Risk Users", F.col("users"), share))
        .unionByName(figure(adoption, "Feature Adoption Rate", F.round("mean", 2), F.col("mean")))
        .unionByName(figure(known, "Early Stage Retention", F.round(kept, 2), kept))
    )


def insight_ratios(behavior, features, subs):
    """The headline comparisons as figures: adoption, early churn, plan, region and device."""
    users = (
        features.select("user_id", "features_adopted")
        .join(modal_value(behavior, "location"), "user_id", "left")
        .join(subs.select("user_id", "is_churned"), "user_id")
    )

    def rate(condition):
        return F.try_divide(
            F.count_if(condition & F.col("is_churned")).cast("double"), F.count_if(condition).cast("double")
        )

    few, many = F.col("features_adopted") <= 1, F.col("features_adopted") >= 5
    apac, west = F.col("location") == "APAC", F.col("location").isin("US", "EU")
    by_user = users.agg(
        ratio(rate(few), rate(many), 4).alias("adoption"),
        F.round(F.try_divide(rate(apac) - rate(west), rate(west)) * 100, 4).alias("region"),
    )
    days = F.datediff("subscription_end", "subscription_start")
    basic, enterprise = F.col("plan_type") == "basic", F.col("plan_type") == "enterprise"
    monthly, annual = F.col("billing_cycle") == "monthly", F.col("billing_cycle") == "annual"
    by_plan = subs.agg(
        pct(F.count_if(F.col("is_churned") & (days <= 90)), churned_count(), 4).alias("early"),
        ratio(rate(basic), rate(enterprise), 4).alias("plan"),
        ratio(rate(monthly), rate(annual), 4).alias("billing"),
    )

    def mean(device):
        return F.avg(F.when(F.col("device_type") == device, F.col("duration_seconds")))

    by_device = behavior.agg(ratio(mean("mobile"), mean("desktop"), 4).alias("device"))
    names = ["insight", "value"]
    return (
        rows_from(
            by_user,
            names,
            [
                (F.lit("Churn ratio of 0-1 to 5+ features"), F.col("adoption")),
                (F.lit("APAC churn against US and EU, percent"), F.col("region")),
            ],
        )
        .unionByName(
            rows_from(
                by_plan,
                names,
                [
                    (F.lit("Share of churns within 90 days, percent"), F.col("early")),
                    (F.lit("Churn ratio of basic to enterprise"), F.col("plan")),
                    (F.lit("Churn ratio of monthly to annual billing"), F.col("billing")),
                ],
            )
        )
        .unionByName(
            rows_from(by_device, names, [(F.lit("Mean duration ratio of mobile to desktop"), F.col("device"))])
        )
    )


SLICED = ("plan_type", "billing_cycle", "payment_method", "location", "device_type")


def churn_slices(behavior, features, subs, dimensions=SLICED):
    """Churn and averages by each of the dimensions and each pair of them, in one aggregate.

    ``sliced_by`` names the dimensions of a row; the others are NULL in it, as is a value that is not known. Location and
    device are each user's most frequent ones. Users without actions count, with averages over those who have some.
    Grouping sets copy one row per user, not the actions, and the copies shrink before they move.
    """
    people = subs.select("user_id", "is_churned", *[c for c in dimensions if c in subs.columns])
    people = people.join(features.select("user_id", "total_actions", "features_adopted"), "user_id", "left")
    for column in dimensions:
        if column not in subs.columns:
            people = people.join(modal_value(behavior, column), "user_id", "left")
    sets = [[c] for c in dimensions] + [list(pair) for pair in combinations(dimensions, 2)]
    # A bit of the grouping id is 1 where its column is aggregated away.
    names = [F.when(F.grouping(c) == 0, c) for c in dimensions]
    return people.groupingSets([[F.col(c) for c in own] for own in sets], *dimensions).agg(
        F.concat_ws(",", *names).alias("sliced_by"),
        F.count("*").alias("total_subscribers"),
        churned_count().alias("churned_count"),
        churn_rate().alias("churn_rate"),
        rounded_avg("total_actions").alias("avg_actions_per_user"),
        rounded_avg("features_adopted").alias("avg_features_adopted"),
    )
