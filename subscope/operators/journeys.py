"""Feature adoption over time: first uses, order, transitions and the effect of early adoption."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope.functions.exprs import churn_rate, churned_count


def first_uses(behavior):
    """First use of each feature per user: at most one row per user and feature name."""
    return (
        behavior.where((F.col("action_type") == "feature_use") & F.col("feature_name").isNotNull())
        .groupBy("user_id", "feature_name")
        .agg(F.min("timestamp").alias("first_used"))
    )


def adoption_journey(behavior):
    """Order in which each user took up features; equal times are ordered by name."""
    order = W.partitionBy("user_id").orderBy("first_used", "feature_name")
    return first_uses(behavior).withColumns({
        "step": F.row_number().over(order),
        "next_feature": F.lead("feature_name").over(order),
    })


def adoption_transitions(behavior):
    """How often one feature was the next to be taken up after another."""
    return (
        adoption_journey(behavior)
        .where(F.col("next_feature").isNotNull())
        .groupBy("feature_name", "next_feature")
        .agg(F.count("*").alias("users"))
        .orderBy(F.desc("users"), "feature_name", "next_feature")
    )


def early_adoption_effect(behavior, subs, days=30, features=3):
    """Churn of users with several features in their first days against all others, and the rates' ratio.

    Behaviour is reduced to first times per user and feature before a user's start is looked up among them.
    """
    first_times = behavior.groupBy("user_id", "feature_name").agg(F.min("timestamp").alias("first_time"))
    start = F.min("first_time").over(W.partitionBy("user_id"))
    early = F.col("feature_name").isNotNull() & (F.datediff("first_time", "start") < days)
    users = (
        first_times.withColumn("start", start)
        .groupBy("user_id")
        .agg(F.count_if(early).alias("early_features"))
    )
    group = F.when(F.col("early_features") >= features, "early adopter").otherwise("late adopter")
    rates = (
        users.join(subs.select("user_id", "is_churned"), "user_id")
        .groupBy(group.alias("adopter_group"))
        .agg(
            F.count("*").alias("user_count"),
            churned_count().alias("churned_count"),
            churn_rate().alias("churn_rate"),
        )
    )
    # Two rows at most, so the window over all of them is one small task.
    exact = F.try_divide(F.col("churned_count").cast("double"), F.col("user_count").cast("double"))
    late = F.max(F.when(F.col("adopter_group") == "late adopter", exact)).over(W.partitionBy())
    return rates.withColumn("rate_vs_late", F.round(F.try_divide(exact, late), 4)).orderBy("adopter_group")
