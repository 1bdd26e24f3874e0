"""Rule checks on the bronze tables: one row per rule with its violation count."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope import settings as S
from subscope.functions.reshape import rows_from


def _missing(*names):
    return {f"{name} not null": lambda name=name: F.col(name).isNull() for name in names}


def _outside(**domains):
    return {
        f"{name} in domain": lambda name=name, values=values: ~F.col(name).isin(values)
        for name, values in domains.items()
    }


# Conditions are built on call: a Column needs a running session.
PAGEVIEW_RULES = (
    _missing("project", "page_title", "view_count", "access_method")
    | {"view_count not negative": lambda: F.col("view_count") < 0}
    | _outside(access_method=S.ACCESS_METHODS)
)
BEHAVIOR_RULES = (
    _missing("user_id", "timestamp", "action_type")
    | {"duration_seconds not negative": lambda: F.col("duration_seconds") < 0}
    | _outside(
        action_type=S.ACTION_TYPES,
        feature_name=S.FEATURE_NAMES,
        device_type=S.DEVICE_TYPES,
        location=S.LOCATIONS,
    )
)
SUBSCRIPTION_RULES = (
    _missing("user_id", "subscription_start", "plan_type", "billing_cycle", "is_churned")
    | {"end not before start": lambda: F.col("subscription_end") < F.col("subscription_start")}
    | _outside(
        plan_type=S.PLAN_TYPES,
        billing_cycle=S.BILLING_CYCLES,
        payment_method=S.PAYMENT_METHODS,
        churn_reason=S.CHURN_REASONS,
    )
)


def check_rules(df, source, rules):
    """All row-wise rules of one table in one pass."""
    counted = df.agg(*[F.count_if(broken()).alias(f"rule_{i}") for i, broken in enumerate(rules.values())])
    rows = [(F.lit(source), F.lit(name), F.col(f"rule_{i}")) for i, name in enumerate(rules)]
    return rows_from(counted, ["source", "rule", "violations"], rows)


def users_without_subscription(behavior, subs):
    """Distinct behaviour users that no subscription names."""
    return behavior.select("user_id").distinct().join(subs.select("user_id"), "user_id", "left_anti")


def out_of_order(behavior, sequence, keys=("user_id", "session_id"), chunk=100_000):
    """Rows whose timestamp lies before that of an earlier row of the same session in arrival order.

    The running maximum is taken within chunks of the arrival number, so that even a session with a large
    share of all rows is never ordered in one task. Only sessions that cross a chunk border need the maximum
    of their earlier chunks, and that small remainder is joined on.
    """
    keys = list(keys)
    chunked = behavior.select(
        *keys, "timestamp", sequence, F.floor(F.col(sequence) / chunk).alias("_chunk")
    ).dropna(subset=[*keys, "timestamp", sequence])
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        chunked.groupBy(*keys, "_chunk")
        .agg(F.max("timestamp").alias("_latest"))
        .withColumn("_carried", F.max("_latest").over(before))
        .where(F.col("_carried").isNotNull())
        .drop("_latest")
    )
    inside = W.partitionBy(*keys, "_chunk").orderBy(sequence).rowsBetween(W.unboundedPreceding, -1)
    return (
        chunked.withColumn("_seen", F.max("timestamp").over(inside))
        .join(carried, [*keys, "_chunk"], "left")
        .where(F.col("timestamp") < F.greatest("_seen", "_carried"))
        .select(*keys, "timestamp", sequence)
    )


def bronze_validation(pageviews, behavior, subs, sequence="event_id"):
    def counted(rows, source, rule):
        return rows.agg(F.count("*").alias("violations")).select(
            F.lit(source).alias("source"), F.lit(rule).alias("rule"), "violations"
        )

    unmatched = users_without_subscription(behavior, subs)
    return (
        check_rules(pageviews, "pageviews", PAGEVIEW_RULES)
        .unionByName(check_rules(behavior, "behavior", BEHAVIOR_RULES))
        .unionByName(check_rules(subs, "subscriptions", SUBSCRIPTION_RULES))
        .unionByName(counted(unmatched, "behavior", "user has a subscription"))
        .unionByName(counted(out_of_order(behavior, sequence), "behavior", "timestamps in order"))
    )
