"""Maps the given star-schema tables to behaviour, subscriptions, pageviews, manifest and scores.

All expressions are deterministic and row-wise, apart from one aggregate per customer and one per file.
"""

from pyspark.sql import functions as F

from subscope import settings as S
from subscope.functions.exprs import as_of_date

# The offset that moves the last order date to the as-of date, and the spread of subscription lengths.
START_SHIFT_DAYS = 8218
LENGTH_SPREAD_DAYS = 400


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(index, names):
    """The name at a 0-based position."""
    return F.element_at(F.array(*[F.lit(name) for name in names]), (index + 1).cast("int"))


def _with_k(events):
    """The number in the JSON column, parsed once for all the columns made from it."""
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def map_behavior(events, keep=()):
    """Event rows as user behaviour; works on static and streaming input."""
    k = F.col("k")
    action = (
        F.when(F.col("event_type") == "signup", "login")
        .when(F.col("event_type") == "view", "page_view")
        .when(F.col("event_type") == "error", "support_ticket")
        .when(F.col("event_type").isin("click", "purchase"), "feature_use")
    )
    is_page = F.col("event_type") == "view"
    is_feature = F.col("event_type").isin("click", "purchase")
    user = F.col("user_id").cast("string")
    return _with_k(events).select(
        user.alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.concat(user, F.lit("_"), F.to_date("ts").cast("string")).alias("session_id"),
        action.alias("action_type"),
        F.when(is_feature, _pick(k % 6, S.FEATURE_NAMES)).alias("feature_name"),
        F.when(is_page | is_feature, F.floor("value").cast("int")).alias("duration_seconds"),
        F.when(is_page, F.concat(F.lit("/page_view/"), k.cast("string"))).alias("page_url"),
        _pick(k % 3, S.DEVICE_TYPES).alias("device_type"),
        _pick(F.col("user_id") % 4, S.LOCATIONS).alias("location"),
        *keep,
    )


def behavior(spark, sf_dir, keep=()):
    return map_behavior(_read(spark, sf_dir, "events"), keep)


def subscriptions(spark, sf_dir, as_of=S.AS_OF):
    """One subscription per customer with orders, from the latest one."""
    latest = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority"))
    orders = (
        _read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(latest.alias("latest"))
    )
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    churned = F.col("latest.o_orderstatus") == "F"
    plan = (
        F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "basic")
        .when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), "pro")
        .otherwise("enterprise")
    )
    payment = (
        F.when(F.col("n_regionkey").isin(0, 1, 2), "credit_card")
        .when(F.col("n_regionkey") == 3, "paypal")
        .otherwise("bank_transfer")
    )
    priority = F.col("latest.o_orderpriority")
    reason = (
        F.when(priority == "1-URGENT", "price")
        .when(priority == "2-HIGH", "features")
        .when(priority == "3-MEDIUM", "support")
        .when(priority == "5-LOW", "competitor")
    )
    start = F.col("latest.o_orderdate") + F.make_dt_interval(F.lit(START_SHIFT_DAYS))
    days = (F.col("latest.o_orderkey") % LENGTH_SPREAD_DAYS).cast("int")
    end = F.least(start + F.make_dt_interval(days), as_of_date(as_of).cast("timestamp_ntz"))
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("user_id"),
            start.alias("subscription_start"),
            F.when(churned, end).alias("subscription_end"),
            plan.alias("plan_type"),
            F.when(F.col("c_custkey") % 10 < 7, "monthly").otherwise("annual").alias("billing_cycle"),
            payment.alias("payment_method"),
            F.when(churned, reason).alias("churn_reason"),
            churned.alias("is_churned"),
        )
    )


def pageviews(spark, sf_dir):
    k = F.col("k")
    return _with_k(_read(spark, sf_dir, "events")).select(
        F.col("event_type").alias("project"),
        F.concat(F.lit("Page_"), k.cast("string")).alias("page_title"),
        F.floor(F.col("value") * F.col("value") / 10).cast("int").alias("view_count"),
        _pick(k % 3, S.ACCESS_METHODS).alias("access_method"),
        F.concat(F.lit("pageviews-"), F.date_format("ts", "yyyyMMdd-HH"), F.lit("0000.gz")).alias("source_file"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("file_timestamp"),
    )


def manifest(spark, sf_dir):
    """One row per pageview file; the size is the sum of its view counts."""
    return (
        pageviews(spark, sf_dir)
        .groupBy(F.col("source_file").alias("filename"), F.col("file_timestamp").alias("timestamp"))
        .agg(F.sum("view_count").alias("file_size_bytes"))
    )


def scores(subs):
    """Scores by rule, for the operators that read predictions; the trained models have no SQL equivalent."""
    base = (F.col("user_id").cast("long") * 37) % 80 + F.when(F.col("is_churned"), 20).otherwise(0)
    probability = base / F.lit(100.0).cast("double")
    return subs.select(
        "user_id",
        F.when(probability >= 0.5, 1.0).otherwise(0.0).alias("prediction"),
        probability.alias("churn_probability"),
        F.when(probability >= 0.5, "high_risk")
        .when(probability >= 0.3, "medium_risk")
        .otherwise("low_risk")
        .alias("churn_risk"),
    )
