"""What was known at a point in time: as-of joins, and features at many cutoffs at once."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope import settings as S
from subscope.operators.features import DIVERSITY, ENGAGEMENT, RECENT_WINDOWS, _bits, _is_action

CHUNK_SECONDS = 7 * 86400


def as_of_join(left, right, on, left_time, right_time, values, chunk_seconds=CHUNK_SECONDS):
    """Every left row with `values` and the time (``matched_time``) of the latest right row of its key up to its time.

    Of right rows at the same instant the greatest values win. The values need names that the left side lacks. Left rows without a match, key or time have nulls.
    Both sides are put together and cut into chunks of time, so that a key with a third of all rows is many tasks. The
    last right row of each chunk, one row per key and chunk, is carried over the borders to chunks that follow.
    """
    match = F.struct(F.col(right_time).alias("matched_time"), *values)
    usable = F.col(on).isNotNull() & F.col(left_time).isNotNull()

    def chunk(time):
        return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / chunk_seconds).alias("_chunk")

    known = right.where(F.col(on).isNotNull() & F.col(right_time).isNotNull())
    asked = left.where(usable)
    rows = known.select(F.col(on).alias("_key"), chunk(right_time), F.col(right_time).alias("_time"), F.lit(0).alias("_asks"), match.alias("_found"))
    rows = rows.unionByName(
        asked.select(
            F.col(on).alias("_key"), chunk(left_time), F.col(left_time).alias("_time"), F.lit(1).alias("_asks"), F.struct(*left.columns).alias("_row")
        ),
        allowMissingColumns=True,
    )
    before = W.partitionBy("_key", "_chunk").orderBy("_time", "_asks", "_found").rowsBetween(W.unboundedPreceding, W.currentRow)
    here = rows.withColumn("_here", F.last("_found", ignorenulls=True).over(before)).where("_asks = 1")

    lasts = known.groupBy(F.col(on).alias("_key"), chunk(right_time)).agg(F.max(match).alias("_last"))
    chunks = lasts.unionByName(asked.select(F.col(on).alias("_key"), chunk(left_time)).distinct(), allowMissingColumns=True)
    # A row per key and chunk: the span of time bounds how many a key has.
    earlier = W.partitionBy("_key").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = chunks.groupBy("_key", "_chunk").agg(F.max("_last").alias("_last")).select(
        "_key", "_chunk", F.last("_last", ignorenulls=True).over(earlier).alias("_carried")
    )
    found = here.join(carried, ["_key", "_chunk"], "left").select("_row", F.coalesce("_here", "_carried").alias("_match"))
    matched = found.select("_row.*", "_match.*")
    return matched.unionByName(left.where(~F.coalesce(usable, F.lit(False))), allowMissingColumns=True)


def features_at_cutoffs(behavior, subs, cutoffs, lookback=S.FEATURE_LOOKBACK_DAYS, horizon=S.PREDICTION_HORIZON_DAYS):
    """`features.cutoff_features` for every date in the column ``cutoff`` of a table, from one pass over the rows.

    Rows are summed by user, session and day first. Each day then goes to the cutoffs that look back on it, by an equal
    join on the day with one row per cutoff and day of its lookback. Users are the sums of sessions and days, so none
    of them is gathered row by row.
    """
    cutoffs = cutoffs.select("cutoff").where("cutoff IS NOT NULL").distinct()
    first = cutoffs.agg(F.date_sub(F.min("cutoff"), lookback)).scalar()
    last = cutoffs.agg(F.max("cutoff")).scalar()
    rows = behavior.where((F.col("timestamp") >= first) & (F.col("timestamp") < last))
    duration = F.col("duration_seconds").cast("decimal(10,0)")
    strange = [F.when(~F.col(c).isin(domain), F.col(c)).alias(f"_{c}") for c, (_, domain) in DIVERSITY.items()]
    visits = rows.groupBy("user_id", "session_id", F.to_date("timestamp").alias("_day"), *strange).agg(
        F.count("*").alias("total_actions"),
        F.count_if(_is_action("feature_use")).alias("feature_usage_count"),
        F.count("duration_seconds").alias("_n"),
        F.sum(duration).alias("_sum"),
        F.sum(duration * duration).alias("_squares"),
        *[_bits(column, domain).alias(f"_{name}") for column, (name, domain) in DIVERSITY.items()],
    )
    days = F.sequence(F.date_sub("cutoff", lookback), F.date_sub("cutoff", 1))
    seen = visits.join(cutoffs.select("cutoff", F.explode(days).alias("_day")), "_day")
    n, total, squares = F.sum("_n"), F.sum("_sum"), F.sum("_squares")
    variance = F.try_divide((n * squares - total * total).cast("double"), (n * (n - 1)).cast("double"))
    users = seen.groupBy("cutoff", "user_id").agg(
        F.sum("total_actions").alias("total_actions"),
        F.countDistinct("session_id").alias("total_sessions"),
        F.countDistinct("_day").alias("active_days"),
        F.sum("feature_usage_count").alias("feature_usage_count"),
        F.try_divide(total.cast("double"), n).alias("avg_session_duration"),
        F.sqrt(variance).alias("stddev_session_duration"),
        *[
            (F.bit_count(F.bit_or(f"_{name}")).cast("long") + F.countDistinct(f"_{column}")).alias(name)
            for column, (name, _) in DIVERSITY.items()
        ],
        *[
            F.sum(F.when(F.col("_day") >= F.date_sub("cutoff", span), F.col("total_actions")).otherwise(0)).alias(name)
            for name, span in RECENT_WINDOWS.items()
        ],
    )
    # The cutoffs at which a subscription is active; their list is one value.
    listed = cutoffs.agg(F.sort_array(F.collect_set("cutoff"))).scalar()
    active = F.filter(
        "_cutoffs",
        lambda c: (F.col("subscription_start") < c) & (F.col("subscription_end").isNull() | (F.col("subscription_end") >= c)),
    )
    people = subs.withColumn("_cutoffs", listed).withColumn("cutoff", F.explode(active)).select(
        "cutoff",
        "user_id",
        "plan_type",
        "billing_cycle",
        "payment_method",
        F.datediff("cutoff", "subscription_start").alias("days_since_subscription"),
        F.coalesce(F.col("is_churned") & (F.col("subscription_end") < F.date_add("cutoff", horizon)), F.lit(False)).alias("churns_in_horizon"),
    )
    counts = [name for name in (*ENGAGEMENT, *RECENT_WINDOWS) if not name.endswith("_duration")]
    joined = people.join(users, ["cutoff", "user_id"], "left").fillna(0, subset=counts)
    return joined.select(*people.columns, *ENGAGEMENT, *RECENT_WINDOWS)


def preceding_action(behavior, action, before, columns=("feature_name", "device_type"), chunk_seconds=CHUNK_SECONDS):
    """Every row of one action with the user's latest row of another action up to then."""
    of = F.col("action_type")
    asked = behavior.where(of == action).select("user_id", "timestamp", "session_id")
    known = behavior.where(of == before).select("user_id", "timestamp", *[F.col(c).alias(f"last_{c}") for c in columns])
    return as_of_join(asked, known, "user_id", "timestamp", "timestamp", [f"last_{c}" for c in columns], chunk_seconds)

