"""The feature matrix kept up to date by days, without reading the history of rows again.

Three tables lie below one folder:

* ``days``: per day and user the sums of that day's rows, partitioned by day. A day written again replaces itself.
* ``sessions``: per day the sessions first seen on it, partitioned by day.
* ``totals``: per user everything up to a day, partitioned by that day.

A refresh reads the rows after the last refreshed day, the sessions, the totals of that day, and of ``days`` only what
has left the rolling windows since. It writes new partitions and changes no old ones, so it can be repeated after a
failure, and the matrix of any refreshed day stays available. Rows that arrive for a day already refreshed need a
refresh from that day on (``since``).
"""

from functools import reduce

from pyspark.sql import functions as F

from subscope import settings as S
from subscope.functions.exprs import as_of_date, until
from subscope.operators.features import (
    DIVERSITY,
    MATRIX_WINDOWS,
    _action_counts,
    _bits,
    _feature_counts,
    _is_action,
    finished_matrix,
)

#: Sums per user and day that add up to those of a user.
COUNTED = ("feature_usage_count", *[f"{name}_count" for name in S.ACTION_TYPES], *S.FEATURE_NAMES)
ADDED = ("total_actions", *COUNTED, "duration_n", "duration_sum", "duration_squares", "active_days", "total_sessions")
BITS = {column: f"bits_{column}" for column in DIVERSITY}
STRANGE = {column: f"strange_{column}" for column in DIVERSITY}
TYPES = {"duration_sum": "decimal(38,0)", "duration_squares": "decimal(38,0)"}


def _day_sums(rows):
    """Per user and day: counts, exact sums of durations and squares, a bit per declared value, and other values seen.

    Undeclared values are kept as they are; they are strays of a column with a declared domain, hence few.
    """
    duration = F.col("duration_seconds").cast("decimal(10,0)")
    conditions = {"feature_usage_count": _is_action("feature_use")} | _action_counts() | _feature_counts()
    return rows.groupBy("user_id", F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("total_actions"),
        *[F.count_if(conditions[name]).alias(name) for name in COUNTED],
        F.count("duration_seconds").alias("duration_n"),
        F.sum(duration).cast("decimal(38,0)").alias("duration_sum"),
        F.sum(duration * duration).cast("decimal(38,0)").alias("duration_squares"),
        *[_bits(column, domain).alias(BITS[column]) for column, (_, domain) in DIVERSITY.items()],
        *[
            F.collect_set(F.when(~F.col(column).isin(domain), F.col(column))).alias(STRANGE[column])
            for column, (_, domain) in DIVERSITY.items()
        ],
    )


def _write(df, path, *, by="day"):
    (
        df.hint("rebalance", F.col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def _read(spark, path, like):
    """The table, or no rows of its schema while it does not exist."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(files):
        return spark.read.schema(like.schema).parquet(path)
    return spark.createDataFrame([], like.schema)


def refresh(behavior, base, as_of, since=None):
    """Bring the tables below `base` from the last refreshed day before `as_of` to `as_of`; returns `base`.

    `since` is that day if it is not the latest one: give the day before the first day whose rows have changed. The
    first refresh reads all rows. Days between the two need not all have rows.
    """
    spark = behavior.sparkSession
    found = _refreshed(spark, base)
    known = [day for day in found if day < str(as_of) and (since is None or day <= str(since))]
    last = max(known, default=None)
    rows = until(behavior, as_of)
    if last:
        rows = rows.where(F.col("timestamp") >= F.date_add(as_of_date(last), 1))
        if "event_date" in rows.columns:
            rows = rows.where(F.col("event_date") > as_of_date(last))

    sums = _day_sums(rows)
    _write(sums, f"{base}/days")
    visits = rows.where(F.col("session_id").isNotNull()).groupBy("user_id", "session_id")
    firsts = visits.agg(F.min(F.to_date("timestamp")).alias("day"))
    if last:
        seen = _read(spark, f"{base}/sessions", firsts).where(F.col("day") <= as_of_date(last))
        firsts = firsts.join(seen.select("user_id", "session_id"), ["user_id", "session_id"], "left_anti")
    _write(firsts, f"{base}/sessions")

    days = spark.read.schema(sums.schema).parquet(f"{base}/days").where(F.col("day") <= as_of_date(as_of))
    fresh = days.where(F.col("day") > as_of_date(last)) if last else days
    opened = _read(spark, f"{base}/sessions", firsts).where(F.col("day") <= as_of_date(as_of))
    opened = opened.where(F.col("day") > as_of_date(last)) if last else opened
    parts = [
        _part(fresh, {name: F.col("day") >= F.date_sub(as_of_date(as_of), n) for name, n in MATRIX_WINDOWS.items()}),
        opened.groupBy("user_id").agg(F.count("*").alias("total_sessions")),
    ]
    if last:
        # What the windows held on the last day, less the days that have left them since.
        gone = {
            name: (F.col("day") >= F.date_sub(as_of_date(last), n)) & (F.col("day") < F.date_sub(as_of_date(as_of), n))
            for name, n in MATRIX_WINDOWS.items()
        }
        left = days.where((F.col("day") <= as_of_date(last)) & reduce(lambda a, b: a | b, gone.values()))
        totals = spark.read.parquet(f"{base}/totals").where(F.col("as_of") == as_of_date(last)).drop("as_of")
        parts += [totals, _expired(left, gone)]
    merged = _merged(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))
    _write(merged.withColumn("as_of", as_of_date(as_of)), f"{base}/totals", by="as_of")
    return base


def _part(days, windows):
    """Days as rows of totals."""
    inside = {name: F.when(condition, F.col("total_actions")).otherwise(0).cast("long") for name, condition in windows.items()}
    return days.withColumns(inside | {"active_days": F.lit(1).cast("long")}).drop("day")


def _expired(days, gone):
    return days.select(
        "user_id",
        *[(-F.when(inside, F.col("total_actions")).otherwise(0)).cast("long").alias(name) for name, inside in gone.items()],
    )


def _merged(rows):
    """One row per user; users are combined within tasks before they move."""
    return rows.groupBy("user_id").agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast(TYPES.get(name, "long")).alias(name) for name in (*ADDED, *MATRIX_WINDOWS)],
        *[F.coalesce(F.bit_or(name), F.lit(0)).cast("long").alias(name) for name in BITS.values()],
        *[F.array_distinct(F.flatten(F.collect_set(name))).alias(name) for name in STRANGE.values()],
    )


def _refreshed(spark, base):
    """The days for which totals are complete."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/totals")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(name.removeprefix("as_of=") for name in names if name.startswith("as_of="))


def refreshed_matrix(spark, base, subs, as_of):
    """The feature matrix of a refreshed day, as `features.feature_matrix` computes it from all rows."""
    totals = spark.read.parquet(f"{base}/totals").where(F.col("as_of") == as_of_date(as_of))
    n, total, squares = F.col("duration_n"), F.col("duration_sum"), F.col("duration_squares")
    variance = F.try_divide((n * squares - total * total).cast("double"), (n * (n - 1)).cast("double"))
    users = totals.withColumns({
        "avg_session_duration": F.try_divide(total.cast("double"), n),
        "stddev_session_duration": F.sqrt(variance),
    } | {
        name: (F.bit_count(BITS[column]) + F.size(STRANGE[column])).cast("long") for column, (name, _) in DIVERSITY.items()
    })
    return finished_matrix(users, subs, as_of)
