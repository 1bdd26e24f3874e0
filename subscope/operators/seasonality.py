"""Smoothing, decomposition and scaling of daily series.

Each series is one row per calendar day (and group) after aggregation, so a window over a group's days is
bounded by the calendar, not by the data.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F


def daily_views(pageviews):
    return pageviews.groupBy("project", F.to_date("file_timestamp").alias("date")).agg(
        F.sum("view_count").alias("value")
    )


def daily_users(behavior):
    return behavior.groupBy(F.to_date("timestamp").alias("date")).agg(F.countDistinct("user_id").alias("value"))


def dense_days(series, by=(), value="value"):
    """Add the missing days between a group's first and last day, with value 0."""
    by = list(by)
    span = series.groupBy(*by).agg(F.min("date").alias("first"), F.max("date").alias("last"))
    days = span.select(*by, F.explode(F.sequence("first", "last")).alias("date"))
    return days.join(series, by + ["date"], "left").fillna(0, subset=[value])


def rolling_averages(series, windows=(7, 30), by=(), value="value"):
    """Trailing means over calendar days; the first days average what there is."""
    order = W.partitionBy(*by).orderBy("date")
    return dense_days(series, by, value).withColumns({
        f"avg_{days}d": F.round(F.avg(value).over(order.rowsBetween(1 - days, 0)), 4) for days in windows
    })


def seasonal_decomposition(series, by=(), value="value"):
    """Additive parts: centred 7-day mean, weekday effect and residual.

    The trend, and with it the residual, is NULL on the three days at either end.
    """
    by = list(by)
    centred = W.partitionBy(*by).orderBy("date").rowsBetween(-3, 3)
    whole = F.count(value).over(centred) == 7
    trended = dense_days(series, by, value).withColumn("trend", F.when(whole, F.avg(value).over(centred)))
    detrended = F.col(value) - F.col("trend")
    weekday = F.dayofweek("date")
    seasonal = F.avg(detrended).over(W.partitionBy(*by, weekday)) - F.avg(detrended).over(W.partitionBy(*by))
    return trended.withColumn("seasonal", seasonal).select(
        *by,
        "date",
        value,
        F.round("trend", 4).alias("trend"),
        F.round("seasonal", 4).alias("seasonal"),
        F.round(F.col(value) - F.col("trend") - F.col("seasonal"), 4).alias("residual"),
    )


def calendar_features(df, holidays, date="date"):
    """Weekday (1 = Sunday), month, weekend flag, and a holiday flag from a table of distinct dates."""
    known = holidays.select(F.col("date").alias("_holiday")).distinct()
    weekday = F.dayofweek(date)
    return (
        df.join(known, F.col(date) == F.col("_holiday"), "left")
        .withColumns({
            "day_of_week": weekday,
            "month": F.month(date),
            "is_weekend": weekday.isin(1, 7),
            "is_holiday": F.col("_holiday").isNotNull(),
        })
        .drop("_holiday")
    )


def seasonal_minmax(series, by=(), value="value"):
    """Position between the least and greatest value of the same weekday; NULL where they are equal."""
    same = W.partitionBy(*by, F.dayofweek("date"))
    low, high = F.min(value).over(same), F.max(value).over(same)
    scaled = F.try_divide((F.col(value) - low).cast("double"), (high - low).cast("double"))
    return series.withColumn("scaled", F.round(scaled, 6))
