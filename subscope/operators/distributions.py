"""Treatment of long-tailed counts: logs, percentile bins, robust statistics, capping.

The per-group cut points come from distinct values (see ``functions.ranking``) and are one row per group.
They are written first, so that joining them back moves the rows only where the groups are too many to
broadcast; the adaptive skew join then splits a hot group.
"""

from pyspark.sql import functions as F

from subscope.functions import ranking
from subscope.session import settled


def log_transform(df, value="view_count"):
    return df.withColumn(f"log_{value}", F.log1p(value))


def _with_group_row(df, stats, by):
    """Left join on one nullable group key."""
    renamed = settled(stats.withColumnRenamed(by, "_group"), "group-cuts")
    return df.join(renamed, F.col(by).eqNullSafe(F.col("_group")), "left").drop("_group")


def percentile_bins(df, value="view_count", by="project", bins=10):
    """Decile 1..bins by percent rank within the group, and its label.

    All rows of one value share a percent rank, (rows below) / (rows - 1), hence one bin. The least value of
    each bin is found on the distinct values and becomes a column per bin, with which rows compare themselves.
    """
    hist = ranking.histogram(df.select(by, value), value, [by])
    ranked = ranking.running_totals(hist, value, [by], ["n"])
    place = F.coalesce(F.try_divide(F.col("n_before") * bins, F.col("n_total") - 1), F.lit(0))
    number = F.least(F.floor(place) + 1, F.lit(bins)).cast("int")
    starts = [f"_start_{i}" for i in range(1, bins + 1)]
    cuts = (
        ranked.select(by, value, number.alias("bin"))
        .groupBy(by)
        .agg(*[F.min(F.when(F.col("bin") == i, F.col(value))).alias(f"_start_{i}") for i in range(1, bins + 1)])
    )
    reached = [F.when(F.col(value) >= F.col(start), i) for i, start in enumerate(starts, 1)]
    step = 100 // bins
    labels = F.array(*[F.lit(f"p{i * step:02d}-{(i + 1) * step:02d}") for i in range(bins)])
    return (
        _with_group_row(df, cuts, by)
        .withColumn("bin", F.greatest(*reached))
        .withColumn("bin_label", F.get(labels, F.col("bin") - 1))
        .drop(*starts)
    )


def robust_stats(df, value="view_count", by="project"):
    """Median, quartiles and interquartile range per group."""
    hist = ranking.histogram(df.select(by, value), value, [by])
    cuts = ranking.percentiles(hist, value, {"p25": 0.25, "median": 0.5, "p75": 0.75}, [by])
    return cuts.withColumn("iqr", F.col("p75") - F.col("p25"))


def cap_outliers(df, value="view_count", by="project", percentile=0.95):
    """Values above the group's percentile are lowered to it."""
    hist = ranking.histogram(df.select(by, value), value, [by])
    caps = ranking.percentiles(hist, value, {"cap": percentile}, [by])
    capped = F.when(F.col(value).isNotNull(), F.least(F.col(value).cast("double"), F.col("cap")))
    return _with_group_row(df, caps, by).withColumn(f"capped_{value}", capped).drop("cap")
