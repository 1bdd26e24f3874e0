"""Column expressions with the rounding, null and boundary rules used throughout."""

from pyspark.sql import functions as F

from subscope import settings as S


def as_of_date(as_of):
    return F.to_date(F.lit(str(as_of)))


def pct(part, whole, scale=2):
    """Percentage as double; NULL where the whole is zero."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), scale)


def ratio(part, whole, scale=2):
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), scale)


def rounded_avg(column, scale=2):
    return F.round(F.avg(column), scale)


def rounded_stddev(column, scale=2):
    return F.round(F.stddev(column), scale)


def pearson(x, y):
    """Pearson correlation over rows where both are known; NULL where either does not vary.

    The built-in ``corr`` raises on a constant column in ANSI mode.
    """
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def churned_count(label="is_churned"):
    return F.count_if(F.col(label))


def active_count(label="is_churned"):
    return F.count_if(~F.col(label))


def churn_rate(label="is_churned"):
    return pct(churned_count(label), F.count("*"))


def since(as_of, days, timestamp="timestamp"):
    """True from midnight ``days`` before ``as_of`` on."""
    return F.col(timestamp) >= F.date_sub(as_of_date(as_of), days)


def _partition(df, timestamp, partition):
    """The partition column and the unit it is cut to, or no column.

    ``partition`` names them as a pair; by default they are those of the layer tables (``settings.PARTITIONS``),
    if the table has that column and it is a date.
    """
    column, unit = partition or S.PARTITIONS.get(timestamp, (None, None))
    known = dict(df.dtypes).get(column) == "date"
    return (column, unit) if known else (None, None)


def until(df, as_of, timestamp="timestamp", partition=None):
    """Rows up to the end of the day ``as_of``, that day included: what a snapshot of that day holds.

    The partition column's own condition lets Spark skip whole directories, which a condition on the timestamp
    alone cannot.
    """
    rows = df.where(F.col(timestamp) < F.date_add(as_of_date(as_of), 1))
    column, unit = _partition(df, timestamp, partition)
    return rows.where(F.col(column) <= F.to_date(F.date_trunc(unit, as_of_date(as_of)))) if column else rows


def recent_rows(df, as_of, days, timestamp="timestamp", partition=None):
    """Rows from midnight ``days`` before ``as_of`` to the end of that day."""
    rows = until(df, as_of, timestamp, partition).where(since(as_of, days, timestamp))
    column, unit = _partition(df, timestamp, partition)
    first = F.date_sub(as_of_date(as_of), days)
    return rows.where(F.col(column) >= F.to_date(F.date_trunc(unit, first))) if column else rows


def snapshot(subs, as_of):
    """Subscriptions as known at the end of the day ``as_of``: later starts are absent, later ends not known yet.

    A subscription that ends later is active, without an end, reason or churn label of its own.
    """
    later = F.to_date("subscription_end") > as_of_date(as_of)
    return until(subs, as_of, "subscription_start").withColumns({
        "subscription_end": F.when(~F.coalesce(later, F.lit(False)), F.col("subscription_end")),
        "churn_reason": F.when(~F.coalesce(later, F.lit(False)), F.col("churn_reason")),
        "is_churned": F.when(later, F.lit(False)).otherwise(F.col("is_churned")),
    })


def age_days(as_of, start="subscription_start"):
    return F.datediff(as_of_date(as_of), F.col(start))


def length_days(as_of, start="subscription_start", end="subscription_end"):
    """Days from start to end, or to ``as_of`` while the subscription is active."""
    return F.datediff(F.coalesce(F.to_date(F.col(end)), as_of_date(as_of)), F.col(start))


def upper_band(value, bands):
    """Label by inclusive upper bounds; NULL and anything above falls to the open band."""
    *bounded, (_, rest) = bands
    label = None
    for bound, name in bounded:
        label = F.when(value <= bound, name) if label is None else label.when(value <= bound, name)
    return label.otherwise(rest)


def lower_band(value, bands):
    """Label by inclusive lower bounds, highest first; NULL falls to the open band."""
    *bounded, (_, rest) = bands
    label = None
    for bound, name in bounded:
        label = F.when(value >= bound, name) if label is None else label.when(value >= bound, name)
    return label.otherwise(rest)


def position(value, labels):
    """Sort key that keeps report rows in their listed order."""
    return F.array_position(F.array(*[F.lit(name) for name in labels]), value)


def hash_below(key, seed, fraction):
    """Reproducible sampling: the first 32 bits of md5(key + seed) fall below the fraction."""
    if fraction >= 1:
        return F.lit(True)
    digits = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), 1, 8)
    return digits < F.lit(format(int(fraction * 2**32), "08x"))
