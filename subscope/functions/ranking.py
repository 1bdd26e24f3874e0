"""Exact ranks and percentiles without sorting a whole group in one task.

Rows are first counted per distinct value. Distinct values are then split into ordered buckets, so that a
group's order statistics come from a short list of bucket totals plus the few buckets that matter.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKETS_PER_OCTAVE = 4096


def ordered_bucket(value, per_octave=BUCKETS_PER_OCTAVE):
    """Monotone bucket number: about 131,000 buckets over the 32-bit integers, ``per_octave`` over [0, 1]."""
    x = value.cast("double")
    return F.floor(F.signum(x) * F.log2(F.abs(x) + 1) * per_octave)


def histogram(rows, value, by=(), **sums):
    """Distinct non-null values per group with their row count ``n`` and optional summed columns."""
    extra = [F.sum(column).alias(name) for name, column in sums.items()]
    return (
        rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"), *extra)
    )


def running_totals(hist, value, by, sums, per_octave=BUCKETS_PER_OCTAVE):
    """Add ``<name>_before`` (sum over smaller values) and ``<name>_total`` (whole group) per summed column."""
    by = list(by)
    placed = hist.withColumn("_bucket", ordered_bucket(F.col(value), per_octave))
    inside = W.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    for name in sums:
        placed = placed.withColumn(f"_in_{name}", F.coalesce(F.sum(name).over(inside), F.lit(0)))
    buckets = placed.groupBy(*by, "_bucket").agg(*[F.sum(name).alias(f"_sum_{name}") for name in sums])
    earlier = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    for name in sums:
        buckets = buckets.withColumn(
            f"_up_{name}", F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0))
        ).withColumn(f"{name}_total", F.sum(f"_sum_{name}").over(whole))
    joined = _join_buckets(placed, buckets.drop(*[f"_sum_{name}" for name in sums]), by)
    for name in sums:
        joined = joined.withColumn(f"{name}_before", F.col(f"_in_{name}") + F.col(f"_up_{name}"))
    return joined.drop("_bucket", *[f"_{kind}_{name}" for kind in ("in", "up") for name in sums])


def percentiles(hist, value, probabilities, by=()):
    """Exact, linearly interpolated percentiles per group of a ``histogram``; columns named by the dict keys.

    Only bucket totals are ordered per group. The ranks asked for pick the buckets that hold them, and just
    the distinct values of those buckets are ordered to find the values.
    """
    by = list(by)
    placed = hist.withColumn("_bucket", ordered_bucket(F.col(value)))
    totals = placed.groupBy(*by, "_bucket").agg(F.sum("n").alias("_size"))
    upto = F.sum("_size").over(W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0))
    size = F.sum("_size").over(W.partitionBy(*by))
    totals = totals.withColumn("_upto", upto).withColumn("_n", size)
    targets = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("_n") - 1)
        for edge, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            targets.append(
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(edge).alias("edge"),
                    rank.cast("long").alias("rank"),
                    (place - F.floor(place)).alias("part"),
                )
            )
    first = F.col("_upto") - F.col("_size")
    wanted = (
        totals.withColumn("_first", first)
        .withColumn("_t", F.explode(F.array(*targets)))
        .where((F.col("_t.rank") >= F.col("_first")) & (F.col("_t.rank") < F.col("_upto")))
        .select(*by, "_bucket", "_first", "_t")
    )
    ordered = W.partitionBy(*by, "_bucket", "_t.name", "_t.edge").orderBy(value)
    found = (
        _join_buckets(wanted, placed, by)
        .withColumn("_last", F.col("_first") + F.sum("n").over(ordered.rowsBetween(W.unboundedPreceding, 0)))
        .where((F.col("_t.rank") < F.col("_last")) & (F.col("_t.rank") >= F.col("_last") - F.col("n")))
    )
    columns = []
    for name in probabilities:
        hit = F.col("_t.name") == name
        low = F.max(F.when(hit & (F.col("_t.edge") == "lo"), F.col(value).cast("double")))
        high = F.max(F.when(hit & (F.col("_t.edge") == "hi"), F.col(value).cast("double")))
        part = F.max(F.when(hit, F.col("_t.part")))
        columns.append((low + (high - low) * part).alias(name))
    return found.groupBy(*by).agg(*columns)


def _join_buckets(left, right, by):
    """Inner join on bucket and group, in which NULL groups match each other."""
    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in [*by, "_bucket"]})
    condition = F.col("_bucket") == F.col("_r__bucket")
    for key in by:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, condition).drop(*[f"_r_{key}" for key in [*by, "_bucket"]])
