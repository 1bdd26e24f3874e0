"""Distinct counts that merge: one state per day, from which weeks, months and totals follow without reading rows again.

Exact states are bitmaps over dense integer keys, 32,768 keys a bitmap. A state is one row per day and bitmap, so a day
with U users is U / 32768 rows of 4 KB at most. Approximate states are sketches of fixed size for any values. Both are
kept in a table partitioned by day; writing a day again replaces it, so a repeated run changes nothing.
"""

from functools import reduce

from pyspark.sql import functions as F

PERIODS = ("day", "week", "month", "total")
#: Size of a sketch as a power of two. The standard error is 0.83 / sqrt(2**LOG_SIZE), 1.3 % here.
LOG_SIZE = 12


def add_keys(values, column, known=None):
    """(value, key): dense keys for the distinct values, those of `known` first; new ones follow its largest key.

    Keys are consecutive within a task and leave gaps between tasks, which cost nothing, as empty bitmaps are not stored.
    Write the result before use: keys of an unwritten table may differ each time it is computed.
    """
    fresh = values.select(column).where(F.col(column).isNotNull()).distinct()
    if known is None:
        return fresh.select(column, F.monotonically_increasing_id().alias("key"))
    start = known.agg(F.coalesce(F.max("key") + 1, F.lit(0))).scalar()
    new = fresh.join(known, column, "left_anti").select(column, (F.monotonically_increasing_id() + start).alias("key"))
    return known.select(column, "key").unionByName(new)


def daily_bitmaps(rows, key, timestamp="timestamp"):
    """(day, bucket, bits, rows): the keys seen per day. Rows without a key count as rows only."""
    bucket = F.coalesce(F.bitmap_bucket_number(key), F.lit(-1)).alias("bucket")
    # A row without a key has bucket -1, whose bits nobody counts.
    bit = F.coalesce(F.bitmap_bit_position(key), F.lit(0))
    return rows.groupBy(F.to_date(timestamp).alias("day"), bucket).agg(
        F.bitmap_construct_agg(bit).alias("bits"), F.count("*").alias("rows")
    )


def write_days(state, path):
    """Replace the days of `state` in the table; other days stay. Returns the path."""
    (
        state.hint("rebalance", F.col("day"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )
    return path


def _start(period, day="day"):
    return F.lit(None).cast("date") if period == "total" else F.to_date(F.date_trunc(period, day))


def _for_periods(count, periods):
    return reduce(lambda left, right: left.unionByName(right), [count(period) for period in periods])


def distinct_by_period(state, periods=PERIODS):
    """(period, period_start, distinct_count, rows) from daily bitmaps. A total has no start.

    Bitmaps are merged per period and bucket, which combines within tasks first; rows are not read again.
    """
    known = F.col("bucket") >= 0

    def count(period):
        merged = state.groupBy(_start(period).alias("period_start"), "bucket").agg(
            F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"), F.sum("rows").alias("rows")
        )
        return merged.groupBy("period_start").agg(
            F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("distinct_count"), F.sum("rows").alias("rows")
        ).select(F.lit(period).alias("period"), "*")

    return _for_periods(count, periods)


def daily_sketches(rows, columns, timestamp="timestamp", log_size=LOG_SIZE):
    """(day, rows, a sketch per column): any number of columns in one aggregate, without a copy of the rows for each."""
    return rows.groupBy(F.to_date(timestamp).alias("day")).agg(
        F.count("*").alias("rows"), *[F.hll_sketch_agg(name, log_size).alias(name) for name in columns]
    )


def estimates_by_period(state, columns, periods=PERIODS):
    """(period, period_start, rows, an estimate per column) from daily sketches."""

    def count(period):
        return state.groupBy(_start(period).alias("period_start")).agg(
            F.sum("rows").alias("rows"),
            *[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in columns],
        ).select(F.lit(period).alias("period"), "*")

    return _for_periods(count, periods)
