"""Turning one-row aggregates into reports, and adding shares and changes to grouped rows."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from subscope.functions.exprs import pct


def rows_from(aggregate, columns, rows):
    """Explode one aggregate row into several; ``rows`` holds a tuple of Columns per output row.

    A single scan feeds every row, where a union of one query per row would scan once for each.
    """
    entries = [
        F.struct(*[value.alias(name) for name, value in zip(columns, row, strict=True)]) for row in rows
    ]
    return aggregate.select(F.inline(F.array(*entries)))


def with_share(grouped, count, share):
    """Share of each group in the total of all groups.

    The total is a scalar subquery over the same aggregate, whose shuffle Spark reuses, so that groups
    are never gathered in one task however many there are.
    """
    total = grouped.agg(F.sum(count).alias("total")).scalar()
    return grouped.withColumn(share, pct(F.col(count), total))


def with_change(series, order, value, previous, change):
    """Previous value and percentage change. The series has one row per calendar period."""
    before = F.lag(value, 1).over(W.orderBy(order))
    return series.withColumn(previous, before).withColumn(
        change, pct(F.col(value) - F.col(previous), F.col(previous))
    )


def distinct_total(df, column):
    """The number of distinct values of one column as a scalar.

    Several distinct counts in one aggregate copy every row once per column. Each as an aggregate of its own reads
    its own column only, so a columnar table is still read once in all. It is written as a count of groups, since Spark
    would merge scalar distinct counts into one aggregate again.
    """
    return df.where(F.col(column).isNotNull()).select(column).distinct().agg(F.count("*")).scalar()
