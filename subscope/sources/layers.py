"""Layer tables as partitioned parquet."""

from pyspark.sql import functions as F


def write_layer(df, path, partition_by=(), table=None):
    """Overwrite data and schema. Rows are rebalanced by partition key first.

    Rebalancing gives few files per directory and, unlike a plain repartition, lets the adaptive planner
    split the partitions of a hot key.
    """
    out = df.hint("rebalance", *[F.col(name) for name in partition_by]) if partition_by else df
    writer = out.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.save(path)
    return path


def read_layer(spark, path=None, table=None):
    return spark.table(table) if table else spark.read.parquet(path)


#: Rows from which the quantiles of the columns are taken, and bits per column.
RANK_SAMPLE = 20_000
RANK_BITS = 6


def _cuts(df, columns):
    """Per column up to 2**RANK_BITS - 1 quantiles of a sample of bounded size, the rows with the smallest hash."""
    sample = df.select(*columns).orderBy(F.xxhash64(*df.columns)).limit(RANK_SAMPLE).collect()
    found = {}
    for name in columns:
        values = sorted(row[name] for row in sample if row[name] is not None)
        steps = 1 << RANK_BITS
        found[name] = sorted({values[len(values) * i // steps] for i in range(1, steps)}) if values else []
    return found


def interleaved_rank(df, columns):
    """A place on a Z-order curve: bits come from the columns in turn, highest first, so near values stay near.

    The bits are read as a Gray code, so that from one cell to the next only one column moves, and a file that ends
    within a cell widens in one column only.
    A column counts by its place among its quantiles, so that its distribution and type do not matter; NULL is lowest.
    """

    def rank(name, cuts):
        reached = F.filter(F.array(*[F.lit(cut) for cut in cuts]), lambda cut: cut <= F.col(name))
        return F.size(reached).cast("long") if cuts else F.lit(0).cast("long")

    ranks = [rank(name, cuts) for name, cuts in _cuts(df, columns).items()]
    key = F.lit(0).cast("long")
    for bit in range(RANK_BITS):
        for place, rank in enumerate(reversed(ranks)):
            key = key + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(ranks) + place)
    step = 1
    while step < RANK_BITS * len(ranks):
        key = key.bitwiseXOR(F.shiftright(key, step))
        step *= 2
    return key


def clustered_rewrite(df, path, columns, files=None):
    """Rewrite along a Z-order curve of ``columns``, so that the statistics of files and row groups skip data by each.

    A plain sort helps filters on its first column only. The range key interleaves the bits of the columns' quantile
    ranks; within a file, rows are sorted by it and then by the columns. A hash of the row is the last range key: it
    spreads rows of one hot combination over several files.
    """
    keyed = df.withColumn("_z", interleaved_rank(df, columns))
    keys = [F.col("_z"), F.xxhash64(*df.columns)]
    ranged = keyed.repartitionByRange(files, *keys) if files else keyed.repartitionByRange(*keys)
    ranged.sortWithinPartitions("_z", *columns).drop("_z").write.mode("overwrite").parquet(path)
    return path


def collect_table_stats(spark, table, columns=()):
    """Store statistics for the cost-based optimizer and return them as one row."""
    detail = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{detail}")
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where(F.col("col_name") == "Statistics")
    return described.select(
        F.lit(table).alias("table_name"),
        F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("row_count"),
        F.regexp_extract("data_type", r"(\d+) bytes", 1).cast("long").alias("size_in_bytes"),
    )
