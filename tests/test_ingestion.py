import gzip
from datetime import datetime

from table_rows import rows
from pyspark.sql import functions as F

from subscope.sources import layers, pageview_files


def manifest(spark, *names, size=10):
    data = [(name, datetime(2024, 1, 1), size, f"http://x/{name}") for name in names]
    return spark.createDataFrame(
        data, "filename string, timestamp timestamp_ntz, file_size_bytes long, full_url string"
    )


def test_read_manifest(spark, tmp_path):
    (tmp_path / "files.csv").write_text(
        "filename,timestamp,file_size_bytes\npageviews-20240101-130000.gz,01-Jan-2024 13:00,42\n"
    )
    got = pageview_files.read_file_manifest(spark, str(tmp_path), "http://host/dir")
    assert rows(got) == [{
        "filename": "pageviews-20240101-130000.gz",
        "timestamp": datetime(2024, 1, 1, 13),
        "file_size_bytes": 42,
        "full_url": "http://host/dir/pageviews-20240101-130000.gz",
    }]


def test_sample_one_file_per_day_in_peak_hours(spark):
    names = [f"pageviews-2024010{day}-{hour:02d}0000.gz" for day in (1, 2) for hour in range(24)]
    listed = manifest(spark, *names, "projectviews-20240103-130000.gz").unionByName(
        manifest(spark, "pageviews-20240104-130000.gz", size=0)
    )
    got = [row.filename for row in pageview_files.daily_file_sample(listed).collect()]
    assert sorted(name[10:18] for name in got) == ["20240101", "20240102"]
    assert all(12 <= int(name[19:21]) <= 16 for name in got)
    assert got == [row.filename for row in pageview_files.daily_file_sample(listed.repartition(3)).collect()]
    other = [row.filename for seed in range(5) for row in pageview_files.daily_file_sample(listed, seed=seed).collect()]
    assert len(set(other)) > 2


def test_parse_short_and_malformed_lines(spark, tmp_path):
    with gzip.open(tmp_path / "pageviews-20240101-130000.gz", "wt") as out:
        out.write("en.wikipedia Main_Page 42 desktop\nen Short\nde Page many mobile-web\n")
    got = pageview_files.parse_pageview_lines(spark, str(tmp_path)).orderBy("page_title")
    plain = got.select("project", "page_title", "view_count", "access_method", "filename").collect()
    name = "pageviews-20240101-130000.gz"
    assert [tuple(row) for row in plain] == [
        ("en.wikipedia", "Main_Page", 42, "desktop", name),
        ("de", "Page", None, "mobile-web", name),
        ("en", "Short", None, None, name),
    ]


def test_enrich_keeps_unlisted_files(spark, tmp_path):
    for day in (1, 2):
        with gzip.open(tmp_path / f"pageviews-2024010{day}-130000.gz", "wt") as out:
            out.write("en A 1 desktop\n")
    parsed = pageview_files.parse_pageview_lines(spark, str(tmp_path))
    got = pageview_files.enrich_pageviews(parsed, manifest(spark, "pageviews-20240101-130000.gz"))
    assert sorted((row.file_size_bytes or 0) for row in got.collect()) == [0, 10]
    assert {row.data_source for row in got.collect()} == {"wikimedia_pageviews"}


def test_layer_overwrites_data_and_schema(spark, tmp_path):
    path = str(tmp_path / "layer")
    layers.write_layer(spark.range(5).withColumn("part", F.col("id") % 2), path, ["part"])
    layers.write_layer(spark.range(3).withColumn("other", F.lit("x")), path)
    got = layers.read_layer(spark, path)
    assert got.columns == ["id", "other"] and got.count() == 3


def test_clustered_rewrite_splits_a_hot_key_and_skips_files(spark, tmp_path):
    hot = spark.range(4000).select(F.lit("en").alias("project"), F.lit(1).alias("views"), "id")
    cold = spark.range(2000).select(F.format_string("p%03d", F.col("id") % 50).alias("project"), F.lit(2).alias("views"), "id")
    path = str(tmp_path / "clustered")
    layers.clustered_rewrite(hot.unionByName(cold), path, ["project", "views"], files=6)
    read = spark.read.parquet(path)
    assert read.count() == 6000
    files = read.where("project = 'en'").select(F.input_file_name()).distinct().count()
    assert files > 1
    assert read.where("project = 'p049'").select(F.input_file_name()).distinct().count() <= 2


def test_clustered_rewrite_skips_files_by_each_column(spark, tmp_path):
    """By the statistics of the files, a filter on any one column touches two fifths of 64 files at most, on average."""
    mixed = F.xxhash64("id")
    df = spark.range(64_000).select(
        F.format_string("p%02d", F.pmod(mixed, F.lit(40))).alias("project"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("int").alias("views"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(300)).cast("int")).alias("day"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("note"),
    )
    path = str(tmp_path / "clustered")
    layers.clustered_rewrite(df, path, ["project", "views", "day"], files=64)
    read = spark.read.parquet(path)
    assert read.exceptAll(df).count() == df.exceptAll(read).count() == 0
    sizes = read.groupBy(F.input_file_name().alias("f")).agg(
        *[f(c).alias(f"{c}_{n}") for c in ("project", "views", "day") for n, f in (("low", F.min), ("high", F.max))]
    ).collect()
    for column in ("project", "views", "day"):
        values = [row[0] for row in df.select(column).distinct().collect()]
        touched = sum(row[f"{column}_low"] <= value <= row[f"{column}_high"] for row in sizes for value in values)
        assert touched <= 0.4 * len(sizes) * len(values), column


def test_clustered_rewrite_of_nulls_and_no_rows(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None)] * 5, "project string, views int")
    for number, rows in enumerate((df, df.limit(0))):
        path = str(tmp_path / f"c{number}")
        layers.clustered_rewrite(rows, path, ["project", "views"])
        assert spark.read.schema(df.schema).parquet(path).count() == rows.count()


def test_table_stats(spark, tmp_path):
    layers.write_layer(spark.range(7), str(tmp_path / "t"), table="stats_table")
    got = layers.collect_table_stats(spark, "stats_table", ["id"]).first()
    assert got.row_count == 7 and got.size_in_bytes > 0
    spark.sql("DROP TABLE stats_table")
