"""File manifest and gzip pageview lines."""

from pyspark.sql import functions as F

from subscope import schemas
from subscope import settings as S


def read_file_manifest(spark, path, base_url):
    """Manifest CSV with header; the schema is given, so nothing is read to infer it."""
    return (
        spark.read.csv(path, header=True, schema=schemas.MANIFEST)
        .withColumn("timestamp", F.to_timestamp_ntz("timestamp", F.lit(S.MANIFEST_TIME_FORMAT)))
        .withColumn("full_url", F.concat_ws("/", F.lit(base_url), F.col("filename")))
    )


def daily_file_sample(manifest, hours=S.PEAK_HOURS, seed=42):
    """One file per day among the non-empty pageview files of the given hours (both inclusive).

    The choice is random by hash, thus the same on every run, and an aggregate rather than a sort.
    """
    stamp = F.try_to_timestamp(
        F.regexp_extract("filename", f"^{S.PAGEVIEW_FILE}", 1), F.lit(S.PAGEVIEW_FILE_TIME)
    )
    draw = F.struct(F.md5(F.concat(F.lit(str(seed)), F.col("filename"))), F.col("filename"))
    candidates = manifest.where((F.col("file_size_bytes") > 0) & F.hour(stamp).between(*hours))
    return (
        candidates.groupBy(F.to_date(stamp))
        .agg(F.min_by(F.struct(*manifest.columns), draw).alias("file"))
        .select("file.*")
        .orderBy("timestamp")
    )


def parse_pageview_lines(spark, path):
    """Space-separated lines of all files below ``path``; short or malformed lines give NULL fields."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    field = F.split("value", " ")
    location = F.col("_metadata.file_path")
    return lines.select(
        F.get(field, F.lit(0)).alias("project"),
        F.get(field, F.lit(1)).alias("page_title"),
        F.get(field, F.lit(2)).try_cast("int").alias("view_count"),
        F.get(field, F.lit(3)).alias("access_method"),
        location.alias("source_file"),
        F.regexp_extract(location, S.PAGEVIEW_FILE + r"[^/]*", 0).alias("filename"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def enrich_pageviews(parsed, manifest, data_source=S.DATA_SOURCE):
    """Left join to the manifest; lines of an unlisted file keep NULL file columns.

    The manifest grows with the files, so broadcasting is left to Spark's size check; beyond it the
    adaptive skew join splits the large files.
    """
    listed = manifest.select(
        "filename",
        F.col("timestamp").alias("file_timestamp"),
        "file_size_bytes",
        F.col("full_url").alias("source_url"),
    )
    return parsed.join(listed, "filename", "left").select(
        "project",
        "page_title",
        "view_count",
        "access_method",
        "source_file",
        "ingestion_timestamp",
        "file_timestamp",
        "file_size_bytes",
        "source_url",
        F.lit(data_source).alias("data_source"),
    )


def write_pageview_lines(pageviews, path):
    """The inverse of parsing: gzip lines in one folder per source file.

    Ranges of files go to one task each; the row hash as second key splits a file that is too large for one.
    """
    line = F.concat_ws(" ", "project", "page_title", "view_count", "access_method").alias("value")
    (
        pageviews.select(line, "source_file")
        .repartitionByRange(F.col("source_file"), F.xxhash64("value"))
        .write.mode("overwrite")
        .partitionBy("source_file")
        .option("compression", "gzip")
        .text(path)
    )


def write_file_manifest(manifest, path):
    (
        manifest.withColumn("timestamp", F.date_format("timestamp", S.MANIFEST_TIME_FORMAT))
        .select("filename", "timestamp", "file_size_bytes")
        .write.mode("overwrite")
        .csv(path, header=True)
    )
