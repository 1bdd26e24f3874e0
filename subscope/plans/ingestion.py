"""From the file manifest to a clustered bronze table of the sampled files."""

from pyspark.sql import functions as F

from subscope import settings as S
from subscope.sources.layers import clustered_rewrite, read_layer, write_layer
from subscope.sources.pageview_files import (
    daily_file_sample,
    enrich_pageviews,
    parse_pageview_lines,
    read_file_manifest,
)

CLUSTER_COLUMNS = ["project", "access_method", "view_count"]


def sampled_paths(manifest, folder, layout="{folder}/{name}", hours=S.PEAK_HOURS, seed=42):
    """Paths of the sampled files: one per calendar day, so the list is short and only these are read."""
    names = daily_file_sample(manifest, hours, seed).select("filename").collect()
    return [layout.format(folder=folder, name=row.filename) for row in names]


def ingest_pageviews(spark, manifest_path, folder, target, base_url, layout="{folder}/{name}"):
    """Read the sampled files, add their manifest data, and write the bronze table by day and project."""
    manifest = read_file_manifest(spark, manifest_path, base_url)
    parsed = parse_pageview_lines(spark, sampled_paths(manifest, folder, layout))
    enriched = enrich_pageviews(parsed, manifest).withColumn("file_date", F.to_date("file_timestamp"))
    return write_layer(enriched, target, ["file_date", "project"])


def compact(spark, path, target):
    """Rewrite a bronze table with co-located keys."""
    return clustered_rewrite(read_layer(spark, path), target, CLUSTER_COLUMNS)
