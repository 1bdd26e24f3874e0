from pyspark.sql import functions as F

from subscope.operators.features import feature_matrix
from subscope.plans import medallion
from subscope.session import shared_dir
from subscope.sources import driver_tables as D

REPORTS = 17


def test_layers_and_dashboard(spark, sf_dir, tmp_path):
    base = str(tmp_path)
    behavior, subs = D.behavior(spark, sf_dir), D.subscriptions(spark, sf_dir)
    medallion.build_bronze(base, D.pageviews(spark, sf_dir), behavior, subs)
    medallion.build_silver(spark, base)
    silver = spark.read.parquet(f"{base}/{medallion.FEATURES}")
    expected = feature_matrix(behavior, subs)
    spread = {"stddev_session_duration": F.round("stddev_session_duration", 6)}
    assert silver.select(expected.columns).withColumns(spread).exceptAll(expected.withColumns(spread)).isEmpty()
    medallion.build_gold(spark, base, medallion.train(spark, base, numTrees=3, maxDepth=2))
    reports = medallion.dashboard(spark, base)
    assert len(reports) == REPORTS
    for name, report in reports.items():
        assert report.columns, name
        report.collect()


def test_shared_dir_reads_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second
    if root:
        assert first.startswith(root)
