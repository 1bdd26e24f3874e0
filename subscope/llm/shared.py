"""Intermediate tables in the shared folder, and small helpers that several operators use."""

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folder = None


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where it is unset, a temporary folder in local mode and an error on a cluster."""
    global _local_folder
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    _local_folder = _local_folder or tempfile.mkdtemp(prefix="llm-")
    return _local_folder


def ship_code(spark: SparkSession) -> None:
    """Gives the executors this package, once per application, so that tasks can import it."""
    context = spark.sparkContext
    if any(Path(file).name == "subscope.zip" for file in context._jsc.sc().listFiles().mkString("\n").split("\n")):
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="llm-code-")
    context.addPyFile(shutil.make_archive(f"{folder}/subscope", "zip", package.parent, package.name))


class Held:
    """Tables written once to the shared folder, so that no later failure recomputes what made them.

    `drop` removes a table that nothing reads any more; what a returned DataFrame still reads stays until the
    caller empties the shared folder.
    """

    def __init__(self, spark: SparkSession):
        ship_code(spark)
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self.count = 0

    def table(self, df: DataFrame, tidy: bool = False) -> DataFrame:
        """`df` as a written table. With `tidy`, the files of its shuffles go at once, not at some garbage collection later."""
        path = f"{self.folder}/{self.count}"
        self.count += 1
        before = self.spark.conf.get(SHUFFLE_CLEANUP)
        self.spark.conf.set(SHUFFLE_CLEANUP, "true" if tidy else before)
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, before)
        held = self.spark.read.schema(df.schema).parquet(path)
        held.held_path = path
        return held

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table.held_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def is_empty(df: DataFrame) -> bool:
    return not df.select(F.lit(1)).head(1)


def one_text_per_id(held: Held, docs: DataFrame) -> DataFrame:
    """(doc_id, text) of rows with a doc_id; of rows that repeat one, the longest text, and of those the greatest."""
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    again = held.table(texts.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if is_empty(again):
        held.drop(again)
        return texts
    longest = F.max_by("text", F.struct(F.coalesce(F.length("text"), F.lit(-1)), "text")).alias("text")
    merged = texts.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(longest)
    return texts.join(again, "doc_id", "left_anti").unionByName(merged)
