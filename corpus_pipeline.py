"""A cleaning run over the documents table: every stage works on what its predecessor kept."""

import public_tokenizers
from pyspark.sql import functions as F

from subscope.llm import decontamination, near_dedup, packing, quality_rules, secret_scan
from subscope.llm.shared import Held

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_enough(spark, docs, sf_dir):
    """Documents that no quality rule rejects stay."""
    return quality_rules.passing(docs.select(*COLUMNS))


def one_of_each_group(spark, docs, sf_dir):
    """One document of each group of near duplicates stays: the one with the smallest doc_id, nulls last.

    Rows without a doc_id or with one that others have too are documents of their own; of whole rows that repeat, one is.
    """
    ids = docs.groupBy("doc_id").count()
    if not ids.where("count > 1 OR doc_id IS NULL").head(1):
        kept = near_dedup.near_duplicates(docs).where("kept").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)
    # The order of doc_id, numbered anew; the numbers are written once, so that all later reads see the same.
    order = [F.col("doc_id").asc_nulls_last(), *[c for c in COLUMNS if c != "doc_id"]]
    rows = docs.select(*COLUMNS).distinct().sort(*order).withColumn("row", F.monotonically_increasing_id())
    rows = Held(spark).table(rows)
    numbered = rows.select(F.col("row").alias("doc_id"), "text")
    kept = near_dedup.near_duplicates(numbered).where("kept").select(F.col("doc_id").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def without_benchmark(spark, docs, sf_dir):
    """Documents that contain an item of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaked = decontamination.contained_items(docs, benchmark).select("doc_id").distinct()
    return docs.join(leaked, "doc_id", "left_anti").select(*COLUMNS)


def without_secrets(spark, docs, sf_dir):
    """All documents stay; their secrets are replaced by the names of their kinds, and n_chars follows the text."""
    return secret_scan.redacted(docs.select(*COLUMNS))


def as_sequences(spark, docs, sf_dir):
    """Token pieces and their places in sequences of at most 4096 tokens."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", good_enough),
    ("near duplicates", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scan", without_secrets),
    ("best-fit packing", as_sequences),
]

#: Token ids have no SQL; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage. Every stage's rows are written before the next one reads them."""
    held = Held(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        docs = held.table(kept) if i < len(STAGES) - 1 else kept
    return docs
