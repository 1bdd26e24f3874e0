"""Benchmark passages inside documents: containment search by size-partitioned MinHash sketches.

An item of q distinct shingles is contained in a document if at least ceil(CONTAINMENT * q / 100) of them occur there.
Items are partitioned by size. A partition's sketch holds the `m` smallest MinHash values of each item, where m is
largest q - ceil(...) + 1 in the partition: one of them must occur in any document that contains the item, however long
the document, so no contained item is missed. Documents probe the sketches with the hashes of their shingles.
Candidates are confirmed by the exact number of shared shingles.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.shared import Held

SHINGLE = 5
#: Per cent of an item's distinct shingles that a document must hold.
CONTAINMENT = 75

_SPACE = " \t\n\x0b\x0c\r"
_WORD_GAP = r"[\x20\x09-\x0D]+"


def _each_shingle(df: DataFrame, key: str) -> DataFrame:
    """(key, h): the 64-bit hashes of all five-word shingles in order, empty for a text of fewer words.

    The lambda binds the words, so that they are split once per text wherever the optimiser moves the expression.
    """
    lowered = F.translate(F.btrim("text", F.lit(_SPACE)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = df.select(key, F.array(F.split(lowered, _WORD_GAP)).alias("w"))
    hashes = f"""transform(w, words -> CASE WHEN size(words) >= {SHINGLE}
        THEN transform(sequence(1, size(words) - {SHINGLE - 1}), i -> xxhash64(slice(words, i, {SHINGLE})))
        ELSE CAST(array() AS array<bigint>) END)[0]"""
    return split.select(key, F.expr(hashes).alias("h"))


def _items(benchmark: DataFrame) -> DataFrame:
    """Per item_id: its distinct shingles, their number q, the number that must be shared, and its size class."""
    each = _each_shingle(benchmark, "item_id").select("item_id", F.explode_outer("h").alias("s"))
    each = each.where("item_id IS NOT NULL AND s IS NOT NULL").distinct()
    items = each.groupBy("item_id").agg(F.sort_array(F.collect_list("s")).alias("shingles"))
    q = F.size("shingles")
    items = items.select("item_id", "shingles", q.alias("q"), F.ceil(q * CONTAINMENT / 100).cast("int").alias("needed"))
    return items.withColumn("size_class", F.floor(F.log2("q")).cast("int"))


def _sketches(items: DataFrame) -> DataFrame:
    """(h, item_id, needed): the sketch of every item, as long as the largest of its size class needs."""
    length = items.groupBy("size_class").agg(F.max(F.col("q") - F.col("needed") + 1).alias("m"))
    least = F.expr("slice(array_sort(transform(shingles, s -> named_struct('v', xxhash64(s), 's', s))), 1, m)")
    return items.join(length, "size_class").select("item_id", "needed", F.explode(least).alias("o")).select("item_id", "needed", F.col("o.s").alias("h"))


def contained_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item it contains: doc_id, item_id, n_item, n_shared, containment.

    `docs` needs doc_id and text, `benchmark` item_id and text; other columns are ignored. Words are runs of anything
    but ASCII white space, with A-Z in lower case. Texts that are null or have fewer than five words hold nothing and
    are held by nothing. Rows that repeat a doc_id or item_id count as one document or item with the shingles of
    all its rows. Rows with a null id are left out.
    """
    held = Held(docs.sparkSession)
    items = held.table(_items(benchmark))
    sketches = held.table(_sketches(items))
    texts = docs.select("doc_id", "text")
    probes = _each_shingle(texts, "doc_id").select("doc_id", F.explode_outer("h").alias("h"))
    hits = held.table(probes.join(sketches, "h").select("doc_id", "item_id").distinct())

    wanted = hits.select("doc_id").distinct()
    found = _each_shingle(texts.join(wanted, "doc_id", "left_semi"), "doc_id")
    pairs = hits.join(found, "doc_id").join(items, "item_id")
    shared = pairs.select("doc_id", "item_id", "q", "needed", F.explode(F.array_intersect("h", "shingles")).alias("s"))
    counted = shared.groupBy("doc_id", "item_id", "q", "needed").agg(F.countDistinct("s").alias("n_shared"))
    return counted.where("n_shared >= needed").select(
        "doc_id", "item_id", F.col("q").cast("long").alias("n_item"), "n_shared", (F.col("n_shared") / F.col("q")).alias("containment")
    )
