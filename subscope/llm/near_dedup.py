"""Near-duplicate documents by an LSH forest over MinHash signatures.

Each distinct shingle set has a signature of TREES * DEPTH minima. Every tree orders all sets by its own DEPTH minima;
sets that share a long prefix stand side by side there. The candidates of a set are its WINDOW next sets in each
order, as far as they share MIN_DEPTH minima. In a sparse region that is every set with that prefix; in a dense one
the window reaches only those with longer common prefixes, so the depth follows the region. A sketch of a few bits of
every minimum travels with the prefixes, so that a candidate whose minima agree too seldom goes no further. Where a window ends
inside a region, the sets on both sides were cut off from the rest of it. Sets cut in CUT_TREES orders or more go
through an exact search on their rarest shingles, which finds every similar pair among them that the windows left out.

Sets are compared once per distinct set, whatever the number of copies, and a pair is confirmed on the full sets. A pair
whose ends are connected already needs no comparison, so the most promising candidates are confirmed first, then the best one
between every two components that still have any, and so on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.components import components
from subscope.llm.shared import Held, one_text_per_id
from subscope.llm.words import Words, chunks, mix

TREES = 16
DEPTH = 8
#: Orders whose direct neighbours are compared before all windows of all orders.
FIRST_TREES = 4
MIN_DEPTH = 2
WINDOW = 8
#: A pair at the threshold shares MIN_DEPTH minima in 9 orders on average, and in fewer than CUT_TREES with probability
#: 0.0004; the windows can lose it only if they cut it off in each of those.
CUT_TREES = 3
#: Bits of a minimum in the sketch, and how many of the minima must agree in them. At the threshold 98 of 128 do on
#: average, and fewer than LEAST_AGREED with probability 2e-8.
SKETCH_BITS = 4
LEAST_AGREED = 67
#: Sets are alike if 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75

_seeds = mix(np.arange(1, 2 * TREES * DEPTH + 1, dtype=np.uint64))
_MULTIPLY = (_seeds[: TREES * DEPTH] | np.uint64(1)).astype(np.uint32)
_FLIP = (_seeds[TREES * DEPTH :] >> np.uint64(32)).astype(np.uint32)

SIGNED = "doc_id long, n long, d1 long, d2 long, signature binary, sketch binary"
SETS = "doc_id long, shingles array<long>"
TREE = "tree int, prefix binary, id long, n long, root long, sketch binary"
PAIRS = "a long, b long, root_a long, root_b long, tree int, common int, cut boolean"


def _signature(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """All minima, big-endian, so that the order of the bytes is the order of the numbers; and their sketch."""
    halves = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(halves), 4096):
        np.minimum(least, ((halves[at : at + 4096, None] ^ _FLIP) * _MULTIPLY).min(axis=0), out=least)
    # Small minima have the same high bits: they are multiplied first.
    bits = ((least * np.uint32(0x9E3779B1)) >> np.uint32(32 - SKETCH_BITS)).astype(np.uint8)
    return least.astype(">u4").tobytes(), (bits[0::2] << SKETCH_BITS | bits[1::2]).tobytes()


def _agreed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """In how many minima the sketches agree, row by row."""
    differ = one ^ two
    differ |= differ >> np.uint64(1)
    differ |= differ >> np.uint64(2)
    differ &= np.uint64(0x1111111111111111)
    return TREES * DEPTH - np.bitwise_count(differ).sum(axis=1, dtype=np.int64)


def _sign(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for at, to, data, offsets in chunks(texts):
            n, d1, d2, signatures, sketches = [], [], [], [], []
            for shingles in Words(data, offsets).shingles():
                n.append(len(shingles))
                d1.append(int(mix(shingles).sum().astype(np.int64)))
                d2.append(int(np.bitwise_xor.reduce(mix(shingles ^ np.uint64(0x5BD1E995))).astype(np.int64)))
                signature, sketch = _signature(shingles) if len(shingles) else (None, None)
                signatures.append(signature)
                sketches.append(sketch)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, to - at), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(signatures, pa.binary()), pa.array(sketches, pa.binary())],
                names=["doc_id", "n", "d1", "d2", "signature", "sketch"],
            )


def _sets(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for at, to, data, offsets in chunks(texts):
            sets = [s.view(np.int64) for s in Words(data, offsets).shingles()]
            lengths = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), lists], names=["doc_id", "shingles"])


def _plant(batches):
    width = 4 * DEPTH
    for batch in batches:
        ids, sizes, roots, sketches, signatures = (batch.column(i) for i in range(5))
        signatures = signatures.to_pylist()
        for tree in range(TREES):
            prefixes = [s[tree * width : (tree + 1) * width] for s in signatures]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), tree, dtype=np.int32)), pa.array(prefixes, pa.binary()), ids, sizes, roots, sketches],
                names=["tree", "prefix", "id", "n", "root", "sketch"],
            )


def _neighbours(window: int, borders: bool):
    """Pairs of the sorted rows of one partition; with `borders` also its first and last rows (b null)."""

    def neighbours(batches):
        rest = None
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([batch])
            if rest is None and borders:
                yield _border(rows.slice(0, window))
            fresh = 0 if rest is None else len(rest)
            rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
            yield from _sweep(rows, fresh, window)
            rest = rows.slice(max(0, len(rows) - window))
        if rest is not None and borders:
            yield _border(rest)

    return neighbours


def _border(rows):
    none = pa.nulls(len(rows), pa.int64())
    tree = rows.column("tree").combine_chunks()
    return pa.RecordBatch.from_arrays(
        [rows.column("id").combine_chunks(), none, none, none, tree, pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.bool_())],
        names=["a", "b", "root_a", "root_b", "tree", "common", "cut"],
    )


def _sweep(rows, fresh, window):
    """Pairs at most `window` apart with a row from `fresh` on, different roots and sketches that agree often enough.

    cut: the window ended in a region.
    """
    tree = rows.column("tree").to_numpy()
    ids, sizes, roots = (rows.column(c).to_numpy() for c in ("id", "n", "root"))
    prefix = np.frombuffer(b"".join(rows.column("prefix").to_pylist()), dtype=">u4").reshape(-1, DEPTH)
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), dtype=np.uint64).reshape(len(ids), -1)
    for apart in range(1, window + 1):
        low = max(0, fresh - apart)
        if len(ids) - apart <= low:
            return
        one, two = slice(low, len(ids) - apart), slice(low + apart, len(ids))
        common = np.logical_and.accumulate(prefix[one] == prefix[two], axis=1).sum(axis=1)
        near = (common >= MIN_DEPTH) & (tree[one] == tree[two]) & (ids[one] != ids[two])
        small, large = np.minimum(sizes[one], sizes[two]), np.maximum(sizes[one], sizes[two])
        possible = near & (roots[one] != roots[two]) & (100 * small >= SIMILARITY * large)
        likely = np.flatnonzero(possible)
        possible[likely] = _agreed(sketch[one][likely], sketch[two][likely]) >= LEAST_AGREED
        cut = near if apart == window else np.zeros(len(near), dtype=bool)
        chosen = np.flatnonzero(possible | cut)
        a, b = ids[one][chosen], ids[two][chosen]
        root_a, root_b = roots[one][chosen], roots[two][chosen]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(np.minimum(root_a, root_b)),
             pa.array(np.maximum(root_a, root_b)), pa.array(tree[one][chosen]), pa.array(np.where(possible, common, 0)[chosen].astype(np.int32)), pa.array(cut[chosen])],
            names=["a", "b", "root_a", "root_b", "tree", "common", "cut"],
        )


def forest_pairs(held: Held, classes: DataFrame, window: int, trees: int = TREES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidate pairs (a, b, votes, root_a, root_b) of different roots from the first `trees` orders, the sets (id) cut off
    in CUT_TREES orders, and all sets with a neighbour that shares MIN_DEPTH minima.

    `classes` has id, n, root, signature and sketch. The orders are range partitions, so a region of any size is spread over
    tasks. The first and last rows of every partition, `window` of each, are swept again together; their number
    follows the number of partitions.
    """
    columns = ["id", "n", "root", "sketch"]
    order = ["tree", "prefix", "id"]
    planted = classes.select(*columns, "signature").mapInArrow(_plant, TREE)
    ordered = planted.repartitionByRange(*order).sortWithinPartitions(*order)
    swept = held.table(ordered.mapInArrow(_neighbours(window, True), PAIRS))
    border = swept.where("b IS NULL").select("tree", F.col("a").alias("id")).distinct()
    prefix = F.expr(f"substring(signature, tree * {4 * DEPTH} + 1, {4 * DEPTH})").alias("prefix")
    border = classes.select(*columns, "signature").join(border, "id").select("tree", prefix, *columns)
    across = border.repartition(1).sortWithinPartitions(*order).mapInArrow(_neighbours(window, False), PAIRS)
    every = held.table(swept.where("b IS NOT NULL").union(across))
    held.drop(swept)
    cut = every.where("cut").select(F.explode(F.array("a", "b")).alias("id"), F.expr("shiftleft(1, tree)").alias("bit"))
    cut = cut.groupBy("id").agg(F.bit_or("bit").alias("trees")).where(F.bit_count("trees") >= CUT_TREES).select("id")
    pairs = every.where(f"common > 0 AND tree < {trees}").groupBy("a", "b", "root_a", "root_b")
    pairs = pairs.agg(F.sum("common").alias("votes"))
    return pairs, cut, every.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that are alike on their full sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("one"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("two"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("one", "two"))
    alike = 100 * shared >= SIMILARITY * (F.size("one") + F.size("two") - shared)
    return joined.where(alike).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not connected yet, with the components of both ends, the smaller first."""
    left = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    right = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    joined = pairs.join(left, "a", "left").join(right, "b", "left")
    one, two = F.coalesce("root_a", "a"), F.coalesce("root_b", "b")
    joined = joined.select("a", "b", "votes", F.least(one, two).alias("root_a"), F.greatest(one, two).alias("root_b"))
    return joined.where("root_a < root_b")


def _connect(held: Held, roots: DataFrame, links: DataFrame) -> DataFrame:
    stars = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
    return components(held.spark, held, stars.union(links))


def _linked(held: Held, pairs: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """The components (node, root) after every pair was confirmed whose ends nothing else connects.

    `pairs` have the components of both ends. A round takes one pair between every two components. When few of them are
    alike, or rounds no longer halve what is left, hardly any pair gets connected by others, and all are confirmed at once.
    """
    before = None
    while True:
        pairs = held.table(pairs)
        left = pairs.count()
        if not left:
            return roots
        best = F.max(F.struct("votes", F.col("a").alias("a"), F.col("b").alias("b"))).alias("p")
        slow = before is not None and 2 * left > before
        chosen = pairs.select("a", "b") if slow else pairs.groupBy("root_a", "root_b").agg(best).select("p.a", "p.b")
        chosen = held.table(chosen)
        links = held.table(_confirmed(chosen, sets))
        roots = _connect(held, roots, links)
        if slow:
            return roots
        others = pairs.join(chosen, ["a", "b"], "left_anti")
        if 10 * links.count() < chosen.count():
            return _connect(held, roots, held.table(_confirmed(others, sets)))
        before = left
        pairs = _apart(others.select("a", "b", "votes"), roots)


def _with_partner(probes: DataFrame) -> DataFrame:
    """The probes that may have a partner in another component: one no larger than they reach, and one that reaches them.

    The two components with the smallest members at a shingle, and the two that reach farthest, tell this for all.
    """
    each = probes.groupBy("s", "root").agg(F.min("n").alias("low"), F.max("largest").alias("reach"))
    smallest = F.min(F.struct("low", "root")).alias("smallest")
    farthest = F.max(F.struct("reach", "root")).alias("farthest")
    first = each.groupBy("s").agg(F.count("*").alias("roots"), smallest, farthest).where("roots > 1")
    second = each.join(first.select("s", "smallest", "farthest"), "s").groupBy("s").agg(
        F.min(F.when(F.col("root") != F.col("smallest.root"), F.col("low"))).alias("next_low"),
        F.max(F.when(F.col("root") != F.col("farthest.root"), F.col("reach"))).alias("next_reach"),
    )
    known = first.join(second, "s").select("s", "smallest", "farthest", "next_low", "next_reach")
    low = F.when(F.col("root") == F.col("smallest.root"), F.col("next_low")).otherwise(F.col("smallest.low"))
    reach = F.when(F.col("root") == F.col("farthest.root"), F.col("next_reach")).otherwise(F.col("farthest.reach"))
    return probes.join(known, "s").where((low <= F.col("largest")) & (F.col("n") <= reach)).select(*probes.columns)


def _rare_shingle_pairs(held: Held, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Every pair (a, b, votes) of these sets that may be alike and is not connected yet.

    Shingles are ordered by how many of the sets have them, then by value. Alike sets x and y with n(y) <= n(x) share
    one of the n(x) - ceil(0.75 n(x)) + 1 first shingles of x and of the n(y) - ceil(1.5 n(y) / 1.75) + 1 first of y, and
    at the first that they share enough others must still follow in both. A shingle brings forth pairs only between
    different components.
    """
    each = sets.select(F.col("doc_id").alias("id"), F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    counted = each.groupBy("s").agg(F.count("*").alias("k")).where("k > 1")
    ranked = each.join(counted, "s").groupBy("id").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("k", "s"))).alias("order")
    )
    # Shingles of one set only come first in the order and can be in no other set.
    alone = F.col("n") - F.size("order")
    prefix = F.greatest(F.lit(0), F.col("n") - F.ceil(F.col("n") * SIMILARITY / 100) + 1 - alone)
    index = F.col("n") - F.ceil(F.col("n") * 2 * SIMILARITY / (100 + SIMILARITY)) + 1
    probes = ranked.where(prefix > 0).select(
        "id", "n", alone.alias("alone"), index.alias("index"), F.posexplode(F.slice("order", F.lit(1), prefix.cast("int")))
    )
    rooted = roots.select(F.col("node").alias("id"), "root")
    place = (F.col("alone") + F.col("pos")).alias("place")
    probes = probes.join(rooted, "id", "left").select(
        "id", "n", place, "index", F.col("col.s").alias("s"), F.coalesce("root", "id").alias("root")
    )
    # What follows a place must hold what a partner needs, so later places meet smaller partners only: at most this size.
    largest = F.floor((F.col("n") - F.col("place")) * (100 + SIMILARITY) / SIMILARITY) - F.col("n")
    probes = held.table(probes.withColumn("largest", largest))
    probes = held.table(_with_partner(probes))
    parts = probes.select("s", "root").distinct()
    # Shingles that occur in the same components bring forth the same pairs: they count as one, at the first place.
    total = F.sum(F.xxhash64("root").cast("decimal(20,0)")).alias("sum")
    lists = parts.groupBy("s").agg(F.count("*").alias("k"), total).where("k > 1")
    merged = probes.join(lists, "s").groupBy(F.xxhash64("k", "sum").alias("s"), "id", "n", "root", "index").agg(
        F.min("place").alias("place"), F.max("largest").alias("largest")
    )
    merged = held.table(merged)
    bounds = F.min("n").alias("low"), F.max("n").alias("high"), F.max("largest").alias("reach")
    parts = held.table(merged.groupBy("s", "root").agg(F.count("*").alias("m"), *bounds))
    few, many = (
        parts.select("s", F.col("root").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("m", "low", "high", "reach")])
        for side in ("few", "many")
    )
    # The component with fewer members at a shingle is expanded first; sizes that cannot be alike do not meet.
    sides = few.join(many, ["s"]).where(
        "few <> many AND (m_few < m_many OR (m_few = m_many AND few < many)) AND low_few <= reach_many AND low_many <= reach_few"
        f" AND 100 * high_few >= {SIMILARITY} * low_many AND 100 * high_many >= {SIMILARITY} * low_few"
    )
    one = merged.select("s", F.col("root").alias("few"), F.struct("id", "n", "place", "index").alias("x"))
    two = merged.select("s", F.col("root").alias("many"), F.struct("id", "n", "place", "index").alias("y"))
    met = sides.select("s", "few", "many").join(one, ["s", "few"]).join(two, ["s", "many"])
    needed = f"ceil({SIMILARITY} * (x.n + y.n) / {100 + SIMILARITY})"
    met = met.where(
        f"100 * least(x.n, y.n) >= {SIMILARITY} * greatest(x.n, y.n)"
        " AND ((y.n <= x.n AND y.place < y.index) OR (x.n <= y.n AND x.place < x.index))"
        f" AND least(x.n - x.place, y.n - y.place) >= {needed}"
    )
    pair = [F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")]
    return met.groupBy(*pair).agg(F.count("*").alias("votes"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per distinct doc_id: n_shingles, component_id (the smallest doc_id reachable over links) and kept.

    `docs` needs doc_id and text; other columns are ignored. Words are runs of bytes other than ASCII white space,
    with A-Z in lower case. Texts that are null, empty or without words have no shingle and no link. Rows with a
    null doc_id are left out. Rows that repeat a doc_id are one document with the longest of its texts.
    """
    spark = docs.sparkSession
    held = Held(spark)
    texts = one_text_per_id(held, docs)
    signed = held.table(texts.mapInArrow(_sign, SIGNED))
    digest = ["n", "d1", "d2"]
    classes = signed.where("n > 0")
    classes = held.table(classes.groupBy(*digest).agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("signature", "sketch")]))
    # The direct neighbours in a few orders first: what they connect needs no wider window.
    near, _, touched = forest_pairs(held, classes.withColumn("root", F.col("id")), 1, FIRST_TREES)
    near = held.table(near)
    best = near.groupBy("b").agg(F.max(F.struct("votes", F.col("a").alias("a"))).alias("p")).select("p.a", "b")
    wanted = held.table(touched.withColumnRenamed("id", "doc_id"))
    sets = held.table(texts.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, SETS))
    roots = components(spark, held, held.table(_confirmed(best, sets)))
    others = near.join(best, ["a", "b"], "left_anti").select("a", "b", "votes")
    roots = _linked(held, _apart(others, roots), sets, roots)

    rooted = classes.join(roots, classes.id == roots.node, "left").withColumn("root", F.coalesce("root", "id"))
    pairs, cut, _ = forest_pairs(held, rooted, WINDOW)
    roots = _linked(held, pairs, sets, roots)
    dense = sets.join(cut, sets.doc_id == cut.id, "left_semi")
    roots = _linked(held, _apart(_rare_shingle_pairs(held, dense, roots), roots), sets, roots)

    lowest = classes.join(roots, classes.id == roots.node, "left").select(*digest, F.coalesce("root", "id").alias("root"))
    joined = signed.select("doc_id", *digest).join(lowest, digest, "left")
    component = F.coalesce("root", "doc_id")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )
