"""Approximate nearest neighbours by inner product: cross-polytope hashing, several probes a table, exact reranking.

Equal vectors are one class, so that a vector with a third of all rows is hashed and compared once. Classes fall into
bands of norms; in a band, vectors get a last coordinate that makes them units, after which the nearest direction is the
largest inner product. Every class goes to one bucket in each of TABLES tables, a query to the first `probes` buckets of
each. Buckets with more rows than a task should take are dealt into blocks, and queries go to all blocks of theirs.

How fine the buckets are and how many are probed is fitted: for SAMPLE queries the true neighbours are found by comparing
them with all classes, and the cheapest setting that reaches TARGET of them is taken. All rows are indexed and all
queries searched with it; queries that find too few rows are compared with all classes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subscope.llm import cross_polytope
from subscope.llm.shared import Held, is_empty
from subscope.llm.vectors import dimension, finite_rows

NEAREST = 20
TABLES = 8
#: The fit uses at most so many query classes (those with the smallest hash of their number), against all classes.
SAMPLE = 128
#: The share of the sample's true neighbours that the setting must reach.
TARGET = 0.95
#: Mean rows of the finest buckets that the fit tries; bands of no more classes are one bucket.
FINEST = 64
#: What a probed bucket costs besides its rows, in comparisons.
PROBE_COST = 500
#: Probes of a table that the fit looks at.
MOST_PROBES = 1024
#: Candidates and queries that meet in one block of a bucket.
BLOCK = 512
QUERY_BLOCK = 2048
#: Candidates of a block where queries are compared with all classes.
SCAN_BLOCK = 8192
#: Rows that a task holds before it merges them by query.
HELD_ROWS = 500_000
#: Scores by matrix products differ from exact ones in the last places; so many more are compared exactly.
SLACK = 4

PACKED = "vec_id long, vector binary, band int, norm double"
HASHED = "key long, class long, first long, vector binary"
COUNTED = "key long, candidates long, queries long"
SCORED = "query long, class long, first long, score double"
FOUND = "query_id long, rank int, vec_id long, score double"


class Band(NamedTuple):
    band: int
    classes: int
    largest: float


class Setting(NamedTuple):
    bits: tuple
    probes: int


def _packed(dims: int, kind: str):
    def packed(batches):
        for batch in batches:
            kept, x = finite_rows(batch.column(1), dims)
            top = np.abs(x).max(axis=1, initial=0)
            kept[np.flatnonzero(kept)[top == 0]] = False
            x, top = x[top > 0] + 0.0, top[top > 0]  # -0.0 becomes 0.0
            norm = np.minimum(top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1)), np.finfo(np.float64).max)
            raw = x.astype(kind)
            band = np.floor(2 * np.log2(norm) + 0.5).astype(np.int32)
            columns = [batch.column(0).filter(pa.array(kept)), pa.array([v.tobytes() for v in raw], pa.binary()), pa.array(band), pa.array(norm)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "band", "norm"])

    return packed


def _matrix(column: pa.Array, kind: str, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, dims).astype(np.float64)


def _unit_candidates(x: np.ndarray, largest: float) -> np.ndarray:
    x = x / largest
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))])


def _unit_queries(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))])


def _tables(bits: int) -> int:
    return TABLES if bits else 1


def _key(band: int, table: int, code: np.ndarray) -> np.ndarray:
    return ((band * 64 + table) << 44) + code


def _candidate_keys(x, bands_of_rows, bands: list[Band], setting: Setting):
    """(rows, keys) for all tables of the band of each row."""
    for i, (band, bits) in enumerate(zip(bands, setting.bits)):
        rows = np.flatnonzero(bands_of_rows == band.band)
        if len(rows):
            units = _unit_candidates(x[rows], band.largest)
            for table in range(_tables(bits)):
                yield rows, _key(i, table, cross_polytope.buckets(units, table, bits))


def _query_keys(x, bands: list[Band], setting: Setting):
    """(rows, keys) for all probes in all tables of all bands."""
    units, known = _unit_queries(x), {}
    for i, bits in enumerate(setting.bits):
        for table in range(_tables(bits)):
            if (bits, table) not in known:
                known[bits, table] = cross_polytope.probes(units, table, bits, min(setting.probes, 1 << bits))
            codes = known[bits, table]
            yield np.repeat(np.arange(len(x)), codes.shape[1]), _key(i, table, codes.ravel())


def _hashed(kind: str, dims: int, bands: list[Band], setting: Setting, as_query: bool):
    def hashed(batches):
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                x = _matrix(part.column(2), kind, dims)
                keys = _query_keys(x, bands, setting) if as_query else _candidate_keys(x, part.column(3).to_numpy(), bands, setting)
                for rows, key in keys:
                    columns = [pa.array(key), *(part.column(k).take(pa.array(rows)) for k in range(3))]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "class", "first", "vector"])

    return hashed


def _counted(kind: str, dims: int, bands: list[Band], setting: Setting, as_query: bool):
    """The rows of each key in a task."""

    def counted(batches):
        for batch in batches:
            x = _matrix(batch.column(2), kind, dims)
            keys = _query_keys(x, bands, setting) if as_query else _candidate_keys(x, batch.column(3).to_numpy(), bands, setting)
            key, n = np.unique(np.concatenate([k for _, k in keys] or [np.zeros(0, dtype=np.int64)]), return_counts=True)
            n, none = pa.array(n), pa.array(np.zeros(len(n), dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(key), *((none, n) if as_query else (n, none))], names=["key", "candidates", "queries"])

    return counted


class _Best:
    """The best candidates of each query that a task has seen: rows are kept up to a bound, then merged, then handed on."""

    def __init__(self, wanted: int):
        self.wanted, self.rows, self.size = wanted, [], 0
        self.queries, self.floors = np.zeros(0, dtype=np.int64), np.zeros(0)

    def floor(self, query: np.ndarray) -> np.ndarray:
        """Scores below need not be kept: the query has `wanted` better classes already."""
        if not len(self.queries):
            return np.full(len(query), -np.inf)
        at = np.minimum(np.searchsorted(self.queries, query), len(self.queries) - 1)
        return np.where(self.queries[at] == query, self.floors[at], -np.inf)

    def add(self, query, number, first, score):
        """Batches to hand on, if the rows have outgrown the bound even when merged."""
        self.rows.append((query, number, first, score))
        self.size += len(query)
        if self.size > HELD_ROWS:
            self._merge()
            if self.size > HELD_ROWS // 2:
                yield from self.close()

    def _merge(self):
        query, number, first, score = (np.concatenate(x) for x in zip(*self.rows))
        order = np.lexsort((number, first, -score, query))
        query, number, first, score = query[order], number[order], first[order], score[order]
        fresh = np.concatenate([[True], (query[1:] != query[:-1]) | (number[1:] != number[:-1])])
        query, number, first, score = query[fresh], number[fresh], first[fresh], score[fresh]
        starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(query)]])))
        last = rank == self.wanted - 1
        self.queries, self.floors = query[last], score[last]
        kept = rank < self.wanted
        self.rows, self.size = [(query[kept], number[kept], first[kept], score[kept])], int(kept.sum())

    def close(self):
        if self.size:
            self._merge()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in self.rows[0]], names=["query", "class", "first", "score"])
        self.rows, self.size = [], 0


def _scores(kind: str, dims: int, wanted: int):
    """From rows sorted by block, candidates before queries: the best candidates of each query in the task."""

    def scored(batches):
        block, held, candidates, best = None, [], None, _Best(wanted)
        for batch in batches:
            place = np.stack([batch.column(k).to_numpy() for k in range(4)])
            edges = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
                if start == end:
                    continue
                some = batch.slice(start, end - start)
                here, is_query = tuple(place[:3, start].tolist()), bool(place[3, start])
                if here != block:
                    block, held, candidates = here, [], None
                if not is_query:
                    held.append(some)
                    continue
                if not held:
                    continue
                if candidates is None:
                    candidates = pa.Table.from_batches(held).combine_chunks()
                    c = _matrix(candidates.column("vector"), kind, dims)
                    number, first = (candidates.column(k).to_numpy() for k in ("class", "first"))
                for at in range(0, len(some), 256):
                    part = some.slice(at, 256)
                    query = part.column(4).to_numpy()
                    yield from best.add(*_best_of_block(query, _matrix(part.column(6), kind, dims), number, first, c, best))
        yield from best.close()

    return scored


def _best_of_block(query, q, number, first, c, best: _Best):
    """The rows (query, class, first, score) of a block that may be among the best of their queries."""
    k = min(best.wanted + SLACK, len(c))
    rough = q @ c.T
    places = np.argpartition(-rough, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(q)), k)
    places = places.ravel()
    near = rough[rows, places]
    kept = near >= best.floor(query)[rows] - 1e-9 * np.abs(near)
    rows, places = rows[kept], places[kept]
    score = (c[places].astype(np.longdouble) * q[rows]).sum(axis=1).astype(np.float64)
    return query[rows], number[places], first[places], score


def _met(held: Held, candidates: DataFrame, queries: DataFrame, blocks: DataFrame, kind: str, dims: int, wanted: int) -> DataFrame:
    """The best `wanted` classes of each query among the candidates that share a key with it.

    `blocks` says into how many blocks the candidates (i) and queries (j) of a key are dealt, where that is not one. A
    row goes to one block of its own side and to all blocks of the other side.
    """

    def dealt(df, is_query):
        own, other = ("q_blocks", "c_blocks") if is_query else ("c_blocks", "q_blocks")
        df = df.join(blocks, "key", "left").na.fill(1, [own, other])
        mine = F.pmod(F.xxhash64("class"), F.col(own)).alias("j" if is_query else "i")
        others = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias("i" if is_query else "j")
        return df.select("key", mine, others, F.lit(int(is_query)).alias("is_query"), "class", "first", "vector")

    both = dealt(candidates, False).unionByName(dealt(queries, True))
    both = both.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "is_query")
    scored = both.select("key", "i", "j", "is_query", "class", "first", "vector").mapInArrow(_scores(kind, dims, wanted), SCORED)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "first", "class")
    distinct = scored.repartition("query").dropDuplicates(["query", "class"])
    return held.table(distinct.withColumn("r", F.row_number().over(best)).where(F.col("r") <= wanted).drop("r"))


def _blocks(counts: DataFrame, block: int) -> DataFrame:
    n = counts.groupBy("key").agg(F.sum("candidates").alias("c"), F.sum("queries").alias("q"))
    dealt = [F.greatest(F.ceil(F.col(x) / size), F.lit(1)).alias(f"{x}_blocks") for x, size in (("c", block), ("q", QUERY_BLOCK))]
    return n.select("key", *dealt).where("c_blocks > 1 OR q_blocks > 1")


def _compared_with_all(held: Held, classes: DataFrame, queries: DataFrame, kind: str, dims: int, wanted: int) -> DataFrame:
    """The best classes of each query among all of them, in blocks."""
    rows = [df.select(F.lit(-1).cast("long").alias("key"), "class", "first", "vector") for df in (classes, queries)]
    counts = [df.agg(F.lit(-1).cast("long").alias("key"), *own) for df, own in (
        (classes, (F.count("*").alias("candidates"), F.lit(0).cast("long").alias("queries"))),
        (queries, (F.lit(0).cast("long").alias("candidates"), F.count("*").alias("queries"))),
    )]
    return _met(held, *rows, held.table(_blocks(counts[0].union(counts[1]), SCAN_BLOCK)), kind, dims, wanted)


def fitted(pairs: list[tuple], bands: list[Band]) -> Setting:
    """The cheapest setting that reaches TARGET of `pairs`: (query, candidate, band of the candidate) as matrices.

    The same number of probes holds for all bands; their bits follow their numbers of classes.
    """
    queries, candidates, of = pairs
    finest = [max(0, int(np.log2(b.classes / FINEST))) for b in bands]
    choices = []
    for coarser in range(max(finest) + 1):
        bits = tuple(max(f - coarser, min(f, 1)) for f in finest)
        ranks = np.full(len(queries), MOST_PROBES + 1)
        units = _unit_queries(queries)
        for band, b in zip(bands, bits):
            rows = np.flatnonzero(of == band.band)
            if not len(rows):
                continue
            own = _unit_candidates(candidates[rows], band.largest)
            for table in range(_tables(b)):
                probed = cross_polytope.probes(units[rows], table, b, min(MOST_PROBES, 1 << b))
                hit = probed == cross_polytope.buckets(own, table, b)[:, None]
                rank = np.where(hit.any(axis=1), hit.argmax(axis=1) + 1, MOST_PROBES + 1)
                ranks[rows] = np.minimum(ranks[rows], rank)
        need = int(np.sort(ranks)[int(np.ceil(TARGET * len(ranks))) - 1]) if len(ranks) else 1
        if need <= MOST_PROBES:
            cost = sum(_tables(b) * min(need, 1 << b) * (band.classes / (1 << b) + PROBE_COST) for band, b in zip(bands, bits))
            choices.append((cost, coarser, Setting(bits, need)))
    return min(choices)[2]


def nearest(df: DataFrame, every: int = 20, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The NEAREST rows by inner product of each query: query_id, rank (from 1), vec_id and score.

    Queries are the rows whose id is divisible by `every`, candidates all rows but the query's own. Nearest first, ties
    by the smaller id; fewer rows only where there are fewer candidates. The score is the inner product of the given
    vectors, rounded once to a double. The result is approximate: TARGET of the neighbours of a sample were reached.

    Rows without an id, and vectors that are null, zero, hold null or non-finite entries or differ from the most
    frequent length, take no part. Rows that repeat an id or a vector are rows of their own. Other columns are ignored.
    A table with one row or none gives no rows.
    """
    spark = df.sparkSession
    held = Held(spark)
    kind = "<f4" if dict(df.dtypes)[column] == "array<float>" else "<f8"
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).where("vec_id IS NOT NULL")
    dims = dimension(rows, "v")
    packed = rows.mapInArrow(_packed(dims, kind), PACKED)
    # A query needs no more rows of a class than the smallest ids, its own among them perhaps.
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    few = packed.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= NEAREST + 1)
    grouped = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.max("band").alias("band"), F.max("norm").alias("norm"))
    classes = held.table(grouped.select(F.monotonically_increasing_id().alias("class"), F.col("ids")[0].alias("first"), "vector", "band", "norm", "ids"))
    asked = packed.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    asked = held.table(asked.join(classes.select("class", "vector"), "vector").select("query_id", F.col("class").alias("query")))
    if is_empty(asked):
        return spark.createDataFrame([], FOUND)
    indexed = classes.select("class", "first", "vector", "band")
    queries = held.table(indexed.join(asked.select(F.col("query").alias("class")).distinct(), "class", "left_semi"))

    by_band = classes.groupBy("band").agg(F.count("*").alias("n"), F.max("norm").alias("largest")).collect()  # by powers of two
    bands = sorted(Band(r["band"], r["n"], r["largest"]) for r in by_band)
    sample = held.table(queries.orderBy(F.xxhash64("class"), "class").limit(SAMPLE))
    truth = _compared_with_all(held, indexed, sample, kind, dims, NEAREST)
    pairs = truth.join(sample.select(F.col("class").alias("query"), F.col("vector").alias("q")), "query").join(indexed, "class")
    found = pairs.select("q", "vector", "band").collect()  # SAMPLE * NEAREST rows at most
    q, c = (np.frombuffer(b"".join(r[k] for r in found), dtype=kind).reshape(-1, dims).astype(np.float64) for k in (0, 1))
    setting = fitted((q, c, np.array([r["band"] for r in found])), bands)

    hashing = (kind, dims, bands, setting)
    counts = [t.mapInArrow(_counted(*hashing, as_query), COUNTED) for t, as_query in ((indexed, False), (queries, True))]
    blocks = held.table(_blocks(counts[0].union(counts[1]), BLOCK))
    hashed = [t.mapInArrow(_hashed(*hashing, as_query), HASHED) for t, as_query in ((indexed, False), (queries, True))]
    best = _met(held, *hashed, blocks, kind, dims, NEAREST + 1)
    lists = held.table(_lists(best, classes))
    reached = lists.where(F.size("found") > NEAREST).select(F.col("query").alias("class"))
    missed = held.table(queries.join(reached, "class", "left_anti"))
    if not is_empty(missed):
        more = _lists(_compared_with_all(held, indexed, missed, kind, dims, NEAREST + 1), classes)
        lists = lists.where(F.size("found") > NEAREST).unionByName(more)

    # The query's own row is one of those that share its class and id.
    joined = asked.join(lists, "query")
    own = F.array_position(F.transform("found", lambda x: (x["vec_id"] == F.col("query_id")) & (x["class"] == F.col("query"))), True)
    others = F.filter("found", lambda x, i: i + 1 != F.col("own"))
    ranked = joined.withColumn("own", own).select("query_id", F.posexplode(F.slice(others, 1, NEAREST)).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def _lists(best: DataFrame, classes: DataFrame) -> DataFrame:
    """(query, found): the first NEAREST + 1 rows of each query's classes, by falling score and rising id."""
    rows = best.join(classes.select("class", "ids"), "class").select("query", "class", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "class")
    rows = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= NEAREST + 1)
    found = F.sort_array(F.collect_list(F.struct("r", "vec_id", "class", "score")))
    return rows.groupBy("query").agg(found.alias("found"))
