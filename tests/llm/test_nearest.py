"""Nearest neighbours against all inner products."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from subscope.llm import cross_polytope, nearest, queries

VECTORS = "vec_id long, embedding array<float>, label int, key long, class string, first string"


@pytest.fixture
def table(spark):
    def make(rows, kind="float"):
        return spark.createDataFrame([(i, v, 1, 2, "c", "f") for i, v in rows], VECTORS.replace("float", kind)).repartition(3)

    return make


def brute(rows, every=20, most=20):
    """{(query row, rank): (vec_id, score)} of each query, from (vec_id, vector) rows that take part."""
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q, (i, _) in enumerate(rows):
        if i % every == 0:
            scores = [math.sumprod(p, x[q].tolist()) for p in x.tolist()]
            others = sorted((-s, rows[k][0]) for k, s in enumerate(scores) if k != q)[:most]
            out[q] = [(i, r + 1, j, -s) for r, (s, j) in enumerate(others)]
    return out


def lists(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["query_id"], []).append(tuple(r))
    return {i: sorted(x, key=lambda y: y[1]) for i, x in found.items()}


def recall(expected, found):
    hit = total = 0
    for want in expected.values():
        total += len(want)
        hit += len({x[2] for x in want} & {x[2] for x in found[want[0][0]]})
    return hit / total


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_recall_on_whole_tables(spark, size):
    t = pq.read_table(f"/root/testdata/{size}/embeddings.parquet")
    rows = list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist()))
    expected = brute(rows)
    found = lists(queries.op13_nearest_neighbours(spark, f"/root/testdata/{size}"))
    assert len(found) == len(expected) and all([x[1] for x in own] == list(range(1, 21)) for own in found.values())
    assert recall(expected, found) >= 0.9
    by_id = {i: np.array(v, dtype=np.float64) for i, v in rows}
    for own in found.values():
        assert own == sorted(own, key=lambda x: (-x[3], x[2]))
        assert all(x[3] == math.fsum(by_id[x[0]] * by_id[x[2]]) and x[0] != x[2] for x in own)


def test_few_rows_are_searched_exactly(table):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(5).astype("f4").tolist()) for i in range(41)]
    good += [(100 + i, good[0][1]) for i in range(30)] + [(200 + i, good[3][1]) for i in range(30)]
    good += [(i + 300, (np.array(good[i][1]) * 10.0 ** (i % 7 - 3)).astype("f4").tolist()) for i in range(20)]
    good += [(0, good[0][1]), (20, good[7][1]), (40, good[40][1])]  # repeated rows and ids
    bad = [(400, None), (420, [0.0] * 5), (440, [1.0, 2.0, None, 4.0, 5.0]), (460, [float("nan")] * 5), (480, [1.0]), (None, [1.0] * 5)]
    expected = sorted(x for own in brute(good).values() for x in own)
    assert sorted(map(tuple, nearest.nearest(table(good + bad)).collect())) == expected


@pytest.mark.parametrize("n, kind", [(0, "float"), (1, "float"), (2, "double"), (15, "double")])
def test_fewer_rows_than_wanted(table, n, kind):
    rng = random.Random(2)
    rows = [(i * 20, [rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)]) for i in range(n)]
    expected = sorted(x for own in brute(rows).values() for x in own)
    assert sorted(map(tuple, nearest.nearest(table(rows, kind)).collect())) == expected


def test_groups_of_copies_split_into_blocks(table, monkeypatch):
    """A third of all rows equal, a third nearly equal: all rows are found, whatever the blocks."""
    monkeypatch.setattr(nearest, "BLOCK", 40)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(3)
    centre, other = rng.standard_normal((2, 12))
    rows = [(i, centre.astype("f4").tolist()) for i in range(400)]
    rows += [(400 + i, (other + 1e-4 * rng.standard_normal(12)).astype("f4").tolist()) for i in range(400)]
    rows += [(800 + i, rng.standard_normal(12).astype("f4").tolist()) for i in range(400)]
    expected, found = brute(rows), lists(nearest.nearest(table(rows)))
    assert recall(expected, found) >= 0.9 and {len(x) for x in found.values()} == {20}
    assert all(found[want[0][0]] == want for q, want in expected.items() if q < 400)


def test_queries_that_find_too_few_are_compared_with_all(table, monkeypatch):
    monkeypatch.setattr(nearest, "TARGET", 0.01)
    monkeypatch.setattr(nearest, "FINEST", 1)
    monkeypatch.setattr(nearest, "TABLES", 1)
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(500)]
    assert {len(x) for x in lists(nearest.nearest(table(rows, "double"))).values()} == {20}


def test_norms_of_many_sizes(table):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(16) * 2.0 ** rng.integers(-3, 3)).astype("f4").tolist()) for i in range(1500)]
    assert recall(brute(rows), lists(nearest.nearest(table(rows)))) >= 0.9


def test_rotations_keep_angles_and_probes_start_at_the_own_bucket():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((50, 20))
    y = cross_polytope.rotated(x, 1, 0)
    assert y.shape == (50, 32) and np.allclose(x @ x.T, y @ y.T)
    for bits in (0, 1, 5, 6, 11):
        probes = cross_polytope.probes(x, 2, bits, 1 << bits)
        assert (probes[:, 0] == cross_polytope.buckets(x, 2, bits)).all()
        assert all(sorted(row) == list(range(1 << bits)) for row in probes.tolist())


def test_near_vectors_share_buckets_more_often():
    rng = np.random.default_rng(7)
    x = rng.standard_normal((400, 32))
    near, far = x + 0.2 * rng.standard_normal(x.shape), rng.standard_normal(x.shape)
    same = [np.mean([(cross_polytope.buckets(x, t, 6) == cross_polytope.buckets(y, t, 6)).mean() for t in range(4)]) for y in (near, far)]
    assert same[0] > 0.4 > 0.1 > same[1]
