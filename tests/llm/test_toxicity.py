import math
import random
from zlib import crc32

import numpy as np
import pytest

from subscope.llm import toxicity
from subscope.llm.toxicity import Chain, _moves


def test_marginals_as_token_by_token():
    rng = np.random.default_rng(1)
    weights = rng.normal(0, 1.5, toxicity._SIZE)
    chain, moves, emit = Chain(weights), _moves(weights), Chain(weights).emit
    for _ in range(30):
        codes = [int(c) if rng.random() < 0.2 else 0 for c in rng.integers(0, 36, rng.integers(1, 60))]
        both = [np.array([1.0, emit[c]]) for c in codes]
        alpha, beta = [np.array([1.0, chain.start]) * both[0]], [np.ones(2)]
        for x in both[1:]:
            alpha.append((alpha[-1] @ moves) * x)
        for x in reversed(both[1:]):
            beta.append(moves @ (x * beta[-1]))
        post = [a * b for a, b in zip(alpha, reversed(beta))]
        expected = {i: post[i][1] / post[i].sum() for i, c in enumerate(codes) if c}
        found = dict(chain.marginals(codes))
        assert found.keys() == expected.keys()
        assert all(abs(found[i] - expected[i]) < 1e-6 for i in found)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 36, (3, 5))
    labels = rng.integers(0, 2, (3, 5)).astype(float)
    mask = np.ones((3, 5), dtype=bool)
    mask[1, 3:] = False
    weights = rng.normal(0, 0.5, toxicity._SIZE)

    def likelihood(w):
        total = 0.0
        emit = toxicity._emission(w, codes)
        moves = np.log(_moves(w))
        for i in range(3):
            n = int(mask[i].sum())
            scores = []
            for path in np.ndindex(*(2,) * n):
                s = sum(emit[i, t] * path[t] for t in range(n)) + w[-1] * path[0]
                scores.append(s + sum(moves[path[t - 1], path[t]] for t in range(1, n)))
                if list(path) == labels[i, :n].astype(int).tolist():
                    own = scores[-1]
            total += own - math.log(sum(map(math.exp, scores)))
        return total / mask.sum()

    slope = toxicity._gradient(weights, codes, labels * mask, mask)
    for k in range(toxicity._SIZE):
        step = np.zeros(toxicity._SIZE)
        step[k] = 1e-5
        assert abs((likelihood(weights + step) - likelihood(weights - step)) / 2e-5 - slope[k]) < 1e-6


def area(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_held_out_documents_are_told_apart(spark):
    """On a whole table: the labels of the held-out quarter are not used."""
    from subscope.llm import queries

    sf_dir = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = queries.op9_toxicity(spark, sf_dir).collect()
    assert len(found) == 10000
    for r in found:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    assert area([(r["score"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]) > 0.95


@pytest.fixture(scope="module")
def toy(sentence):
    rng = random.Random(7)
    rows = [(i, sentence(rng, 30) + (" you foul wretch. " if i % 4 == 0 else " ") + sentence(rng, 20)) for i in range(400)]
    return rows, [(i, int(i % 4 == 0), 1) for i in range(300)]


def test_spans_point_at_the_toxic_words(spark, make_docs, toy):
    rows, known = toy
    labels = spark.createDataFrame(known + [(None, 1, 1), (3, None, 0)], "doc_id long, toxic int, text int")
    texts = dict(rows)
    for r in toxicity.scored(make_docs(rows), labels).collect():
        assert r["predicted"] == int(r["doc_id"] % 4 == 0)
        words = {texts[r["doc_id"]][int(a) : int(b)] for a, b in (s.split(":") for s in r["spans"].split(",") if s)}
        assert words <= {"you", "foul", "wretch."} and (len(words) >= 2) == (r["doc_id"] % 4 == 0)


def test_labels_of_held_out_rows_change_nothing(spark, make_docs, toy):
    rows, known = toy
    other = [(i, 1 - y if crc32(str(i).encode()) % 4 == 2 else y, 1) for i, y, _ in known]
    schema = "doc_id long, toxic int, lang int"
    one, two = (
        sorted((r["doc_id"], r["score"]) for r in toxicity.scored(make_docs(rows), spark.createDataFrame(x, schema)).collect())
        for x in (known, other)
    )
    assert one == two


def test_tricky_rows_and_missing_labels(spark, make_docs, tricky, toy):
    labels = spark.createDataFrame(toy[1], "doc_id long, toxic int, text int")
    rows = tricky + [(1000 + i, t) for i, t in toy[0][:80]]
    labels = labels.selectExpr("doc_id + 1000 AS doc_id", "toxic")
    found = toxicity.scored(make_docs(rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    none = labels.where("false")
    assert {r["score"] < 1e-9 for r in toxicity.scored(make_docs(tricky), none).collect()} == {True}
    assert toxicity.scored(make_docs([], 1), labels).count() == 0
