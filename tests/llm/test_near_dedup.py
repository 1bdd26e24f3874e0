import random

import brute
import numpy as np
import pytest

from subscope.llm import components, near_dedup
from subscope.llm.shared import Held


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_tricky_rows(make_docs, tricky):
    docs = dict(tricky)
    assert result(near_dedup.near_duplicates(make_docs(tricky + [(None, "one two three")]))) == brute.near_duplicates(docs)


def test_empty_table(make_docs):
    assert result(near_dedup.near_duplicates(make_docs([], 1))) == {}


def test_repeated_ids_take_the_longest_text(make_docs):
    rows = [(1, "a b c d e"), (1, "a b c d e f g"), (2, "a b c d e f g"), (1, None)]
    assert result(near_dedup.near_duplicates(make_docs(rows))) == {1: (3, 1, True), 2: (3, 1, False)}


def mutants(rng, sentence, groups, copies):
    rows = []
    for _ in range(groups):
        base = sentence(rng, rng.randint(30, 150)).split(" ")
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = sentence(rng, 1) + "x"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("groups, copies", [(30, 4), (2, 60)])
def test_mutated_copies_as_brute_force(make_docs, sentence, groups, copies):
    rows = mutants(random.Random(groups), sentence, groups, copies)
    assert result(near_dedup.near_duplicates(make_docs(rows))) == brute.near_duplicates(dict(rows))


def test_shared_boilerplate_cuts_windows_but_no_links(make_docs, sentence, monkeypatch):
    """Many unlike documents share most of their words; the windows are cut off, the exact search finds the rest."""
    monkeypatch.setattr(near_dedup, "WINDOW", 1)
    monkeypatch.setattr(near_dedup, "CUT_TREES", 1)
    rng = random.Random(3)
    common = sentence(rng, 60)
    rows = [(i, common + " " + sentence(rng, 40)) for i in range(40)]
    rows += [(100 + i, rows[i][1] + " tail of its own") for i in range(0, 40, 5)]
    assert result(near_dedup.near_duplicates(make_docs(rows))) == brute.near_duplicates(dict(rows))


def test_a_third_of_all_rows_is_nearly_alike(spark, make_docs, sentence, monkeypatch):
    """Rows alike by 0.6 to 0.7, no two of them linked: the candidates and all joins on them follow the number of sets."""
    rng = random.Random(11)
    common = sentence(rng, 120).split(" ")
    rows = [(i, sentence(rng, 60)) for i in range(200)]
    for i in range(100):
        words = list(common)
        for at in rng.sample(range(0, 120, 5), 4):
            words[at] = sentence(rng, 1) + "x"
        rows.append((1000 + i, " ".join(words)))
    sizes = []
    for name in ("_apart", "_confirmed"):
        plain = getattr(near_dedup, name)

        def counted(pairs, other, plain=plain):
            sizes.append(pairs.count())
            return plain(pairs, other)

        monkeypatch.setattr(near_dedup, name, counted)
    assert result(near_dedup.near_duplicates(make_docs(rows))) == brute.near_duplicates(dict(rows))
    assert max(sizes) <= near_dedup.WINDOW * near_dedup.TREES * 100


@pytest.mark.parametrize("shared, own", [(3, 1), (30, 10), (300, 100)])
def test_sketches_of_alike_sets_agree(shared, own):
    """A quarter of the union is in one of the two sets only: the threshold itself."""
    rng = np.random.default_rng(shared)
    for _ in range(300):
        union = rng.integers(0, 2**64, shared + own, dtype=np.uint64)
        one, two = union[: shared + own // 2], np.concatenate([union[:shared], union[shared + own // 2 :]])
        sketches = [np.frombuffer(near_dedup._signature(x)[1], dtype=np.uint64).reshape(1, -1) for x in (one, two)]
        assert near_dedup._agreed(*sketches)[0] >= near_dedup.LEAST_AGREED


def test_query_as_brute_force(spark, sf_dir):
    from subscope.llm import queries

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert result(queries.op4_minhash_near_dedup(spark, sf_dir)) == brute.near_duplicates(docs)


@pytest.mark.parametrize("per_task", [3, 250_000])
def test_components(spark, monkeypatch, per_task):
    monkeypatch.setattr(components, "EDGES_PER_TASK", per_task)
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(30)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(35)]
    edges += [(200, x) for x in range(201, 230)] + [(5, 5), (230, 200)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(4)
    found = {r["node"]: r["root"] for r in components.components(spark, Held(spark), df).collect()}
    nodes = {x for edge in edges for x in edge}
    expected = brute.components(nodes, edges)
    assert {n: found.get(n, n) for n in nodes} == expected
