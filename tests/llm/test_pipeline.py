"""The stages of the pipeline against plain versions, each on its own input."""

import random

import brute
import corpus_pipeline
import public_tokenizers
from test_tokens import check_places, pieces

from subscope.llm.shared import Held


def test_stages_as_brute_force(spark, sf_dir):
    held = Held(spark)
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    docs, texts = source, {r["doc_id"]: r["text"] for r in source.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near duplicates", "benchmark decontamination", "secret scan", "best-fit packing"]

    def run(name):
        nonlocal docs
        docs = held.table(stages[name](spark, docs, sf_dir))
        if name != "best-fit packing":
            assert docs.columns == source.columns
            assert docs.dtypes == source.dtypes
        return docs.collect()

    kept = {r["doc_id"]: r["text"] for r in run("quality rules")}
    assert kept == {i: t for i, t in texts.items() if brute.quality(t)[-1]}
    near = brute.near_duplicates(kept)
    texts = {i: t for i, t in kept.items() if near[i][2]}
    kept = {r["doc_id"]: r["text"] for r in run("near duplicates")}
    assert kept == texts
    leaked = {i for i, _ in brute.contained(texts, items)}
    kept = {r["doc_id"]: r["text"] for r in run("benchmark decontamination")}
    assert kept == {i: t for i, t in texts.items() if i not in leaked}
    before = kept
    found = run("secret scan")
    for r in found:
        base = brute.base_secrets(before[r["doc_id"]])
        assert r["n_chars"] == len(r["text"])
        if base:
            assert r["text"] != before[r["doc_id"]]
            assert all(before[r["doc_id"]][a:b] not in r["text"] for _, a, b in base)
    assert {r["doc_id"] for r in found} == set(before)
    packed = run("best-fit packing")
    rows = [(r["doc_id"], r["text"]) for r in found]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == pieces(rows)
    check_places(packed)


def test_run_gives_the_last_stage(spark, sf_dir):
    first = corpus_pipeline.run(spark, sf_dir)
    assert first.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert first.count() > 0 and public_tokenizers.path("word_bpe_49k.json")


def test_stages_on_tricky_rows(spark, make_docs, tricky, tmp_path):
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (tricky, []):
        docs = make_docs(rows, 1).selectExpr("doc_id", "text", "lang", "'s' AS source", "n AS n_chars")
        for _, stage in corpus_pipeline.STAGES:
            docs = Held(spark).table(stage(spark, docs, str(tmp_path)))
        assert (docs.count() > 0) == bool(rows)


def test_rows_without_an_id_of_their_own(spark, sentence):
    rng = random.Random(4)
    texts = [sentence(rng, 40) for _ in range(5)]
    rows = [(None, texts[0]), (None, texts[1]), (7, texts[1]), (7, texts[1]), (7, texts[2]), (8, texts[3] + " end"), (3, texts[3])]
    rows += [(None, texts[3]), (None, None), (None, None), (9, ""), (2, texts[4])]
    docs = spark.createDataFrame([(i, t, "en", "s", 5) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    found = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert found.columns == docs.columns
    expected = [(None, texts[0]), (7, texts[1]), (7, texts[2]), (3, texts[3]), (None, None), (9, ""), (2, texts[4])]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in found.collect()))) == sorted(map(str, expected))
