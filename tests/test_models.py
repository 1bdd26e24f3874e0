import random

import numpy as np
import pytest
from table_rows import rows
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks import queries
from subscope.operators import classifiers, evaluation, preprocessing, tuning

SMALL = {"numTrees": 5, "maxDepth": 3}


@pytest.fixture(scope="module")
def toy(spark):
    """Two classes that one feature separates."""
    random.seed(0)
    data = []
    for i in range(200):
        y = float(i % 2)
        data.append((f"u{i}", Vectors.dense([y * 3 + random.random(), random.random()]), y))
    return spark.createDataFrame(data, ["user_id", "features", "label"]).cache()


def brute_auc(pairs):
    pos = [p for p, y in pairs if y]
    neg = [p for p, y in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_equals_brute_force_with_ties_and_segments(make):
    random.seed(2)
    data = [(random.choice("ab"), round(random.random(), 1), random.random() < 0.4) for _ in range(300)]
    data += [("c", 0.5, True), ("c", 0.6, True)]
    got = {row["segment"]: row for row in rows(evaluation.segment_auc(make.scored(*data), "score", "label", ["segment"]))}
    for name in "ab":
        pairs = [(p, y) for s, p, y in data if s == name]
        assert got[name]["roc_auc"] == pytest.approx(brute_auc(pairs), abs=1e-6)
        assert got[name]["n"] == len(pairs)
    assert got["c"]["roc_auc"] is None and got["c"]["pr_auc"] is None


def test_metrics_equal_the_evaluators(toy):
    mixed = toy.withColumn("label", F.when(F.crc32("user_id") % 5 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    model = classifiers.train_random_forest(mixed, **SMALL)
    expected = classifiers.evaluator_metrics(model.transform(mixed))
    got = classifiers.evaluate_models({"m": classifiers.predictions(model, mixed)}).first().asDict()
    for name, value in expected.items():
        assert got[name] == pytest.approx(value, abs=1e-6)


def test_logistic_on_separable_data(toy):
    model = classifiers.train_logistic(toy)
    got = classifiers.evaluate_models({"m": classifiers.predictions(model, toy)}).first()
    assert got.roc_auc > 0.9 and got.accuracy > 0.9


def test_boosting_and_forest_are_repeatable(toy):
    for train, settings in ((classifiers.train_random_forest, SMALL), (classifiers.train_gbt, {"maxIter": 3, "maxDepth": 2})):
        first, second = (
            [row.churn_probability for row in classifiers.predictions(train(toy, **settings), toy).collect()]
            for _ in range(2)
        )
        assert first == second
        assert all(0 <= p <= 1 for p in first)


def test_ranking_metrics_share_ties(make):
    data = [("s", 0.9, True), ("s", 0.9, False)] + [("s", 0.1, i < 2) for i in range(8)]
    got = evaluation.ranking_metrics(make.scored(*data), "score", "label").first()
    assert got.precision_at_top == 0.5
    assert got.recall_at_flagged == pytest.approx(1 / 3, abs=1e-6)
    assert got.false_positive_rate == pytest.approx(1 / 7, abs=1e-6)


def test_calibration_bins_and_brier(make):
    data = [("s", 1.0, True), ("s", 0.95, False), ("s", 0.0, False)]
    got = rows(evaluation.calibration(make.scored(*data), "score", "label"))
    assert [(row["bin"], row["n"], row["observed_rate"]) for row in got] == [(0, 1, 0.0), (9, 2, 0.5)]
    assert got[0]["brier_score"] == pytest.approx(0.95**2 / 3, abs=1e-6)


def test_risk_bands(spark):
    df = spark.createDataFrame([(0.29,), (0.3,), (0.69,), (0.7,)], "churn_probability double")
    assert {row["band"]: row["user_count"] for row in rows(evaluation.risk_bands(df))} == {
        "green": 1, "yellow": 2, "red": 1
    }


def test_compare_marks_the_best(spark):
    df = spark.createDataFrame(
        [("a", 0.9, 0.1, 1.0, 1.0, 1.0), ("b", 0.8, 0.2, 1.0, 1.0, 1.0)],
        "model_name string, roc_auc double, pr_auc double, accuracy double, precision double, recall double",
    )
    first, second = rows(evaluation.compare_models(df))
    assert (first["best_roc_auc"], first["best_pr_auc"]) == ("Best ROC-AUC", "")
    assert (second["best_roc_auc"], second["best_pr_auc"]) == ("", "Best PR-AUC")


def test_types_and_fill(spark):
    df = spark.createDataFrame(
        [("u", None, None, None, None)],
        "user_id string, total long, plan_type string, churn_reason string, is_churned boolean",
    )
    assert preprocessing.feature_types(df) == (["total"], ["plan_type"])
    assert preprocessing.fill_missing(df).first().asDict() == {
        "user_id": "u", "total": 0, "plan_type": "unknown", "churn_reason": None, "is_churned": None
    }


def test_preprocessing_scales_and_excludes_leaks(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 9), ("b", 3, "y", 9), ("c", 5, "y", 9)],
        "user_id string, total int, plan_type string, subscription_length_days int",
    )
    numeric, categorical = preprocessing.feature_types(df)
    assert numeric == ["total"]
    fitted = preprocessing.preprocessing(numeric, categorical).fit(df)
    index = [tuple(row) for row in preprocessing.category_index(spark, fitted).collect()]
    assert index == [("plan_type", "y", 0.0), ("plan_type", "x", 1.0)]
    scaled = preprocessing.scaled_values(fitted.transform(df), numeric).orderBy("user_id").collect()
    assert [row.total for row in scaled] == [-1.0, 0.0, 1.0]
    unseen = spark.createDataFrame([("d", 1, "new", 9)], df.schema)
    assert fitted.transform(unseen).select(vector_to_array("features")).count() == 1


def test_split_is_stable_and_near_its_fraction(spark):
    df = spark.range(5000).selectExpr("cast(id as string) user_id")
    train, test = preprocessing.train_test_split(df)
    assert train.count() + test.count() == 5000 and 3900 < train.count() < 4100
    assert train.exceptAll(preprocessing.train_test_split(df.repartition(5))[0]).count() == 0


def test_labels_are_required(spark):
    df = spark.createDataFrame([("a", True, Vectors.dense([1.0])), ("b", None, Vectors.dense([1.0]))],
                               ["user_id", "is_churned", "features"])
    assert [row.user_id for row in preprocessing.labelled(df).collect()] == ["a"]


def test_folds_expand(spark, make):
    subs = make.subscriptions(*[{"user_id": str(i), "subscription_start": f"2023-01-{i + 1:02d}"} for i in range(12)])
    windowed = preprocessing.time_windows(subs, folds=5)
    assert sorted(row.time_window for row in windowed.collect()) == sorted(list(range(6)) * 2)
    sizes = {(row["fold"], row["role"]): row["users"] for row in rows(preprocessing.fold_sizes(windowed, 5))}
    assert sizes[(1, "train")] == 2 and sizes[(5, "train")] == 10 and sizes[(3, "validate")] == 2


def test_tuning_and_its_improvement(spark, toy):
    tuned = tuning.tune_random_forest(toy, folds=2, grid={"numTrees": [2, 4], "maxDepth": [2]}, parallelism=2)
    report = rows(tuning.tuning_results(spark, tuned))
    assert len(report) == 2 and report[0]["mean_roc_auc"] >= report[1]["mean_roc_auc"]
    assert tuning.best_settings(tuned)["maxDepth"] == 2
    scores = classifiers.predictions(tuned.bestModel, toy)
    got = classifiers.tuning_improvement(scores, scores).first()
    assert got.roc_auc_improvement_pct == 0.0 and got.roc_auc > 0.9


def test_default_grid_is_complete():
    from subscope import settings as S

    assert int(np.prod([len(values) for values in S.TUNING_GRID.values()])) == 81


def test_importance_sums_to_one_under_source_names(spark, sf_dir):
    model = classifiers.train_random_forest(queries._training_table(spark, sf_dir), **SMALL)
    importance = classifiers.feature_importance(spark, model, queries._vectors(spark, sf_dir))
    got = rows(importance)
    assert sum(row["importance"] for row in got) == pytest.approx(1.0, abs=1e-9)
    assert not any("_encoded" in row["feature_name"] for row in got)
    share = rows(classifiers.importance_share(importance, top=3))
    assert len(share) == 3
    for row, full in zip(share, got):
        assert row["importance_percentage"] == pytest.approx(100 * full["importance"], abs=0.006)


def test_reloaded_model_scores_alike(spark, sf_dir):
    direct = queries.queries()["score_users"](spark, sf_dir)
    again = queries.queries()["save_and_reload_model"](spark, sf_dir)
    assert direct.exceptAll(again).count() == 0 and direct.count() == again.count() == 15
    for row in direct.collect():
        assert 0 <= row.churn_probability <= 1
        if row.prediction == 1:
            assert row.churn_risk == "high_risk"
        else:
            assert row.churn_risk == ("medium_risk" if row.churn_probability >= 0.3 else "low_risk")


def test_training_files_follow_the_rows(spark, toy, tmp_path, monkeypatch):
    from subscope.operators import preprocessing

    monkeypatch.setattr(preprocessing, "ROWS_PER_FILE", max(1, toy.count() // 4))
    first, second = (preprocessing.write_training(df, str(tmp_path / name)) for name, df in (("a", toy), ("b", toy.repartition(3))))
    assert len(list((tmp_path / "a").glob("part-*.parquet"))) >= 4
    parts = [sorted([r.user_id for r in spark.read.parquet(str(f)).collect()] for f in (tmp_path / name).glob("part-*.parquet")) for name in "ab"]
    assert parts[0] == parts[1] and sum(map(len, parts[0])) == toy.count()
